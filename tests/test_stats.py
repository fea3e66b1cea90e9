import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import exchanges, rows
from quantelle.design import Contrast, Design
from quantelle.functions.tails import f_sf, f_tail
from quantelle.operators import clean, profiles, reshape, stats, summaries

DESIGN = Design.from_counts({"A": 3, "B": 3, "C": 2})
LONG = "id string, condition string, replicate int, abundance double"


def long_table(spark, table):
    return spark.createDataFrame(
        [(i, s.condition, s.replicate, None if v is None else float(v))
         for i, values in table.items() for s, v in zip(DESIGN.samples, values)], LONG)


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(5)
    return {f"id{i:03d}": list(rng.normal(20, 2, size=8)) for i in range(60)}


def test_tail_closed_forms():
    f = np.array([0.0, 1e-3, 0.5, 1, 4, 40, 1e4, 1e8])
    np.testing.assert_allclose(f_tail(f, np.full(8, 2.0), np.full(8, 9.0)), (9 / (9 + 2 * f)) ** 4.5, rtol=1e-11)
    t = np.sqrt(f)
    theta = np.arctan(t / math.sqrt(6))
    c2 = np.cos(theta) ** 2
    want = 1 - np.sin(theta) * (1 + c2 / 2 + 3 * c2 * c2 / 8)
    np.testing.assert_allclose(f_tail(f, np.ones(8), np.full(8, 6.0)), want, atol=1e-12)
    np.testing.assert_allclose(f_tail(f, np.ones(8), np.ones(8)), 1 - 2 / np.pi * np.arctan(t), atol=1e-12)
    assert f_tail(np.array([np.inf]), np.array([1.0]), np.array([3.0]))[0] == 0


def test_tail_of_missing_values_is_null(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0), (1.0, None, 2.0), (1.0, 1.0, 0.0), (1.0, 2.0, 2.0)],
                               "f double, a double, b double")
    assert [r.p for r in df.select(f_sf("f", "a", "b").alias("p")).collect()] == [None, None, None, 0.5]


def test_ttest_and_anova_by_hand(spark, matrix):
    df = long_table(spark, matrix)
    got = {(r.id, r.comparison): r for r in stats.compare(df, DESIGN.all_contrasts()).collect()}
    aov = {r.id: r for r in stats.anova(df, DESIGN.conditions).collect()}
    for i, values in matrix.items():
        a, b, c = np.array(values[:3]), np.array(values[3:6]), np.array(values[6:])
        for name, x, y in (("A-B", a, b), ("A-C", a, c), ("B-C", b, c)):
            dof = len(x) + len(y) - 2
            pooled = ((len(x) - 1) * x.var(ddof=1) + (len(y) - 1) * y.var(ddof=1)) / dof
            t = (y.mean() - x.mean()) / math.sqrt(pooled * (1 / len(x) + 1 / len(y)))
            r = got[i, name]
            assert r.fc == pytest.approx(y.mean() - x.mean())
            assert r.t == pytest.approx(t) and r.dof == dof
            assert r.p_value == pytest.approx(f_tail(np.array([t * t]), np.ones(1), np.array([dof]))[0])
        grand = np.mean(values)
        ssb = sum(len(g) * (g.mean() - grand) ** 2 for g in (a, b, c))
        ssw = sum(((g - g.mean()) ** 2).sum() for g in (a, b, c))
        assert aov[i].f == pytest.approx((ssb / 2) / (ssw / 5))
        assert aov[i].p_value == pytest.approx((5 / (5 + 2 * aov[i].f)) ** 2.5)


def test_undefined_tests_are_null(spark):
    df = long_table(spark, {"flat": [5] * 8, "step": [5, 5, 5, 7, 7, 7, 9, 9], "gap": [1, 2, 3] + [None] * 5})
    got = {(r.id, r.comparison): r.p_value for r in stats.compare(df, DESIGN.all_contrasts()).collect()}
    assert set(got.values()) == {None}
    assert {r.p_value for r in stats.anova(df, DESIGN.conditions).collect()} == {None}


def test_unbalanced_and_null_cells(spark):
    df = long_table(spark, {"x": [1.0, 2.0, None, 4.0, None, 5.0, None, 9.0]})
    r = stats.compare(df, [Contrast("A", "B")]).first()
    assert (r.fc, r.dof) == (3.0, 2.0)
    a = stats.anova(df, DESIGN.conditions).first()
    assert (a.dof1, a.dof2) == (2.0, 2.0)


def test_by_keys_separate_experiments(spark, matrix):
    one = long_table(spark, matrix)
    both = one.withColumn("experiment", F.lit("e1")).unionByName(
        one.where("id < 'id030'").withColumn("experiment", F.lit("e2")))
    alone = stats.calculate_ttest(one.where("id < 'id030'"), DESIGN.all_contrasts())
    joint = stats.calculate_ttest(both, DESIGN.all_contrasts(), by=["experiment"]).where("experiment = 'e2'")
    key = ["id", "comparison"]
    a = rows(alone.select(*key, F.round("fdr", 12)), *key)
    assert a == rows(joint.select(*key, F.round("fdr", 12)), *key)


def test_results_do_not_depend_on_partitioning(spark, matrix):
    df = long_table(spark, matrix)
    one = stats.calculate_ttest(df.repartition(1), DESIGN.all_contrasts())
    many = stats.calculate_ttest(df.repartition(13), DESIGN.all_contrasts(), partitions=7)
    key = ["id", "comparison"]
    assert rows(one.select(*key, F.round("fdr", 12)), *key) == rows(many.select(*key, F.round("fdr", 12)), *key)


def test_fc_max_prefers_the_negative_of_equal_magnitudes(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", -2.0), ("b", 3.0), ("b", 1.0), ("c", 1.0), ("c", None)], "id string, fc double")
    assert rows(stats.add_fc_max(df), "id") == [("a", -2.0), ("b", 3.0), ("c", None)]


def test_zscores(spark, matrix):
    got = {(r.id, r.condition): r.z for r in stats.zscore_profiles(long_table(spark, matrix), DESIGN.conditions).collect()}
    for i, v in matrix.items():
        means = np.array([np.mean(v[:3]), np.mean(v[3:6]), np.mean(v[6:])])
        want = (means - means.mean()) / means.std(ddof=1)
        np.testing.assert_allclose([got[i, c] for c in "ABC"], want, atol=1e-9)


def test_sample_structure_equals_numpy(spark, matrix):
    df = long_table(spark, matrix)
    x = np.array(list(matrix.values()))
    names = DESIGN.names
    r = {(q.sample1, q.sample2): q.r for q in profiles.sample_correlation(df, DESIGN).collect()}
    want = np.corrcoef(x.T)
    np.testing.assert_allclose([[r[a, b] for b in names] for a in names], want, atol=1e-9)
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    d = {(q.sample1, q.sample2): q.distance for q in profiles.sample_distance(df, DESIGN).collect()}
    want = np.linalg.norm(z.T[:, None, :] - z.T[None, :, :], axis=2)
    np.testing.assert_allclose([[d[a, b] for b in names] for a in names], want, atol=1e-6)
    got = np.array([[q.pc1, q.pc2] for q in profiles.pca_loadings(df, DESIGN).collect()])
    _, _, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    np.testing.assert_allclose(np.abs(got), np.abs(vt[:2].T), atol=1e-6)
    assert all(got[np.abs(got[:, j]).argmax(), j] > 0 for j in (0, 1))


def test_clusters_cover_all_varying_profiles(spark):
    table = {f"u{i}": [1, 1, 1, 5, 5, 5 + i / 100, 9, 9] for i in range(10)}
    table |= {f"d{i}": [9, 9, 9, 5, 5, 5 + i / 100, 1, 1] for i in range(10)}
    table["flat"] = [3] * 8
    got = profiles.cluster_profiles(long_table(spark, table), DESIGN.conditions, 2)
    labels = {r.id: r.cluster for r in got.collect()}
    assert len(labels) == 20 and "flat" not in labels
    assert {labels[f"d{i}"] for i in range(10)} == {"A"} and {labels[f"u{i}"] for i in range(10)} == {"B"}
    sizes = {r.cluster_count for r in profiles.cluster_profile_long(got, DESIGN.conditions).collect()}
    assert sizes == {"A\n10", "B\n10"}
    assert profiles.cluster_profiles(long_table(spark, {"a": [1, 1, 1, 2, 2, 2, 3, 3]}), DESIGN.conditions, 3).count() == 1


def test_one_exchange_from_cells_to_statistics(spark, matrix):
    """Dense grid, cleaning, transformation, moments and effects share the exchange on the id."""
    cells = long_table(spark, matrix)
    logged = clean.transform_data(clean.clean_min(reshape.densify(cells, DESIGN), 2))
    assert exchanges(stats.compare(logged, DESIGN.all_contrasts())) == 1
    assert exchanges(stats.anova(logged, DESIGN.conditions)) == 1
    assert exchanges(stats.add_fc_max(stats.calculate_fc(logged, DESIGN.all_contrasts()))) == 1
    assert exchanges(stats.zscore_profiles(clean.impute_within(logged, "center"), DESIGN.conditions)) == 1


def test_volcano_rules(spark):
    df = spark.createDataFrame(
        [("a", "A-B", -1.0, 0.04), ("b", "A-B", 1.0, 0.04), ("c", "A-B", 1.0, 0.05), ("d", "A-B", 5.0, None),
         ("e", "A-B", 0.1, None)], "id string, comparison string, fc double, fdr double").withColumn("p_value", F.col("fdr"))
    v = summaries.volcano_classify(df, threshold=2)
    assert [r.type for r in v.orderBy("id").collect()] == ["down", "up", "same", None, "same"]
    assert summaries.volcano_counts(v).first().label == "A-B\nDown 1 / Up 1"


def test_spiked_ids_are_recovered(spark):
    """Known positives: ids with a 16-fold change are found, and few of the others."""
    rng = np.random.default_rng(11)
    table = {}
    for i in range(200):
        base = rng.normal(20, 2)
        shift = 4.0 if i < 20 else 0.0
        table[f"{'P' if i < 20 else 'N'}_{i}"] = [base + shift * (k in (3, 4, 5)) + rng.normal(0, 0.2) for k in range(8)]
    tested = stats.calculate_ttest(long_table(spark, table), [Contrast("A", "B")])
    hits = [r.id for r in tested.where("fdr < 0.05 and abs(fc) >= 1").collect()]
    assert sum(h.startswith("P_") for h in hits) == 20 and sum(h.startswith("N_") for h in hits) == 0


def test_samples_with_gaps_are_compared_over_common_ids(spark):
    rng = np.random.default_rng(12)
    values = rng.normal(size=(200, len(DESIGN.names))) * 3 + 1e6
    values[:, 1] += values[:, 0] - 1e6
    holes = rng.uniform(size=values.shape) < 0.2
    holes[:, -1] = True  # a sample without values
    rows = [(i, s.condition, s.replicate, None if holes[i, j] else float(values[i, j])) for i in range(200) for j, s in enumerate(DESIGN.samples)]
    df = spark.createDataFrame(rows, "id int, condition string, replicate int, abundance double").repartition(7)
    moments = profiles.sample_moments(df, DESIGN)
    for i in range(3):
        for j in range(3):
            both = ~holes[:, i] & ~holes[:, j]
            assert moments.n[i, j] == both.sum()
            assert moments.correlation[i, j] == pytest.approx(np.corrcoef(values[both, i], values[both, j])[0, 1], abs=1e-9)
            assert moments.covariance[i, j] == pytest.approx(np.cov(values[both, i], values[both, j])[0, 1], rel=1e-8)
    told = {(r.sample1, r.sample2): r.r for r in profiles.sample_correlation(df, DESIGN, moments=moments).collect()}
    assert told[DESIGN.names[0], DESIGN.names[-1]] is None and told[DESIGN.names[0], DESIGN.names[0]] == pytest.approx(1.0)


def test_clusters_do_not_depend_on_placement(spark):
    rng = np.random.default_rng(2)
    shapes = np.array([[0, 5, 9], [9, 4, 0], [5, 0, 5]])
    rows = [(f"p{i:03}", c, r, float(shapes[i % 3][j] + rng.normal() * 0.3)) for i in range(90) for j, c in enumerate("ANR") for r in range(1, 5)]
    rows += [("flat", c, 1, 1.0) for c in "ANR"]
    df = spark.createDataFrame(rows, "id string, condition string, replicate int, abundance double")
    found = [{r.id: r.cluster for r in profiles.cluster_profiles(df.repartition(n), ["A", "N", "R"], 3).collect()} for n in (1, 6)]
    assert found[0] == found[1] and "flat" not in found[0]
    assert all(found[0][f"p{i:03}"] == found[0][f"p{i % 3:03}"] for i in range(90)) and len(set(found[0].values())) == 3
    few = profiles.cluster_profiles(df.where("id IN ('p000', 'p001')"), ["A", "N", "R"], 5)
    assert sorted(r.cluster for r in few.collect()) == ["A", "B"]
    assert profiles.cluster_profiles(df.where("id = 'none'"), ["A", "N", "R"], 3).collect() == []

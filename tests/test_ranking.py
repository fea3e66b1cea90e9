import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import physical
from quantelle.operators import keys, ranking


def sequential_bh(p):
    """Textbook definition; NaN counts towards the number of tests."""
    m = len(p)
    out = np.full(m, np.nan)
    order = np.argsort(p)  # NaN last
    best = 1.0
    for rank in range(int(np.sum(~np.isnan(p))), 0, -1):
        i = order[rank - 1]
        best = min(best, p[i] * m / rank)
        out[i] = best
    return out


@pytest.fixture(scope="module")
def tests_table(spark):
    rng = np.random.default_rng(7)
    data = []
    for family, n in (("a", 4000), ("b", 900), (None, 300)):
        p = rng.uniform(size=n) ** 2
        p[: n // 3] = 0.25  # a third are copies
        p[-5:] = np.nan
        data += [(family, i, None if np.isnan(v) else float(v)) for i, v in enumerate(p)]
    return spark.createDataFrame(data, "family string, id int, p double"), data


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_bh_equals_sequential_definition(tests_table, partitions):
    df, data = tests_table
    got = {(r.family, r.id): r.q for r in
           ranking.adjust_bh(df, "p", ["family"], ["id"], "q", partitions).collect()}
    assert len(got) == len(data)
    for family in ("a", "b", None):
        mine = [(i, np.nan if p is None else p) for f, i, p in data if f == family]
        want = sequential_bh(np.array([p for _, p in mine]))
        have = np.array([np.nan if got[family, i] is None else got[family, i] for i, _ in mine])
        np.testing.assert_allclose(have, want, rtol=1e-12, equal_nan=True)


def test_bh_small_families_and_shuffle_join(tests_table, monkeypatch):
    df, _ = tests_table
    key = ["family", "id", "q"]
    large = ranking.adjust_bh(df, "p", ["family"], ["id"], "q")
    monkeypatch.setattr(keys, "MAX_BROADCAST_ROWS", 0)
    joined = ranking.adjust_bh(df, "p", ["family"], ["id"], "q")
    small = ranking.adjust_bh_small(df, "p", ["family"], "q")

    def table(d):
        return sorted((str(r.family), r.id, -1.0 if r.q is None else round(r.q, 12)) for r in d.select(*key).collect())

    assert table(large) == table(small) == table(joined)


def test_bh_never_gathers_a_family(tests_table):
    df, _ = tests_table
    plan = physical(ranking.adjust_bh(df, "p", ["family"], ["id"], "q"))
    assert "SinglePartition" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") <= 2  # ranks are pinned; rows meet them once


def test_bh_of_extreme_and_few_values(spark):
    ps = [0.0, 0.0, 1e-300, 5e-324, 1.0, 1.0, 0.5, 0.5000001]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(ps)] + [(99, None)], "id int, p double")
    got = {r.id: r.q for r in ranking.adjust_bh(df, "p", (), ["id"], "q").collect()}
    want = sequential_bh(np.array([*ps, np.nan]))
    assert [got[i] for i in range(len(ps))] == pytest.approx(list(want[:-1]), rel=1e-12) and got[99] is None
    assert ranking.adjust_bh(df.where("id < 0"), "p", (), ["id"], "q").collect() == []


@pytest.mark.parametrize("limit", [10, 0])
def test_exact_quantiles_with_brackets(spark, monkeypatch, limit):
    monkeypatch.setattr(keys, "MAX_BROADCAST_ROWS", limit)
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=3000), np.full(1500, 0.5), rng.exponential(size=31)])
    rng.shuffle(values)
    data = [("g", float(v)) for v in values] + [("h", float(v)) for v in range(7)] + [("g", None), ("n", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    probs = {"lo": 0.0, "q1": 0.25, "mid": 0.5, "q9": 0.9, "hi": 1.0}
    got = {r.g: r for r in ranking.exact_quantiles(df, "v", ["g"], probs, limit=100, bins=16).collect()}
    assert set(got) == {"g", "h"}
    for name, p in probs.items():
        assert got["g"][name] == pytest.approx(np.quantile(values, p), abs=1e-12)
        assert got["h"][name] == pytest.approx(np.quantile(np.arange(7), p), abs=1e-12)


def test_quantiles_gather_no_group(spark):
    """Cells and values are counted before the shuffle; no sketch, no percentile, no error is raised."""
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.pow(F.lit(1.01), F.col("id") % 1500).alias("v"))
    got = ranking.exact_quantiles(df, "v", ["g"], {"a": 0.1, "b": 0.999}, limit=50, bins=8)
    plan = physical(got)
    assert "SinglePartition" not in plan and "percentile" not in plan and "raise_error" not in plan
    want = {g: [float(np.quantile([1.01 ** (i % 1500) for i in range(g, 5000, 2)], q)) for q in (0.1, 0.999)] for g in (0, 1)}
    for r in got.collect():
        assert [r.a, r.b] == pytest.approx(want[r.g], rel=1e-12)


def test_quantiles_of_ties_extremes_and_one_group(spark):
    rows = [(1.0,)] * 700 + [(1e300,)] * 300 + [(-1e300,), (float("inf"),), (float("-inf"),)]
    df = spark.createDataFrame(rows, "v double")
    got = ranking.exact_quantiles(df, "v", [], {"m": 0.5, "q": 0.9, "lo": 0.001}, limit=10, bins=4).first()
    assert (got.m, got.q, got.lo) == (1.0, 1e300, pytest.approx(-1e300, rel=0.01))
    assert [r.m for r in ranking.exact_quantiles(df.where("v IS NULL"), "v", [], {"m": 0.5}).collect()] == [None]


def test_quantile_groups_may_be_null(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("x", 3.0)], "g string, v double")
    got = {r.g: r.m for r in ranking.exact_quantiles(df, "v", ["g"], {"m": 0.5}).collect()}
    assert got == {None: 1.5, "x": 3.0}


def test_top_k_is_pruned_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    top = ranking.top_k_per_group(df, ["g"], [F.col("v").desc()], 2)
    assert sorted(tuple(r) for r in top.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    assert physical(top).count("WindowGroupLimit") == 2

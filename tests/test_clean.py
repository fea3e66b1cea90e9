import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from quantelle.design import Design
from quantelle.operators import clean, reshape
from quantelle.plans import workflows

DESIGN = Design.from_counts({"A": 3, "B-x": 3})  # a dash inside a condition is allowed
LONG = "id string, condition string, replicate int, abundance double"


def long_table(spark, table):
    return spark.createDataFrame(
        [(i, s.condition, s.replicate, None if v is None else float(v))
         for i, values in table.items() for s, v in zip(DESIGN.samples, values)], LONG)


def ids(df):
    return sorted({r.id for r in df.select("id").collect()})


def test_zero_and_null_are_missing(spark):
    df = long_table(spark, {"a": [1, 2, 0, 0, 0, 0], "b": [1, 0, 0, 1, 0, 0], "c": [0, 0, 0, 4, 5, 6],
                            "d": [1, 2, None, None, None, None]})
    assert ids(clean.clean_min(df, 2)) == ["a", "c", "d"]
    assert ids(clean.clean_min(df, 3)) == ["c"]


def test_log2_maps_missing_to_zero(spark):
    df = long_table(spark, {"a": [8, 1, 0, -4, None, 2]})
    got = [r.abundance for r in clean.transform_data(df).orderBy("condition", "replicate").collect()]
    assert got == [3.0, 0.0, 0.0, 0.0, 0.0, 1.0]
    with pytest.raises(ValueError):
        clean.transform_data(df, "ln")


@pytest.fixture(scope="module")
def observed(spark):
    rng = np.random.default_rng(2)
    table = {}
    for i in range(300):
        v = rng.normal(20, 1, size=6)
        v[rng.uniform(size=6) < 0.25] = 0
        if i % 10 == 0:
            v[3:] = 0
        table[f"id{i}"] = list(v)
    return clean.clean_min(long_table(spark, table), 1)


@pytest.mark.parametrize("mode", ["center", "draw"])
def test_imputation_completes_and_keeps_observations(observed, mode):
    done = clean.impute(observed, mode)
    both = observed.alias("x").join(done.alias("y"), ["id", "condition", "replicate"]).select(
        F.col("x.abundance").alias("x"), F.col("y.abundance").alias("y"))
    assert both.count() == observed.count()
    assert both.where("y is null or y = 0").count() == 0
    assert both.where("x <> 0 and x <> y").count() == 0


def test_draws_depend_on_the_seed_and_not_on_partitions(observed):
    key = ["id", "condition", "replicate"]
    one = rows(clean.impute(observed.repartition(1), "draw").select(*key, F.round("abundance", 9)), *key)
    assert one == rows(clean.impute(observed.repartition(9), "draw").select(*key, F.round("abundance", 9)), *key)
    assert one != rows(clean.impute(observed, "draw", seed=5).select(*key, F.round("abundance", 9)), *key)


def test_absent_conditions_are_filled_low(observed):
    gone = (observed.groupBy("id", "condition").agg(F.max("abundance").alias("m")).where("m = 0").select("id", "condition"))
    filled = clean.impute(observed, "draw").join(gone, ["id", "condition"], "left_semi")
    mean = filled.agg(F.avg("abundance")).first()[0]
    assert filled.count() > 0 and 18 < mean < 20  # around the lower quartile of N(20, 1)


def test_missing_conditions_are_listed_by_name(spark):
    raw = long_table(spark, {"a": [0, 0, 0, 0, 0, 0], "b": [1, 0, 0, 0, 0, 0], "c": [1, 0, 0, 0, 1, 0], "u": [0] * 6})
    tested = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "id string, x int")
    assert rows(clean.add_missingness(tested, raw, DESIGN), "id") == [("a", 1, "A-B-x"), ("b", 2, "B-x"), ("c", 3, None)]


def test_reshaping_round_trip(spark):
    wide = spark.createDataFrame([("p", 1.0, 2.0, 3.0, 4.0, 5.0, 6.0)], ["acc", "x", "x1", "x2", "y", "y1", "y2"])
    named = DESIGN.rename(wide)
    assert named.columns == ["acc", *DESIGN.names]
    back = reshape.to_wide(reshape.to_long(named, DESIGN, "acc"), DESIGN, "acc")
    assert rows(back) == rows(named)
    repeated = wide.toDF("acc", "n", "n", "n", "n", "n", "n")
    assert rows(DESIGN.rename(repeated)) == rows(named)


@pytest.mark.parametrize("limit", [80, 2])
def test_densify_fills_the_grid(spark, monkeypatch, limit):
    monkeypatch.setattr(reshape, "MAX_WIDE_SAMPLES", limit)
    df = spark.createDataFrame([("a", "A", 1, 1.0), ("a", "A", 1, 2.0), ("b", "B-x", 3, 5.0), ("b", "zz", 1, 9.0)], LONG)
    got = {(r.id, r.condition, r.replicate): r.abundance for r in reshape.densify(df, DESIGN).collect()}
    assert len(got) == 12
    assert {k: v for k, v in got.items() if v} == {("a", "A", 1): 3.0, ("b", "B-x", 3): 5.0}


def test_results_long_reads_comparison_before_the_first_underscore(spark):
    df = spark.createDataFrame([("a", 0.1, 0.2, 1.0, 2.0, 3.0)], "id string, `A-B_P` double, `A-B_FDR` double, "
                               "`A-B_FC` double, `A-C_FC` double, FC_max double")
    assert rows(reshape.results_long(df), "comparison") == [("a", "A-B", 0.1, 0.2, 1.0), ("a", "A-C", None, None, 2.0)]


def test_analysis_runs_end_to_end(observed):
    result = workflows.analyze(observed, DESIGN, DESIGN.all_contrasts(), nonzero=2, transform=None, clusters=2, alpha=1.1)
    n = ids(result.abundance)
    assert ids(result.tests) == ids(result.anova) == ids(result.extremes) == n
    assert result.tests.where("p_value between 0 and 1 and fdr between p_value and 1").count() == len(n)
    assert result.extremes.where("missing is not null").count() > 0
    assert 0 < result.clusters.count() <= len(n)


def test_missingness_sums_raw_rows_before_the_join(spark):
    design = Design.from_counts({"A": 2, "N": 2})
    raw = spark.createDataFrame([(i, c, r, 0.0 if (i, c) in ((1, "A"), (3, "N"), (2, "A"), (2, "N")) else 5.0)
                                 for i in range(4) for c in "AN" for r in (1, 2)], "id int, condition string, replicate int, abundance double")
    tested = spark.createDataFrame([(0,), (1,), (2,), (9,)], "id int")
    found = clean.add_missingness(tested, raw, design)
    assert sorted(map(tuple, found.collect())) == [(0, None), (1, "A"), (2, "A-N"), (9, None)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1

"""Rows that are chosen without their samples get them back, and only theirs are shuffled."""

from pyspark.sql import functions as F

from helpers import rows
from quantelle import sources
from quantelle.operators import late, process
from quantelle.plans import exports, inputs, workflows
from quantelle.sources.measurements import PEPTIDE_EXPORT

SAMPLES = [f"s {j}" for j in range(8)]


def source(spark, n=20000):
    n_ = F.col("id")
    return spark.range(n).select(
        F.when(n_ % 7 != 0, n_ % 5000).alias("a"), (n_ % 3).cast("double").alias("b"), F.when(n_ % 2 == 0, F.lit("x")).alias("c"),
        *[(n_ * j).cast("double").alias(s) for j, s in enumerate(SAMPLES)])


def test_fetch_finds_rows_by_keys_with_nulls(spark):
    df = source(spark)
    chosen = df.where("a % 50 = 3 OR (a IS NULL AND b = 1)").select("c", "a", "b").distinct().withColumn("of", F.concat_ws("-", "a", "c"))
    got = late.fetch(chosen, df, SAMPLES, ["a", "b", "c"], ["a"])
    assert got.columns == ["c", "a", "b", "of", *SAMPLES] and got.count() == chosen.count() > 200
    least = {(r.a, r.b, r.c): r.m for r in df.groupBy("a", "b", "c").agg(F.min("s 1").alias("m")).collect()}  # of equal keys
    assert all(r["s 1"] == least[r.a, r.b, r.c] and r["s 7"] == 7 * r["s 1"] for r in got.collect())
    assert late.fetch(chosen.where("false"), df, SAMPLES, ["a", "b", "c"], ["a"]).count() == 0
    twice = late.fetch(chosen.unionByName(chosen), df, SAMPLES, ["a", "b", "c"], ["a"])  # a row with two sites
    assert twice.count() == 2 * chosen.count()


def test_sift_is_a_filter_that_keeps_every_wanted_row(spark):
    df = source(spark, 200000).withColumn("k", F.monotonically_increasing_id())
    wanted = df.where("k % 100 = 7").select("k").distinct().localCheckpoint()
    kept = late.sift(df, wanted, ["k"])
    assert kept.join(wanted, "k", "left_semi").count() == wanted.count() == df.where("k % 100 = 7").count()
    assert kept.count() < wanted.count() + 0.06 * 200000
    joined = spark.range(10).select(F.col("id").alias("b"), F.lit("y").alias("y")).join(source(spark), "b")
    plan = late.sift(joined, wanted.select(F.col("k").alias("a")), ["a"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("hex(")  # before other columns are joined


def test_candidates_compete_without_many_samples(spark, monkeypatch):
    peptides = spark.createDataFrame([
        (1, 1, "20", "ACDE", "[2] Phospho (C)", "P", "kinase", 1.0), (1, 2, "30", "ACDE", "[2] Phospho (C)", "P", "kinase", 2.0),
        (1, 2, "30", "ACDE", "[2] Phospho (C)", "P", "kinase", 2.0),  # the same row twice
        (2, 3, "40", "ACDE", "[2] Phospho (C)", "P", "kinase", 4.0), (3, 4, "---", "FCGH", None, "P", "kinase", 8.0),
        (4, 5, "50", "FCGH", None, "P", "cRAP", 16.0), (5, 6, "50", "FCGH", None, "P", "kinase", 32.0)],
        "feature int, ordinal int, score string, sequence string, modifications string, accession string, "
        "description string, s double").withColumns({s: F.col("s") + j for j, s in enumerate(SAMPLES)}).drop("s")
    proteins = spark.createDataFrame([("P;R", 3, 2, 9.0), ("P", 1, None, 3.0), ("Q", 1, 1, 1.0)],
                                     "accession string, peptide_count int, unique_peptides int, confidence_score double")
    database = spark.createDataFrame([("P", "MACDEFCGHK"), ("Q", "MKKCAAA")], "accession string, sequence string")
    seen = []
    reduce = process.reduce_features
    monkeypatch.setattr(process, "reduce_features", lambda df, *a, **k: seen.append(df) or reduce(df, *a, **k))

    def found():
        return [rows(t.select(t.columns[0], "s 0", "s 7"), t.columns[0]) for t in (
            workflows.phospho_abundance(peptides, proteins, database, SAMPLES), workflows.redox_abundance(peptides, proteins, database, SAMPLES),
            workflows.peptide_abundance(peptides, proteins, SAMPLES))]

    got = found()
    assert got == [[("P--C3", 6.0, 20.0)], [("P--C3", 6.0, 20.0), ("P--C7", 32.0, 39.0)], [("P--ACDE", 6.0, 20.0), ("P--FCGH", 32.0, 39.0)]]
    assert len(seen) == 3 and not any(s in df.columns for df in seen for s in SAMPLES)
    monkeypatch.setattr(late, "FEW_SAMPLES", len(SAMPLES))
    assert found() == got and "s 7" in seen[-1].columns


def test_a_protein_row_per_accession_meets_the_candidates(spark):
    proteins = spark.createDataFrame([("P", 9, None, 9.0), ("P", 1, 2, None), ("P", 1, 2, 4.0), ("P", 1, 1, 8.0), (None, 1, 1, 1.0), ("Q", 1, None, None)],
                                     "accession string, peptide_count int, unique_peptides int, confidence_score double")
    best = process.best_statistics(proteins)
    assert {(r.accession, r.unique_peptides, r.confidence_score) for r in best.collect()} == {("P", 2, 4.0), (None, 1, 1.0), ("Q", None, None)}


def test_the_export_is_compressed_and_ordered_before_it_is_wide(spark, tmp_path):
    items = spark.range(40).select(
        F.col("id").alias("l_orderkey"), (F.col("id") * 7 % 40).alias("l_partkey"), (F.col("id") % 3).alias("l_suppkey"),
        (1 + F.col("id") % 7).cast("int").alias("l_linenumber"), F.lit(20.0).alias("l_quantity"), (F.col("id") + 0.5).alias("l_extendedprice"),
        F.lit(0.1).alias("l_discount"), F.lit(0.02).alias("l_tax"))
    items.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(40).select(F.col("id").alias("p_partkey"), F.lit("hot bolt").alias("p_name")).write.parquet(f"{tmp_path}/part.parquet")
    samples = inputs.DESIGN.names
    path = exports.peptides(spark, str(tmp_path), samples, inputs.as_peptide_samples)
    files = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    assert files and all(f.endswith(".gz") for f in files)
    read = sources.read_measurements(spark, path, samples=range(7, 7 + len(samples)), types={"#": "long"}, columns=PEPTIDE_EXPORT)
    want = inputs.as_peptide_samples(inputs.peptide_rows(spark, str(tmp_path)))
    columns = ["feature", "score", "sequence", "modifications", "accession", "description", *[f"`{s}`" for s in samples]]
    assert rows(read.orderBy("ordinal").select(*columns)) == rows(want.orderBy("ordinal").select(*columns)) and read.count() == 40


def test_labelled_candidates_compete_without_many_samples(spark):
    heavy, light = "C2:N-ethylmaleimide(D5):99.0;M1:Oxidation:1.0", "C2:N-ethylmaleimide:99.0;C4:N-ethylmaleimide:9.0"
    peptides = spark.createDataFrame([
        (1, 1, "P", "K.ACDE.F", None, heavy, 10.0, 1.0), (1, 2, "P", "K.ACDE.F", None, heavy, 5.0, 64.0),  # the worse one of a scan
        (2, 3, "P", "K.ACDC.F", "x", light, 20.0, 9.0), (2, 3, "P", "K.ACDC.F", "x", light, 20.0, 9.0),  # the same row twice
        (3, 4, "P", "M.A(+1)CDE.F", "x", light, 30.0, 0.0), (4, 5, "R", "K.ACDE.F", "x", light, 30.0, 5.0)],  # R: no statistics
        "scan int, ordinal int, accession string, peptide string, ptm string, ascore string, lgp double, s double",
    ).withColumns({s: F.col("s") * (j + 1) for j, s in enumerate(SAMPLES)}).drop("s")
    proteins = spark.createDataFrame([("P", 7.0, 2, "kinase"), ("R", None, 1, "kinase"), ("Q", 1.0, 1, "cRAP")],
                                     "accession string, lgp double, unique_peptides int, description string")
    database = spark.createDataFrame([("P", "MACDEFACDCK"), ("R", "MACDE")], "accession string, sequence string")
    whole = workflows.labelled_sites(workflows.labelled_candidates(peptides, proteins), database, SAMPLES)
    best = workflows.labelled_candidates(peptides, proteins, samples=SAMPLES)
    assert not set(SAMPLES) & set(best.columns)
    got = workflows.labelled_sites(best, database, SAMPLES, source=peptides)
    columns = ["label_identifier", "identifier", "scan", "lgp", "h_or_l", "redox_state", *[f"`{s}`" for s in SAMPLES]]
    assert rows(got.select(columns), "label_identifier") == rows(whole.select(columns), "label_identifier")
    assert [(r.label_identifier, r["s 1"]) for r in got.orderBy("label_identifier").collect()] == [
        ("P--C10-L", 18.0), ("P--C3-H", 2.0), ("P--C3-L", 0.0), ("P--C5-L", 0.0), ("P--C8-L", 18.0)]

"""Measurement views derived from generic order/part/supplier tables.

They give every operator inputs of realistic shape (missing cells, tied scores,
contaminants, grouped accessions) whose size grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..design import Design
from ..operators.reshape import densify, to_wide

DESIGN = Design.from_counts({"A": 4, "N": 4, "R": 4})
CONTRASTS = DESIGN.all_contrasts()
#: Parts whose names make up the sequence of a supplier.
PARTS_HELD = 48


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _part_id(k: Column) -> Column:
    return F.concat(F.lit("P"), k.cast("string"), F.when(k % 20 == 0, F.lit("_UPS")).otherwise(F.lit("")))


def quant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long abundances, 3 conditions x 4 replicates; every 20th id is spiked."""
    items = table(spark, sf_dir, "lineitem").withColumn("replicate", F.pmod(F.col("l_linenumber") - 1, F.lit(4)) + 1)
    cells = items.select(
        _part_id(F.col("l_partkey")).alias("id"),
        F.col("l_returnflag").alias("condition"), "replicate",
        F.col("l_extendedprice").alias("abundance"))
    factor = F.when(F.col("id").endswith("_UPS") & (F.col("condition") == "N"), 16).when(
        F.col("id").endswith("_UPS") & (F.col("condition") == "R"), 4).otherwise(1)
    return densify(cells, DESIGN).withColumn("abundance", F.round(F.col("abundance") * factor, 2))


def quant_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_wide(quant(spark, sf_dir), DESIGN)


def peptide_text(name: Column) -> Column:
    """Peptide letters made from a product name."""
    return F.translate(F.upper(F.replace(name, F.lit(" "), F.lit(""))), "BGL", "CCS")


def _protein(suppkey: Column) -> Column:
    return F.concat(F.lit("sp|S"), suppkey.cast("string"), F.lit("|X"))


def _tag(suppkey: Column) -> Column:
    return F.when(suppkey % 17 == 0, F.lit("cRAP")).otherwise(F.lit("protein"))


#: Position of a peptide row in its export.
PEPTIDE_ORDINAL = "l_partkey * 10000000 + l_linenumber * 1000000 + l_suppkey"


def peptide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table rows that :func:`as_peptides` turns into peptide candidates."""
    return table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))


def as_peptides(rows: DataFrame) -> DataFrame:
    n = F.col("l_linenumber")
    return rows.select(
        F.col("l_orderkey").alias("feature"),
        F.expr(PEPTIDE_ORDINAL).alias("ordinal"),
        F.when(F.col("l_tax") == 0, F.lit("---")).otherwise(F.col("l_quantity").cast("int").cast("string"))
        .alias("score"),
        _protein(F.col("l_suppkey")).alias("accession"),
        peptide_text(F.col("p_name")).alias("sequence"),
        F.when(n % 4 == 0, F.lit(None)).otherwise(F.concat(
            F.lit("["), (1 + n % 4).cast("string"), F.lit("] Phospho (ST)|["), (1 + n % 3).cast("string"),
            F.lit("] Nethylmaleimide (C)|["), (2 + n).cast("string"), F.lit("] Phospho (ST)"))).alias("modifications"),
        _tag(F.col("l_suppkey")).alias("description"),
        F.col("l_extendedprice").alias("s1"), F.col("l_quantity").alias("s2"), F.col("l_discount").alias("s3"))


def peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peptide candidates: several per feature, tied scores, ``---``, NULL modifications."""
    return as_peptides(peptide_rows(spark, sf_dir))


def as_peptide_samples(rows: DataFrame) -> DataFrame:
    """The peptides with one abundance per sample of the design, every fifth one missing;
    those of every fourth supplier differ between conditions."""
    rows = as_peptides(rows)
    for j, sample in enumerate(DESIGN.names):
        factor = F.when((F.col("ordinal") % 4 == 0) & (F.lit(j // 4) == 1), 8).otherwise(1)
        value = F.col("s1") * factor * (10 + (F.col("ordinal") + 7 * j) % 13)
        rows = rows.withColumn(sample, F.when((F.col("feature") + j) % 5 == 0, 0.0).otherwise(value))
    return rows.drop("s1", "s2", "s3")


def proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Protein groups with statistics, some of them NULL."""
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.concat(_protein(s), F.lit(";"), _protein(s + 1)).alias("accession"),
        (F.col("s_nationkey") % 6).alias("peptide_count"),
        F.when(s % 13 != 0, F.col("s_nationkey") % 4).alias("unique_peptides"),
        F.col("s_acctbal").alias("confidence_score"), _tag(s).alias("description"))


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Protein sequences, each made of the peptides of ``PARTS_HELD`` parts in the order of
    their keys, so that some peptides of a protein are not found in it."""
    held = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.explode(F.sequence(F.col("s_suppkey") * 20, F.col("s_suppkey") * 20 + PARTS_HELD - 1)).alias("p_partkey"))
    named = held.join(table(spark, sf_dir, "part").select("p_partkey", peptide_text(F.col("p_name")).alias("pep")), "p_partkey", "left")
    ordered = named.groupBy("s_suppkey").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "pep"))).alias("held"))
    return ordered.select(_protein(F.col("s_suppkey")).alias("accession"),
                          F.concat(F.lit("M"), F.array_join(F.col("held.pep"), "")).alias("sequence"))


def annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n = F.col("s_suppkey"), F.col("s_nationkey")

    def go(number: Column) -> Column:
        return F.concat(F.lit("process "), number.cast("string"), F.lit(" [GO:000000"), number.cast("string"), F.lit("]"))

    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), s.cast("string")).alias("entry"),
        F.when(s % 11 != 0, F.concat(go(n % 5), F.lit("; "), go(5 + s % 4))).alias("go_bp"),
        F.concat(F.lit("a deliberately long molecular function name for truncation "), (n % 3).cast("string"),
                 F.lit(" [GO:0000010]")).alias("go_mf"))


def site_peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flanked peptides with heavy/light site scores, some scores and abundances NULL."""
    rows = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    n, s = F.col("l_linenumber"), F.col("l_suppkey")
    pep = peptide_text(F.col("p_name"))
    heavy = (s % 3 == 2) | ((s % 3 == 1) & (F.col("l_returnflag") == "A"))
    return rows.select(
        (F.col("l_orderkey") * 10 + n).alias("scan"), _protein(s).alias("accession"),
        F.concat(F.when(n % 3 == 0, F.lit("K.")).when(n % 3 == 1, F.lit("R.")).otherwise(F.lit("")),
                 F.substring(pep, 1, 3), F.lit("(+125.05)"), F.substr(pep, F.lit(4)), F.lit(".K")).alias("peptide"),
        F.concat(F.lit("C"), (1 + n % 3).cast("string"), F.lit(":N-ethylmaleimide"),
                 F.when(heavy, F.lit("(D5)")).otherwise(F.lit("")),
                 F.lit(":1000.00;M1:Oxidation:12.50")).alias("ascore"),
        F.when(n != 6, F.col("l_quantity")).alias("lgp"), F.col("l_extendedprice").alias("s1"),
        F.when(F.col("l_orderkey") % 50 != 3, F.col("l_extendedprice") * F.col("l_discount")).alias("s2"))


def labelled_peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same peptides as candidates that compete for their scan."""
    return site_peptides(spark, sf_dir).withColumns({
        "ordinal": F.col("scan") * 1000000 + F.floor("s1"),
        "ptm": F.when(F.col("scan") % 2 == 0, "N-ethylmaleimide"),
        "scan": F.expr("scan div 10")})


def labelled_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The competing labelled peptides with one abundance per sample of the design."""
    rows = labelled_peptides(spark, sf_dir)
    for j, sample in enumerate(DESIGN.names):
        factor = F.when((F.col("scan") % 4 == 0) & (F.lit(j // 4) == 1), 8).otherwise(1)
        value = F.col("s1") * factor * (10 + (3 * F.col("scan") + 7 * j) % 13)
        rows = rows.withColumn(sample, F.when((F.col("scan") + j) % 5 == 0, 0.0).otherwise(value))
    return rows.drop("s1", "s2")


def two_experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long abundances of two experiments ``x`` and ``y`` with the same ids."""
    rows = quant(spark, sf_dir)
    other = F.when(F.col("condition") == "R", F.col("abundance")).otherwise(F.col("abundance") * 3)
    return rows.withColumn("experiment", F.lit("x")).unionByName(rows.withColumns({"experiment": F.lit("y"), "abundance": other}))


def peaks_proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Protein table whose score and modification names clash with those of the peptides."""
    s = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        _protein(s).alias("accession"), F.when(s % 19 != 0, F.col("s_acctbal")).alias("lgp"),
        F.when(s % 13 != 0, F.col("s_nationkey") % 4).alias("unique_peptides"), F.lit("Oxidation").alias("ptm"),
        _tag(s).alias("description"))


def occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long shares between 0 and 1 per (id, condition, replicate): a weighted
    mean per cell, 0 where there is no cell."""
    items = table(spark, sf_dir, "lineitem").withColumn("replicate", F.pmod(F.col("l_linenumber") - 1, F.lit(4)) + 1)
    cells = items.select(
        _part_id(F.col("l_partkey")).alias("id"), F.col("l_returnflag").alias("condition"),
        "replicate", F.col("l_extendedprice").alias("total"),
        (F.col("l_extendedprice") * F.col("l_discount") * 10).alias("heavy"))
    shares = cells.groupBy("id", "condition", "replicate").agg(
        F.round(F.try_divide(F.sum("heavy"), F.sum("total")), 6).alias("abundance"))
    return densify(shares, DESIGN)


def part_terms(spark: SparkSession, sf_dir: str, closed: bool = False) -> DataFrame:
    """One row per id with two annotation terms, NULL for every ninth id; further ids have
    terms but no values. ``closed`` ends every term with ``;`` instead of separating with ``; ``."""
    parts = table(spark, sf_dir, "part").select(_part_id(F.col("p_partkey")).alias("id"), F.col("p_partkey").alias("k"))
    others = table(spark, sf_dir, "supplier").select(F.concat(F.lit("X"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_suppkey").alias("k"))
    k = F.col("k")
    first = F.concat(F.lit("process "), (k % 7).cast("string"))
    second = F.concat(F.lit("process "), (7 + k % 11).cast("string"))
    joined = F.concat(first, F.lit(";"), second, F.lit(";")) if closed else F.concat(first, F.lit("; "), second)
    return parts.unionByName(others).select("id", F.when(k % 9 != 0, joined).alias("Gene ontology (biological process)"))

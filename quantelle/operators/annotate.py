"""Accession parsing, annotation join and annotation-term tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .ranking import first_per_key, top_k_per_group


def add_accession(df: DataFrame, identifier: str = "identifier") -> DataFrame:
    """Split ``Accession--Sites``; further parts are dropped, missing ones NULL."""
    return df.withColumns({"accession": text.piece(F.col(identifier), "--", 1),
                           "sites": text.piece(F.col(identifier), "--", 2)})


def add_annotation(df: DataFrame, annotation: DataFrame, accession: str = "accession", entry: str = "entry"
                   ) -> DataFrame:
    """Reduce the accession to its entry name and LEFT JOIN the annotation table."""
    keyed = annotation.withColumnRenamed(entry, accession)
    return df.withColumn(accession, text.uniprot_entry(F.col(accession))).join(keyed, accession, "left")


def explode_terms(df: DataFrame, column: str = "Gene ontology", accession: str = "accession",
                  ordinal: str | None = None, extra: Sequence[str] = (), width: int = 50) -> DataFrame:
    """One row per (accession, category, term).

    Every accession is used once (its first row). Categories are the columns
    whose name contains ``column``; their label is the text in parentheses. The
    13-character identifier suffix of a term is dropped before it is shortened.
    """
    chosen = [c for c in df.columns if column.lower() in c.lower()]
    if not chosen:
        raise ValueError(f"no column contains {column!r}")
    order = [F.col(ordinal).asc()] if ordinal else [F.col(c).asc_nulls_last() for c in (*extra, *chosen)]
    once = first_per_key(df.select(accession, *extra, *chosen, *([ordinal] if ordinal else [])), [accession], order)
    rows = F.array(*[
        F.struct(F.lit(c.split("(", 1)[1][:-1] if "(" in c else "").alias("category"), F.col(f"`{c}`").alias("_terms"))
        for c in chosen
    ])
    exploded = once.select(accession, *extra, F.inline(rows)).where(F.col("_terms").isNotNull())
    return exploded.select(accession, *extra, "category", F.explode(F.split("_terms", "; ")).alias("term")).withColumn(
        "term", text.truncate(text.drop_last(F.col("term"), 13), width))


def go_top_terms(df: DataFrame, top: int = 5, **options) -> DataFrame:
    """Most frequent terms of each category; equal counts are ordered by name."""
    counts = explode_terms(df, **options).groupBy("category", "term").agg(F.count(F.lit(1)).alias("n"))
    return top_k_per_group(counts, ["category"], [F.col("n").desc(), F.col("term").asc()], top)


def go_top_terms_by_cluster(df: DataFrame, top: int = 5, cluster: str = "cluster", **options) -> DataFrame:
    """Counts per (category, term, cluster) of all terms that are among the top
    of some cluster."""
    counts = explode_terms(df, extra=[cluster], **options).groupBy("category", "term", cluster).agg(
        F.count(F.lit(1)).alias("n"))
    best = top_k_per_group(counts, ["category", cluster], [F.col("n").desc(), F.col("term").asc()], top)
    return counts.join(best.select("term").distinct(), "term", "left_semi")


def term_values(values: DataFrame, annotation: DataFrame, column: str, threshold: int, id: str = "id",
                sep: str = "; ", drop_last: int = 0) -> DataFrame:
    """Per-id values of every annotation term that covers more than ``threshold``
    distinct ids with values, with the label ``<term>\\n<ids>``.

    ``annotation`` holds one row per id; ids without values count for no term. Terms are
    counted on the short (id, term) table before the values are attached, and rare terms
    never reach that join.
    """
    raw = F.col(f"`{column}`")
    valued = annotation.where(raw.isNotNull()).join(values.select(id).distinct(), id, "left_semi")
    terms = valued.select(id, F.explode(F.split(text.drop_last(raw, drop_last) if drop_last else raw, sep)).alias("term"))
    counts = (terms.distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > threshold))
    kept = terms.join(counts, "term").withColumn(
        "term_n", F.concat("term", F.lit("\n"), F.col("n").cast("string")))
    return values.join(kept, id)


def term_profiles(profiles: DataFrame, annotation: DataFrame, column: str = "Gene ontology (biological process)",
                  threshold: int = 10, id: str = "id") -> DataFrame:
    """z-profiles by term; the annotation's closing character is dropped and
    terms are separated by ``;``."""
    return term_values(profiles, annotation, column, threshold, id, sep=";", drop_last=1)


def term_fold_changes(effects: DataFrame, annotation: DataFrame, column: str = "Gene ontology (biological process)",
                      threshold: int = 5, id: str = "id") -> DataFrame:
    return term_values(effects, annotation, column, threshold, id)


def term_heatmap(scaled: DataFrame, annotation: DataFrame, column: str = "Gene ontology", threshold: int = 5,
                 id: str = "id") -> DataFrame:
    return term_values(scaled, annotation, column, threshold, id)

"""Protein sequence databases in FASTA format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_fasta(spark: SparkSession, path: str | Sequence[str], accession_pattern: str | None = None,
               accession_piece: int = 2) -> DataFrame:
    """``(accession, sequence)`` with one row per record.

    Records are split by Spark on ``newline >``, so large files are read in
    parallel and a ``>`` inside a header is harmless. The accession is the header
    up to the first space; with ``accession_pattern`` (for example
    ``[^A-Za-z0-9]+``) it is that piece of the split header instead.
    """
    text = spark.read.option("lineSep", "\n>").text(path if isinstance(path, str) else list(path))
    record = F.regexp_replace("value", r"^>", "")
    parts = F.split(record, "\n", 2)
    header = F.trim(F.regexp_replace(parts.getItem(0), r"\r", ""))
    body = F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))
    if accession_pattern is None:
        accession = F.split(header, " ", 2).getItem(0)
    else:
        accession = F.try_element_at(F.split(header, accession_pattern), F.lit(accession_piece))
    return text.select(accession.alias("accession"), F.regexp_replace(body, r"\s+", "").alias("sequence")).where(
        F.col("accession").isNotNull() & (F.col("accession") != ""))

"""Modification-site and cysteine-site identifiers (array expressions, in-row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..session import drop_finished, pin


def attach_sequence(df: DataFrame, database: DataFrame, accession: str = "accession",
                    protein: str = "protein_sequence", prune: bool = False) -> DataFrame:
    """LEFT JOIN the protein sequence by accession.

    The database is never broadcast by hint: Catalyst broadcasts it when its size
    is small, otherwise both sides shuffle on the accession and adaptive
    execution splits accessions that are much more frequent than others.
    ``prune=True`` first drops proteins that no row refers to.
    """
    db = database.select(F.col("accession").alias(accession), F.col("sequence").alias(protein))
    if prune:
        db = db.join(df.select(accession), accession, "left_semi")
    return df.join(db, accession, "left")


def locate_peptides(df: DataFrame, database: DataFrame, accession: str = "accession",
                    sequence: str = "sequence", out: str = "start") -> DataFrame:
    """1-based start of each peptide in its protein, NULL when it is not found.

    Peptides are looked up once for each protein: the distinct (accession, peptide) pairs
    meet the protein texts, and only the positions are joined back to the rows, which are
    pinned. A text is shuffled once, however many rows refer to its protein.
    """
    rows = pin(df)
    drop_finished(rows.sparkSession)
    pairs = rows.select(accession, sequence).where(F.col(accession).isNotNull() & F.col(sequence).isNotNull()).distinct()
    db = database.select(F.col("accession").alias(accession), F.col("sequence").alias("_protein"))
    found = pairs.join(db, accession).select(accession, sequence, text.find(F.col("_protein"), F.col(sequence)).alias(out))
    return rows.join(found, [accession, sequence], "left").select(*[F.col(f"`{c}`") for c in df.columns], out)


def _bracket_position(modification: Column) -> Column:
    """Number between the brackets of ``[pos] Name (residues)``."""
    return F.regexp_extract(modification, r"\[(.*)\]", 1).try_cast("int")


def _modification_positions(modifications: Column, pattern: str) -> Column:
    parts = F.filter(F.split(modifications, r"\|"), lambda m: m.rlike(pattern))
    return F.transform(parts, _bracket_position)


def phospho_identifier(df: DataFrame, database: DataFrame, mod: str = "Phospho", accession: str = "accession",
                       sequence: str = "sequence", modifications: str = "modifications",
                       out: str = "identifier") -> DataFrame:
    """``Accession--S11-T13``: residue and protein position of every matching
    modification, in listed order.

    Rows without a matching modification are dropped. A peptide that is not part
    of its protein, or a modification without a usable position, gives NULL (see
    :func:`split_located`).
    """
    matching = F.exists(F.split(F.col(modifications), r"\|"), lambda m: m.rlike(mod))
    found = df.where(matching).withColumn("_positions", _modification_positions(F.col(modifications), mod))
    located = locate_peptides(found, database, accession, sequence, "_start")
    sites = F.transform(
        F.col("_positions"),
        lambda p: F.concat(F.substr(F.col(sequence), p, F.lit(1)), (F.col("_start") + p - 1).cast("string")))
    usable = F.col("_start").isNotNull() & F.forall(F.col("_positions"), lambda p: p.isNotNull())
    identifier = F.when(usable, F.concat(F.col(accession), F.lit("--"), F.array_join(sites, "-")))
    return located.withColumn(out, identifier).drop("_positions", "_start")


def _cysteine_positions(sequence: Column) -> Column:
    """1-based positions of every C."""
    indices = F.when(F.length(sequence) > 0, F.sequence(F.lit(1), F.length(sequence))).otherwise(
        F.array().cast("array<int>"))
    return F.filter(indices, lambda i: F.substr(sequence, i, F.lit(1)) == "C")


def redox_identifier(df: DataFrame, database: DataFrame, reduced: str = "Nethylmaleimide",
                     accession: str = "accession", sequence: str = "sequence",
                     modifications: str = "modifications", out: str = "identifier") -> DataFrame:
    """``Accession--C12-C15``: protein positions of the cysteines that are not
    blocked by ``reduced``. NULL when the peptide is not part of its protein."""
    blocked = F.coalesce(_modification_positions(F.col(modifications), reduced), F.array().cast("array<int>"))
    free = F.array_except(_cysteine_positions(F.col(sequence)), blocked)
    located = locate_peptides(df, database, accession, sequence, "_start")
    sites = F.transform(free, lambda p: F.concat(F.lit("C"), (F.col("_start") + p - 1).cast("string")))
    identifier = F.when(F.col("_start").isNotNull(),
                        F.concat(F.col(accession), F.lit("--"), F.array_join(sites, "-")))
    return located.withColumn(out, identifier).drop("_start")


def explode_cys_sites(df: DataFrame, reduced: str = "Nethylmaleimide", sequence: str = "sequence",
                      modifications: str = "modifications", drop_blocked: bool = False) -> DataFrame:
    """One row per cysteine: its position in the peptide and whether it is blocked."""
    blocked = F.coalesce(_modification_positions(F.col(modifications), reduced), F.array().cast("array<int>"))
    sites = df.select(*df.columns, F.explode(_cysteine_positions(F.col(sequence))).alias("cys")).withColumn(
        "blocked", F.array_contains(blocked, F.col("cys")))
    return sites.where(~F.col("blocked")) if drop_blocked else sites


def split_located(df: DataFrame, identifier: str = "identifier") -> tuple[DataFrame, DataFrame]:
    """(rows with an identifier, rejected rows without one)."""
    return df.where(F.col(identifier).isNotNull()), df.where(F.col(identifier).isNull())

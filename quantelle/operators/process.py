"""Row filters and reductions that turn raw identifications into unique identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .keys import key_list, pinned_side, strict_sum
from .ranking import first_per_key

#: Largest table of protein statistics that is broadcast: an accession and a few numbers a row.
MAX_PROTEINS = 1_000_000


# ---------------------------------------------------------------- row filters

def split_accession_group(df: DataFrame, accession: str = "accession", members: str = "group_members") -> DataFrame:
    """``A;B;C`` -> lead accession ``A`` and the remaining members ``B;C`` (NULL if none)."""
    return df.withColumns({members: text.other_accessions(F.col(accession)),
                           accession: text.lead_accession(F.col(accession))})


def explode_accessions(df: DataFrame, accession: str = "accession",
                       keep: Sequence[str] = ("accession", "peptide_count", "unique_peptides", "confidence_score"),
                       ) -> DataFrame:
    """One row per member of an accession group, with the statistics columns only."""
    rest = [c for c in keep if c != accession]
    return df.select(F.explode(F.split(accession, ";")).alias(accession), *rest)


def drop_contaminants(df: DataFrame, description: str = "description", tag: str = "cRAP") -> DataFrame:
    """Keep rows whose description differs from ``tag``; NULL descriptions are dropped."""
    return df.where(F.col(description) != F.lit(tag))


def min_peptide_evidence(df: DataFrame, peptides: str = "peptide_count", unique: str = "unique_peptides",
                         min_peptides: int = 2, min_unique: int = 1) -> DataFrame:
    return df.where((F.col(peptides) >= min_peptides) & (F.col(unique) >= min_unique))


def filter_score(df: DataFrame, score: str = "score", threshold: float = 13) -> DataFrame:
    """Numeric score strictly above the threshold; ``---`` and other text are dropped."""
    return df.withColumn(score, F.col(score).try_cast("double")).where(F.col(score) > F.lit(float(threshold)))


def filter_modified(df: DataFrame, pattern: str, modifications: str = "modifications") -> DataFrame:
    return df.where(F.col(modifications).rlike(pattern))


def filter_redox(df: DataFrame, reduced: str = "Nethylmaleimide", sequence: str = "sequence",
                 modifications: str = "modifications") -> DataFrame:
    """Peptides with more cysteines than blocked (``reduced``) cysteines."""
    filled = df.withColumn(modifications, F.coalesce(F.col(modifications), F.lit("")))
    cysteines = F.regexp_count(F.col(sequence), F.lit("C"))
    return filled.where(cysteines > F.regexp_count(F.col(modifications), F.lit(reduced)))


def select_abundance(df: DataFrame, id: str, samples: Sequence[str]) -> DataFrame:
    """Identifier and sample columns only (the shape analysis starts from)."""
    return df.select(id, *[F.col(f"`{s}`") for s in samples])


def peptide_identifier(df: DataFrame, accession: str = "accession", sequence: str = "sequence",
                       out: str = "identifier") -> DataFrame:
    """``Accession--Sequence``; NULL when either part is NULL."""
    return df.withColumn(out, F.concat(F.col(accession), F.lit("--"), F.col(sequence)))


# ---------------------------------------------------------------------- joins

def attach_protein_stats(peptides: DataFrame, proteins: DataFrame, accession: str = "accession",
                         columns: Sequence[str] = ("peptide_count", "unique_peptides", "confidence_score"),
                         ) -> DataFrame:
    """Peptides LEFT JOIN exploded protein statistics. May fan out; the
    candidates are resolved by :func:`reduce_features`."""
    return peptides.join(proteins.select(accession, *columns), accession, "left")


def attach_proteins_inner(peptides: DataFrame, proteins: DataFrame, accession: str = "accession",
                          tag: str = "cRAP", suffix: str = "_protein") -> DataFrame:
    """Join with clashing protein columns suffixed, then the contaminant filter on
    the protein description. The filter rejects unmatched peptides, so the join
    is written as the inner join it amounts to."""
    clash = {c: f"{c}{suffix}" for c in proteins.columns if c != accession and c in peptides.columns}
    kept = drop_contaminants(proteins, tag=tag).withColumnsRenamed(clash)
    return peptides.join(kept, accession, "inner")


def best_statistics(proteins: DataFrame, accession: str = "accession", peptides: str = "peptide_count",
                    unique: str = "unique_peptides", confidence: str = "confidence_score") -> DataFrame:
    """One row per accession, the one that :func:`reduce_features` would prefer of those that
    candidates of the accession meet. Written once, and broadcast unless there are very many."""
    order = [F.col(c).desc_nulls_last() for c in (unique, confidence, peptides)]
    return pinned_side(first_per_key(proteins, [accession], order), MAX_PROTEINS)


def join_results(df: DataFrame, other: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """LEFT JOIN a per-id result (statistics, clusters, missingness) onto a table."""
    return df.join(other, list(keys), "left")


def keep_tested(raw: DataFrame, tested: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Raw rows whose id is present in a result table."""
    return raw.join(tested.select(*keys), list(keys), "left_semi")


# ----------------------------------------------------------------- reductions

def reduce_features(df: DataFrame, feature: str = "feature", sequence: str = "sequence",
                    modifications: str = "modifications", score: str = "score",
                    unique: str = "unique_peptides", confidence: str = "confidence_score",
                    ordinal: str = "ordinal", by: Sequence[str] = ()) -> DataFrame:
    """Best candidate per feature.

    First one row per (feature, sequence, modifications, score): most unique
    peptides, then highest confidence, then input order; a group whose winner
    lacks either statistic disappears. Then one row per feature: best score, then
    (sequence, modifications) in binary order.

    Both steps keep one row per group on the map side before their exchange, so
    a feature with very many candidates does not reach one task as raw rows.
    """
    candidates = first_per_key(
        df, key_list(by, feature, sequence, modifications, score),
        [F.col(unique).desc_nulls_last(), F.col(confidence).desc_nulls_last(), F.col(ordinal).asc()],
    ).where(F.col(unique).isNotNull() & F.col(confidence).isNotNull())
    return first_per_key(
        candidates, key_list(by, feature),
        [F.col(score).desc_nulls_last(), F.col(sequence).asc_nulls_last(), F.col(modifications).asc_nulls_last()],
    )


def reduce_identifiers(df: DataFrame, samples: Sequence[str], identifier: str = "identifier", score: str = "score",
                       order: Sequence[str] = ("ordinal", "feature"), by: Sequence[str] = (), counted: str | None = None) -> DataFrame:
    """One row per identifier: attributes of its best-scoring row (ties: first in
    ``order``), abundances summed over all its rows (NULL if any is NULL).

    A single partially aggregated exchange, so popular identifiers are combined
    before they are shuffled. Rows without a score count in the sums but cannot be the
    best row; an identifier without any scored row is left out. With ``counted``, a column
    of this name holds the number of rows, and identifiers without a scored row stay, with
    NULL attributes.
    """
    keys = key_list(by, identifier)
    attributes = [c for c in df.columns if c not in samples and c not in keys]
    rank = F.when(F.col(score).isNotNull(), F.struct(-F.col(score), *order))
    reduced = df.groupBy(*keys).agg(
        F.min_by(F.struct(*attributes), rank).alias("_best"), F.count(score).alias("_scored"), F.count(F.lit(1)).alias("_rows"),
        *[strict_sum(F.col(f"`{s}`")).alias(s) for s in samples])
    kept = reduced if counted else reduced.where("_scored > 0")
    return kept.select(*keys, *[F.col(f"_best.`{a}`").alias(a) for a in attributes],
                       *[F.col(f"`{s}`") for s in samples], *([F.col("_rows").alias(counted)] if counted else []))

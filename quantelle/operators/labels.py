"""Heavy/light labelled cysteine peptides: sites, label state, redox state, occupancy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..session import pin
from .keys import key_list, strict_sum
from .process import reduce_identifiers
from .sites import locate_peptides

LIGHT, HEAVY = 1, 2


def add_bare_sequence(df: DataFrame, peptide: str = "peptide", out: str = "sequence",
                      flank: str = r"^[KRM]\.") -> DataFrame:
    """Peptide without mass annotations and flanking residues. Only K, R and M
    are recognised before the first dot by default; pass ``^[A-Z]\\.`` for any."""
    return df.withColumn(out, text.strip_peptide(F.col(peptide), flank))


def explode_site_scores(df: DataFrame, ascore: str = "ascore", sequence: str = "sequence",
                        modification: str = "N-ethylmaleimide") -> DataFrame:
    """One row per scored site of ``modification``, with its peptide position and residue."""
    others = [c for c in df.columns if c != ascore]
    sites = df.select(*others, F.explode(F.split(ascore, ";")).alias(ascore)).where(
        F.col(ascore).contains(modification))
    return sites.withColumn("position", F.regexp_extract(ascore, r"C(\d+):[A-Z]", 1).try_cast("int")).withColumn(
        "residue", F.substr(F.col(sequence), F.col("position"), F.lit(1)))


def locate_site(df: DataFrame, database: DataFrame, accession: str = "accession", sequence: str = "sequence",
                position: str = "position", out: str = "identifier") -> DataFrame:
    """``Accession--C<position in the protein>``; NULL when the peptide is not found."""
    located = locate_peptides(df, database, accession, sequence, "_start")
    site = (F.col("_start") + F.col(position) - 1).cast("string")
    return located.withColumn(out, F.concat(F.col(accession), F.lit("--C"), site)).drop("_start")


def tag_label_state(df: DataFrame, ascore: str = "ascore", identifier: str = "identifier") -> DataFrame:
    """Label-specific identifier (``-H``/``-L``), label state 2/1 and the
    modification name without its score."""
    heavy = F.col(ascore).contains("D5")
    return df.withColumns({
        "label_identifier": F.concat(F.col(identifier), F.when(heavy, F.lit("-H")).otherwise(F.lit("-L"))),
        "h_or_l": F.when(heavy, F.lit(HEAVY)).otherwise(F.lit(LIGHT)),
        "modification": F.regexp_replace(ascore, r"^(.*?):[0-9]*\.[0-9]*", "$1"),
    })


def redox_state(df: DataFrame, identifier: str = "identifier", by: Sequence[str] = ()) -> DataFrame:
    """2 when a site is seen in both label states, else 1.

    The mean label state is a partially aggregated table that is joined back: a
    site with very many rows is never gathered into one window. The rows are pinned,
    so what they were made from is computed once.
    """
    keys = key_list(by, identifier)
    df = pin(df)
    means = df.groupBy(*keys).agg(F.avg("h_or_l").alias("mean_modification"))
    both = ((F.col("mean_modification") > LIGHT) & (F.col("mean_modification") < HEAVY)) | (
        F.col("mean_modification") > HEAVY)
    return df.join(means, keys, "left").withColumn("redox_state", F.when(both, F.lit(2)).otherwise(F.lit(1)))


def reduce_labelled(df: DataFrame, samples: Sequence[str], score: str = "lgp", order: Sequence[str] = ("scan",),
                    identifier: str = "identifier", by: Sequence[str] = ()) -> DataFrame:
    """:func:`redox_state` of all rows, then one row per labelled site as by
    :func:`process.reduce_identifiers`.

    The rows are collapsed first, with their number: a site has two labels at most, so its
    mean label state follows from two rows, and the wide rows are neither written nor
    joined for it. Sites without a scored row count before they are left out.
    """
    keys = key_list(by, "label_identifier")
    rows = reduce_identifiers(df, samples, "label_identifier", score, order, by, counted="_rows")
    heavy = F.col("label_identifier").endswith("-H")  # also where the attributes are NULL
    site = F.expr("left(label_identifier, length(label_identifier) - 2)")
    state = rows.withColumns({"_site": site, "_state": F.when(heavy, F.lit(HEAVY)).otherwise(F.lit(LIGHT))})
    per_site = Window.partitionBy(*by, "_site")
    mean = F.sum(F.col("_state") * F.col("_rows")).over(per_site) / F.sum("_rows").over(per_site)
    both = (F.col("mean_modification") > LIGHT) & (F.col("mean_modification") < HEAVY)
    done = state.withColumn("mean_modification", mean).withColumn("redox_state", F.when(both, F.lit(2)).otherwise(F.lit(1))).where(F.col(score).isNotNull())
    attributes = [c for c in df.columns if c not in samples and c not in keys]
    return done.select(*keys, *[F.col(f"`{a}`") if a != identifier else F.col("_site").alias(identifier) for a in attributes], "mean_modification", "redox_state",
                       *[F.col(f"`{s}`") for s in samples])


def split_reduced_oxidized(df: DataFrame, single_state_only: bool = True) -> DataFrame:
    """Label rows ``Reduced`` (light) or ``Oxidized`` (heavy), by default only
    for sites seen in a single state."""
    rows = df.where(F.col("redox_state") == 1) if single_state_only else df
    return rows.withColumn("red_or_ox", F.when(F.col("h_or_l") == LIGHT, F.lit("Reduced")).otherwise(F.lit("Oxidized")))


def percent_oxidized(df: DataFrame, samples: Sequence[str], identifier: str = "identifier",
                     by: Sequence[str] = ()) -> DataFrame:
    """heavy / (heavy + light) per sample for sites seen in both states, keyed
    ``<identifier>-H``; an undefined share, for example with a NULL abundance, is 0.

    The states are those of ``redox_state`` where the table has it; else they are counted
    in the aggregate of the shares, and no other pass is needed."""
    keys = key_list(by, identifier)
    heavy = F.col("h_or_l") == HEAVY
    shares = [
        F.coalesce(F.try_divide(F.sum(F.when(heavy, F.col(f"`{s}`"))), strict_sum(F.col(f"`{s}`"))), F.lit(0.0)).alias(s)
        for s in samples
    ]
    if "redox_state" in df.columns:
        found = df.where(F.col("redox_state") == 2).groupBy(*keys).agg(*shares)
    else:
        found = df.groupBy(*keys).agg(*shares, F.count_if(heavy).alias("_heavy"), F.count_if(F.col("h_or_l") == LIGHT).alias("_light")).where(
            "_heavy > 0 AND _light > 0").drop("_heavy", "_light")
    return found.withColumn(identifier, F.concat(F.col(identifier), F.lit("-H")))

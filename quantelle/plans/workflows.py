"""End-to-end workflows composed from the operators.

Each returns lazy DataFrames; the only eager steps are the reliable checkpoints
inside the FDR adjustment and the profile clustering.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sources
from ..design import Contrast, Design
from ..operators import annotate, clean, labels, late, process, profiles, reshape, sites, stats
from ..operators.keys import pinned_side
from ..session import drop_finished, pin
from ..sources.measurements import PEPTIDE_EXPORT, PROTEIN_EXPORT


@dataclass
class Analysis:
    """Result tables of the analysis section."""

    abundance: DataFrame  # cleaned, transformed, imputed long table
    tests: DataFrame  # one row per (id, comparison): fc, t, p_value, fdr
    anova: DataFrame  # one row per id: f, p_value, fdr
    extremes: DataFrame  # one row per id: fc_max, missing
    clusters: DataFrame | None  # one row per significant id: z-profile, cluster


def analyze(long: DataFrame, design: Design, contrasts: Sequence[Contrast], nonzero: int = 3,
            transform: str | None = "log2", impute: str = "draw", seed: int = 123, clusters: int | None = None,
            alpha: float = 0.05, id: str = "id", by: Sequence[str] = ()) -> Analysis:
    """Clean, transform, impute, test, compare and optionally cluster.

    ``long`` should come partitioned by id (``densify`` leaves it so); all per-id
    steps then share that one exchange. ``transform=None`` analyses occupancies
    without a logarithm. Five results read the imputed table; all but its last step, which
    works on single rows, is pinned by the imputation.
    """
    ready = clean.clean_min(long, nonzero, id, by)
    if transform:
        ready = clean.transform_data(ready, transform)
    ready = clean.impute(ready, impute, seed=seed, id=id, by=by)
    tests = stats.calculate_ttest(ready, contrasts, id, by)
    variance = stats.calculate_1anova(ready, design.conditions, id, by)
    keys = [*by, id]
    extremes = clean.add_missingness(stats.add_fc_max(tests, id=id, by=by), long, design, id, by)
    drop_finished(ready.sparkSession)
    grouped = None
    if clusters:
        significant = variance.where(F.col("fdr") < alpha).select(*keys)
        grouped = profiles.cluster_profiles(ready.join(significant, keys, "left_semi"), design.conditions, clusters,
                                            seed, id, by)
    return Analysis(ready, tests, variance, extremes, grouped)


def protein_abundance(proteins: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Protein export -> unique lead accessions with abundances."""
    kept = process.min_peptide_evidence(process.drop_contaminants(process.split_accession_group(proteins)))
    return process.select_abundance(kept, "accession", samples)


def _scored(peptides: DataFrame, threshold: float) -> DataFrame:
    return process.drop_contaminants(process.filter_score(peptides, threshold=threshold))


def _best_peptides(scored: DataFrame, proteins: DataFrame) -> DataFrame:
    joined = process.attach_protein_stats(scored, process.best_statistics(process.explode_accessions(proteins)))
    return process.reduce_features(joined)


def _summed(identified: DataFrame, source: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Identifiers with summed abundances, which ``source`` has if the rows have none."""
    keys = [c for c in source.columns if c not in samples]
    order = ["score", "ordinal", "feature"]
    if any(s not in identified.columns for s in samples):
        identified = late.fetch(identified.select(*keys, "identifier"), source, samples, keys, ["ordinal"])
    rows = identified.select("identifier", *order, *[F.col(f"`{s}`") for s in samples])
    return process.select_abundance(process.reduce_identifiers(rows, samples), "identifier", samples)


def peptide_abundance(peptides: DataFrame, proteins: DataFrame, samples: Sequence[str], threshold: float = 13
                      ) -> DataFrame:
    """Peptide export -> ``Accession--Sequence`` identifiers with summed abundances."""
    scored = _scored(peptides, threshold)
    return _summed(process.peptide_identifier(_best_peptides(_without(scored, samples), proteins)), scored, samples)


def _without(df: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Candidates as they are chosen from: without their samples if these are many."""
    return df.drop(*samples) if len(samples) > late.FEW_SAMPLES else df


def phospho_abundance(peptides: DataFrame, proteins: DataFrame, database: DataFrame, samples: Sequence[str],
                      threshold: float = 13, mod: str = "Phospho") -> DataFrame:
    """Peptide export -> modification-site identifiers with summed abundances."""
    scored = _scored(peptides, threshold)
    modified = process.filter_modified(_best_peptides(_without(scored, samples), proteins), mod)
    located, _ = sites.split_located(sites.phospho_identifier(modified, database, mod))
    return _summed(located, scored, samples)


def redox_abundance(peptides: DataFrame, proteins: DataFrame, database: DataFrame, samples: Sequence[str],
                    threshold: float = 13, reduced: str = "Nethylmaleimide") -> DataFrame:
    """Peptide export -> free-cysteine identifiers with summed abundances."""
    scored = _scored(peptides, threshold)
    free = process.filter_redox(_best_peptides(_without(scored, samples), proteins), reduced)
    located, _ = sites.split_located(sites.redox_identifier(free, database, reduced))
    return _summed(located, process.filter_redox(scored, reduced), samples)


def site_analysis(abundance: DataFrame, annotation: DataFrame, design: Design, contrasts: Sequence[Contrast], **options
                  ) -> tuple[DataFrame, Analysis]:
    """Site identifiers with abundances -> the analysis, and its tests with the conditions
    in which a site was not seen, its accession and sites, and the accession's annotation.
    The design's positions count the identifier as column 1. The abundances, which two steps
    read, are pinned."""
    held = pin(abundance)
    drop_finished(held.sparkSession)
    long = reshape.to_long(design.rename(held.repartition(*options.get("by", ()), "identifier")), design, "identifier", options.get("by", ()))
    result = analyze(long, design, contrasts, id="identifier", **options)
    by = list(options.get("by", ()))
    told = process.join_results(result.tests, result.extremes.select(*by, "identifier", "missing"), [*by, "identifier"])
    return annotate.add_annotation(annotate.add_accession(told), annotation), result


def read_site_inputs(spark: SparkSession, peptides: str | Sequence[str], proteins: str | Sequence[str], database: str | Sequence[str],
                     samples: Sequence[int]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Peptide, protein and sequence files of a vendor export -> the tables that the
    abundance workflows take. ``samples`` are positions in the peptide export."""
    read = sources.read_measurements(spark, peptides, samples=samples, types={"#": "long"}, columns=PEPTIDE_EXPORT)
    stats_ = sources.read_measurements(
        spark, proteins, types={"Peptide count": "int", "Unique peptides": "int", "Confidence score": "double"}, columns=PROTEIN_EXPORT, ordinal=None)
    return read, stats_, sources.read_fasta(spark, database)


def labelled_candidates(peptides: DataFrame, proteins: DataFrame, score: str = "lgp", ordinal: str = "ordinal", samples: Sequence[str] = ()) -> DataFrame:
    """Heavy/light peptides with all proteins they support -> one row per scan.

    Of equal peptides the protein with most unique peptides, then the highest protein
    score wins; then the best-scoring peptide of the scan. If many ``samples`` are named,
    the rows compete without them, and :func:`labelled_sites` brings them back.
    """
    held = pinned_side(proteins, process.MAX_PROTEINS)
    joined = process.attach_proteins_inner(_without(peptides, samples), held)
    return process.reduce_features(joined, "scan", "peptide", "ptm", score, "unique_peptides", f"{score}_protein", ordinal)


def labelled_sites(peptides: DataFrame, database: DataFrame, samples: Sequence[str], score: str = "lgp",
                   order: Sequence[str] = ("scan",), source: DataFrame | None = None, near: Sequence[str] = ("scan", "ordinal")) -> DataFrame:
    """Heavy/light peptides -> one row per labelled site with its redox state.

    The state is derived from all rows, unscored ones included, before they are
    collapsed to (site, label). Peptides without their ``samples`` get those of the row of
    ``source`` that has the same other columns, once they are located; ``near`` are columns
    that few rows of it share. Of the columns, then, only those of the site and the label
    and the ordering ones remain.
    """
    late_ = any(s not in peptides.columns for s in samples)
    if late_:  # a row's scores are split into sites below
        whole = F.xxhash64("ascore")
        source = source.withColumn("_scores", whole).drop("ascore")
        keys = [c for c in source.columns if c not in samples]
        peptides = peptides.withColumn("_scores", whole).select(*keys, "ascore")
    scored = labels.explode_site_scores(labels.add_bare_sequence(peptides))
    located, _ = sites.split_located(labels.locate_site(scored, database))
    tagged = labels.tag_label_state(located)
    if late_:
        site = ["identifier", "label_identifier", "h_or_l", "modification"]
        found = late.fetch(tagged.select(*keys, *site), source, samples, keys, near)
        tagged = found.select(*dict.fromkeys([score, *order]), *site, *[F.col(f"`{s}`") for s in samples])
    return labels.reduce_labelled(tagged, samples, score, order)


def occupancy_analysis(labelled: DataFrame, samples: Sequence[str], design: Design, contrasts: Sequence[Contrast],
                       nonzero: int = 2, **options) -> Analysis:
    """Labelled sites with redox state -> percent oxidised of sites seen in both
    states -> the analysis on shares (no logarithm). ``fc`` is the change in
    oxidation. The design's positions count the identifier as column 1."""
    shares = labels.percent_oxidized(labelled, samples)
    long = reshape.to_long(design.rename(process.select_abundance(shares, "identifier", samples)), design, "identifier")
    return analyze(long, design, contrasts, nonzero, None, id="identifier", **options)

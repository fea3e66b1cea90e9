"""One query per operator, on views derived from the given tables.

Computed doubles are rounded so that results can be compared across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..design import Contrast
from ..functions import text
from ..functions.tails import f_sf
from ..operators import (annotate, clean, labels, process, profiles, ranking, reshape, sites, stats, summaries)
from .. import sources
from ..sources.measurements import PEPTIDE_EXPORT
from . import exports, inputs, workflows
from .inputs import CONTRASTS, DESIGN

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

GO_BP = "Gene ontology (biological process)"
GO_MF = "Gene ontology (molecular function)"


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})


# ------------------------------------------------------------- shared stages

def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_min(inputs.quant(spark, sf), 3)


def logged(spark: SparkSession, sf: str) -> DataFrame:
    return clean.transform_data(cleaned(spark, sf), "log2")


def imputed(spark: SparkSession, sf: str) -> DataFrame:
    return clean.impute(logged(spark, sf), "center")


def occupancy_tested(spark: SparkSession, sf: str) -> DataFrame:
    ready = clean.clean_min(inputs.occupancy(spark, sf), 2)
    return stats.calculate_ttest(ready, CONTRASTS).withColumnRenamed("fc", "change_ox")


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Scored peptides without contaminants, joined to protein statistics."""
    scored = process.drop_contaminants(process.filter_score(inputs.peptides(spark, sf)))
    return process.attach_protein_stats(scored, process.explode_accessions(inputs.proteins(spark, sf)))


def best(spark: SparkSession, sf: str) -> DataFrame:
    return process.reduce_features(candidates(spark, sf))


def tagged_sites(spark: SparkSession, sf: str) -> DataFrame:
    scored = labels.explode_site_scores(labels.add_bare_sequence(inputs.site_peptides(spark, sf)))
    located = labels.locate_site(scored, inputs.sequences(spark, sf))
    return labels.tag_label_state(located.where(F.col("identifier").isNotNull()))


# ------------------------------------------------------- reshape and cleaning

@query("densify")
def _densify(spark, sf):
    return inputs.quant(spark, sf)


@query("to_wide")
def _to_wide(spark, sf):
    return inputs.quant_wide(spark, sf)


@query("to_long")
def _to_long(spark, sf):
    return reshape.to_long(inputs.quant_wide(spark, sf), DESIGN)


@query("rename_columns")
def _rename_columns(spark, sf):
    wide = inputs.quant_wide(spark, sf)
    return DESIGN.rename(wide.toDF("id", *[f"x{i}" for i in range(len(DESIGN.samples))]))


@query("clean_min")
def _clean_min(spark, sf):
    return cleaned(spark, sf)


@query("log2_transform")
def _log2(spark, sf):
    return rounded(clean.transform_data(inputs.quant(spark, sf), "log2"), "abundance")


@query("asinh_transform")
def _asinh(spark, sf):
    return rounded(clean.transform_data(inputs.quant(spark, sf), "asinh"), "abundance")


@query("back_transform")
def _back(spark, sf):
    return rounded(clean.back_transform(clean.transform_data(inputs.quant(spark, sf), "asinh")), "abundance", digits=4)


@query("impute_center")
def _impute_center(spark, sf):
    return rounded(imputed(spark, sf), "abundance")


@query("impute_draw")
def _impute_draw(spark, sf):
    return rounded(clean.impute(logged(spark, sf), "draw"), "abundance")


@query("missingness")
def _missingness(spark, sf):
    quant = inputs.quant(spark, sf)
    tested = clean.clean_min(quant, 3).select("id").distinct()
    return clean.add_missingness(tested, quant, DESIGN)


@query("keep_tested")
def _keep_tested(spark, sf):
    quant = inputs.quant(spark, sf)
    return process.keep_tested(quant, clean.clean_min(quant, 4).select("id").distinct())


# ------------------------------------------------------------------ statistics

@query("group_moments")
def _moments(spark, sf):
    return rounded(stats.group_moments(logged(spark, sf)), "mean", "variance")


@query("condition_means")
def _condition_means(spark, sf):
    return rounded(stats.condition_means(logged(spark, sf)), "mean")


@query("fold_change")
def _fold_change(spark, sf):
    return rounded(stats.calculate_fc(logged(spark, sf), CONTRASTS), "fc")


@query("fc_max")
def _fc_max(spark, sf):
    return rounded(stats.add_fc_max(stats.calculate_fc(logged(spark, sf), CONTRASTS)), "fc_max")


@query("f_tail")
def _f_tail(spark, sf):
    rows = inputs.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity") / 5).alias("f"))
    return rows.withColumn("p", F.round(f_sf("f", F.lit(2.0), F.lit(9.0)), 9))


@query("ttest")
def _ttest(spark, sf):
    tested = stats.calculate_ttest(imputed(spark, sf), CONTRASTS)
    return rounded(tested.select("id", "comparison", "fc", "t", "p_value", "fdr"), "fc", "t", "p_value", "fdr")


@query("anova")
def _anova(spark, sf):
    tested = stats.calculate_1anova(imputed(spark, sf), DESIGN.conditions)
    return rounded(tested.select("id", "f", "p_value", "fdr"), "f", "p_value", "fdr", digits=5)


@query("results_join")
def _results_join(spark, sf):
    ready = imputed(spark, sf)
    means = reshape.spread_conditions(stats.condition_means(ready), DESIGN.conditions, suffix="_mean")
    tests = reshape.results_wide(stats.compare(ready, CONTRASTS), [c.name for c in CONTRASTS],
                                 {"p_value": "P", "fc": "FC"})
    joined = process.join_results(means, tests)
    return rounded(joined, *[c for c in joined.columns if c != "id"])


def _test_rows(spark, sf):
    """Made-up p-values with many ties and some NULLs."""
    p = F.when(F.col("l_tax") != 0, F.floor(F.col("l_extendedprice")) % 5000 / 5000.0)
    return inputs.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", p.alias("p"))


@query("bh_adjust")
def _bh(spark, sf):
    adjusted = ranking.adjust_bh(_test_rows(spark, sf), "p", ["l_returnflag"],
                                 ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], "q")
    return rounded(adjusted, "q", digits=9)


@query("exact_quantiles")
def _quantiles(spark, sf):
    return rounded(ranking.exact_quantiles(
        inputs.table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag", "l_linenumber"],
        {"q05": 0.05, "q25": 0.25, "median": 0.5, "q90": 0.9}), "q05", "q25", "median", "q90", digits=4)


@query("zscore_profiles")
def _zscores(spark, sf):
    return rounded(stats.zscore_profiles(imputed(spark, sf), DESIGN.conditions), "z")


@query("sample_correlation")
def _correlation(spark, sf):
    return rounded(profiles.sample_correlation(logged(spark, sf), DESIGN), "r")


@query("sample_distance")
def _distance(spark, sf):
    return rounded(profiles.sample_distance(logged(spark, sf), DESIGN), "distance", digits=5)


@query("pca_loadings")
def _pca(spark, sf):
    return rounded(profiles.pca_loadings(logged(spark, sf), DESIGN), "pc1", "pc2")


@query("cluster_profiles")
def _clusters(spark, sf):
    found = profiles.cluster_profiles(imputed(spark, sf), DESIGN.conditions, 3)
    return rounded(found, *[f"{c}_Z" for c in DESIGN.conditions])


@query("cluster_profile_long")
def _cluster_long(spark, sf):
    found = profiles.cluster_profiles(imputed(spark, sf), DESIGN.conditions, 3)
    return rounded(profiles.cluster_profile_long(found, DESIGN.conditions), "z")


# -------------------------------------------------------- result summaries

def _tests(spark, sf):
    return stats.calculate_ttest(imputed(spark, sf), CONTRASTS)


@query("results_long")
def _results_long(spark, sf):
    wide = reshape.results_wide(stats.compare(imputed(spark, sf), CONTRASTS), [c.name for c in CONTRASTS],
                                {"p_value": "P", "fc": "FC"})
    return rounded(reshape.results_long(wide, statistics=("P", "FC")), "P", "FC")


@query("volcano_classify")
def _volcano(spark, sf):
    v = summaries.volcano_classify(_tests(spark, sf), threshold=2)
    return rounded(v.select("id", "comparison", "fc", "significance", "down", "up", "type"), "fc", "significance")


@query("volcano_counts")
def _volcano_counts(spark, sf):
    return summaries.volcano_counts(summaries.volcano_classify(_tests(spark, sf), fdr=False, threshold=2))


@query("volcano_change_ox")
def _volcano_ox(spark, sf):
    v = summaries.volcano_classify(occupancy_tested(spark, sf), fdr=False, threshold=0.10, effect="change_ox",
                                   log_threshold=False)
    return rounded(summaries.volcano_labelled(v).select("id", "comparison", "change_ox", "significance", "type", "label"),
                   "change_ox", "significance", digits=9)


@query("volcano_by_label")
def _volcano_label(spark, sf):
    rows = _tests(spark, sf).withColumn(
        "red_or_ox", F.when(F.col("id").endswith("_UPS"), F.lit("Oxidized")).otherwise(F.lit("Reduced")))
    v = summaries.volcano_classify(rows, fdr=False, threshold=2)
    return rounded(summaries.volcano_labelled(v).select("id", "red_or_ox", "comparison", "fc", "type", "label"), "fc")


@query("summarize_volcano")
def _summarize_volcano(spark, sf):
    v = summaries.summarize_volcano(_tests(spark, sf))
    return rounded(v.select("id", "comparison", "fc", "fdr", "class"), "fc", "fdr")


@query("fdr_by_class")
def _fdr_by_class(spark, sf):
    return summaries.summarize_ttest_fdr(_tests(spark, sf))


@query("fc_summary")
def _fc_summary(spark, sf):
    effects = stats.calculate_fc(imputed(spark, sf), CONTRASTS)
    return rounded(summaries.summarize_fc(effects), "median", "mean", "sd", digits=5)


@query("cv_summary")
def _cv_summary(spark, sf):
    return rounded(summaries.summarize_cv(imputed(spark, sf)), "cv_mean", "cv_median", "cv_90")


@query("cv_by_class")
def _cv_by_class(spark, sf):
    return rounded(summaries.cv_by_class(imputed(spark, sf), "_UPS", "P", "N"), "median")


@query("z_by_class")
def _z_by_class(spark, sf):
    z = stats.zscore_profiles(imputed(spark, sf), DESIGN.conditions)
    return rounded(summaries.summarize_z(z), "z")


@query("value_counts")
def _value_counts(spark, sf):
    return rounded(summaries.summarize_count(inputs.peptides(spark, sf), "modifications"), "freq", digits=9)


@query("term_counts")
def _term_counts(spark, sf):
    return rounded(summaries.count_terms(inputs.peptides(spark, sf), "modifications", 50), "freq", digits=9)


@query("site_counts")
def _site_counts(spark, sf):
    found = sites.phospho_identifier(best(spark, sf), inputs.sequences(spark, sf))
    ids = annotate.add_accession(found.where(F.col("identifier").isNotNull()).select("identifier").distinct())
    return summaries.site_counts(ids)


@query("sites_per_accession")
def _sites_per_accession(spark, sf):
    return summaries.sites_per_accession(_site_counts(spark, sf))


@query("box_stats")
def _box(spark, sf):
    return rounded(summaries.sample_box_stats(imputed(spark, sf)), "q1", "median", "q3", "lower", "upper")


@query("histogram")
def _histogram(spark, sf):
    means = rounded(stats.condition_means(clean.clean_min(inputs.occupancy(spark, sf), 2)), "mean", digits=9)
    return rounded(summaries.histogram(means, 0.1), "center")


@query("heatmap_order")
def _heatmap(spark, sf):
    return rounded(summaries.heatmap_order(logged(spark, sf)), "mean_value")


# ------------------------------------------------ identifications, identifiers

@query("accession_group_split")
def _split_group(spark, sf):
    return process.split_accession_group(inputs.proteins(spark, sf))


@query("explode_accessions")
def _explode(spark, sf):
    return process.explode_accessions(inputs.proteins(spark, sf))


@query("drop_contaminants")
def _contaminants(spark, sf):
    return process.drop_contaminants(inputs.proteins(spark, sf))


@query("peptide_evidence")
def _evidence(spark, sf):
    return process.min_peptide_evidence(inputs.proteins(spark, sf))


@query("filter_score")
def _filter_score(spark, sf):
    return process.filter_score(inputs.peptides(spark, sf)).select("feature", "ordinal", "score", "accession")


@query("filter_modified")
def _filter_modified(spark, sf):
    return process.filter_modified(inputs.peptides(spark, sf), "Phospho").select("feature", "ordinal", "modifications")


@query("filter_redox")
def _filter_redox(spark, sf):
    return process.filter_redox(inputs.peptides(spark, sf)).select("feature", "ordinal", "sequence", "modifications")


@query("select_abundance")
def _select_abundance(spark, sf):
    return process.select_abundance(inputs.peptides(spark, sf), "feature", ["s1", "s2", "s3"])


@query("peptide_identifier")
def _peptide_identifier(spark, sf):
    return process.peptide_identifier(inputs.peptides(spark, sf)).select("feature", "ordinal", "identifier")


@query("attach_protein_stats")
def _attach_stats(spark, sf):
    return candidates(spark, sf).select(
        "feature", "ordinal", "accession", "peptide_count", "unique_peptides", "confidence_score")


@query("attach_proteins_inner")
def _attach_inner(spark, sf):
    proteins = process.split_accession_group(inputs.proteins(spark, sf)).drop("group_members")
    return process.attach_proteins_inner(inputs.peptides(spark, sf), proteins).select(
        "feature", "ordinal", "accession", "description", "description_protein", "unique_peptides")


@query("reduce_features")
def _reduce_features(spark, sf):
    return best(spark, sf).select("feature", "ordinal", "sequence", "modifications", "score", "accession",
                                  "unique_peptides", "confidence_score")


@query("reduce_identifiers")
def _reduce_identifiers(spark, sf):
    identified = process.peptide_identifier(process.filter_score(inputs.peptides(spark, sf)))
    reduced = process.reduce_identifiers(identified, ["s1", "s2", "s3"])
    return rounded(reduced, "s1", "s2", "s3", digits=2)


@query("first_per_key")
def _first_per_key(spark, sf):
    rows = inputs.peptides(spark, sf).select("accession", "sequence", "ordinal", "feature")
    return ranking.first_per_key(rows, ["accession"], [F.col("ordinal"), F.col("feature"), F.col("sequence")])


@query("top_k_per_group")
def _top_k(spark, sf):
    counts = inputs.peptides(spark, sf).groupBy("accession", "sequence").agg(F.count(F.lit(1)).alias("n"))
    return ranking.top_k_per_group(counts, ["accession"], [F.col("n").desc(), F.col("sequence")], 3)


@query("attach_sequence")
def _attach_sequence(spark, sf):
    rows = inputs.peptides(spark, sf).select("feature", "ordinal", "accession", "sequence")
    return sites.locate_peptides(rows, inputs.sequences(spark, sf))


@query("phospho_sites")
def _phospho(spark, sf):
    return sites.phospho_identifier(inputs.peptides(spark, sf), inputs.sequences(spark, sf)).select(
        "feature", "ordinal", "identifier")


@query("redox_sites")
def _redox(spark, sf):
    free = process.filter_redox(inputs.peptides(spark, sf))
    return sites.redox_identifier(free, inputs.sequences(spark, sf)).select("feature", "ordinal", "identifier")


@query("cys_sites")
def _cys(spark, sf):
    return sites.explode_cys_sites(inputs.peptides(spark, sf)).select("feature", "ordinal", "cys", "blocked")


# ------------------------------------------------------------- labelled sites

@query("strip_peptide")
def _strip(spark, sf):
    return labels.add_bare_sequence(inputs.site_peptides(spark, sf)).select("scan", "accession", "peptide", "sequence")


@query("site_scores")
def _site_scores(spark, sf):
    return labels.explode_site_scores(labels.add_bare_sequence(inputs.site_peptides(spark, sf))).select(
        "scan", "accession", "ascore", "position", "residue")


@query("locate_site")
def _locate_site(spark, sf):
    scored = labels.explode_site_scores(labels.add_bare_sequence(inputs.site_peptides(spark, sf)))
    return labels.locate_site(scored, inputs.sequences(spark, sf)).select("scan", "accession", "sequence", "identifier")


@query("label_state")
def _label_state(spark, sf):
    return tagged_sites(spark, sf).select("scan", "label_identifier", "h_or_l", "modification")


@query("redox_state")
def _redox_state(spark, sf):
    state = labels.redox_state(tagged_sites(spark, sf))
    return rounded(state.select("scan", "identifier", "h_or_l", "mean_modification", "redox_state"),
                   "mean_modification")


@query("split_reduced_oxidized")
def _split_ox(spark, sf):
    return labels.split_reduced_oxidized(labels.redox_state(tagged_sites(spark, sf))).select(
        "scan", "label_identifier", "red_or_ox")


def _labelled(spark, sf):
    numbered = inputs.site_peptides(spark, sf).withColumn("ordinal", F.col("scan") * 1000000 + F.floor("s1"))
    return workflows.labelled_sites(numbered, inputs.sequences(spark, sf), ["s1", "s2"], order=["ordinal"])


@query("reduce_label_identifiers")
def _reduce_labels(spark, sf):
    return rounded(_labelled(spark, sf).select("label_identifier", "scan", "lgp", "s1", "s2", "redox_state"),
                   "s1", "s2", digits=5)


@query("percent_oxidized")
def _percent(spark, sf):
    return rounded(labels.percent_oxidized(tagged_sites(spark, sf), ["s1", "s2"]), "s1", "s2")


@query("change_ox")
def _change_ox(spark, sf):
    ready = clean.clean_min(inputs.occupancy(spark, sf), 2)
    return rounded(stats.calculate_fc(ready, CONTRASTS, out="change_ox"), "change_ox", digits=9)


@query("change_ox_max")
def _change_ox_max(spark, sf):
    ready = clean.clean_min(inputs.occupancy(spark, sf), 2)
    effects = stats.calculate_fc(ready, CONTRASTS, out="change_ox")
    return rounded(stats.add_fc_max(effects, "change_ox", "change_ox_max"), "change_ox_max", digits=9)


# ------------------------------------------------------------------ annotation

@query("add_accession")
def _add_accession(spark, sf):
    found = sites.phospho_identifier(inputs.peptides(spark, sf), inputs.sequences(spark, sf))
    return annotate.add_accession(found.select("feature", "ordinal", "identifier"))


@query("uniprot_entry")
def _entry(spark, sf):
    return inputs.peptides(spark, sf).select("feature", "ordinal", text.uniprot_entry(F.col("accession")).alias("entry"))


@query("label_class")
def _label_class(spark, sf):
    return summaries.add_class(inputs.quant(spark, sf).groupBy("id").agg(F.count(F.lit(1)).alias("n")))


@query("annotate")
def _annotate(spark, sf):
    rows = inputs.peptides(spark, sf).select("feature", "ordinal", "accession")
    return annotate.add_annotation(rows, inputs.annotation(spark, sf))


def _go(spark, sf):
    return inputs.annotation(spark, sf).select(
        F.col("entry").alias("accession"), F.col("go_bp").alias(GO_BP), F.col("go_mf").alias(GO_MF),
        F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")),
                     (1 + F.substr("entry", F.lit(2)).cast("int") % 3)).alias("cluster"))


@query("explode_terms")
def _explode_terms(spark, sf):
    return annotate.explode_terms(_go(spark, sf))


@query("go_top_terms")
def _go_top(spark, sf):
    return annotate.go_top_terms(_go(spark, sf), 5)


@query("go_top_terms_by_cluster")
def _go_clusters(spark, sf):
    return annotate.go_top_terms_by_cluster(_go(spark, sf), 2)


@query("term_profiles")
def _term_profiles(spark, sf):
    z = stats.zscore_profiles(imputed(spark, sf), DESIGN.conditions).drop("condition_order")
    return rounded(annotate.term_profiles(z, inputs.part_terms(spark, sf, closed=True), GO_BP, 250), "z")


@query("term_fold_changes")
def _term_fc(spark, sf):
    fc = stats.calculate_fc(imputed(spark, sf), CONTRASTS)
    return rounded(annotate.term_fold_changes(fc, inputs.part_terms(spark, sf), GO_BP, 200), "fc")


@query("term_heatmap")
def _term_heatmap(spark, sf):
    scaled = stats.condition_means(imputed(spark, sf)).withColumnRenamed("mean", "scaled")
    return rounded(annotate.term_heatmap(scaled, inputs.part_terms(spark, sf), GO_BP, 250), "scaled")


# ------------------------------------------------------------------- workflows

@query("protein_workflow")
def _protein_workflow(spark, sf):
    """Long table -> clean, log2, impute, t-test, fold change, extremes, missingness."""
    quant = inputs.quant(spark, sf)
    result = workflows.analyze(quant, DESIGN, [Contrast("A", "N"), Contrast("A", "R")], impute="center")
    tests = reshape.results_wide(result.tests, ["A-N", "A-R"], {"p_value": "P", "fdr": "FDR", "fc": "FC"})
    variance = result.anova.select("id", F.col("p_value").alias("P"), F.col("fdr").alias("FDR"))
    joined = process.join_results(process.join_results(tests, variance), result.extremes)
    return rounded(joined, *[c for c in joined.columns if c not in ("id", "missing")], digits=5)


@query("protein_abundance")
def _protein_abundance(spark, sf):
    return workflows.protein_abundance(inputs.proteins(spark, sf), ["confidence_score"])


@query("peptide_workflow")
def _peptide_workflow(spark, sf):
    return rounded(workflows.peptide_abundance(inputs.peptides(spark, sf), inputs.proteins(spark, sf),
                                               ["s1", "s2", "s3"]), "s1", "s2", "s3", digits=2)


@query("phospho_workflow")
def _phospho_workflow(spark, sf):
    return rounded(workflows.phospho_abundance(inputs.peptides(spark, sf), inputs.proteins(spark, sf),
                                               inputs.sequences(spark, sf), ["s1", "s2", "s3"]),
                   "s1", "s2", "s3", digits=2)


@query("redox_workflow")
def _redox_workflow(spark, sf):
    return rounded(workflows.redox_abundance(inputs.peptides(spark, sf), inputs.proteins(spark, sf),
                                             inputs.sequences(spark, sf), ["s1", "s2", "s3"]),
                   "s1", "s2", "s3", digits=2)


def _site_inputs(spark, sf, samples, view=inputs.as_peptides):
    first = len(PEPTIDE_EXPORT) + 1
    return workflows.read_site_inputs(spark, exports.peptides(spark, sf, samples, view), exports.proteins(spark, sf),
                                      exports.database(spark, sf), range(first, first + len(samples)))


@query("peptide_files_workflow")
def _peptide_files(spark, sf):
    """Files -> scores, proteins, best candidates by input order, summed peptides."""
    samples = ["s1", "s2", "s3"]
    peptides, proteins, _ = _site_inputs(spark, sf, samples)
    return rounded(workflows.peptide_abundance(peptides, proteins, samples), *samples, digits=2)


@query("phospho_analysis")
def _phospho_analysis(spark, sf):
    """Files -> phosphorylation sites -> clean, log2, impute, test -> missing conditions, accession, annotation."""
    read, proteins, database = _site_inputs(spark, sf, DESIGN.names, inputs.as_peptide_samples)
    abundance = workflows.phospho_abundance(read, proteins, database, DESIGN.names)
    annotation = sources.read_annotation(spark, exports.annotation(spark, sf), out="entry")
    told, _ = workflows.site_analysis(abundance, annotation, DESIGN, CONTRASTS, impute="center")
    return rounded(told.select("identifier", "comparison", "fc", "p_value", "fdr", "missing", "accession", "sites", "go_bp"),
                   "fc", "p_value", "fdr", digits=5)


@query("occupancy_workflow")
def _occupancy_workflow(spark, sf):
    """Labelled peptides -> best of each scan, sites, redox state, percent oxidised, change in oxidation."""
    peptides = inputs.labelled_samples(spark, sf)
    best_ = workflows.labelled_candidates(peptides, inputs.peaks_proteins(spark, sf), samples=DESIGN.names)
    sites_ = workflows.labelled_sites(best_, inputs.sequences(spark, sf), DESIGN.names, order=["scan"], source=peptides)
    result = workflows.occupancy_analysis(sites_, DESIGN.names, DESIGN, CONTRASTS, impute="center")
    return rounded(result.tests.select("identifier", "comparison", F.col("fc").alias("change_ox"), "p_value", "fdr"),
                   "change_ox", "p_value", "fdr", digits=5)


@query("clustered_analysis")
def _clustered_analysis(spark, sf):
    """The profiles of the ids that differ between conditions, in three clusters."""
    result = workflows.analyze(inputs.quant(spark, sf), DESIGN, CONTRASTS, impute="center", clusters=3)
    return rounded(result.clusters, *[f"{c}_Z" for c in DESIGN.conditions])


@query("analysis_by_experiment")
def _analysis_by_experiment(spark, sf):
    """Two experiments in one table: every step keeps them apart."""
    result = workflows.analyze(inputs.two_experiments(spark, sf), DESIGN, CONTRASTS, impute="center", by=["experiment"])
    told = process.join_results(result.tests, result.extremes, ["experiment", "id"])
    return rounded(told.select("experiment", "id", "comparison", "fc", "p_value", "fdr", "fc_max", "missing"),
                   "fc", "p_value", "fdr", "fc_max", digits=5)


@query("peaks_reduce_features")
def _peaks_reduce_features(spark, sf):
    return _labelled_candidates(spark, sf).select("scan", "ordinal", "peptide", "ptm", "lgp", "accession",
                                                  "unique_peptides", "lgp_protein")


@query("labelled_workflow")
def _labelled_workflow(spark, sf):
    reduced = _labelled_candidates(spark, sf)
    sites_ = workflows.labelled_sites(reduced, inputs.sequences(spark, sf), ["s1", "s2"], order=["scan"])
    return rounded(sites_.select("label_identifier", "scan", "lgp", "s1", "s2", "redox_state"), "s1", "s2", digits=5)


def _labelled_candidates(spark, sf):
    return workflows.labelled_candidates(inputs.labelled_peptides(spark, sf), inputs.peaks_proteins(spark, sf))


# ------------------------------------------------- readers and sinks, on files written from the tables

@query("read_measurements")
def _read_measurements(spark, sf):
    return sources.read_measurements(spark, exports.measurements(spark, sf), samples=[7, 8],
                                     types={"#": "long", "Score": "double"}, columns=PEPTIDE_EXPORT).drop("ordinal")


@query("read_peaks_proteins")
def _read_peaks_proteins(spark, sf):
    return sources.read_peaks_proteins(spark, exports.peaks_proteins(spark, sf), samples=[7, 8])


@query("read_peaks_peptides")
def _read_peaks_peptides(spark, sf):
    return sources.read_peaks_peptides(spark, exports.peaks_peptides(spark, sf), samples=[7], last=7).drop("ordinal")


@query("read_fasta")
def _read_fasta(spark, sf):
    return sources.read_fasta(spark, exports.fasta(spark, sf))


@query("read_fasta_pattern")
def _read_fasta_pattern(spark, sf):
    return sources.read_fasta(spark, exports.fasta(spark, sf), accession_pattern="[^A-Za-z0-9]+")


@query("read_annotation")
def _read_annotation(spark, sf):
    return sources.read_annotation(spark, exports.annotation(spark, sf))


@query("read_processed")
def _read_processed(spark, sf):
    path = exports.folder(spark, "processed.csv")
    sources.write_table(inputs.quant_wide(spark, sf), path, "csv")
    return sources.read_processed(spark, path)


@query("write_table")
def _write_table(spark, sf):
    path = exports.folder(spark, "long.parquet")
    sources.write_table(inputs.quant(spark, sf), path, by=["condition"])
    return sources.read_processed(spark, path)

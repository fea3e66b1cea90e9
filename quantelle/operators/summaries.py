"""Classification, counts and distribution summaries (the tables behind the charts)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .clean import back_transform
from ..session import pin
from .keys import key_list, null_safe_join, pinned_side
from .ranking import exact_quantiles, first_per_key
from .stats import group_moments

ALPHA = 0.05


def add_class(df: DataFrame, pattern: str = "_UPS", yes: str = "UPS1", no: str = "Background", id: str = "id",
              out: str = "class") -> DataFrame:
    """Ground-truth class of an id by regular expression."""
    return df.withColumn(out, text.label_class(F.col(id), pattern, yes, no))


def volcano_classify(df: DataFrame, fdr: bool = True, threshold: float = 2, effect: str = "fc",
                     log_threshold: bool = True, p: str = "p_value", q: str = "fdr") -> DataFrame:
    """Mark effects as down, up or same.

    The cut-off is log2(threshold), or the threshold itself for raw differences
    such as changes in oxidation. A test that cannot be decided because its
    significance is NULL has a NULL type.
    """
    cut = math.log2(threshold) if log_threshold else float(threshold)
    significance = F.col(q if fdr else p)
    significant = significance < ALPHA
    down = ((F.col(effect) <= -cut) & significant).cast("int")
    up = ((F.col(effect) >= cut) & significant).cast("int")
    kind = F.when(F.col("down") == 1, F.lit("down")).when(
        F.col("down") == 0, F.when(F.col("up") == 1, F.lit("up")).when(F.col("up") == 0, F.lit("same")))
    return df.withColumns({
        "significance": significance, "neg_log10": -F.log10(significance), "down": down, "up": up,
    }).withColumn("type", kind)


def volcano_counts(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Down/up totals, rows and facet label per comparison."""
    return classified.groupBy(*key_list(by, "comparison")).agg(
        F.coalesce(F.sum("down"), F.lit(0)).alias("down"), F.coalesce(F.sum("up"), F.lit(0)).alias("up"),
        F.count(F.lit(1)).alias("n"),
    ).withColumn("label", F.concat(
        F.col("comparison"), F.lit("\nDown "), F.col("down").cast("string"), F.lit(" / Up "),
        F.col("up").cast("string")))


def volcano_labelled(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Classified rows with their comparison's label (a fan-out join to one row
    per comparison, so the popular side is never gathered in a window)."""
    labels = volcano_counts(classified, by).select(*key_list(by, "comparison"), "label")
    return classified.join(pinned_side(labels), key_list(by, "comparison"), "left")


def summarize_volcano(results: DataFrame, pattern: str = "_UPS", id: str = "id") -> DataFrame:
    """Long results with the ground-truth class and -log10 FDR."""
    return add_class(results, pattern, id=id).withColumn("neg_log10_fdr", -F.log10("fdr"))


def summarize_ttest_fdr(results: DataFrame, pattern: str = "_UPS", yes: str = "UPS1", no: str = "Background",
                        id: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """Significant ids per comparison, one column per class (NULL when none)."""
    hits = add_class(results.where(F.col("fdr") < ALPHA), pattern, yes, no, id)
    counts = [F.nullif(F.count_if(F.col("class") == c), F.lit(0)).alias(c) for c in (no, yes)]
    return hits.groupBy(*key_list(by, "comparison")).agg(*counts)


def summarize_fc(effects: DataFrame, pattern: str = "_UPS", id: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """Median, mean and standard deviation of the back-transformed fold change
    per (comparison, class)."""
    groups = key_list(by, "comparison", "class")
    ratio = back_transform(add_class(effects, pattern, id=id), "fc").select(*groups, "fc")
    medians = exact_quantiles(ratio, "fc", groups, {"median": 0.5})
    rest = ratio.groupBy(*groups).agg(F.avg("fc").alias("mean"), F.stddev_samp("fc").alias("sd"))
    return null_safe_join(medians, rest, groups)


def coefficient_of_variation(df: DataFrame, id: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """Mean, standard deviation and CV in percent per (id, condition)."""
    sd = F.sqrt("variance")
    return group_moments(df, id, by=by).select(
        *key_list(by, id), "condition", "mean", sd.alias("sd"), (F.try_divide(sd, F.col("mean")) * 100).alias("cv"))


def summarize_cv(df: DataFrame, id: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """Mean, median and 90 % quantile of the CV per condition."""
    groups = key_list(by, "condition")
    cv = coefficient_of_variation(df, id, by).select(*groups, "cv")
    quantiles = exact_quantiles(cv, "cv", groups, {"cv_median": 0.5, "cv_90": 0.9})
    return null_safe_join(quantiles, cv.groupBy(*groups).agg(F.avg("cv").alias("cv_mean")), groups)


def cv_by_class(df: DataFrame, pattern: str = "P_", yes: str = "P", no: str = "N", id: str = "id",
                by: Sequence[str] = ()) -> DataFrame:
    """Median CV on the back-transformed scale per (condition, class)."""
    groups = key_list(by, "condition", "class")
    cv = add_class(coefficient_of_variation(back_transform(df), id, by), pattern, yes, no, id)
    return exact_quantiles(cv, "cv", groups, {"median": 0.5})


def summarize_z(profiles: DataFrame, pattern: str = "_UPS", id: str = "id") -> DataFrame:
    """Long z-profiles with the ground-truth class."""
    return add_class(profiles, pattern, id=id)


def summarize_count(df: DataFrame, column: str) -> DataFrame:
    """Frequency of every non-NULL value, most frequent first."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("freq", F.col("n") / total).orderBy(F.col("n").desc(), F.col(column))


def count_terms(df: DataFrame, column: str, threshold: int = 0, width: int = 25) -> DataFrame:
    """Values counted more than ``threshold`` times; the frequency refers to all
    values. ``term`` is the shortened value."""
    return summarize_count(df, column).where(F.col("n") > threshold).withColumn(
        "term", text.truncate(F.col(column), width))


def site_counts(df: DataFrame) -> DataFrame:
    """Sites per identifier, identifiers per accession and distinct sites per
    accession, on every row of a table with ``accession`` and ``sites``, which is pinned:
    it is counted and read."""
    df = pin(df)
    sites = df.select("accession", F.posexplode_outer(F.split("sites", "-")).alias("_at", "_site"))
    per_site = sites.groupBy("accession", "_site").agg(
        F.count_if(F.coalesce("_at", F.lit(0)) == 0).alias("_rows"))
    per_accession = per_site.groupBy("accession").agg(
        F.sum("_rows").alias("identifiers_accession"), F.count(F.lit(1)).alias("sites_accession"))
    counted = df.withColumn("sites_identifier", F.regexp_count(F.col("sites"), F.lit("-")) + 1)
    return null_safe_join(counted, per_accession, ["accession"], "left")


def sites_per_accession(counted: DataFrame, identifier: str = "identifier") -> DataFrame:
    """The first row of every accession (in identifier order)."""
    return first_per_key(counted, ["accession"], [F.col(identifier).asc_nulls_last()])


def sample_box_stats(df: DataFrame, groups: Sequence[str] = ("condition", "replicate"), value: str = "abundance",
                     by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, most extreme values within 1.5 interquartile ranges, and counts
    per sample."""
    keys = key_list(by, *groups)
    quartiles = exact_quantiles(df, value, keys, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    fences = quartiles.withColumn("_reach", 1.5 * (F.col("q3") - F.col("q1")))
    x = F.col(value)
    placed = null_safe_join(df.where(x.isNotNull()).select(*keys, value), pinned_side(fences), keys)
    inside = F.when((x >= F.col("q1") - F.col("_reach")) & (x <= F.col("q3") + F.col("_reach")), x)
    return placed.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(inside).alias("lower"), F.max(inside).alias("upper"), F.count(F.lit(1)).alias("n"),
        F.count_if(inside.isNull()).alias("outliers"))


def histogram(df: DataFrame, width: float = 0.1, value: str = "mean", groups: Sequence[str] = ("condition",)
              ) -> DataFrame:
    """Counts per bin of the given width, bins centred on its multiples."""
    index = F.floor((F.col(value) + F.lit(width / 2)) / F.lit(width))
    return df.where(F.col(value).isNotNull()).groupBy(*groups, index.alias("bin")).agg(
        F.count(F.lit(1)).alias("n")).withColumn("center", F.col("bin") * F.lit(width))


def heatmap_order(df: DataFrame, id: str = "id", value: str = "abundance") -> DataFrame:
    """Ids ordered by descending mean value."""
    return df.groupBy(id).agg(F.avg(value).alias("mean_value")).orderBy(F.col("mean_value").desc(), F.col(id))

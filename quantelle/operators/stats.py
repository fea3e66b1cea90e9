"""Moments, tests, fold changes and z-profiles.

Everything derives from one partially aggregated pass over the long table:
count, mean and variance per (id, condition). With a known list of conditions
the moments of an id are columns of a single row, so contrasts, ANOVA and
profiles are expressions on that row and need no further exchange.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..design import Contrast
from ..functions.tails import f_sf
from .keys import key_list
from .ranking import adjust_bh

_CONSTANT = 10 * sys.float_info.epsilon


def group_moments(df: DataFrame, id: str = "id", value: str = "abundance", by: Sequence[str] = ()) -> DataFrame:
    """n, mean and sample variance per (id, condition); NULL abundances are not counted."""
    return df.groupBy(*key_list(by, id), "condition").agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("variance"))


def condition_means(df: DataFrame, id: str = "id", by: Sequence[str] = ()) -> DataFrame:
    return group_moments(df, id, by=by).select(*key_list(by, id), "condition", "mean")


def _moment_row(df: DataFrame, conditions: Sequence[str], id: str, by: Sequence[str], variance: bool = True
                ) -> DataFrame:
    """One row per id with n, mean (and variance) of every condition as columns."""
    columns = []
    for i, c in enumerate(conditions):
        x = F.when(F.col("condition") == c, F.col("abundance"))
        columns += [F.count(x).alias(f"_n{i}"), F.avg(x).alias(f"_m{i}")]
        if variance:
            columns.append(F.var_samp(x).alias(f"_v{i}"))
    return df.groupBy(*key_list(by, id)).agg(*columns)


def _within(n: Column, v: Column) -> Column:
    """Sum of squares inside a group; a single value contributes nothing."""
    return F.when(n > 1, (n - 1) * v).otherwise(F.lit(0.0))


def compare(df: DataFrame, contrasts: Sequence[Contrast], id: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """One row per (id, contrast): group means, fold change, pooled-variance t
    statistic, degrees of freedom and two-sided p-value (not yet adjusted).

    The p-value is NULL where the statistic is undefined: fewer than three
    values, an empty side, or data without variation.
    """
    conditions = list(dict.fromkeys(c for k in contrasts for c in (k.left, k.right)))
    at = {c: i for i, c in enumerate(conditions)}
    pairs = F.array(*[
        F.struct(
            F.lit(k.name).alias("comparison"),
            *[F.col(f"_{s}{at[k.left]}").alias(f"{s}1") for s in "nmv"],
            *[F.col(f"_{s}{at[k.right]}").alias(f"{s}2") for s in "nmv"],
        ) for k in contrasts
    ])
    keys = key_list(by, id)
    rows = _moment_row(df, conditions, id, by).select(*keys, F.inline(pairs))
    n1, n2, m1, m2 = (F.col(c) for c in ("n1", "n2", "m1", "m2"))
    dof = n1 + n2 - 2
    pooled = F.try_divide(_within(n1, F.col("v1")) + _within(n2, F.col("v2")), F.when(dof > 0, dof))
    error = F.sqrt(pooled * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    varies = error >= F.lit(_CONSTANT) * F.greatest(F.abs(m1), F.abs(m2))
    scored = rows.select(
        *keys, "comparison", m1.alias("mean_left"), m2.alias("mean_right"), (m2 - m1).alias("fc"),
        F.when(varies, F.try_divide(m2 - m1, error)).alias("t"), F.when(dof > 0, dof).cast("double").alias("dof"))
    return scored.withColumn("p_value", f_sf(F.col("t") * F.col("t"), F.lit(1.0), F.col("dof")))


def calculate_ttest(df: DataFrame, contrasts: Sequence[Contrast], id: str = "id", by: Sequence[str] = (),
                    partitions: int | None = None) -> DataFrame:
    """Two-sided t-test per id and contrast with Benjamini-Hochberg FDR per contrast."""
    tested = compare(df, contrasts, id, by)
    return adjust_bh(tested, "p_value", key_list(by, "comparison"), (id,), "fdr", partitions)


def _anova_terms(df: DataFrame, conditions: Sequence[str], id: str, by: Sequence[str]) -> DataFrame:
    row = _moment_row(df, conditions, id, by)
    n = [F.col(f"_n{i}") for i in range(len(conditions))]
    m = [F.coalesce(F.col(f"_m{i}"), F.lit(0.0)) for i in range(len(conditions))]
    v = [F.col(f"_v{i}") for i in range(len(conditions))]
    total = reduce(lambda a, b: a + b, n)
    grand = F.try_divide(reduce(lambda a, b: a + b, [ni * mi for ni, mi in zip(n, m)]), total)
    groups = reduce(lambda a, b: a + b, [(ni > 0).cast("int") for ni in n])
    with_grand = row.withColumns({"_grand": grand, "_groups": groups, "_total": total})
    between = reduce(lambda a, b: a + b, [ni * (mi - F.col("_grand")) * (mi - F.col("_grand")) for ni, mi in zip(n, m)])
    within = reduce(lambda a, b: a + b, [_within(ni, vi) for ni, vi in zip(n, v)])
    scale = F.greatest(*[F.abs(mi) for mi in m], F.lit(0.0))
    return with_grand.withColumns({"_ssb": between, "_ssw": within, "_scale": scale})


def anova(df: DataFrame, conditions: Sequence[str], id: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """One-way analysis of variance per id over the given conditions: F, degrees
    of freedom and p-value (NULL without variation inside the conditions)."""
    if len(conditions) < 2:
        raise ValueError("analysis of variance needs at least two conditions")
    terms = _anova_terms(df, conditions, id, by)
    d1 = (F.col("_groups") - 1).cast("double")
    d2 = (F.col("_total") - F.col("_groups")).cast("double")
    rows = terms.select(
        *key_list(by, id), F.when(d1 > 0, d1).alias("dof1"), F.when(d2 > 0, d2).alias("dof2"),
        "_ssb", "_ssw", "_scale")
    residual = F.try_divide(F.col("_ssw"), F.col("dof2"))
    varies = F.sqrt(residual) > F.lit(_CONSTANT) * F.col("_scale")
    statistic = F.when(varies, F.try_divide(F.try_divide(F.col("_ssb"), F.col("dof1")), residual))
    scored = rows.select(*key_list(by, id), "dof1", "dof2", statistic.alias("f"))
    return scored.withColumn("p_value", f_sf(F.col("f"), F.col("dof1"), F.col("dof2")))


def calculate_1anova(df: DataFrame, conditions: Sequence[str], id: str = "id", by: Sequence[str] = (),
                     partitions: int | None = None) -> DataFrame:
    """ANOVA with Benjamini-Hochberg FDR over all ids (per ``by`` group)."""
    return adjust_bh(anova(df, conditions, id, by), "p_value", by, (id,), "fdr", partitions)


def calculate_fc(df: DataFrame, contrasts: Sequence[Contrast], id: str = "id", by: Sequence[str] = (),
                 out: str = "fc") -> DataFrame:
    """mean(right) - mean(left) per id and contrast. On log values a fold change,
    on occupancies a change in oxidation (``out="change_ox"``)."""
    conditions = list(dict.fromkeys(c for k in contrasts for c in (k.left, k.right)))
    at = {c: i for i, c in enumerate(conditions)}
    effects = F.array(*[
        F.struct(F.lit(k.name).alias("comparison"),
                 (F.col(f"_m{at[k.right]}") - F.col(f"_m{at[k.left]}")).alias(out)) for k in contrasts
    ])
    return _moment_row(df, conditions, id, by, variance=False).select(*key_list(by, id), F.inline(effects))


def add_fc_max(effects: DataFrame, effect: str = "fc", out: str = "fc_max", id: str = "id",
               by: Sequence[str] = ()) -> DataFrame:
    """Signed extreme of an id's effects; of two equal magnitudes the negative
    one. NULL as soon as one effect is NULL."""
    x = F.col(effect)
    extreme = F.when(F.max(x) > F.abs(F.min(x)), F.max(x)).otherwise(F.min(x))
    return effects.groupBy(*key_list(by, id)).agg(
        F.when(F.count(x) == F.count(F.lit(1)), extreme).alias(out))


def zscore_wide(df: DataFrame, conditions: Sequence[str], id: str = "id", by: Sequence[str] = (),
                suffix: str = "_Z") -> DataFrame:
    """Per-id z-scores of the condition means, one column per condition; NULL
    where the means do not vary or one is missing."""
    row = _moment_row(df, conditions, id, by, variance=False)
    k = len(conditions)
    m = [F.col(f"_m{i}") for i in range(k)]
    centre = reduce(lambda a, b: a + b, m) / F.lit(float(k))
    row = row.withColumn("_centre", centre)
    squares = reduce(lambda a, b: a + b, [(x - F.col("_centre")) * (x - F.col("_centre")) for x in m])
    row = row.withColumn("_sd", F.sqrt(F.try_divide(squares, F.lit(float(k - 1)))))
    return row.select(*key_list(by, id), *[
        F.try_divide(F.col(f"_m{i}") - F.col("_centre"), F.col("_sd")).alias(f"{c}{suffix}")
        for i, c in enumerate(conditions)
    ])


def zscore_profiles(df: DataFrame, conditions: Sequence[str], id: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """Long z-profiles ``(id, condition, condition_order, z)``."""
    wide = zscore_wide(df, conditions, id, by)
    rows = F.array(*[
        F.struct(F.lit(c).alias("condition"), F.lit(i).alias("condition_order"), F.col(f"`{c}_Z`").alias("z"))
        for i, c in enumerate(conditions)
    ])
    return wide.select(*key_list(by, id), F.inline(rows))

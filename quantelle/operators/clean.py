"""Filtering by observation count, transformation, imputation and missingness.

Zero means "not observed" throughout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..design import Design
from ..functions.noise import gaussian
from ..session import pin
from .keys import key_list, null_safe_join
from .ranking import exact_quantiles


def observed(abundance: Column) -> Column:
    return F.when(abundance != 0, abundance)


def clean_min(df: DataFrame, nonzero: int = 3, id: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """Keep ids that have at least ``nonzero`` observed replicates in some condition.

    Two windows over one sort of the (id, condition) rows; input that is already
    partitioned by id is not shuffled again.
    """
    keys = key_list(by, id)
    per_condition = Window.partitionBy(*keys, "condition")
    counted = df.withColumn("_seen", F.count(observed(F.col("abundance"))).over(per_condition))
    return (
        counted.withColumn("_best", F.max("_seen").over(Window.partitionBy(*keys)))
        .where(F.col("_best") >= nonzero)
        .drop("_seen", "_best")
    )


def transform_data(df: DataFrame, method: str = "log2") -> DataFrame:
    """``log2`` (zero, negative and NULL abundances become 0, i.e. missing) or ``asinh``."""
    a = F.col("abundance")
    if method == "log2":
        value = F.coalesce(F.log2(a), F.lit(0.0))
    elif method == "asinh":
        value = F.asinh(a)
    else:
        raise ValueError(f"unknown method {method!r}")
    return df.withColumn("abundance", value)


def back_transform(df: DataFrame, column: str = "abundance") -> DataFrame:
    return df.withColumn(column, F.pow(F.lit(2.0), F.col(column)))


def _per_condition(table: DataFrame, by: Sequence[str]) -> DataFrame:
    """A per-condition table is bounded by the design when there are no ``by`` keys."""
    return table if by else F.broadcast(table)


def impute_within(df: DataFrame, mode: str = "draw", seed: int = 123, id: str = "id",
                  by: Sequence[str] = ()) -> DataFrame:
    """Fill missing cells of an (id, condition) that has at least one observation.

    ``center`` uses the mean of the observed replicates, ``draw`` adds normal
    noise whose spread is the condition's median within-id standard deviation.
    The noise is a function of (id, condition, replicate, seed) only.
    """
    keys = key_list(by, id)
    per = Window.partitionBy(*keys, "condition")
    seen = observed(F.col("abundance"))
    centred = df.withColumn("_mean", F.avg(seen).over(per))
    missing = seen.isNull()
    if mode == "center":
        fill = F.col("_mean")
    elif mode == "draw":
        spread = _spread(df, keys, by)
        centred = null_safe_join(centred, _per_condition(spread, by), [*by, "condition"], "left")
        fill = F.col("_mean") + F.coalesce("_sd", F.lit(0.0)) * _noise(keys, seed)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    value = F.when(missing, F.coalesce(fill, F.lit(0.0))).otherwise(F.col("abundance"))
    return centred.withColumn("abundance", value).select(*df.columns)


def impute_absent(df: DataFrame, mode: str = "draw", q: float = 0.25, seed: int = 123, id: str = "id",
                  by: Sequence[str] = (), pinned: bool = False) -> DataFrame:
    """Fill cells that are still missing (the id was not observed in that
    condition at all) around the condition's ``q`` quantile of present values.

    The quantiles are pinned, so the result can be read again at the cost of reading ``df``.
    ``pinned`` says that ``df`` is a written table, whose values need no copy."""
    keys = key_list(by, id)
    seen = observed(F.col("abundance"))
    level = pin(exact_quantiles(df.withColumn("_seen", seen), "_seen", [*by, "condition"], {"_level": q}, pinned=pinned))
    filled = null_safe_join(df, _per_condition(level, by), [*by, "condition"], "left")
    fill = F.col("_level")
    if mode == "draw":
        filled = null_safe_join(filled, _per_condition(pin(_spread(df, keys, by)), by), [*by, "condition"], "left")
        fill = fill + F.coalesce("_sd", F.lit(0.0)) * _noise(keys, seed + 1)
    elif mode != "center":
        raise ValueError(f"unknown mode {mode!r}")
    value = F.when(seen.isNull(), fill).otherwise(F.col("abundance"))
    return filled.withColumn("abundance", value).select(*df.columns)


def impute(df: DataFrame, mode: str = "draw", q: float = 0.25, seed: int = 123, id: str = "id",
           by: Sequence[str] = ()) -> DataFrame:
    """Within-condition imputation followed by imputation of absent conditions.

    The second step takes a quantile of the first one's output, so it reads that
    output three times: it is pinned rather than sorted and computed again.
    """
    return impute_absent(pin(impute_within(df, mode, seed, id, by)), mode, q, seed, id, by, pinned=True)


def _spread(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Median over ids of the within-condition standard deviation."""
    sds = df.groupBy(*keys, "condition").agg(F.stddev_samp(observed(F.col("abundance"))).alias("_s"))
    return exact_quantiles(sds, "_s", [*by, "condition"], {"_sd": 0.5})


def _noise(keys: Sequence[str], seed: int) -> Column:
    return gaussian(*[F.col(k) for k in keys], F.col("condition"), F.col("replicate"), seed=seed)


def missing_conditions(raw: DataFrame, design: Design, id: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """``-``-joined, name-sorted conditions whose raw abundances sum to zero, per id."""
    ordered = sorted(design.conditions)
    sums = [F.sum(F.when(F.col("condition") == c, F.col("abundance"))).alias(f"_s{i}") for i, c in enumerate(ordered)]
    names = [F.when(F.col(f"_s{i}") == 0, F.lit(c)) for i, c in enumerate(ordered)]
    keys = key_list(by, id)
    return raw.groupBy(*keys).agg(*sums).select(
        *keys, F.nullif(F.concat_ws("-", *names), F.lit("")).alias("missing"))


def add_missingness(tested: DataFrame, raw: DataFrame, design: Design, id: str = "id",
                    by: Sequence[str] = ()) -> DataFrame:
    """Attach the list of completely unobserved conditions to tested ids. The raw rows are
    summed up before they meet the tested ids, so only one row per id is joined."""
    return tested.join(missing_conditions(raw, design, id, by), key_list(by, id), "left")

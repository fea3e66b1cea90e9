"""Wide <-> long reshaping, grid completion and result tables.

The long form ``(by..., id, condition, replicate, abundance)`` is canonical.
Wide rows become long rows with a generator rather than ``unpivot``: a generator
keeps the partitioning of its input, so everything after a per-id aggregate
stays on the same exchange.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..design import Design
from .keys import key_list, null_safe_join

#: Above this many samples the per-sample columns of one aggregate would leave
#: whole-stage code generation (100 fields), so the grid is joined instead.
MAX_WIDE_SAMPLES = 80


def to_long(df: DataFrame, design: Design, id: str = "id", by: Sequence[str] = ()) -> DataFrame:
    """Wide table with columns named ``Condition-Replicate`` -> long form.

    Conditions and replicates come from the design, so no name is split and a
    dash inside a condition is safe.
    """
    cells = F.array(*[
        F.struct(F.lit(s.condition).alias("condition"), F.lit(s.replicate).alias("replicate"),
                 F.col(f"`{s.name}`").cast("double").alias("abundance"))
        for s in design.samples
    ])
    return df.select(*key_list(by, id), F.inline(cells))


def to_wide(df: DataFrame, design: Design, id: str = "id", value: str = "abundance",
            by: Sequence[str] = ()) -> DataFrame:
    """Long form -> one row per id, one column per sample; absent cells are NULL."""
    cells = [
        F.max(F.when((F.col("condition") == s.condition) & (F.col("replicate") == s.replicate),
                     F.col(value))).alias(s.name)
        for s in design.samples
    ]
    return df.groupBy(*key_list(by, id)).agg(*cells)


def spread_conditions(df: DataFrame, conditions: Sequence[str], id: str = "id", value: str = "mean",
                      suffix: str = "", by: Sequence[str] = ()) -> DataFrame:
    """One column per condition (``<condition><suffix>``) from ``(id, condition, value)``."""
    return df.groupBy(*key_list(by, id)).agg(*[
        F.max(F.when(F.col("condition") == c, F.col(value))).alias(f"{c}{suffix}") for c in conditions
    ])


def densify(df: DataFrame, design: Design, id: str = "id", value: str = "abundance",
            by: Sequence[str] = ()) -> DataFrame:
    """Complete the (id, sample) grid; absent cells become 0, repeated cells are summed.

    One partially aggregated exchange on the id, whose partitioning is kept by
    the returned rows. An id with very many input rows is combined on the map
    side and reaches its task as one row per map task.
    """
    keys = key_list(by, id)
    if len(design.samples) <= MAX_WIDE_SAMPLES:
        sums = [
            F.sum(F.when((F.col("condition") == s.condition) & (F.col("replicate") == s.replicate),
                         F.col(value))).alias(f"_c{i}")
            for i, s in enumerate(design.samples)
        ]
        cells = F.array(*[
            F.struct(F.lit(s.condition).alias("condition"), F.lit(s.replicate).alias("replicate"),
                     F.coalesce(F.col(f"_c{i}").cast("double"), F.lit(0.0)).alias("abundance"))
            for i, s in enumerate(design.samples)
        ])
        return df.groupBy(*keys).agg(*sums).select(*keys, F.inline(cells))
    grid_cells = F.array(*[
        F.struct(F.lit(s.condition).alias("condition"), F.lit(s.replicate).alias("replicate"))
        for s in design.samples
    ])
    grid = df.select(*keys).distinct().select(*keys, F.inline(grid_cells))
    cells = df.groupBy(*keys, "condition", "replicate").agg(F.sum(value).cast("double").alias("_cell"))
    return null_safe_join(grid, cells, [*keys, "condition", "replicate"], "left").select(
        *keys, "condition", "replicate", F.coalesce("_cell", F.lit(0.0)).alias("abundance"))


def results_long(df: DataFrame, id: str = "id", statistics: Sequence[str] = ("P", "FDR", "FC"),
                 by: Sequence[str] = ()) -> DataFrame:
    """Columns ``<comparison>_<statistic>`` of an external wide result -> one row
    per (id, comparison) with one column per statistic (NULL when absent). A name is split
    at its last ``_``, so comparisons may hold others."""
    found: dict[str, dict[str, str]] = {}
    pattern = re.compile(rf"^(.+)_({'|'.join(map(re.escape, statistics))})$")
    for name in df.columns:
        hit = pattern.match(name)
        if hit and name not in (*by, id):
            found.setdefault(hit.group(1), {})[hit.group(2)] = name
    if not found:
        raise ValueError("no column is named <comparison>_<statistic>")
    rows = F.array(*[
        F.struct(F.lit(comparison).alias("comparison"), *[
            (F.col(f"`{cols[s]}`") if s in cols else F.lit(None)).cast("double").alias(s) for s in statistics
        ])
        for comparison, cols in found.items()
    ])
    return df.select(*key_list(by, id), F.inline(rows))


def results_wide(df: DataFrame, comparisons: Sequence[str], statistics: dict[str, str], id: str = "id",
                 by: Sequence[str] = ()) -> DataFrame:
    """Long results -> ``<comparison>_<suffix>`` columns; ``statistics`` maps a
    column of ``df`` to its suffix, e.g. ``{"p_value": "P", "fdr": "FDR"}``."""
    return df.groupBy(*key_list(by, id)).agg(*[
        F.max(F.when(F.col("comparison") == c, F.col(col))).alias(f"{c}_{suffix}")
        for c in comparisons for col, suffix in statistics.items()
    ])

"""Small helpers for grouping keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin

#: Largest narrow table that is broadcast.
MAX_BROADCAST_ROWS = 200_000


def key_list(by: Sequence[str], *rest: str) -> list[str]:
    """``by`` keys (for example an experiment) followed by the operator's own keys."""
    return [*by, *rest]


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL matches NULL; the key columns of
    ``left`` are kept."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = None
    for k in keys:
        match = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        condition = match if condition is None else condition & match
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def strict_sum(c: Column) -> Column:
    """Sum that is NULL as soon as one value is NULL."""
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def pinned_side(df: DataFrame, limit: int | None = None) -> DataFrame:
    """A narrow join side, written once, and broadcast if it was counted to have at most
    ``limit`` rows (``MAX_BROADCAST_ROWS``); a larger one is joined by a shuffle."""
    side = pin(df)
    return F.broadcast(side) if side.count() <= (MAX_BROADCAST_ROWS if limit is None else limit) else side

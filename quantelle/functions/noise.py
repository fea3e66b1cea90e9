"""Reproducible normal noise that does not depend on partitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def digits(*keys: Column, seed: int) -> Column:
    """32 hexadecimal digits of a row's keys: the MD5 of the seed and the keys' texts."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("-")) for k in keys]))


def uniform(text: Column, start: int) -> Column:
    """Twelve hexadecimal digits as a number in (0, 1)."""
    return (F.conv(F.substring(text, start, 12), 16, 10).cast("double") + 0.5) / F.lit(float(2**48))


def gaussian(*keys: Column, seed: int = 123) -> Column:
    """Standard normal draw (Box-Muller) that is a function of the row's keys only; any
    engine with MD5 can repeat it."""
    drawn = digits(*keys, seed=seed)
    return F.sqrt(-2.0 * F.log(uniform(drawn, 1))) * F.cos(2.0 * math.pi * uniform(drawn, 13))

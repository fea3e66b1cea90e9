"""Rows chosen without their wide columns, which only the chosen ones get back.

Candidates that compete for a feature carry one abundance per sample, most of a row's
bytes, and most candidates lose. The choice is made on the other columns; then the source
is read once more, and only rows that may be among the chosen ones are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import drop_finished, pin
from .ranking import first_per_key

#: Rows with at most so many samples are carried whole.
FEW_SAMPLES = 6
#: Bits of a sieve for each chosen row, and the binary logarithms of the bits of one block
#: and of all blocks at most (32 MB, which every task of the reading stage gets).
BITS_PER_ROW, BLOCK_BITS, MAX_BITS = 32, 15, 28


def _spot(near: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in near]), F.lit(1 << bits))


def sift(source: DataFrame, chosen: DataFrame, near: Sequence[str]) -> DataFrame:
    """Rows of ``source`` that agree in ``near`` with a row of ``chosen``, and some others
    that do not: one in 32 or fewer, more where the chosen rows outgrow the bits. ``chosen``
    is read twice. The test is a filter on the columns ``near``, so Spark makes it before
    other columns are parsed, computed or joined."""
    bits = min(MAX_BITS, max(BLOCK_BITS, (BITS_PER_ROW * chosen.count()).bit_length()))
    size = 1 << BLOCK_BITS
    spots = chosen.select(_spot(near, bits).alias("_spot")).select(
        F.shiftright("_spot", BLOCK_BITS).alias("_block"), F.pmod("_spot", F.lit(size)).alias("_at"))
    every = chosen.sparkSession.range(1 << (bits - BLOCK_BITS)).select(F.col("id").alias("_block"), F.lit(None).cast("long").alias("_at"))
    blocks = spots.unionByName(every).repartition("_block").groupBy("_block").agg(F.bitmap_construct_agg("_at").alias("_marks"))
    in_order = F.array_sort(F.collect_list(F.struct("_block", "_marks")))
    marks = blocks.agg(in_order.alias("_all")).select(F.col("_all._marks").alias("_all")).scalar()
    spot = _spot(near, bits)
    at = F.pmod(spot, F.lit(size))
    byte = F.substr(F.get(marks, F.shiftright(spot, BLOCK_BITS).cast("int")), F.shiftright(at, 3).cast("int") + 1, F.lit(1))
    bit = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), F.pmod(at, F.lit(8)).cast("int") + 1)
    return source.where(F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(bit) != 0)


def fetch(chosen: DataFrame, source: DataFrame, columns: Sequence[str], keys: Sequence[str], near: Sequence[str]) -> DataFrame:
    """``chosen`` with ``columns`` of the row of ``source`` that has the same ``keys``, NULLs
    included; of several such rows the one with the least values. ``near`` are keys that
    few rows share. ``chosen`` is pinned."""
    rows = pin(chosen)
    drop_finished(rows.sparkSession)
    key = F.struct(*[F.col(f"`{c}`") for c in keys]).alias("_key")
    values = [F.col(f"`{c}`") for c in columns]
    found = first_per_key(sift(source, rows, near).select(key, *values), ["_key"], values)
    extra = [c for c in chosen.columns if c not in keys]
    joined = rows.select(key, *[F.col(f"`{c}`") for c in extra]).join(found, "_key")
    return joined.select(*[F.col(f"_key.`{c}`") if c in keys else F.col(f"`{c}`") for c in chosen.columns], *values)

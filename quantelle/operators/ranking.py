"""Order-dependent operators that never put a whole family into one task:
Benjamini-Hochberg adjustment, exact quantiles and top-k per group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin
from .keys import null_safe_join, pinned_side

#: Slabs of p-values to a halving; one holds at most values that differ by 0.02 %.
SLABS_PER_OCTAVE = 4096


def _log_slab(p: Column) -> Column:
    """Number of the slab of a p-value; it never falls as p grows. Slabs are equally wide on
    a logarithmic scale, so no sample of the data is needed to cut them."""
    return F.when(p > 0, F.floor(F.log2(p) * SLABS_PER_OCTAVE)).otherwise(F.lit(-(2**40)))


def adjust_bh(df: DataFrame, p: str = "p_value", family: Sequence[str] = (), tie: Sequence[str] = ("id",),
              out: str = "fdr", partitions: int | None = None) -> DataFrame:
    """Benjamini-Hochberg adjusted p-values within each family.

    Equal p-values have equal results, so the work is done on the distinct ones with their
    counts, which are combined before they are shuffled: a value that very many rows share
    is one row. Distinct values lie in slabs of close values. The rank of a value is the
    count of earlier slabs plus the running count in its own; the minimum over larger
    values is the running one inside the slab combined with the minima of later slabs. Only
    one row per (slab, family), at most some hundred thousand a family whatever the data,
    is combined across slabs. The rows themselves meet their results in one join.

    ``df`` is pinned, as it is read twice. Rows with a NULL p count towards the family size
    and get a NULL result. ``tie`` is not needed and kept for callers; ``partitions`` is the
    number of tasks for the slabs.
    """
    family = list(family)
    slab = [*family, "_slab"]
    rows = pin(df)
    tests = rows.where(F.col(p).isNotNull()).groupBy(*family, _log_slab(F.col(p)).alias("_slab"), F.col(p).alias("_p")).agg(
        F.count(F.lit(1)).alias("_c"))
    tests = pin(tests.repartition(partitions, *slab) if partitions else tests.repartition(*slab))
    sizes = rows.groupBy(*family).agg(F.count(F.lit(1)).alias("_m"))
    earlier = Window.partitionBy(*family).orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    counts = tests.groupBy(*slab).agg(F.sum("_c").alias("_rows")).withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    placed = null_safe_join(null_safe_join(tests, pinned_side(counts), slab), pinned_side(sizes), family) if family else null_safe_join(
        tests, pinned_side(counts), slab).withColumn("_m", F.lit(rows.count()))

    down = Window.partitionBy(*slab).orderBy(F.col("_p").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank = F.col("_before") + F.col("_rows") - F.sum("_c").over(down) + F.col("_c")
    raw = placed.withColumn("_raw", F.col("_m") / rank * F.col("_p"))
    running = pin(raw.select(*slab, "_p", F.min("_raw").over(down).alias("_running")))
    later = Window.partitionBy(*family).orderBy(F.col("_slab").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = running.groupBy(*slab).agg(F.min("_running").alias("_least")).select(*slab, F.min("_least").over(later).alias("_carry"))
    value = F.least(F.lit(1.0), F.col("_running"), F.col("_carry"))
    adjusted = pinned_side(null_safe_join(running, pinned_side(carry), slab).select(*family, F.col("_p"), value.alias("_q")))
    found = null_safe_join(rows.withColumn("_p", F.col(p)), adjusted, [*family, "_p"], "left")
    return found.select(*df.columns, F.col("_q").alias(out))


def adjust_bh_small(df: DataFrame, p: str = "p_value", family: Sequence[str] = (), out: str = "fdr") -> DataFrame:
    """The same adjustment when the caller knows that every family is small
    (say under a million rows) and there are many of them: one window per family."""
    family = list(family)
    whole = Window.partitionBy(*family)
    down = Window.partitionBy(*family).orderBy(F.col(p).desc_nulls_first())
    rank = F.col("_m") - F.row_number().over(down) + 1
    return (
        df.withColumn("_m", F.count(F.lit(1)).over(whole))
        .withColumn("_raw", F.col("_m") / rank * F.col(p))
        .withColumn(out, F.min("_raw").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn(out, F.when(F.col(p).isNotNull(), F.least(F.lit(1.0), F.col(out))))
        .drop("_m", "_raw")
    )


def exact_quantiles(df: DataFrame, value: str, groups: Sequence[str], probs: Mapping[str, float],
                    limit: int = 100_000, bins: int = 4096, pinned: bool = False) -> DataFrame:
    """Exact linearly interpolated quantiles (R type 7) per group.

    ``probs`` maps an output column to a probability. Every quantile starts with the range
    of its group as bracket. While a bracket holds more than ``limit`` values, one pass
    counts the values of ``bins`` equally wide cells of it, and the cell with the wanted
    rank, cut to the values in it, is the next bracket; a cell of one distinct value, or
    two ranks in neighbouring cells, end the search. What is left, at most ``limit`` values
    each, is ordered. Counts are combined before they are shuffled, so no group is ever
    merged or sorted as a whole, whatever its size and its ties.

    Values are written once and read by every pass; with ``pinned``, the caller says that
    ``df`` is little more than a written table, and it is read itself. NaN counts as the largest value.
    Groups without a value are left out; without groups there is one row.
    """
    groups = list(groups)
    names = list(probs)
    key = [*groups, "_i"]
    values = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_v"))
    values = values if pinned else pin(values)
    wanted = F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(float(probs[n])).alias("_at")) for i, n in enumerate(names)])
    sizes = values.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    at = F.col("_at") * (F.col("_n") - 1)
    nothing = F.lit(None).cast("double")
    state = sizes.select("*", F.inline(wanted)).select(
        *key, (at - F.floor(at)).alias("_part"), F.floor(at).alias("_k"), F.least(F.floor(at) + 1, F.col("_n") - 1).alias("_k2"), "_lo", "_hi",
        F.lit(0).cast("long").alias("_below"), F.col("_n").alias("_inside"), nothing.alias("_x"), nothing.alias("_x2"))
    state = pin(state)
    wide = F.col("_x").isNull() & (F.col("_inside") > limit) & (F.col("_lo") < F.col("_hi")) & (F.col("_hi") - F.col("_lo") < float("inf"))
    while not state.where(wide).isEmpty():
        state = pin(state.where(~wide).unionByName(_narrowed(values, state.where(wide), groups, bins)))
    single = F.col("_x").isNull() & (F.col("_lo") == F.col("_hi"))
    known = state.withColumns({"_x": F.when(single, F.col("_lo")).otherwise(F.col("_x")), "_x2": F.when(single, F.col("_lo")).otherwise(F.col("_x2"))})
    found = _ordered(values, known.where("_x IS NULL"), groups)
    done = known.where("_x IS NOT NULL").select(*key, "_part", "_x", "_x2").unionByName(found)
    quantile = F.col("_x") + (F.col("_x2") - F.col("_x")) * F.col("_part")
    return done.groupBy(*groups).agg(*[F.max(F.when(F.col("_i") == i, quantile)).alias(n) for i, n in enumerate(names)])


def _inside(values: DataFrame, brackets: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Values with every bracket of their group that holds them."""
    sides = brackets.select(*groups, "_i", "_lo", "_hi")
    joined = null_safe_join(values, pinned_side(sides), groups) if groups else values.crossJoin(F.broadcast(sides))  # one row a quantile
    return joined.where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))


def _with_ranks(counted: DataFrame, brackets: DataFrame, groups: Sequence[str], order: str) -> DataFrame:
    """Counts in order with the ranks they cover, and the ranks that are looked for."""
    upwards = Window.partitionBy(*groups, "_i").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sides = brackets.select(*groups, "_i", "_part", "_k", "_k2", "_below")
    ranked = null_safe_join(counted.withColumn("_upto", F.sum("_c").over(upwards)), pinned_side(sides), [*groups, "_i"])
    return ranked.withColumns({"_end": F.col("_below") + F.col("_upto"), "_start": F.col("_below") + F.col("_upto") - F.col("_c")})


def _covers(rank: str) -> Column:
    return (F.col("_start") <= F.col(rank)) & (F.col(rank) < F.col("_end"))


def _narrowed(values: DataFrame, brackets: DataFrame, groups: Sequence[str], bins: int) -> DataFrame:
    """One counting pass over the cells of the brackets."""
    width = (F.col("_hi") - F.col("_lo")) / bins
    cell = F.least(F.lit(bins - 1), F.floor((F.col("_v") - F.col("_lo")) / width))
    counted = _inside(values, brackets, groups).groupBy(*groups, "_i", cell.alias("_cell")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    ranked = _with_ranks(counted, brackets, groups, "_cell").where(_covers("_k") | _covers("_k2"))
    first, second = (lambda c: F.max(F.when(_covers("_k"), c))), (lambda c: F.max(F.when(_covers("_k2"), c)))
    picked = ranked.groupBy(*groups, "_i", "_part", "_k", "_k2").agg(
        first(F.col("_min")).alias("_lo"), first(F.col("_max")).alias("_hi"), first(F.col("_start")).alias("_below"), first(F.col("_c")).alias("_inside"),
        (first(F.col("_cell")) != second(F.col("_cell"))).alias("_apart"), second(F.col("_min")).alias("_next"))
    return picked.withColumns({"_x": F.when(F.col("_apart"), F.col("_hi")), "_x2": F.when(F.col("_apart"), F.col("_next"))}).drop("_apart", "_next")


def _ordered(values: DataFrame, brackets: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The wanted values of small brackets."""
    counted = _inside(values, brackets, groups).groupBy(*groups, "_i", "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranked = _with_ranks(counted, brackets, groups, "_v").where(_covers("_k") | _covers("_k2"))
    return ranked.groupBy(*groups, "_i", "_part").agg(
        F.max(F.when(_covers("_k"), F.col("_v"))).alias("_x"), F.max(F.when(_covers("_k2"), F.col("_v"))).alias("_x2"))


def top_k_per_group(df: DataFrame, groups: Sequence[str], order: Sequence, k: int) -> DataFrame:
    """First ``k`` rows of every group in a total order. Spark prunes each map
    task to ``k`` rows per group before the shuffle."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Keep the first row of every key in the given order."""
    return top_k_per_group(df, keys, order, 1)

"""Mixing of sources to target weights by Sainte-Laguë apportionment of equal-word blocks."""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash, word_count

#: Sources are named corpora whose weights a person states; more names than this is an error.
MAX_SOURCES = 1_000_000
MAX_BLOCK_WORDS = 4096
_LARGEST_INDEX = 2**31


@dataclass
class Share:
    """Plan of one source: words it has, words wanted, and per shard its blocks and quotas."""

    source: str | None
    size: int
    target: float
    blocks: list[int]
    quotas: list[int]


def fill_targets(sizes: list[int], weights: list[float], total: float, repeat: float) -> list[float]:
    """Share ``total`` by weight; a target stops at ``repeat`` times its size and the
    excess is shared again by weight among the rest until none is above."""
    targets, capped = [0.0] * len(sizes), [False] * len(sizes)
    while True:
        left = total - sum(repeat * s for s, c in zip(sizes, capped) if c)
        weight = sum(w for w, c in zip(weights, capped) if not c)
        over = False
        for i, (s, w) in enumerate(zip(sizes, weights)):
            targets[i] = repeat * s if capped[i] else left * w / weight
        for i, s in enumerate(sizes):
            if not capped[i] and targets[i] > repeat * s:
                capped[i] = over = True
        if not over:
            return targets
        if all(capped):
            return [repeat * s for s in sizes]


def apportion(votes: list[float], seats: int, caps: list[int]) -> list[int]:
    """Sainte-Laguë: seats go to the highest quotients ``votes / (2 k + 1)``, ties to the
    first, no one above its cap; fewer seats are dealt only when all are at their caps.

    Quotients above a divisor at which no more than ``seats`` exist are taken at once;
    a heap deals the few that are left.
    """
    total = sum(votes)
    spare = seats - len(votes) / 2
    divisor = total / spare if spare > 0 and total > 0 else math.inf
    got = [min(c, math.floor(v / divisor + 0.5)) if divisor < math.inf else 0 for v, c in zip(votes, caps)]
    heap = [(-v / (2 * g + 1), i) for i, (v, g, c) in enumerate(zip(votes, got, caps)) if g < c and v > 0]
    heapq.heapify(heap)
    left = seats - sum(got)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        got[i] += 1
        left -= 1
        if got[i] < caps[i]:
            heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    return got


def plan_mix(sizes: list[tuple[str | None, int]], weights=(5, 2, 1), share: float = 1.5, repeat: int = 2, shards: int = 8) -> tuple[int, list[Share]]:
    """Block length in words and the plan of every source; ``sizes`` by code point, null last."""
    total = sum(n for _, n in sizes)
    targets = fill_targets([n for _, n in sizes], [weights[i % len(weights)] for i in range(len(sizes))], share * total, repeat) if total else [0.0] * len(sizes)
    least = min((t for t in targets if t > 0), default=1.0)
    block = max(1, min(MAX_BLOCK_WORDS, int(least // 256)), math.ceil(total / (_LARGEST_INDEX * shards)))
    blocks = [-(-n // block) for _, n in sizes]
    quotas = apportion(targets, round(sum(targets) / block), [repeat * b for b in blocks])
    plan = []
    for (source, size), target, n, quota in zip(sizes, targets, blocks, quotas):
        held = [n // shards + (s < n % shards) for s in range(shards)]
        plan.append(Share(source, size, target, held, apportion([float(h) for h in held], quota, [repeat * h for h in held])))
    return block, plan


def _stride(n: int, seed: int, source: int, shard: int) -> tuple[int, int]:
    """Step prime to ``n`` and offset of a seeded permutation ``(step * i + offset) mod n``."""
    step = int(n * 0.6180339887) + (seed * 31 + source * 7 + shard) % 97 + 1
    while math.gcd(step, n) != 1:
        step += 1
    return step % n, (seed * 1_000_003 + source * 10_007 + shard * 101) % n


def mix(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=(5, 2, 1), share: float = 1.5,
        repeat: int = 2, shards: int = 8, seed: int = 17) -> DataFrame:
    """Per document ``(key, size, source_size, target, taken, u)``.

    A source's documents stand in seeded order and are cut into blocks of equal word
    count; block ``j`` belongs to shard ``j mod shards``. Each shard takes its quota of
    blocks: all of them as often as they fit, and a seeded choice once more. ``taken``
    counts the document's words in the blocks taken, at most ``repeat`` times its size;
    ``u`` in [0, 1) is the document's seeded number. Only one row per source, at most
    ``MAX_SOURCES``, comes to the driver; positions come from prefix sums over range
    partitions, so a source of any share of the rows is spread over tasks.

    NULL sources are one source, the last; NULL and empty texts have size 0 and take 0
    words. Repeated rows are separate documents. A corpus without words has targets 0; an
    empty table gives no rows.
    """
    spark = documents.sparkSession
    body = F.col(f"`{text}`")
    sized = stash(documents.select(
        F.col(f"`{key}`").alias("k"), F.col(f"`{source}`").alias("s"), word_count(body).alias("n"),
        F.xxhash64(F.lit(seed), F.col(f"`{key}`"), body).alias("h")), "mix-sizes")
    per_source = sized.groupBy("s").agg(F.sum("n").alias("n"))
    if (count := per_source.count()) > MAX_SOURCES:
        raise ValueError(f"{count} sources; at most {MAX_SOURCES} can be weighted")
    rows = sorted(((r.s, r.n) for r in per_source.collect()), key=lambda r: (r[0] is None, r[0] or ""))
    block, plan = plan_mix(rows, weights, share, repeat, shards)

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = stash(sized.repartitionByRange(parts, "s", "h", "k", "n").withColumn("p", F.spark_partition_id()), "mix-order")
    earlier = Window.partitionBy("s").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy("s", "p").agg(F.sum("n").alias("words")).select(
        "s", "p", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("s", "p").orderBy("h", "k", "n").rowsBetween(Window.unboundedPreceding, -1)
    run = placed.withColumn("run", F.coalesce(F.sum("n").over(within), F.lit(0)))
    at = run.alias("r").join(bases.alias("b"), F.col("r.s").eqNullSafe(F.col("b.s")) & (F.col("r.p") == F.col("b.p"))).select(
        "r.k", "r.s", "r.n", "r.h", (F.col("run") + F.col("base")).alias("start"))

    table = []
    for i, x in enumerate(plan):
        steps = [_stride(h, seed, i, s) if h else (0, 0) for s, h in enumerate(x.blocks)]
        table.append((x.source, x.size, float(x.target), [max(h, 1) for h in x.blocks], [q // h if h else 0 for q, h in zip(x.quotas, x.blocks)],
                      [q % h if h else 0 for q, h in zip(x.quotas, x.blocks)], [a for a, _ in steps], [c for _, c in steps]))
    schema = "s string, source_size long, target double, held array<long>, whole array<long>, extra array<long>, step array<long>, shift array<long>"
    shares = spark.createDataFrame(table, schema)
    joined = at.alias("a").join(F.broadcast(shares).alias("q"), F.col("a.s").eqNullSafe(F.col("q.s")))

    def words_of(j: Column) -> Column:
        shard, index = (j % shards).cast("int"), F.floor(j / shards)
        chosen = (F.get("step", shard) * index + F.get("shift", shard)) % F.get("held", shard) < F.get("extra", shard)
        overlap = F.least(F.col("start") + F.col("n"), (j + 1) * block) - F.greatest(F.col("start"), j * block)
        return overlap * (F.get("whole", shard) + chosen.cast("long"))

    span = F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + n - 1) div {block}"))
    taken = F.when(F.col("n") > 0, F.aggregate(span, F.lit(0).cast("long"), lambda s, j: s + words_of(j))).otherwise(F.lit(0))
    return joined.select(
        F.col("k").alias(key), F.col("n").alias("size"), F.col("source_size"), F.col("target"), taken.cast("long").alias("taken"),
        (F.pmod(F.col("h"), F.lit(1 << 20)) / F.lit(float(1 << 20))).alias("u"))


def copies(mixed: DataFrame) -> DataFrame:
    """Whole copies of each document that stand for the words taken: ``taken / size``
    rounded up or down by the document's seeded number; one copy where there are no words."""
    n = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.floor(F.try_divide(F.col("taken"), F.col("size")) + F.col("u")))
    return mixed.withColumn("copies", n.cast("int"))

"""Frequent phrases and their cohesion by set-oriented mining of occurrence relations.

Texts are lower-cased (A-Z only), cut into pieces at ``.,;:!?`` and line breaks, and pieces
into words at blanks and tabs. The relation ``R_k`` holds the occurrences of the frequent
phrases of ``k`` words, sorted by piece and position: words are numbered within a block of
texts of one language, and a number is left out after every piece, so that neighbouring
numbers are neighbouring words of one piece. ``R_k`` is merge-joined with ``R_1`` at the
adjacent position, the pairs are counted (within the block, then over all blocks), pairs
below the least count are dropped, and the occurrences are semi-joined with the frequent
ones before they are extended again. Every relation is written once.

A block holds at most ``BLOCK_CHARS`` characters (or one longer piece) and sends each of
its distinct pairs once, with a count: the most frequent word of a corpus gives one row a
block. Relations lie in tables bucketed by block and are never shuffled; only frequent
phrases, with numbers given to them, go back to the blocks.

Counts are 64-bit, scores are taken in 38-digit decimals, nothing is rounded. A NULL text
is empty, a NULL language ``und``. Empty texts and tables give no rows. Documents are not
told apart, so repeated rows count as often as they occur and other columns play no part.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bucketed, checked, in_arrow, ship, slices, stash

BLOCK_CHARS = 2_000_000
#: Text bytes to a bucket of the relations.
BUCKET_BYTES, MAX_BUCKETS = 32_000_000, 100_000
#: Parts that a language's phrases are ranked in before its best are ranked together.
RANK_PARTS = 256
_STOP = b"."  # ends a piece; cannot be inside a word
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + _STOP * 9)
_PIECE_END = re.compile(r"[.,;:!?\n-\r]")
_BLOCK = "lang string, words array<string>, counts array<long>, total long, stream binary"
#: Occurrences of phrases (pos, grp) and of single words (wpos, wgrp), sorted; ``ids`` and ``wids`` are
#: the numbers of their groups. Positions are stored as gaps. ``R_1`` leaves pos and grp to wpos and wgrp.
_RELATION = "block long, pos binary, grp binary, ids binary, wpos binary, wgrp binary, wids binary"
_PAIRS = "block long, pair long"
_COUNTED = "part int, pairs binary, counts binary"
#: Distinct pairs that a task adds up before it sends them.
MAX_HELD = 4_000_000
#: So many frequent words or pairs (16 bytes each, and the words) are sent to all tasks for the
#: semi-join; more of them are joined by shuffles.
MAX_SENT = 500_000
_MASK = (1 << 33) - 1


def _cut(text: str, limit: int) -> Iterator[str]:
    """Parts of a text that end with a piece, each of about ``limit`` characters."""
    start = 0
    while len(text) - start > limit:
        end = _PIECE_END.search(text, start + limit)
        if end is None:
            break
        yield text[start:end.end()]
        start = end.end()
    yield text[start:]


def _encode(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Distinct words and the texts as their numbers from 1 on, 0 after every piece."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    number[_STOP]
    spaced = b" " + _STOP + b" "
    words = spaced.join(t.encode().translate(_TABLE).replace(_STOP, spaced) for t in texts).split()
    stream = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
    return [w.decode() for w in number][1:], stream


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    by_lang: dict[str, list[str]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        if text:
            by_lang.setdefault(lang, []).extend(_cut(text, BLOCK_CHARS))
    for lang, texts in by_lang.items():
        for a, b in slices(texts, BLOCK_CHARS):
            words, stream = _encode(texts[a:b])
            if words:
                counts = np.bincount(stream, minlength=len(words) + 1)[1:].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([words], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64())),
                     pa.array([int(counts.sum())], pa.int64()), pa.array([stream.tobytes()], pa.binary())],
                    ["lang", "words", "counts", "total", "stream"])


def _relation(block: int, *arrays: np.ndarray) -> pa.Table:
    names = [c.split()[0] for c in _RELATION.split(", ")]
    stored = [np.diff(a, prepend=0).astype(np.int32) if n in ("pos", "wpos") else a for n, a in zip(names[1:], arrays)]
    return pa.table([pa.array([block], pa.int64()), *[pa.array([a.tobytes()], pa.binary()) for a in stored]], names=names)


def _none(dtype: type = np.int32) -> np.ndarray:
    return np.zeros(0, dtype)


def _no_relation() -> pa.Table:
    return _relation(0, *[_none()] * 6).slice(0, 0)


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


class _Occurrences:
    """A row of a relation: arrays, and the merge-join with the words after each phrase."""

    def __init__(self, row: dict, k: int, width: int):
        self.block = row["block"]
        self.wpos = np.cumsum(np.frombuffer(row["wpos"], np.int32), dtype=np.int32)
        self.wgrp, self.wids = np.frombuffer(row["wgrp"], np.int32), np.frombuffer(row["wids"], np.int64)
        words = k == 2
        self.pos = self.wpos if words else np.cumsum(np.frombuffer(row["pos"], np.int32), dtype=np.int32)
        grp, ids = (self.wgrp, self.wids) if words else (np.frombuffer(row["grp"], np.int32), np.frombuffer(row["ids"], np.int64))
        following = self.pos + (k - 1)
        at = np.minimum(np.searchsorted(self.wpos, following), max(len(self.wpos) - 1, 0))
        self.hit = np.flatnonzero(self.wpos[at] == following) if len(self.wpos) else _none(np.int64)
        at = at[self.hit]
        #: One number for the phrase of an occurrence and the word after it.
        self.pair = ids[grp[self.hit]] * width + self.wids[self.wgrp[at]]


def _frequent_words(block: int, stream: bytes, local: np.ndarray, ids: np.ndarray) -> pa.Table:
    """``R_1`` of a block: the occurrences of its frequent words, given by number in the block."""
    if not len(local):
        return _no_relation()
    words = np.frombuffer(stream, np.int32)
    to = np.full(max(int(words.max()), int(local.max())) + 1, -1, np.int32)
    to[local] = np.arange(len(local), dtype=np.int32)
    grp = to[words]
    pos = np.flatnonzero(grp >= 0).astype(np.int32)
    return _relation(block, _none(), _none(), _none(np.int64), pos, grp[pos], ids.astype(np.int64))


def _words_of(left: pa.Table, right: pa.Table) -> pa.Table:
    if not left.num_rows or not right.num_rows:
        return _no_relation()
    return _frequent_words(left.column("block")[0].as_py(), left.column("stream")[0].as_py(), _column(right, "g"), _column(right, "id"))


def _words_sent(sent: Broadcast):
    """The same with all frequent words at hand, by language."""
    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i] for c in ("block", "lang", "words", "stream")}
            phrases, ids = sent.value.get(row["lang"].as_py(), (pa.array([], pa.string()), _none(np.int64)))
            at = pc.index_in(row["words"].values, value_set=phrases)
            local = np.flatnonzero(np.asarray(at.is_valid()))
            found = ids[np.asarray(at.drop_null())]
            yield from _frequent_words(row["block"].as_py(), row["stream"].as_py(), local + 1, found).to_batches()
    return each


def _pairs(k: int, width: int):
    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            pair = np.unique(_Occurrences(row, k, width).pair)
            for a in range(0, len(pair), 100_000):
                part = pair[a:a + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), row["block"], np.int64)), pa.array(part)],
                                                 [x.split()[0] for x in _PAIRS.split(", ")])
    return each


def _summed(pair: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order and the sums of their counts."""
    order = np.argsort(pair, kind="stable")
    pair, c = pair[order], c[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(pair), 1), bool), pair[1:] != pair[:-1])))
    return pair[first], np.add.reduceat(c, first) if len(first) else c


def _pair_counts(k: int, width: int, parts: int):
    """Counts of the pairs of a task's blocks, dealt to ``parts`` by pair; a part's pairs are
    sorted and sent as gaps, which take a third of the bytes of single rows."""
    def sent(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        pair, c = _summed(*map(np.concatenate, zip(*held)))
        part = ((pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        ends = np.cumsum(np.bincount(part.astype(np.int64), minlength=parts))
        for i, (a, b) in enumerate(zip([0, *ends], ends)):
            if b > a:
                gaps = np.diff(pair[order[a:b]], prepend=0)
                small = np.uint32 if gaps.max() < 2**32 else np.int64
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([gaps.astype(small).tobytes()], pa.binary()), pa.array([c[order[a:b]].tobytes()], pa.binary())],
                    [x.split()[0] for x in _COUNTED.split(", ")])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for row in batch.to_pylist():
                held.append(np.unique(_Occurrences(row, k, width).pair, return_counts=True))
                if sum(len(p) for p, _ in held) > MAX_HELD:
                    yield from sent(held)
                    held = []
        if held:
            yield from sent(held)
    return each


def _often(min_count: int):
    def each(table: pa.Table) -> pa.Table:
        """Pairs of one part that occur often enough over all blocks."""
        found = []
        for gaps, counts in zip(table.column("pairs").to_pylist(), table.column("counts").to_pylist()):
            c = np.frombuffer(counts, np.int64)
            wide = np.frombuffer(gaps, np.uint32 if len(gaps) == 4 * len(c) else np.int64)
            found.append((np.cumsum(wide, dtype=np.int64), c))
        pair, f = _summed(*map(np.concatenate, zip(*found)))
        return pa.table({"pair": pair[f >= min_count], "f": f[f >= min_count]})
    return each


def _narrowed(row: dict, k: int, width: int, longest: int, wanted: np.ndarray, ids: np.ndarray) -> pa.Table:
    """``R_k`` of a block, given the frequent pairs in order, and of ``R_1`` what later joins can
    still meet."""
    found = _Occurrences(row, k, width)
    group = np.minimum(np.searchsorted(wanted, found.pair), len(wanted) - 1)
    kept = wanted[group] == found.pair
    if not kept.any():
        return _no_relation()
    pos = found.pos[found.hit[kept]]
    local, grp = np.unique(group[kept], return_inverse=True)
    near = np.zeros(int(found.wpos[-1]) + longest + 1, bool)
    for step in range(k, longest):
        near[pos + step] = True
    still = near[found.wpos]
    return _relation(found.block, pos, grp.astype(np.int32), ids[local], found.wpos[still], found.wgrp[still], found.wids)


def _semi_joined(k: int, width: int, longest: int):
    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _no_relation()
        wanted, ids = _column(right, "pair"), _column(right, "id").astype(np.int64)
        order = np.argsort(wanted)
        return _narrowed(left.to_pylist()[0], k, width, longest, wanted[order], ids[order])
    return each


def _semi_sent(k: int, width: int, longest: int, sent: Broadcast):
    """The same with all frequent pairs at hand."""
    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            if len(sent.value[0]):
                yield from _narrowed(row, k, width, longest, *sent.value).to_batches()
    return each


def _numbered(frequent: DataFrame, label: str) -> DataFrame:
    """``frequent`` with ``id``, consecutive numbers from 0 on. Rows are written once with
    their places; a number is the place plus the rows of earlier parts."""
    placed = stash(frequent.withColumn("_at", F.monotonically_increasing_id()), label)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    parts = placed.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    joined = placed.withColumn("_part", F.shiftright("_at", 33)).join(checked(parts), "_part")
    return joined.withColumn("id", F.col("_before") + F.col("_at").bitwiseAND(F.lit(_MASK))).drop("_part", "_before", "_at")


def frequent_phrases(documents: DataFrame, min_count: int = 100, longest: int = 5, text: str = "text",
                     lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words that occur ``min_count`` times or more, as
    ``(lang, k, phrase, f)``, and the number of words of every language, ``(lang, n)``."""
    spark = documents.sparkSession
    ship(spark)
    rows = documents.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    size = rows.select(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(MAX_BUCKETS, size // BUCKET_BYTES + 1)
    blocks = bucketed(in_arrow(rows, _blocks, _BLOCK).withColumn("block", F.monotonically_increasing_id()), "block", buckets, "phrase_blocks")
    totals = stash(blocks.groupBy("lang").agg(F.sum("total").alias("n")), "totals")
    each = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("g", "_e")).select(
        F.col("block").alias("of"), "lang", (F.col("g") + 1).alias("g"), F.col("_e.words").alias("phrase"), F.col("_e.counts").alias("c"))
    words = _numbered(each.groupBy("lang", "phrase").agg(F.sum("c").alias("f")).where(F.col("f") >= min_count), "words")
    width = max(words.count(), 1)
    levels, last = [words.select("lang", F.lit(1).alias("k"), "phrase", "f")], words

    def written(relation: DataFrame, k: int) -> DataFrame:
        return bucketed(relation, "block", buckets, f"phrases_r{k}")

    if width <= MAX_SENT:
        table = words.select("lang", "phrase", "id").toPandas()
        sent = {x: (pa.array(g["phrase"], pa.string()), g["id"].to_numpy(np.int64)) for x, g in table.groupby("lang")}
        relation = in_arrow(blocks.select("block", "lang", "words", "stream"), _words_sent(spark.sparkContext.broadcast(sent)), _RELATION)
    else:
        found = each.select("of", "lang", "g", "phrase").join(words.select("lang", "phrase", "id"), ["lang", "phrase"]).select("of", "g", "id")
        relation = blocks.select("block", "stream").groupBy("block").cogroup(found.groupBy("of")).applyInArrow(_words_of, _RELATION)
    relation = written(relation, 1)
    for k in range(2, longest + 1):
        often = relation.mapInArrow(_pair_counts(k, width, buckets), _COUNTED).groupBy("part").applyInArrow(_often(min_count), "pair long, f long")
        split = often.withColumns({"_gid": F.expr(f"pair div {width}L"), "_wid": F.col("pair") % width})
        heads = last.select(F.col("id").alias("_gid"), "lang", F.col("phrase").alias("_head"))
        tails = words.select(F.col("id").alias("_wid"), F.col("phrase").alias("_tail"))
        named = split.join(heads, "_gid").join(tails, "_wid").select("pair", "lang", F.concat_ws(" ", "_head", "_tail").alias("phrase"), "f")
        last = _numbered(named, f"phrases{k}")
        levels.append(last.select("lang", F.lit(k).alias("k"), "phrase", "f"))
        if k == longest:
            break
        if last.count() <= MAX_SENT:
            table = last.select("pair", "id").toPandas().sort_values("pair")
            sent = spark.sparkContext.broadcast((table["pair"].to_numpy(np.int64), table["id"].to_numpy(np.int64)))
            relation = written(in_arrow(relation, _semi_sent(k, width, longest, sent), _RELATION), k)
        else:
            pairs = in_arrow(relation, _pairs(k, width), _PAIRS).select(F.col("block").alias("of"), "pair")
            found = pairs.join(last.select("pair", "id"), "pair").select("of", "pair", "id")
            relation = written(relation.groupBy("block").cogroup(found.groupBy("of")).applyInArrow(_semi_joined(k, width, longest), _RELATION), k)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out, totals


def collocations(documents: DataFrame, min_count: int = 100, longest: int = 5, top: int = 2000, text: str = "text",
                 lang: str = "lang") -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of every language by cohesion:
    ``(lang, rank, phrase, a, l, r, n, score)``.

    A phrase of count ``a`` that is cut after its first words, of count ``l``, leaving a
    rest of count ``r``, scores ``floor(1000 a n / (l r))`` among ``n`` words; its lowest
    cut counts, the first of equal ones. A phrase that some longer one holds as often is
    left out. Ties of score go by ``a``, then by phrase in byte order.
    """
    phrases, totals = frequent_phrases(documents, min_count, longest, text, lang)
    longer = phrases.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("_w"))
    shorter = phrases.select("lang", "phrase", "f")
    part = lambda start, length: F.array_join(F.slice("_w", start, length), " ")
    # What a longer phrase holds as often lies inside a phrase one word shorter that it holds as often, too.
    inner = longer.where("k > 2").select("lang", "a", F.explode(F.array(part(1, F.col("k") - 1), part(2, F.col("k") - 1))).alias("phrase"))
    held = inner.groupBy("lang", "phrase").agg(F.max("a").alias("_held"))
    kept = longer.join(held, ["lang", "phrase"], "left").where("_held IS NULL OR 100 * _held < 100 * a").drop("_held")
    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "lang", "phrase", "a", "cut", part(1, F.col("cut")).alias("_head"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("_tail"))
    sided = (cuts.join(shorter.select("lang", F.col("phrase").alias("_head"), F.col("f").alias("l")), ["lang", "_head"])
             .join(shorter.select("lang", F.col("phrase").alias("_tail"), F.col("f").alias("r")), ["lang", "_tail"])
             .join(checked(totals), "lang"))
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r", "n")}
    scored = sided.withColumns({"_up": (F.lit(1000).cast("decimal(4,0)") * exact["a"] * exact["n"]).cast("decimal(38,0)"),
                                "_down": (exact["l"] * exact["r"]).cast("decimal(38,0)")}).withColumn("score", F.expr("CAST(_up div _down AS BIGINT)"))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("_low")).select(
        "lang", "phrase", "a", "n", "_low.score", "_low.l", "_low.r")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    parted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*order)
    best = lowest.withColumn("rank", F.row_number().over(parted)).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

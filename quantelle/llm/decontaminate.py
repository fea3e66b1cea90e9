"""Benchmark decontamination by a BM25 inverted index with block maxima.

Benchmark items are the indexed documents; every passage of every training text is a
query. Weights are divided by an item's score for itself, so one threshold serves items
of any length. As in block-max WAND a passage is given up when the sum of its words'
largest weights, over the index and then over a block of items, stays below the
threshold; only blocks that can hold a match are scored in full. What is retrieved is
verified on the word shingles of the item, and of its answer where the table has one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, slices

WIDTH = 5
OVERLAP = 0.75
#: Largest share of an item's own score that a passage must reach. Passages are at least as
#: long as any item, so one of the two that share a contained item holds half of the score of
#: what is left of it; items that can lose much of their score need less (``least_score``).
THRESHOLD = 0.4
BLOCK = 8
K1, B = 1.2, 0.75
#: Text of benchmark items per index; larger benchmarks are searched in parts of this size.
MAX_INDEX_BYTES = 64_000_000
_WORD = re.compile(r"\w+")
HIT = "k long, item_id long, start long, end long, score double, question_overlap double, answer_overlap double"


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams(words: list[str]) -> set[tuple[str, ...]]:
    """Distinct runs of ``WIDTH`` words, the whole sequence if it is shorter."""
    if not words:
        return set()
    return {tuple(words[i:i + WIDTH]) for i in range(max(1, len(words) - WIDTH + 1))}


@dataclass
class Index:
    """Postings by term in compressed rows: items with weights, and blocks with maxima."""

    terms: dict[str, int]
    largest: np.ndarray
    item_at: np.ndarray
    items: np.ndarray
    weights: np.ndarray
    block_at: np.ndarray
    blocks: np.ndarray
    maxima: np.ndarray
    ids: list[int]
    parts: list[tuple[set, set]]
    window: int
    scale: np.ndarray
    sizes: list[int] = field(default_factory=list)


def score_at_risk(words: list[str], weight: dict[str, float], overlap: float) -> float:
    """Bound of the weight of words that stand in no shingle left when ``overlap`` of a
    text's shingles are. ``weight`` is that of one occurrence of a word."""
    if len(words) < WIDTH:
        return 0.0
    starts = len(words) - WIDTH + 1
    times = sorted(Counter(tuple(words[i:i + WIDTH]) for i in range(starts)).values(), reverse=True)
    missing = max(m for m in range(len(times) + 1) if m == 0 or (len(times) - m) / len(times) >= overlap)
    most = sum(times[:missing])
    # best[r, m]: m starts missing so far, the last r of them in a row; those outside the text count as missing
    best = np.full((WIDTH + 1, most + 1), -np.inf)
    best[WIDTH, 0] = 0.0
    for at, word in enumerate(words):
        new = np.full_like(best, -np.inf)
        if at < starts:
            new[0] = best.max(axis=0)
            new[1:WIDTH, 1:] = best[:WIDTH - 1, :-1]
            new[WIDTH, 1:] = best[WIDTH - 1:, :-1].max(axis=0) + weight[word]
        else:
            new[1:WIDTH] = best[:WIDTH - 1]
            new[WIDTH] = best[WIDTH - 1:].max(axis=0) + weight[word]
        best = new
    return float(best.max())


def least_score(question: list[str], answer: list[str], weight: dict[str, float], overlap: float) -> float:
    """Share of its own score that one of two neighbouring passages reaches, whichever
    words are lost from an item that keeps ``overlap`` of its shingles."""
    times = Counter([*question, *answer])
    each = {w: weight[w] / c for w, c in times.items()}
    lost = score_at_risk(question, each, overlap) + score_at_risk(answer, each, overlap)
    return max((1 - lost) / 2 - 1e-6, 1e-6)


def build_index(items: list[tuple[int, str, str]], threshold: float = THRESHOLD, overlap: float = OVERLAP) -> Index:
    """Index of ``(item_id, question, answer)``; items without words cannot be found.

    Weights are shares of the item's own score times its ``scale``, which brings the least
    score of an item that keeps ``overlap`` of its shingles up to ``threshold``."""
    split = [(i, words_of(q or ""), words_of(a or "")) for i, q, a in items]
    split = [x for x in split if x[1] or x[2]]
    frequency = Counter(w for _, q, a in split for w in {*q, *a})
    # items that share their most frequent words stand together, which makes blocks' maxima low elsewhere
    split.sort(key=lambda x: ([(-frequency[w], w) for w in sorted({*x[1], *x[2]}, key=lambda w: (-frequency[w], w))[:6]], x[0]))
    terms = {w: t for t, w in enumerate(sorted(frequency))}
    n, mean = len(split), sum(len(q) + len(a) for _, q, a in split) / max(1, len(split))
    rows, scale = [], np.ones(n)
    for at, (_, q, a) in enumerate(split):
        times = Counter([*q, *a])
        length = len(q) + len(a)
        raw = {w: np.log(1 + (n - frequency[w] + 0.5) / (frequency[w] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * length / mean)) for w, c in times.items()}
        own = sum(raw.values())
        scale[at] = max(1.0, threshold / least_score(q, a, {w: x / own for w, x in raw.items()}, overlap))
        rows += [(terms[w], at, x / own * scale[at]) for w, x in raw.items()]
    term = np.array([r[0] for r in rows], np.int64)
    item = np.array([r[1] for r in rows], np.int64)
    weight = np.array([r[2] for r in rows])
    order = np.lexsort((item, term))
    term, item, weight = term[order], item[order], weight[order]
    item_at = np.searchsorted(term, np.arange(len(terms) + 1))
    pair, first = np.unique(term * (n // BLOCK + 1) + item // BLOCK, return_index=True)
    maxima = np.maximum.reduceat(weight, first) if len(first) else weight
    block_term, blocks = pair // (n // BLOCK + 1), pair % (n // BLOCK + 1)
    largest = np.maximum.reduceat(weight, item_at[:-1]) if len(terms) else weight
    return Index(terms, largest, item_at, item, weight, np.searchsorted(block_term, np.arange(len(terms) + 1)), blocks, maxima,
                 [i for i, _, _ in split], [(grams(q), grams(a)) for _, q, a in split], max([64, *(len(q) + len(a) for _, q, a in split)]), scale,
                 [len(q) + len(a) for _, q, a in split])


def _expand(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Repeat each row for the postings ``low..high`` and give their positions."""
    count = high - low
    owner = np.repeat(rows, count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return owner, np.repeat(low, count) + inside


def retrieve(index: Index, passage: np.ndarray, term: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages, items and scores at or above the threshold, from distinct
    ``(passage, term)`` pairs sorted by passage; passages are numbered from 0."""
    nothing = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    if not len(passage):
        return nothing
    above = np.bincount(passage, index.largest[term]) >= threshold
    keep = above[passage]
    passage, term = passage[keep], term[keep]
    blocks = int(index.blocks.max()) + 1 if len(index.blocks) else 1
    owner, at = _expand(passage, index.block_at[term], index.block_at[term + 1])
    if not len(owner):
        return nothing
    low = owner[0]
    bound = np.bincount((owner - low) * blocks + index.blocks[at], index.maxima[at])
    live = np.flatnonzero(bound >= threshold - 1e-9)
    live_passage, live_block = live // blocks + low, live % blocks
    if not len(live):
        return nothing
    # score the items of live blocks in full
    starts, ends = np.searchsorted(passage, live_passage), np.searchsorted(passage, live_passage, "right")
    case, word = _expand(np.arange(len(live)), starts, ends)
    case, at = _expand(case, index.item_at[term[word]], index.item_at[term[word] + 1])
    item = index.items[at]
    mine = item // BLOCK == live_block[case]
    case, item, at = case[mine], item[mine], at[mine]
    score = np.bincount(case * BLOCK + item % BLOCK, index.weights[at], len(live) * BLOCK)
    hit = np.flatnonzero(score >= threshold)
    return live_passage[hit // BLOCK], live_block[hit // BLOCK] * BLOCK + hit % BLOCK, score[hit]


def search(index: Index, texts: list[str], threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[tuple[int, int, int, int, float, float, float]]:
    """``(text number, item_id, first word, end word, score, question, answer overlap)`` of
    every verified match: the best passage of each text and item."""
    if not index.terms:
        return []
    words = [words_of(t) for t in texts]
    known = index.terms.get
    lengths = np.array([len(w) for w in words], np.int64)
    passages = -(-lengths // index.window)
    base = np.cumsum(passages) - passages
    ids = np.fromiter((x for w in words for x in map(known, w, repeat(-1))), np.int64, int(lengths.sum()))
    within = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    passage = np.repeat(base, lengths) + within // index.window
    seen = ids >= 0
    pairs = np.unique(passage[seen] * len(index.terms) + ids[seen])
    found = retrieve(index, pairs // len(index.terms), pairs % len(index.terms), threshold)
    best: dict[tuple[int, int], tuple] = {}
    held: dict[tuple[int, int], set] = {}
    for p, item, score in zip(*(x.tolist() for x in found)):
        text = int(np.searchsorted(base, p, "right")) - 1
        while passages[text] == 0:
            text -= 1
        at = p - int(base[text])
        low, high = max(0, (at - 1) * index.window), (at + 2) * index.window
        score /= index.scale[item]
        near = held.get((text, at))
        if near is None:
            held = {(text, at): grams_around(words[text], low, high)} if len(held) > 64 else {**held, (text, at): grams_around(words[text], low, high)}
            near = held[text, at]
        question, answer = index.parts[item]
        q, a = share(question, near, words[text], low, high), share(answer, near, words[text], low, high)
        if q >= overlap and a >= overlap and best.get((text, item), (-1.0,))[0] < score:
            best[text, item] = (score, at * index.window, min((at + 1) * index.window, len(words[text])), q, a)
    return [(t, index.ids[i], s, e, score, q, a) for (t, i), (score, s, e, q, a) in sorted(best.items())]


def grams_around(words: list[str], low: int, high: int) -> set:
    part = words[low:high]
    return {tuple(part[i:i + WIDTH]) for i in range(max(0, len(part) - WIDTH + 1))}


def share(wanted: set, near: set, words: list[str], low: int, high: int) -> float:
    """Part of the wanted shingles that stand near the passage; 1 for none. A shingle
    shorter than ``WIDTH`` is looked for as a run of words."""
    if not wanted:
        return 1.0
    if len(wanted) == 1 and len(next(iter(wanted))) < WIDTH:
        run = next(iter(wanted))
        part = words[low:high]
        return float(any(tuple(part[i:i + len(run)]) == run for i in range(len(part) - len(run) + 1)))
    return len(wanted & near) / len(wanted)


def contaminated(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
                 answer: str | None = None, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """``(key, item_id, start, end, score, question_overlap, answer_overlap)`` for every
    document and item whose question and answer both stand in a passage and around it.

    Texts are cut into passages of as many words as the longest item, 64 at least; words
    are lower-cased runs of letters and digits. Each passage queries the index; a match
    needs ``threshold`` of the item's own BM25 score, or less where an item that keeps
    ``overlap`` of its shingles can have less, then ``overlap`` of the five-word shingles of
    its question and of its answer within the passage and one passage on each side. Without
    an ``answer`` column the whole item is the question, and ``answer_overlap`` is 1. ``start``
    and ``end`` count words. NULL, empty and wordless texts and items match nothing;
    NULL keys are returned as NULL; repeated rows match each for itself. The benchmark
    is broadcast in parts of at most ``MAX_INDEX_BYTES`` of text, each searched by every
    passage; an empty one gives no rows. No shuffle of documents.
    """
    spark = documents.sparkSession
    told = F.col(f"`{answer}`") if answer else F.lit(None).cast("string")
    items = benchmark.select(F.col(f"`{item}`").cast("long").alias("i"), F.col(f"`{item_text}`").alias("q"), told.alias("a"))
    size = items.agg(F.sum(F.coalesce(F.octet_length("q"), F.lit(0)) + F.coalesce(F.octet_length("a"), F.lit(0)))).first()[0] or 0
    parts = max(1, -(-size // MAX_INDEX_BYTES))
    rows = documents.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{text}`").alias("t")).where("t is not null")
    out = None
    for part in range(parts):
        mine = items.where(F.pmod(F.xxhash64("i", "q"), F.lit(parts)) == part).collect()
        index = spark.sparkContext.broadcast(build_index([(r.i, r.q, r.a) for r in mine], threshold, overlap))

        def look(batch: pa.RecordBatch, index=index) -> Iterator[pa.RecordBatch]:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            hits = [(keys[low + t], *rest) for low, high in slices(texts, 300_000) for t, *rest in search(index.value, texts[low:high], threshold, overlap)]
            kinds = [pa.int64()] * 4 + [pa.float64()] * 3
            columns = zip(*hits) if hits else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in HIT.split(", ")])

        found = in_arrow(rows, look, HIT)
        out = found if out is None else out.unionByName(found)
    return out.withColumnRenamed("k", key)

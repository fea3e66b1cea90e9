"""Removal of repeated byte strings by a distributed, sparse suffix array.

Every byte covered by a string of ``length`` bytes that also starts earlier (in a document
of smaller key, or before in the same document) is removed; strings overlap and are judged
on the input. Sorting the suffix of every byte would ship each byte ``length`` times, so
only chosen suffixes are sorted, and no string is lost by it:

1. **Anchors.** In each window of ``length`` bytes the 16-byte gram of least hash (leftmost
   of equals) is its anchor. The choice looks at nothing but the window, so equal windows
   have the same anchor at the same offset, and a run of windows shares one anchor.
2. **Filter.** Anchors meet by gram and by the whole stretch their windows cover. Of equal
   stretches all but the earliest lose all windows. Only the earliest of each stretch goes
   on, and only where another stretch has its gram, too.
3. **Suffix array.** Sampled splitters range-partition the suffixes that start at anchors
   by leading bytes. A bucket sorts them by multikey quicksort on eight-byte digits, and
   the reversed text before them likewise; for every offset of a window, runs of the two
   orders are its classes of equal windows, and all but the earliest of a class are repeats.
4. **Boundaries.** A window may have equals in another bucket only if its suffix agrees with
   a splitter beside its bucket as far as the window reaches. The earliest of such classes
   meet by digest over all buckets. Equal splitters stand for a suffix more frequent than
   a bucket is large; its rows are dealt over all buckets between them.

Texts lie in blocks of some megabytes in a table bucketed by block, so that they are never
shuffled; all that goes back to them is positions. A block sends each of its distinct
stretches once, so the most frequent one gives a row a block. Stretches are compared by two
64-bit hashes, windows at boundaries by 128 bits of a digest, all else byte by byte.

NULL and empty texts have nothing to remove; a text shorter than ``length`` stays whole.
NULL keys come after all others, rows of equal key in the order in which they are stored.
An empty table gives an empty result, and other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, in_arrow, ship, slices, stash

BLOCK_CHARS = 4_000_000
GRAM = 16
#: Windows looked at together; their number has 20 bits.
_SPAN = 1 << 18
#: Text bytes to a bucket of the block table, and to a part of the anchors.
BUCKET_BYTES, PART_BYTES = 64_000_000, 32_000_000
#: Suffixes to a bucket of the suffix array, and sampled ones to a splitter.
BUCKET_ROWS, SAMPLE = 200_000, 20
MAX_SAMPLE, MAX_BUCKETS = 1_000_000, 100_000
_LAST = np.iinfo(np.int64).max
_BLOCK = "keys array<long>, sizes array<long>, data binary"
_ANCHOR = "part long, gram long, stretch long, key long, block long, place long"
_FOUND = "block long, place long, repeated boolean"
_SUFFIX = "bucket int, after binary, before binary, key long, block long, place long"
_REPEAT = "block long, place long, key long, digest binary"


def _batch(schema: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], [c.split()[0] for c in schema.split(", ")])


# ------------------------------------------------------------------ text blocks

def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    for a, b in slices(texts, BLOCK_CHARS):
        parts = [(t or "").encode() for t in texts[a:b]]
        yield _batch(_BLOCK, pa.array([keys[a:b]], pa.list_(pa.int64())), pa.array([[len(p) for p in parts]], pa.list_(pa.int64())),
                     pa.array([b"".join(parts)], pa.binary()))


def text_blocks(documents: DataFrame, key: str, text: str, total: int) -> DataFrame:
    """Documents in blocks, written as a table bucketed by ``block`` to the shared folder."""
    rows = documents.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    blocks = in_arrow(rows, _blocks, _BLOCK).withColumn("block", F.monotonically_increasing_id())
    return bucketed(blocks, "block", min(MAX_BUCKETS, total // BUCKET_BYTES + 1), "text_blocks")


def _bounds(row: dict) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(row["sizes"], dtype=np.int64)))


def bytes_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a block and where its texts begin and end."""
    return np.frombuffer(row["data"], np.uint8), _bounds(row)


def keys_at(row: dict, bounds: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Keys of the texts that hold these places of a block; NULL is the largest."""
    keys = np.array([_LAST if k is None else k for k in row["keys"]], np.int64)
    return keys[np.searchsorted(bounds, where, "right") - 1]


# ---------------------------------------------------------------------- anchors

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mixed(a) + b * np.uint64(0xC2B2AE3D27D4EB4F)


def _hashes(data: np.ndarray, longest: int) -> dict[int, np.ndarray]:
    """Hashes of all substrings of 1, 2, 4, … bytes, up to ``longest``."""
    size, found = 1, {1: (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)}
    while size * 2 <= longest:
        last = found[size]
        found[size * 2] = _joined(last[:-size], last[size:])
        size *= 2
    return found


def _at(hashes: dict[int, np.ndarray], where: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the substrings of ``length`` bytes that start at ``where``."""
    out, start = None, 0
    for size in sorted(hashes, reverse=True):
        if length - start >= size:
            piece = hashes[size][where + start]
            out, start = piece if out is None else _joined(out, piece), start + size
    return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values, size = np.minimum(values[:-size], values[size:]), size * 2
    return np.minimum(values[:len(values) - (width - size)], values[width - size:])


def packed(start: np.ndarray, anchor: np.ndarray, width: np.ndarray) -> np.ndarray:
    """First window, offset of the anchor in it and number of windows less one, in one number."""
    return (start.astype(np.int64) << 16) | (anchor.astype(np.int64) << 8) | width.astype(np.int64)


def anchors(data: np.ndarray, bounds: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``(gram, stretch, place)`` of all runs of windows that share an anchor, span by span."""
    n, slots = len(data), length - GRAM + 1
    edge = np.zeros(n + 1, np.int32)  # windows that would leave their document
    np.add.at(edge, np.maximum(bounds[:-1], bounds[1:] - (length - 1)), 1)
    np.add.at(edge, bounds[1:], -1)
    inside = np.cumsum(edge[:-1]) == 0
    for a in range(0, n - length + 1, _SPAN):
        ok = inside[a:min(a + _SPAN, n - length + 1)]
        if not ok.any():
            continue
        hashes = _hashes(data[a:a + len(ok) + length - 1], length)
        gram = _mixed(hashes[GRAM][:len(ok) + slots - 1])
        order = (gram >> np.uint64(20) << np.uint64(20)) | np.arange(len(gram), dtype=np.uint64)
        anchor = (_least(order, slots) & np.uint64((1 << 20) - 1)).astype(np.int64)
        anchor[~ok] = -1
        first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        last = np.concatenate((first[1:], [len(anchor)])) - 1
        real = anchor[first] >= 0
        first, last = first[real], last[real]
        p = anchor[first]
        shape = ((p - first) * 256 + (last - first)).astype(np.uint64)
        stretch = _mixed(_joined(_joined(_at(hashes, first, length), _at(hashes, last, length)), shape))
        yield gram[p].view(np.int64), stretch.view(np.int64), packed(first + a, p - first, last - first)


def _firsts(*order: np.ndarray) -> np.ndarray:
    """True where a row differs from the one before in any of the (sorted) columns."""
    change = np.zeros(len(order[0]), bool)
    change[:1] = True
    for c in order:
        change[1:] |= c[1:] != c[:-1]
    return change


def _anchor_rows(length: int, parts: int, units: Callable[[dict], tuple[np.ndarray, np.ndarray]]):
    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            data, bounds = units(row)
            found = list(anchors(data, bounds, length))
            if not found:
                continue
            gram, stretch, place = (np.concatenate(c) for c in zip(*found))
            key = keys_at(row, bounds, place >> 16)
            order = np.lexsort((place, key, stretch, gram))
            gram, stretch, key, place = gram[order], stretch[order], key[order], place[order]
            again = ~_firsts(gram, stretch)
            place = np.where(again, -1 - place, place)  # known to be repeats; told by a number below 0
            part = np.where(again, row["block"] % parts, gram % parts)
            for a in range(0, len(place), 50_000):
                s = slice(a, a + 50_000)
                yield _batch(_ANCHOR, part[s], gram[s], stretch[s], key[s], np.full(len(place[s]), row["block"], np.int64), place[s])
    return each


def _meet(table: pa.Table) -> pa.Table:
    """Of equal stretches all but the earliest are repeats; the earliest of those whose gram
    has several stretches are to be compared."""
    gram, stretch, key, block, place = (table.column(c).to_numpy() for c in ("gram", "stretch", "key", "block", "place"))
    known = place < 0
    fresh = np.flatnonzero(~known)
    order = fresh[np.lexsort((place[fresh], block[fresh], key[fresh], stretch[fresh], gram[fresh]))]
    new_gram = _firsts(gram[order])
    new_stretch = _firsts(gram[order], stretch[order])
    run = np.cumsum(new_gram) - 1
    several = (np.bincount(run, new_stretch) > 1)[run] if len(run) else new_stretch
    repeats, compared = order[~new_stretch], order[new_stretch & several]
    block = np.concatenate((block[known], block[repeats], block[compared]))
    place = np.concatenate((-1 - place[known], place[repeats], place[compared]))
    return pa.Table.from_batches([_batch(_FOUND, block, place, np.arange(len(place)) < len(place) - len(compared))])


def met(blocks: DataFrame, length: int, total: int, units: Callable[[dict], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``(block, place, repeated)`` for runs of windows of ``length`` units that are repeats or to be compared."""
    parts = total // PART_BYTES + 1
    found = in_arrow(blocks.select("block", "keys", "sizes", "data"), _anchor_rows(length, parts, units), _ANCHOR)
    return stash(found.groupBy("part").applyInArrow(_meet, _FOUND), "found")


def placed(blocks: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Blocks with the list of the places among ``rows`` that lie in them."""
    lists = rows.groupBy("block").agg(F.collect_list("place").alias("places"))
    return blocks.join(lists, "block", how).select("block", "keys", "sizes", "data", "places")


# ----------------------------------------------------------------- suffix array

def _suffix_rows(length: int):
    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            data, bounds, place = row["data"], _bounds(row), np.sort(np.array(row["places"], np.int64))
            first, anchor, width = place >> 16, (place >> 8) & 255, place & 255
            key = keys_at(row, bounds, first)
            for a in range(0, len(place), 20_000):
                s = slice(a, a + 20_000)
                cut = list(zip(first[s].tolist(), (first[s] + anchor[s]).tolist(), (first[s] + width[s] + length).tolist()))
                yield _batch(_SUFFIX, np.zeros(len(cut), np.int32), pa.array([data[p:e] for _, p, e in cut], pa.binary()),
                             pa.array([data[f:p][::-1] for f, p, _ in cut], pa.binary()), key[s], np.full(len(cut), row["block"], np.int64), place[s])
    return each


def splitters(suffixes: DataFrame, rows: int) -> list[bytes]:
    """Leading bytes that cut ``rows`` suffixes into buckets of about ``BUCKET_ROWS``, from a
    sample of at most ``MAX_SAMPLE``; frequent suffixes occur several times."""
    buckets = min(MAX_BUCKETS, rows // BUCKET_ROWS + 1)
    if buckets == 1:
        return []
    share = min(1.0, min(MAX_SAMPLE, SAMPLE * buckets) / rows)
    drawn = sorted(bytes(r[0]) for r in suffixes.select("after").sample(share, seed=7).limit(2 * MAX_SAMPLE).collect())
    return [drawn[len(drawn) * i // buckets] for i in range(1, buckets)] if drawn else []


def _dealt(cuts: list[bytes]):
    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        import bisect
        import zlib

        out = []
        for after, before in zip(batch.column("after").to_pylist(), batch.column("before").to_pylist()):
            low, high = bisect.bisect_left(cuts, after), bisect.bisect_right(cuts, after)
            out.append(low + (zlib.crc32(before) % (high - low + 1) if high > low else 0))
        yield _batch(_SUFFIX, pa.array(out, pa.int32()), *[batch.column(c) for c in ("after", "before", "key", "block", "place")])
    return each


def _digits(texts: list[bytes], width: int) -> np.ndarray:
    """Texts as rows of big-endian eight-byte digits, filled up with zero bytes."""
    words = -(-width // 8)
    padded = b"".join(t.ljust(words * 8, b"\0") for t in texts)
    return np.frombuffer(padded, ">u8").reshape(len(texts), words).astype(np.uint64)


def multikey_sort(digits: np.ndarray) -> np.ndarray:
    """Order of the rows by their digits: runs that are equal so far are sorted by the next
    digit, and only those of more than one row go on."""
    order = np.argsort(digits[:, 0], kind="stable")
    run = np.cumsum(_firsts(digits[order, 0]))
    for d in range(1, digits.shape[1]):
        same = run[1:] == run[:-1]
        open_ = np.flatnonzero(np.concatenate((same, [False])) | np.concatenate(([False], same)))
        if not len(open_):
            break
        rows = order[open_]
        inner = np.lexsort((digits[rows, d], run[open_]))
        order[open_] = rows[inner]
        split = np.zeros(len(order), bool)
        split[open_] = _firsts(run[open_], digits[order[open_], d])
        alone = np.ones(len(order), bool)
        alone[open_] = False
        run = np.cumsum(split | alone)
    return order


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bytes in which the rows of ``a`` and ``b`` agree."""
    out = np.full(len(a), a.shape[1] * 8, np.int64)
    undecided = np.arange(len(a))
    for d in range(a.shape[1]):
        differ = a[undecided, d] ^ b[undecided, d]
        here = np.flatnonzero(differ)
        zeros = np.zeros(len(here), np.int64)
        for bits in range(56, 0, -8):
            zeros += differ[here] < np.uint64(1 << bits)
        out[undecided[here]] = d * 8 + zeros
        undecided = undecided[differ == 0]
    return out


def _compared(length: int, cuts: list[bytes]):
    """Repeated windows of one bucket, and windows that other buckets may have, too."""
    def each(table: pa.Table) -> pa.Table:
        key, block, place = (table.column(c).to_numpy() for c in ("key", "block", "place"))
        earliest = np.lexsort((place, block, key))  # rows by order of their windows
        key, block, place = key[earliest], block[earliest], place[earliest]
        table = table.take(pa.array(earliest))
        after, before = table.column("after").to_pylist(), table.column("before").to_pylist()
        n, slots = len(place), length - GRAM + 1
        first, high, width = place >> 16, (place >> 8) & 255, place & 255
        low = high - width
        sides = []
        for texts, size in ((after, length), (before, max(slots - 1, 1))):
            digits = _digits(texts, size)
            order = multikey_sort(digits)
            sides.append((order, np.concatenate(([0], agreement(digits[order[:-1]], digits[order[1:]])))))
            if texts is after:
                bucket, near = table.column("bucket")[0].as_py(), np.full(n, -1)
                for at in (bucket - 1, bucket):
                    if 0 <= at < len(cuts):
                        near = np.maximum(near, agreement(digits, np.broadcast_to(_digits([cuts[at]], length), digits.shape)))
        out = []
        group, other = np.empty(n, np.int64), np.empty(n, np.int64)
        for offset in range(int(low.min()), int(high.max()) + 1):
            rows = np.flatnonzero((low <= offset) & (offset <= high))
            (order, lcp), (order_b, lcp_b) = sides
            group[order] = np.cumsum(lcp < length - offset)
            other[order_b] = np.cumsum(lcp_b < offset) if offset else 0
            _, kept = np.unique(group[rows] * (n + 1) + other[rows], return_index=True)
            repeated = np.ones(len(rows), bool)
            repeated[kept] = False
            asked = rows[kept][near[rows[kept]] >= length - offset]
            gone = rows[repeated]
            start = np.concatenate((first[gone] + high[gone] - offset, first[asked] + high[asked] - offset))
            told = np.concatenate((gone, asked))
            digests = [None] * len(gone) + [
                hashlib.blake2b(before[i][:offset][::-1] + after[i][:length - offset], digest_size=16).digest() for i in asked.tolist()]
            out.append(_batch(_REPEAT, block[told], start << 16, key[told], pa.array(digests, pa.binary())))
        return pa.Table.from_batches(out)
    return each


# ------------------------------------------------------------------------- cuts

_CUT = "key long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _cuts(length: int):
    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            data, bounds = np.frombuffer(row["data"], np.uint8), _bounds(row)
            cover = np.zeros(len(data) + 1, np.int32)
            if row["places"]:
                place = np.array(row["places"], np.int64)
                np.add.at(cover, place >> 16, 1)
                np.add.at(cover, (place >> 16) + (place & 255) + length, -1)
            gone = np.cumsum(cover[:-1]) > 0
            for a in range(0, len(row["keys"]), 1000):
                keys, spans, kept = row["keys"][a:a + 1000], [], []
                for k in range(a, a + len(keys)):
                    s, e = int(bounds[k]), int(bounds[k + 1])
                    edge = np.flatnonzero(np.diff(np.concatenate(([False], gone[s:e], [False])).astype(np.int8)))
                    spans.append([{"start": x, "end": y} for x, y in edge.reshape(-1, 2).tolist()])
                    kept.append(data[s:e][~gone[s:e]].tobytes() if len(edge) else row["data"][s:e])
                yield _batch(_CUT, pa.array(keys, pa.int64()), pa.array(row["sizes"][a:a + 1000], pa.int64()), pa.array(spans, _SPANS), pa.array(kept, pa.binary()))
    return each


def remove_repeats(documents: DataFrame, length: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_bytes, spans, kept)`` for every row: the spans of bytes to remove, from 0 on
    and as long as possible, and the bytes that remain, put together.

    ``length`` may be 32 to 256 bytes. ``key`` is an integer column.
    """
    if not 32 <= length <= 256:
        raise ValueError("length must be between 32 and 256")
    ship(documents.sparkSession)
    total = documents.select(F.sum(F.octet_length(f"`{text}`"))).first()[0] or 0
    blocks = text_blocks(documents, key, text, total)
    found = met(blocks, length, total, bytes_of)
    suffixes = stash(in_arrow(placed(blocks, found.where("not repeated"), "inner"), _suffix_rows(length), _SUFFIX), "suffixes")
    cuts = splitters(suffixes, suffixes.count())
    dealt = in_arrow(suffixes, _dealt(cuts), _SUFFIX) if cuts else suffixes
    compared = stash(dealt.groupBy("bucket").applyInArrow(_compared(length, cuts), _REPEAT), "compared")
    asked = compared.where("digest IS NOT NULL").withColumn("_at", F.struct("key", "block", "place"))
    earliest = asked.groupBy("digest").agg(F.min("_at").alias("_first"))
    later = asked.join(earliest, "digest").where("_at > _first")
    repeats = (found.where("repeated").select("block", "place")
               .unionByName(compared.where("digest IS NULL").select("block", "place")).unionByName(later.select("block", "place")))
    out = in_arrow(placed(blocks, repeats, "left"), _cuts(length), _CUT)
    return out.withColumnRenamed("key", key)

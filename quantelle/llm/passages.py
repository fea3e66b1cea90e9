"""Repeated passages of words, wherever they begin and end in lines and sentences.

A window of ``words`` words that also starts earlier (in a document of smaller key, or before
in the same document) is a repeat; every word of it goes. Words are those of
:mod:`.shingles`, so case of A-Z and the kind of white space play no part. Windows overlap
and are judged on the input.

Anchors stand for the windows, as in :mod:`.suffix_dedup` and with words in place of bytes:
runs of windows with equal words meet whole, and only the earliest of each, where their
anchor has several, are compared window by window. Words are compared by 64-bit hashes,
windows by 128 bits of a digest of these.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, ship, stash
from .shingles import shingle_hashes, word_list
from .suffix_dedup import keys_at, met, placed, text_blocks

_WINDOW = "digest binary, key long, block long, place long"
_SPAN = "key long, start int, end int, n_words int"
_WHITE = np.isin(np.arange(256), list(b"\t\n\v\f\r "))


def words_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block and where its texts begin and end among them."""
    ends = np.cumsum(row["sizes"], dtype=np.int64).tolist()
    found = [shingle_hashes(word_list(row["data"][e - n:e]), 1) for e, n in zip(ends, row["sizes"])]
    bounds = np.concatenate(([0], np.cumsum([len(f) for f in found], dtype=np.int64)))
    return np.concatenate(found or [np.empty(0, np.uint64)]), bounds


def _windows(words: int):
    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            data, bounds = words_of(row)
            place = np.array(row["places"], np.int64)
            width = (place & 255) + 1
            starts = np.repeat(place >> 16, width) + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            for a in range(0, len(starts), 50_000):
                s = starts[a:a + 50_000]
                digests = [hashlib.blake2b(data[p:p + words], digest_size=16).digest() for p in s.tolist()]
                columns = [pa.array(digests, pa.binary()), *map(pa.array, (keys_at(row, bounds, s), np.full(len(s), row["block"], np.int64), s << 16))]
                yield pa.RecordBatch.from_arrays(columns, ["digest", "key", "block", "place"])
    return each


def _spans(words: int):
    def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            place, out, first, at = np.array(row["places"], np.int64), [], 0, 0
            covered = np.sort(place >> 16), np.sort((place >> 16) + (place & 255) + words)
            for key, size in zip(row["keys"], row["sizes"]):
                data = np.frombuffer(row["data"], np.uint8, size, at)
                solid = np.concatenate(([False], ~_WHITE[data], [False]))
                edge = np.flatnonzero(solid[1:] != solid[:-1])  # bytes where words begin and end, in turn
                n, at = len(edge) // 2, at + size
                opened, closed = (c[slice(*np.searchsorted(c, b))] - first for c, b in zip(covered, ((first, first + n), (first + 1, first + n + 1))))
                first += n
                if not len(opened):
                    continue
                depth = np.cumsum(np.bincount(opened, minlength=n + 1) - np.bincount(closed, minlength=n + 1))
                gone = np.flatnonzero(np.diff(np.concatenate(([False], depth[:n] > 0, [False])).astype(np.int8))).reshape(-1, 2)
                chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)))
                begin, end = chars[edge[2 * gone[:, 0]]], chars[edge[2 * gone[:, 1] - 1]]
                out.extend(zip([key] * len(gone), begin.tolist(), end.tolist(), (gone[:, 1] - gone[:, 0]).tolist()))
            for a in range(0, len(out), 50_000):
                columns = [pa.array(c, t) for c, t in zip(zip(*out[a:a + 50_000]), [pa.int64()] + [pa.int32()] * 3)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "start", "end", "n_words"])
    return each


def repeated_passages(documents: DataFrame, words: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, start, end, n_words)`` for every passage to remove: as long as possible, from
    its first to its last word, with offsets in characters of the original text.

    ``words`` may be 32 to 256; shorter texts, NULL and empty ones have no passages. NULL
    keys come after all others, rows of equal key in the order in which they are stored, so
    the first of repeated rows stays. ``key`` is an integer column, other columns play no
    part, and an empty table gives no rows.
    """
    if not 32 <= words <= 256:
        raise ValueError("words must be between 32 and 256")
    ship(documents.sparkSession)
    total = documents.select(F.sum(F.octet_length(f"`{text}`"))).first()[0] or 0
    blocks = text_blocks(documents, key, text, total)
    found = met(blocks, words, total, words_of)
    windows = stash(in_arrow(placed(blocks, found.where("not repeated"), "inner"), _windows(words), _WINDOW), "windows")
    at = F.struct("key", "block", "place")
    first = stash(windows.groupBy("digest").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"), "first")
    later = windows.join(first, "digest").where(at > F.col("first"))
    repeats = found.where("repeated").select("block", "place").unionByName(later.select("block", "place"))
    return in_arrow(placed(blocks, repeats, "inner"), _spans(words), _SPAN).withColumnRenamed("key", key)

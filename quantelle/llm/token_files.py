"""Token ids in flat unsigned files with 64-bit document offsets.

A shard is three files: ``.bin`` (ids, little-endian, 16 or 32 bits by vocabulary),
``.idx`` (unsigned 64-bit offsets in ids, one more than documents) and ``.ids``
(signed 64-bit document ids, then one byte each: 1 where the id is NULL). Shards follow
each other in ascending document order; the base of a shard is the prefix sum of the
ids before it.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe_count import byte_symbols
from .common import filesystem, in_arrow, publish, ship, stash

MANIFEST = "shard long, path string, width int, docs long, tokens long"
MAX_PIECES = 200_000
MAX_MARKS = 10_000
#: A word in Latin, Greek or Cyrillic letters is one pre-token, a run of ASCII punctuation behind it another.
_WORD = re.compile(r"(\n?)([A-Za-zÀ-ÖØ-öø-ʯΑ-ΡΣ-ώЀ-ҁҊ-ԯ]+)([!-/:-@\[-`{-~]*)")
_CUT = re.compile(r"(?<=\S)(?=[ \n])")


class _Unsafe(Exception):
    """A piece whose neighbours could change its tokens."""


class PieceEncoder(dict):
    """Ids of texts by a byte-level tokenizer, each distinct piece encoded once.

    A pre-token has white space only at its start, so a text may be cut before a space or
    line feed that follows another character, and the library may encode each piece alone.
    This mapping holds ids by piece, a single space at its start left out; with
    ``MAX_PIECES`` they become the ``older`` ones, which are forgotten when the next are
    full. Words go to the library's model at once, other pieces through its pre-tokenizer.
    A text with special strings, and every text of a tokenizer that normalises or splits
    otherwise, goes to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder()
        self.special = sorted(t.content for t in added.values())
        largest = max([self.library.get_vocab_size(with_added_tokens=True) - 1, *added])
        self.dtype = np.dtype("<u2" if largest < 2**16 else "<u4")
        split, self.model = self.library.pre_tokenizer, self.library.model
        self.by_piece = (self.library.normalizer is None and isinstance(self.model, models.BPE) and isinstance(split, pre_tokenizers.ByteLevel)
                         and split.use_regex and not split.add_prefix_space)
        self.symbols = byte_symbols()
        self.space = self.symbols[ord(" ")]
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _mark(self, text: str) -> bytes:
        if text not in self.marks:
            if len(self.marks) >= MAX_MARKS:
                self.marks.clear()
            self.marks[text] = self._ids(text)
        return self.marks[text]

    def _word(self, word: str, before: str = "") -> bytes:
        shown = before + (word if word.isascii() else "".join([self.symbols[b] for b in word.encode()]))
        width = self.dtype.itemsize
        return b"".join([t.id.to_bytes(width, "little") for t in self.model.tokenize(shown)])

    def __missing__(self, piece: str) -> bytes:
        if not piece or piece[-1].isspace() or piece[0].isspace() and piece[0] not in " \n":
            raise _Unsafe
        found = self.older.get(piece)
        if found is None:
            word = _WORD.fullmatch(piece)
            if word is None:
                found = self._ids(piece if piece[0].isspace() else " " + piece)
            elif word[1]:
                found = self._mark("\n") + self._word(word[2])
            else:
                found = (word[3] and self.get(word[2])) or self._word(word[2], self.space)
            if word is not None and word[3]:
                found += self._mark(word[3])
        if len(self) >= MAX_PIECES:
            self.older = dict(self)
            self.clear()
        self[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        """Little-endian ids of a whole text."""
        if not self.by_piece or any(s in text for s in self.special):
            return self._ids(text)
        pieces = text.replace("\n", " \n").split(" ")
        try:
            if pieces[0][-1:].isspace():
                raise _Unsafe
            return self._ids(pieces[0]) + b"".join(map(self.__getitem__, pieces[1:]))
        except _Unsafe:
            pieces = _CUT.split(text)
        return self._ids(pieces[0]) + b"".join(map(self._inner, pieces[1:]))

    def _inner(self, piece: str) -> bytes:
        if piece[-1].isspace():
            return self._ids(piece)
        return self[piece[1:] if piece[0] == " " and not piece[1].isspace() else piece]


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def write_token_files(documents: DataFrame, folder: str, tokenizer: str, end_id: int | None = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode whole texts, append ``end_id`` to each document and write shards in ascending
    ``key`` order (NULL first, equal keys by text); returns the manifest
    ``(shard, path, width, docs, tokens, base)``, also written beside the shards.

    Range partitions are sorted and streamed to files; a task holds one Arrow batch of
    texts. NULL texts are empty. ``base`` is the prefix sum over the manifest, one row per
    shard. An empty table writes no shard.
    """
    ship(documents.sparkSession)
    rows = documents.select(F.col(f"`{key}`").alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    parts = max(1, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartitionByRange(parts, F.col("k").asc_nulls_first()).sortWithinPartitions(F.col("k").asc_nulls_first(), "t")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:06d}"
        waiting = (b for b in batches if b.num_rows)
        first = next(waiting, None)
        if first is None:
            return
        encode = encoder(tokenizer)
        end = b"" if end_id is None else np.array([end_id], encode.dtype).tobytes()
        lengths: list[int] = []
        keys: list[int | None] = []

        def fill(out: pa.NativeFile) -> None:
            batch = first
            while batch is not None:
                keys.extend(batch.column(0).to_pylist())
                for value in batch.column(1):
                    ids = encode.encode(value.as_py()) + end
                    lengths.append(len(ids) // encode.dtype.itemsize)
                    out.write(ids)
                batch = next(waiting, None)

        publish(path + ".bin", fill)
        offsets = np.concatenate(([0], np.cumsum(lengths, dtype=np.uint64))).astype("<u8")
        publish(path + ".idx", lambda out: out.write(offsets.tobytes()))
        ids = np.array([0 if k is None else k for k in keys], "<i8")
        publish(path + ".ids", lambda out: out.write(ids.tobytes() + np.array([k is None for k in keys], "u1").tobytes()))
        yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [path], "width": pa.array([encode.dtype.itemsize], pa.int32()),
                                          "docs": [len(keys)], "tokens": [int(offsets[-1])]})

    manifest = stash(ordered.mapInArrow(write, MANIFEST), "token-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _bytes_of(uri: str, memory_map: bool = True) -> np.ndarray:
    """Bytes of a file, memory-mapped where it is local."""
    fs, path = filesystem(uri)
    if fs.type_name == "local" and os.path.getsize(path):
        return np.memmap(path, dtype="u1", mode="r")
    with fs.open_input_file(path) as file:
        return np.frombuffer(file.read(), "u1")


def read_token_files(spark: SparkSession, manifest: DataFrame, ids: bool = False) -> DataFrame:
    """Documents of token files: ``(doc_id, start, n_tokens, ids_crc32[, ids])``.

    ``start`` counts all ids of earlier documents, ``ids_crc32`` covers the ids as
    little-endian unsigned 32-bit integers; ``ids`` adds them as an array. One task per
    shard maps its files.
    """
    out = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if ids else "")
    spread = manifest.select("path", "width", "docs", "base").repartition(max(1, manifest.count()), "path")

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for path, width, docs, base in zip(*(batch.column(c).to_pylist() for c in ("path", "width", "docs", "base"))):
            flat = _bytes_of(path + ".bin").view(f"<u{width}") if docs else np.empty(0, f"<u{width}")
            offsets = _bytes_of(path + ".idx").view("<u8").astype(np.int64)
            stored = _bytes_of(path + ".ids")
            keys, missing = np.frombuffer(stored[:8 * docs].tobytes(), "<i8"), stored[8 * docs:].astype(bool)
            for low in range(0, docs, 4096):
                high = min(low + 4096, docs)
                spans = [flat[offsets[i]:offsets[i + 1]] for i in range(low, high)]
                columns = [pa.array(keys[low:high], pa.int64(), mask=np.array(missing[low:high])), pa.array(base + offsets[low:high], pa.int64()),
                           pa.array(np.diff(offsets[low:high + 1]), pa.int64()),
                           pa.array([zlib.crc32(s.astype("<u4").tobytes()) for s in spans], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if ids:
                    columns.append(pa.array([s.tolist() for s in spans], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return in_arrow(spread, read, out)

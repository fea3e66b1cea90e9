"""Token counts by byte-pair merging with a heap and a linked list.

The count of a pre-token is its initial symbols minus its merges; no identifiers are
made. Vocabulary files are read, never trained.
"""

from __future__ import annotations

import heapq
import json
import re as plain_re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow

MAX_PIECES = 1_000_000
_CONTROL = "\x1c\x1d\x1e\x1f"
#: White space as the vocabulary's normaliser has it: without the four control characters above.
_SPACE = "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"


def byte_symbols() -> list[str]:
    """Printable stand-in of every byte in byte-level vocabularies: printable Latin-1
    characters stand for themselves, the rest take code points from 256 on, in order."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table, spare = [""] * 256, 256
    for b in range(256):
        if b in shown:
            table[b] = chr(b)
        else:
            table[b], spare = chr(spare), spare + 1
    return table


def count_after_merges(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left when the adjacent pair of lowest rank, leftmost first, is merged until
    no ranked pair is left."""
    n = len(symbols)
    if n < 2:
        return n
    after, before = [*range(1, n), -1], [*range(-1, n - 1)]
    parts: list[str | None] = list(symbols)
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    left = n
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else -1
        if j < 0 or ranks.get((parts[i], parts[j])) != rank:
            continue  # made of symbols that have been merged since
        parts[i], parts[j] = parts[i] + parts[j], None
        left -= 1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            if (r := ranks.get((parts[i], parts[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := ranks.get((parts[h], parts[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return left


class WordCounter(dict):
    """Token counts of texts by a lower-casing word-level BPE vocabulary (``.json``).

    Maps a white-space-free piece of a normalised text to its count, and forgets all
    pieces when it has ``MAX_PIECES``.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.ranks = {m: i for i, m in enumerate(merges)}
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.words = regex.compile(next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split"))
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = plain_re.compile("|".join(map(plain_re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.marks = special
        self.space = plain_re.compile(_SPACE)
        self.symbols = byte_symbols()
        self.known: dict[str, int] = {}

    def _word(self, word: str) -> int:
        n = self.known.get(word)
        if n is None:
            symbols = [self.symbols[b] for b in word.encode("utf-8", "surrogatepass")]
            symbols[-1] += self.suffix
            if len(self.known) >= MAX_PIECES:
                self.known.clear()
            n = self.known[word] = count_after_merges(symbols, self.ranks)
        return n

    def __missing__(self, piece: str) -> int:
        n = sum(map(self._word, self.words.findall(piece)))
        if len(self) >= MAX_PIECES:
            self.clear()
        self[piece] = n
        return n

    def _segment(self, text: str) -> int:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        # The library lowers each character alone; str.lower looks at a final sigma's neighbours.
        text = text.lower() if "Σ" not in text else "".join(map(str.lower, text))
        pieces = self.space.split(text) if any(c in text for c in _CONTROL) else text.split()
        return sum(map(self.__getitem__, pieces))

    def count(self, text: str) -> int:
        if self.special is not None and any(m in text for m in self.marks):
            segments = self.special.split(text)
            return len(segments) - 1 + sum(map(self._segment, segments))
        return self._segment(text)


@lru_cache(maxsize=2)
def counter(path: str) -> WordCounter:
    return WordCounter(path)


def count_tokens(documents: DataFrame, vocabulary: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_bytes, n_tokens, over_limit)`` for every row, without begin or end tokens.

    Special strings inside a text count one token each. NULL texts are empty and have 0
    tokens; repeated rows and NULL keys stay; an empty table gives no rows. No shuffle:
    every task counts its own rows and meets each distinct word once.
    """
    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tokens = counter(vocabulary)
        counts = [tokens.count(t) if (t := v.as_py()) else 0 for v in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), batch.column(2)], names=["k", "n_tokens", "n_bytes"])

    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"), F.coalesce(F.octet_length(f"`{text}`"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = in_arrow(rows, count, f"k {kind}, n_tokens long, n_bytes long")
    return counted.select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

"""Removal of repeated lines, paragraphs or sentences by hashing, with original offsets.

Passages copied between texts seldom fill whole lines, and short lines repeat by chance.
Sentences as units, reported only in runs of neighbouring repeated sentences of
``run_words`` words or more, find the former and leave the latter alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_arrow, stash

#: What ends a unit: a line feed; one followed by blank lines; a line feed or a space after a full stop, ``!`` or ``?``.
SEPARATORS = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n[\x20\t\r\x0b\x0c]*\n\s*"), "sentence": re.compile(r"\n|(?<=[.!?]) ")}
UNIT = "row long, k long, r long, unit int, place int, start int, end int, n_words int, digest binary"


def normalise(unit: str) -> bytes:
    """A-Z in lower case, runs of ASCII white space as one space, none at the ends."""
    return b" ".join(unit.encode("utf-8", "surrogatepass").lower().split())


def units_of(text: str, kind: str) -> Iterator[tuple[int, int]]:
    """Bounds of the units of a text, separators left out."""
    at = 0
    for found in SEPARATORS[kind].finditer(text):
        yield at, found.start()
        at = found.end()
    yield at, len(text)


def split_units(documents: DataFrame, kind: str = "line", min_words: int = 5, key: str = "doc_id", text: str = "text", rank: str | None = None) -> DataFrame:
    """``(row, k, r, unit, place, start, end, n_words, digest)`` for every unit of ``min_words``
    words or more; offsets count characters of the original text, ``unit`` all units of the
    text, ``place`` those returned, and ``row`` tells rows apart."""
    rank_ = F.col(f"`{rank}`").cast("long") if rank else F.lit(0).cast("long")
    rows = documents.select(F.col(f"`{key}`").cast("long").alias("k"), rank_.alias("r"), F.monotonically_increasing_id().alias("row"), F.col(f"`{text}`").alias("t"))

    def split(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for k, r, row, t in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
            value, place = t.as_py() or "", 0
            for number, (start, end) in enumerate(units_of(value, kind)):
                plain = normalise(value[start:end])
                words = plain.count(b" ") + 1 if plain else 0
                if words >= max(1, min_words):
                    out.append((row, k, r, number, place, start, end, words, hashlib.blake2b(plain, digest_size=16).digest()))
                    place += 1
        columns = zip(*out) if out else [[]] * 9
        kinds = [pa.int64()] * 3 + [pa.int32()] * 5 + [pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in UNIT.split(", ")])

    return in_arrow(rows, split, UNIT)


def repeated_units(documents: DataFrame, kind: str = "line", min_words: int = 5, key: str = "doc_id", text: str = "text", rank: str | None = None,
                   run_words: int = 0) -> DataFrame:
    """Every unit to remove: ``(key, unit, start, end, n_words, first_doc, first_start)``.

    Units are normalised and grouped by digest over all documents; the occurrence of
    lowest (``rank``, key, position) stays, the rest are returned with offsets into the
    original texts and the place of the one that stays. With ``run_words``, units that go
    are returned only in runs of neighbours that hold so many words together. NULL ranks
    and keys come last; NULL and empty texts have no units; shorter units than
    ``min_words`` always stay and do not part neighbours. Of repeated rows the first
    copy's units stay and each other copy's are listed. An empty table gives no rows.
    Minima are combined before the shuffle, so a unit of any frequency sends one row per
    task, and only digests seen twice are joined back. They are written first: adaptive
    execution splits the occurrences of a frequent one only in a join without the aggregate.
    """
    units = stash(split_units(documents, kind, min_words, key, text, rank), "units")
    far = F.lit(2**63 - 1)
    at = F.struct(F.coalesce("r", far).alias("r"), F.col("k").isNull().alias("no_key"), "k", "start", "row")
    first = stash(units.groupBy("digest").agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first"), "first")
    gone = units.join(first, "digest").where(at != F.col("first"))
    if run_words:
        by_place = Window.partitionBy("row").orderBy("place")
        runs = gone.withColumn("run", F.col("place") - F.row_number().over(by_place))
        gone = runs.withColumn("held", F.sum("n_words").over(Window.partitionBy("row", "run"))).where(F.col("held") >= run_words)
    return gone.select(F.col("k").alias(key), "unit", "start", "end", "n_words", F.col("first.k").alias("first_doc"), F.col("first.start").alias("first_start"))


def remove_units(documents: DataFrame, removed: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with the removed units cut out of their texts (separators stay), and
    ``removed`` spans ``(start, end)`` of the original text. Keys are taken to be unique."""
    spans = removed.groupBy(key).agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("removed"))
    cut = F.aggregate(F.col("removed"), F.struct(F.lit(0).alias("at"), F.lit("").alias("kept")), lambda s, x: F.struct(
        x["end"].alias("at"), F.concat(s["kept"], F.substr(F.col(f"`{text}`"), s["at"] + 1, x["start"] - s["at"])).alias("kept")),
        lambda s: F.concat(s["kept"], F.substr(F.col(f"`{text}`"), s["at"] + 1)))
    return documents.drop("removed").join(spans, key, "left").withColumn(text, F.when(F.col("removed").isNull(), F.col(f"`{text}`")).otherwise(cut))

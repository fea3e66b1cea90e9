"""Delimited text files as numbered records.

Files are read split by split. A record ends at a line break outside quotes, so whether a
line continues the record before it depends on all quotes before it in its file. One pass
counts quotes and lines of every split, for both cases of how the split begins; prefix sums
over the splits (one row each) then settle every split's case and first number. A second
pass puts records together where their lines are read; only what a split holds of a record
that began in an earlier one, at most one piece a split, is joined to that record.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.keys import null_safe_join, pinned_side
from ..session import pin

#: Different header lines that one reading may meet.
MAX_HEADERS = 1000
_SPLITS = "file string, start long, _lines long, _quotes long, _last0 long, _last1 long, _header string"
_RECORDS = "file string, line long, ordinal long, value string, _whole boolean"


def _count_lines(skip: int | None, quoted_breaks: bool):
    """One row per split: its lines, its quotes, and the last line that begins a record if the
    split begins outside (``_last0``) or inside (``_last1``) quotes, -1 for none. With the
    beginning of a file comes the record at its line ``skip``, if it ends in the split."""
    names = [c.split()[0] for c in _SPLITS.split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, lines, before, last, title, titled = None, 0, 0, [-1, -1], [], False

        def counted() -> pa.RecordBatch:
            header = "\n".join(title) if title and (titled or before % 2 == 0 or not quoted_breaks) else None
            row = [*split, lines, before, *last]
            return pa.RecordBatch.from_arrays([*[pa.array([x]) for x in row], pa.array([header], pa.string())], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            values, files, starts = batch.column("value"), batch.column("file"), np.asarray(batch.column("start"))
            quotes = np.asarray(pc.count_substring(values, '"')).astype(np.int64)
            codes = np.asarray(files.dictionary_encode().indices)
            edges = np.flatnonzero((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(quotes)]):
                here = (files[a].as_py(), int(starts[a]))
                if here != split:
                    if split:
                        yield counted()
                    split, lines, before, last, title, titled = here, 0, 0, [-1, -1], [], False
                upto = before + np.cumsum(quotes[a:b])
                odd = (upto - quotes[a:b]) % 2
                for case in (0, 1):
                    begins = np.flatnonzero(odd == case)
                    if len(begins):
                        last[case] = lines + int(begins[-1])
                if skip is not None and not here[1] and not titled and lines + b - a > skip:
                    low = max(0, skip - lines)
                    heads = np.flatnonzero(odd[low:] == 0) + low if quoted_breaks else np.arange(low, b - a)
                    if lines <= skip and not (len(heads) and heads[0] == low):
                        titled = True  # the line goes on from a record before it
                    else:
                        later = heads[heads > skip - lines]
                        title.extend(values.slice(a + low, (int(later[0]) if len(later) else b - a) - low).to_pylist())
                        titled = len(later) > 0
                lines, before = lines + b - a, int(upto[-1])
        if split:
            yield counted()

    return each


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of every split. A record that goes on in later splits has its lines of this one;
    lines before the first record of a split are one row with the line of the record that
    they go on from, and ``_whole`` is false. Splits differ in ``_base``."""
    split, lines, before = None, 0, 0
    held: list[str] = []  # of the record that may go on in the next batch
    at: tuple = ()

    def flushed() -> pa.RecordBatch:
        row = [*at[:3], "\n".join(held), at[3]]
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names)

    names = [c.split()[0] for c in _RECORDS.split(", ")]
    for batch in batches:
        if not batch.num_rows:
            continue
        values, files = batch.column("value"), batch.column("file")
        bases = np.asarray(batch.column("_base"))
        quotes = np.asarray(pc.count_substring(values, '"')).astype(np.int64)
        edges = np.flatnonzero(bases[1:] != bases[:-1]) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(bases)]):
            base, line, inside = int(bases[a]), batch.column("_line")[a].as_py(), batch.column("_inside")[a].as_py()
            if base != split:
                if held:
                    yield flushed()
                split, lines, before, held = base, 0, 0, []
                at = (files[a].as_py(), batch.column("_owner")[a].as_py(), base, False)
            upto = before + np.cumsum(quotes[a:b])
            if inside is None:  # every line is a record
                heads = np.arange(b - a)
            else:
                heads = np.flatnonzero((upto - quotes[a:b]) % 2 == inside)
            first = int(heads[0]) if len(heads) else b - a
            held.extend(values.slice(a, first).to_pylist())
            if len(heads):
                if held:
                    yield flushed()
                final = int(heads[-1])
                if len(heads) > 1:
                    whole, n = values.slice(a + first, final - first), lines + heads[:-1]
                    if len(n) < len(whole):
                        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(heads - first, pa.int32()), whole), "\n")
                    yield pa.RecordBatch.from_arrays(
                        [files.slice(a, len(n)), pa.array(line + n), pa.array(base + n), whole, pa.repeat(True, len(n))], names)
                at, held = (files[a].as_py(), line + lines + final, base + lines + final, True), values.slice(a + final, b - a - final).to_pylist()
            lines, before = lines + b - a, int(upto[-1])
    if held:
        yield flushed()


def _lines_of(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    source = spark.read.text(path if isinstance(path, str) else list(path))
    return source.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _splits_of(lines: DataFrame, quoted_breaks: bool, skip: int | None = None) -> DataFrame:
    """Every split's first line in its file and over all files, whether it begins inside quotes
    (NULL if that is not asked), and the record that its first lines go on from. Written once."""
    in_file = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    overall = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)  # one row a split

    def so_far(column, window):
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    return pin(
        lines.mapInArrow(_count_lines(skip, quoted_breaks), _SPLITS)
        .withColumns({"_inside": (so_far("_quotes", in_file) % 2).cast("int") if quoted_breaks else F.lit(None).cast("int"),
                      "_line": so_far("_lines", in_file), "_base": so_far("_lines", overall)})
        .withColumn("_last", F.when(F.col("_inside") == 0, F.col("_last0")).otherwise(F.col("_last1")))
        .withColumn("_owner", F.last(F.when(F.col("_last") >= 0, F.col("_line") + F.col("_last")), True).over(in_file))
        .select("file", "start", "_lines", "_inside", "_line", "_base", "_owner", "_header")
    )


def _records_of(lines: DataFrame, splits: DataFrame, all_splits: bool = True) -> DataFrame:
    """Records of the given splits. The splits are broadcast, one narrow row each; the driver
    holds as many to plan the reading of the files."""
    def read(chosen: DataFrame, how: str) -> DataFrame:
        placed = null_safe_join(lines, F.broadcast(chosen.drop("_lines", "_header")), ["file", "start"], how)
        known = F.coalesce("_line", F.raise_error(F.lit("files changed while they were read")).cast("long"))
        return placed.select("file", "value", "_inside", known.alias("_line"), "_base", "_owner").mapInArrow(_put_together, _RECORDS)

    whole = read(splits, "left" if all_splits else "inner").where("_whole").drop("_whole")
    going_on = splits.where("_inside = 1")
    if going_on.isEmpty():
        return whole
    rest = read(going_on, "inner").where("NOT _whole").groupBy("file", "line").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "value"))), lambda x: x["value"]), "\n").alias("_rest"))
    joined = null_safe_join(whole, pinned_side(rest), ["file", "line"], "left")
    return joined.select("file", "line", "ordinal", F.concat_ws("\n", "value", "_rest").alias("value"))


def numbered_records(spark: SparkSession, path: str | Sequence[str], quoted_breaks: bool = True) -> DataFrame:
    """``(file, line, ordinal, value)`` of every record: its text, the number of its first line
    within the file, and that number over all files in the order of their paths, from 0 on.

    With ``quoted_breaks``, line breaks inside quotes belong to the record; a file in which
    quotes do not pair should be read without. Empty files have no records.
    """
    lines = _lines_of(spark, path)
    return _records_of(lines, _splits_of(lines, quoted_breaks))


def with_cells(records: DataFrame, width: int, sep: str = ",") -> tuple[DataFrame, list[Column]]:
    """Records with the first ``width`` cells of their delimited text as columns, and these
    columns; missing and empty cells are NULL. A generator parses every record once, however
    often the cells are used."""
    names = [f"_cell{i}" for i in range(width)]
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    parsed = F.from_csv("value", ", ".join(f"{n} string" for n in names), options)
    return records.select(*[c for c in records.columns if c != "value"], F.inline(F.array(parsed)).alias(*names)), [F.col(n) for n in names]


def headed_records(spark: SparkSession, path: str | Sequence[str], skip: int = 0, sep: str = ",", quoted_breaks: bool = True,
                   name=lambda header: header) -> tuple[DataFrame, list[str]]:
    """Records below the header of every file, by column name.

    In each file, line ``skip`` (from 0 on) is the header and the lines before it are left
    out. ``name`` turns a header's cells into column names. The columns are those of the
    first file by path, then those that only later files have; a column that a file lacks
    is NULL there. Returns ``(file, ordinal, _cells)``, ``_cells`` an array in the order of
    the returned names.
    """
    lines = _lines_of(spark, path)
    splits = _splits_of(lines, quoted_breaks, skip)
    titles = splits.where("_header IS NOT NULL").select("file", "_header")
    at_header = splits.where(((F.col("_line") <= skip) & (skip < F.col("_line") + F.col("_lines"))) | (F.col("_owner") == skip))
    far = pin(at_header.join(titles, "file", "left_anti"))
    if not far.isEmpty():  # headers that reach beyond the first split of their file
        found = _records_of(lines, far.select(splits.columns), all_splits=False).where(F.col("line") == skip)
        titles = titles.unionByName(found.select("file", F.col("value").alias("_header")))
    titles = pinned_side(titles)
    kinds = titles.groupBy("_header").agg(F.min("file").alias("_first")).orderBy("_first").limit(MAX_HEADERS + 1).collect()
    if not kinds:
        raise ValueError("the file ends before its header line")
    if len(kinds) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different header lines")
    headers = {k[0]: name(next(csv.reader([k[0]], delimiter=sep), [])) for k in kinds}
    names = list(dict.fromkeys(n for h in headers.values() for n in h))
    width = max(len(h) for h in headers.values())
    body = _records_of(lines, splits).where(F.col("line") > skip).select("file", "ordinal", "value")
    if len(headers) == 1:
        parsed, cells = with_cells(body, width, sep)
        return parsed.select("file", "ordinal", F.array(*cells).alias("_cells")), names
    places = {k: [h.index(n) if n in h else None for n in names] for k, h in headers.items()}
    order = spark.createDataFrame([(k, p) for k, p in places.items()], "_header string, _order array<int>")
    known = titles.join(F.broadcast(order), "_header").select("file", "_order")  # at most MAX_HEADERS rows
    parsed, cells = with_cells(null_safe_join(body, pinned_side(known), ["file"]), width, sep)
    ordered = [F.get(F.array(*cells), F.get("_order", F.lit(j))) for j in range(len(names))]
    return parsed.select("file", "ordinal", F.array(*ordered).alias("_cells")), names


# Ship this module's code with the function, so that executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Helpers shared by the corpus operators: shipping code, shared storage, Arrow batches."""

from __future__ import annotations

import os
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir

#: A word is a run of bytes outside this set; the same class as ``bytes.split()``.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
_SHIPPED = "_quantelle_shipped"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per session.

    Functions are then pickled by reference, so module-level caches live as long
    as a worker and not only as long as a task.
    """
    sc = spark.sparkContext
    if getattr(sc, _SHIPPED, False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(SparkFiles.getRootDirectory(), f"quantelle-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(target)
    setattr(sc, _SHIPPED, True)


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and continue from the files.

    Used where a table is read more than once or where a value depends on row
    placement: a lost executor costs a read, never another result.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, buckets: int, label: str) -> DataFrame:
    """As :func:`stash`, as a table bucketed by ``key``: joins and groups by it read the rows
    where they lie, and only the other side is shuffled."""
    name = f"{label}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).option("path", scratch(df.sparkSession, label)).option("compression", "zstd").saveAsTable(name)
    return df.sparkSession.table(name)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a Hadoop-style location (``/x``, ``file:/x``, ``hdfs://…``)."""
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


def publish(uri: str, write: Callable[[pa.NativeFile], None]) -> None:
    """Write one file under a private name, then rename it, so that task retries and
    duplicate attempts leave one complete file."""
    fs, path = filesystem(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    private = f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}"
    with fs.open_output_stream(private) as out:
        write(out)
    fs.move(private, path)


def in_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""
    ship(df.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(each, schema)


def slices_of(sizes: list[int], limit: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to at most ``limit``, a larger one alone."""
    start = size = 0
    for i, n in enumerate(sizes):
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)


def slices(texts: list, limit: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of at most ``limit`` characters, a longer text alone."""
    return slices_of([len(t) if t else 0 for t in texts], limit)


#: Tables of at most so many narrow rows are broadcast; larger ones are joined by shuffle.
MAX_BROADCAST_ROWS = 2_000_000


def checked(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``MAX_BROADCAST_ROWS`` rows (counted)."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_ROWS else df


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer where ``df`` has such a column."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def without(documents: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents whose key is not among ``ids``; rows with a NULL key stay."""
    name = free_name(documents, "gone")
    gone = stash(ids.select(F.col(key).alias(name)).where(F.col(name).isNotNull()).distinct(), "gone")
    return documents.join(checked(gone), F.col(f"`{key}`") == F.col(name), "left_anti").select(*[F.col(f"`{c}`") for c in documents.columns])


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""Near-duplicate vectors by int8 tile products with proven error bounds.

Unit vectors are written as ``scale * integers + remainder`` with the remainder's norm
kept. The product of two integer rows bounds the cosine from above and below; only
pairs that the bounds leave possibly at the threshold are computed in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stash
from .components import connected_components

TILE = 2048
BLOCK = 1024
#: Room for the rounding of the bounds themselves, far above double precision's own.
SLACK = 1e-6


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Integers in -127..127, scales and norms of the remainders of unit rows."""
    scale = np.abs(unit).max(axis=1) / 127.0
    whole = np.rint(unit / scale[:, None])
    return whole.astype(np.int8), scale, np.linalg.norm(unit - whole * scale[:, None], axis=1)


def tile_pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs ``(i, j)`` of rows whose cosine is at least ``threshold``, in blocks."""
    length_a, length_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    whole_a, scale_a, rest_a = quantise(a / length_a[:, None])
    whole_b, scale_b, rest_b = quantise(b / length_b[:, None])
    # Sums of products of integers up to 127 are exact in single precision below 2**24.
    exact = np.float32 if a.shape[1] * 127 * 127 < 2**24 else np.float64
    whole_a, whole_b = whole_a.astype(exact), whole_b.astype(exact)
    for i in range(0, len(a), BLOCK):
        for j in range(0, len(b), BLOCK):
            low, high = slice(i, i + BLOCK), slice(j, j + BLOCK)
            near = whole_a[low] @ whole_b[high].T
            near = near * scale_a[low, None] * scale_b[None, high]
            # cos = (u - e)(v - f) + e v + u f - e f for unit u, v with remainders e, f
            slack = rest_a[low, None] + rest_b[None, high] + rest_a[low, None] * rest_b[None, high] + SLACK
            x, y = np.nonzero(near + slack >= threshold)
            if len(x):
                x, y = x + i, y + j
                for s in range(0, len(x), 100_000):
                    p, q = x[s:s + 100_000], y[s:s + 100_000]
                    cosine = np.einsum("ij,ij->i", a[p], b[q]) / (length_a[p] * length_b[q])
                    kept = cosine >= threshold
                    yield p[kept], q[kept]


class _Sets:
    """Union-find over row numbers, the smaller number as root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def usable(vector: Column) -> Column:
    """Whether a vector has components, all finite and not NULL, and is not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(vectors: DataFrame, threshold: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label", tile: int = TILE) -> DataFrame:
    """``(key, n_links, component_id, kept)`` for every row.

    Rows of equal, non-NULL label and equal dimension whose cosine is at least
    ``threshold`` are linked. NULL, empty, zero and non-finite vectors and rows with a
    NULL key link with nothing. ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest key reachable. Equal vectors of a label are one class
    with a count, so copies are never paired. Each task compares two tiles of about
    ``tile`` classes of one label and returns per class a count and one edge of a spanning
    forest, never the pairs; a label of any size is cut into tiles. The work is quadratic
    in the classes of a label, as exhaustive tile products are. Rows that share a key are
    one node. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    body = F.col(f"`{vector}`").cast("array<double>")
    name = vectors.schema[label].dataType.simpleString()
    rows = stash(vectors.select(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").alias("label"), F.when(
        usable(body) & F.col(f"`{label}`").isNotNull() & F.col(f"`{key}`").isNotNull(), body).alias("v")).withColumn(
        "class", F.when(F.col("v").isNotNull(), F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.col("v").cast("string")), 256))), "vectors")
    held = rows.where("class is not null")
    classes = held.groupBy("class").agg(F.min("k").alias("rep"), F.count("*").alias("n"))
    singles = held.alias("h").join(classes.alias("c"), (F.col("h.class") == F.col("c.class")) & (F.col("h.k") == F.col("c.rep"))).select(
        "h.class", "c.rep", "c.n", "h.label", F.size("h.v").alias("dim"), "h.v").dropDuplicates(["class"])
    singles = stash(singles, "vector-classes")
    sizes = singles.groupBy("label", "dim").agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("tiles"))
    cut = singles.join(sizes, ["label", "dim"]).withColumn("own", F.pmod(F.xxhash64("class"), F.col("tiles")).cast("int"))
    keyed = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")).select(
        "label", "dim", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "class", "rep", "n", "v")

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("rep", "ascending"), ("class", "ascending")])
        reps, counts, own = (table.column(c).to_numpy() for c in ("rep", "n", "own"))
        dim = table.column("dim")[0].as_py()
        flat = table.column("v").combine_chunks()
        matrix = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        first = np.flatnonzero(own == i)
        second = first if i == j else np.flatnonzero(own == j)
        links, sets = np.zeros(len(reps), np.int64), _Sets(len(reps))
        for p, q in tile_pairs(matrix[first], matrix[second], threshold):
            p, q = first[p], second[q]
            if i == j:
                p, q = p[p != q], q[p != q]
            np.add.at(links, p, counts[q])
            if i != j:
                np.add.at(links, q, counts[p])
            for x, y in zip(p.tolist(), q.tolist()):
                sets.join(x, y)
        found = np.flatnonzero(links)
        roots = np.array([sets.root(x) for x in found.tolist()], np.int64)
        return pa.table({"class": table.column("class").take(pa.array(found)).cast(pa.string()), "links": pa.array(links[found]), "rep": pa.array(reps[found]),
                         "root": pa.array(reps[roots] if len(found) else reps[:0])})

    compared = stash(keyed.withColumn("label", F.col("label").cast(name)).groupBy("label", "dim", "i", "j").applyInArrow(compare, "class string, links long, rep long, root long"), "vector-links")
    links = compared.groupBy("class").agg(F.sum("links").alias("links"))
    # rows that share a key are one node, so a class also hangs on each of its keys that another class holds
    shared = held.groupBy("k").agg(F.count_distinct("class").alias("m")).where("m > 1").select("k")
    extra = held.join(shared, "k").join(classes, "class").select(F.col("k").alias("a"), F.col("rep").alias("b"))
    components = connected_components(compared.select(F.col("rep").alias("a"), F.col("root").alias("b")).unionByName(extra))
    by_class = classes.join(links, "class", "left").join(components.withColumnRenamed("node", "rep"), "rep", "left").select(
        "class", F.coalesce("component", "rep").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    return rows.select("k", "class").join(by_class, "class", "left").select(
        F.col("k").alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "k").alias("component_id"),
        (F.col("k") == F.coalesce("component", "k")).alias("kept"))

"""Clustering of profiles and sample-by-sample structure (S x S results)."""

from __future__ import annotations

import string
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..design import Design
from ..session import pin
from .keys import key_list
from .reshape import to_wide
from .stats import zscore_wide

#: z-scores are clustered as whole numbers of this fraction, so that sums do not depend on their order.
Z_UNITS = 1_000_000


def _squared(points: Sequence[Column], centre: Sequence[float]) -> Column:
    total = None
    for x, c in zip(points, centre):
        d = x.cast("double") - F.lit(float(c))
        total = d * d if total is None else total + d * d
    return total


def cluster_profiles(df: DataFrame, conditions: Sequence[str], k: int = 3, seed: int = 123, id: str = "id",
                     by: Sequence[str] = (), rounds: int = 8) -> DataFrame:
    """z-profiles with a cluster letter, ``(id, <condition>_Z..., cluster)``.

    Bisecting k-means is used instead of a complete-linkage tree, which needs the
    full distance matrix; the partition is therefore not the same one. The largest cluster
    (of equal ones the oldest) is split until there are ``k``: from the profile farthest
    from its centre and the profile farthest from that one (ties by id), ``rounds`` times
    each profile joins the nearer of two centres, the first of equally near ones. Centres
    are means of whole numbers, so the result does not depend on how rows are placed, and
    ``seed`` is not needed; it is kept for callers.

    Letters are given in the order of the smallest id of each cluster. Profiles without
    variation have no cluster and are left out; with fewer distinct profiles than ``k``
    there are fewer clusters. With ``by`` keys, the profiles of all experiments share one
    set of clusters. Profiles are pinned; only counts and centres reach the driver.
    """
    if not 1 <= k <= len(string.ascii_uppercase):
        raise ValueError("k must be between 1 and 26")
    names = [f"{c}_Z" for c in conditions]
    z = zscore_wide(df, conditions, id, by).dropna(subset=[f"`{n}`" for n in names])
    keys = key_list(by, id)
    units = [f"_q{i}" for i in range(len(names))]
    points = pin(z.withColumns({u: F.round(F.col(f"`{n}`") * Z_UNITS).cast("long") for u, n in zip(units, names)}))
    columns = [F.col(u) for u in units]
    label = F.lit(0)

    def centres(rows: DataFrame, group: Column) -> dict[int, tuple[int, list[float]]]:
        """Size and centre of every group, at most ``k`` rows."""
        found = rows.groupBy(group.alias("_g")).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(u).alias(u) for u in units]).collect()
        return {r["_g"]: (r["_n"], [r[u] / r["_n"] for u in units]) for r in found}

    for new in range(1, k):
        held = centres(points, label)
        if not held:
            break
        target = min(held, key=lambda g: (-held[g][0], g))
        inside = points.where(label == target)

        def farthest(centre: Sequence[float]) -> list[float]:
            best = inside.agg(F.min(F.struct((-_squared(columns, centre)).alias("d"), *keys, *units)).alias("b")).first()["b"]
            return [float(best[u]) for u in units]

        first = farthest(held[target][1])
        second = farthest(first)
        for _ in range(rounds):
            nearer = _squared(columns, second) < _squared(columns, first)
            sides = centres(inside, nearer.cast("int"))
            moved = [sides[s][1] if s in sides else c for s, c in ((0, first), (1, second))]
            if moved == [first, second]:
                break
            first, second = moved
        nearer = _squared(columns, second) < _squared(columns, first)
        label = F.when((label == target) & nearer, F.lit(new)).otherwise(label)

    labelled = points.withColumn("_c", label).drop(*units)
    found = labelled.groupBy("_c").agg(F.min(F.struct(id, *by)).alias("_first"))
    letters = F.array(*[F.lit(x) for x in string.ascii_uppercase])
    names_of = found.select(
        "_c", F.element_at(letters, F.row_number().over(Window.orderBy("_first"))).alias("cluster"))
    return labelled.join(F.broadcast(names_of), "_c").drop("_c")  # at most k <= 26 rows


def cluster_profile_long(clustered: DataFrame, conditions: Sequence[str], id: str = "id",
                         by: Sequence[str] = ()) -> DataFrame:
    """Clustered profiles in long form with the label ``<cluster>\\n<size>``."""
    sizes = clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n"))
    rows = F.array(*[
        F.struct(F.lit(c).alias("condition"), F.lit(i).alias("condition_order"), F.col(f"`{c}_Z`").alias("z"))
        for i, c in enumerate(conditions)
    ])
    labelled = clustered.join(F.broadcast(sizes), "cluster").withColumn(  # one row per cluster letter
        "cluster_count", F.concat("cluster", F.lit("\n"), F.col("_n").cast("string")))
    return labelled.select(*key_list(by, id), "cluster", "cluster_count", F.inline(rows))


@dataclass
class SampleMoments:
    """What all pairs of samples have in common: ids with both values, covariance and
    correlation over these ids (NaN where undefined). S x S matrices, set by the design."""

    names: list[str]
    n: np.ndarray
    covariance: np.ndarray
    correlation: np.ndarray


_CROSS = "i int, j int, n double, sx double, sxx double, sxy double"


def _cross_sums(shift: np.ndarray):
    """Sums over the ids of one task, relative to ``shift``, for all pairs of samples."""
    size = len(shift)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sx, sxx, sxy = (np.zeros((size, size)) for _ in range(4))
        for batch in batches:
            values = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            seen = ~np.isnan(values)
            apart, there = np.where(seen, values - shift, 0.0), seen.astype(float)
            n += there.T @ there
            sx += apart.T @ there
            sxx += (apart * apart).T @ there
            sxy += apart.T @ apart
        i, j = np.indices((size, size)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(x.ravel()) for x in (i, j, n, sx, sxx, sxy)], [c.split()[0] for c in _CROSS.split(", ")])

    return each


def sample_moments(df: DataFrame, design: Design, id: str = "id", by: Sequence[str] = ()) -> SampleMoments:
    """Pairwise-complete moments of all samples in one pass over the ids.

    Every task adds up its cross sums around the samples' means; they are summed up in a
    partially aggregated group of S x S rows. Ids that lack a sample count for all pairs of
    the others.
    """
    wide = to_wide(df, design, id, by=by)
    columns = [f"s{i}" for i in range(len(design.names))]
    values = pin(wide.select(*[F.col(f"`{n}`").cast("double").alias(c) for n, c in zip(design.names, columns)]))
    means = values.agg(*[F.avg(F.nanvl(F.col(c), F.lit(None))).alias(c) for c in columns]).first()
    shift = np.array([m if m is not None else 0.0 for m in means])
    sums = values.mapInArrow(_cross_sums(shift), _CROSS).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sxx", "sxy")])
    n, sx, sxx, sxy = (np.zeros((len(columns), len(columns))) for _ in range(4))
    for r in sums.collect():  # S x S rows
        n[r.i, r.j], sx[r.i, r.j], sxx[r.i, r.j], sxy[r.i, r.j] = r.n, r.sx, r.sxx, r.sxy
    with np.errstate(divide="ignore", invalid="ignore"):
        spread = np.maximum(sxx - sx * sx / n, 0.0)
        cross = sxy - sx * sx.T / n
        r = np.clip(cross / np.sqrt(spread * spread.T), -1.0, 1.0)
        return SampleMoments(design.names, n, cross / np.where(n > 1, n - 1, np.nan), r)


def _pairs(df: DataFrame, moments: SampleMoments, matrix: np.ndarray, name: str) -> DataFrame:
    rows = [(a, b, float(matrix[i, j]) if np.isfinite(matrix[i, j]) else None) for i, a in enumerate(moments.names) for j, b in enumerate(moments.names)]
    return df.sparkSession.createDataFrame(rows, f"sample1 string, sample2 string, {name} double")


def sample_correlation(df: DataFrame, design: Design, id: str = "id", moments: SampleMoments | None = None) -> DataFrame:
    """Pearson correlation of every pair of samples over the ids that have both,
    ``(sample1, sample2, r)``; NULL where a sample does not vary. Pass ``moments`` to
    share one pass with the other sample tables."""
    moments = moments or sample_moments(df, design, id)
    return _pairs(df, moments, moments.correlation, "r")


def sample_distance(df: DataFrame, design: Design, id: str = "id", moments: SampleMoments | None = None) -> DataFrame:
    """Euclidean distance between column-scaled samples. For scaled columns it is
    sqrt(2 (n - 1) (1 - r)), so no scaled copy of the data is made."""
    moments = moments or sample_moments(df, design, id)
    return _pairs(df, moments, np.sqrt(2.0 * (moments.n - 1) * np.maximum(1.0 - moments.correlation, 0.0)), "distance")


def pca_loadings(df: DataFrame, design: Design, k: int = 2, id: str = "id", moments: SampleMoments | None = None) -> DataFrame:
    """Loadings of every sample on the first ``k`` components of a centred,
    unscaled PCA whose observations are the ids. The sign is fixed by making each
    component's largest-magnitude loading positive."""
    moments = moments or sample_moments(df, design, id)
    _, vectors = np.linalg.eigh(np.nan_to_num(moments.covariance))
    loadings = vectors[:, ::-1][:, :k]
    pivot = loadings[np.abs(loadings).argmax(axis=0), np.arange(k)]
    loadings = loadings * np.where(pivot < 0, -1.0, 1.0)
    order = {c: i for i, c in enumerate(design.conditions)}
    rows = [(s.condition, s.replicate, order[s.condition], *map(float, loadings[i]))
            for i, s in enumerate(design.samples)]
    schema = "condition string, replicate int, condition_order int, " + ", ".join(f"pc{i + 1} double" for i in range(k))
    return df.sparkSession.createDataFrame(rows, schema)


# Ship this module's code with the function, so that executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

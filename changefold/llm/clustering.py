"""Centroid clustering of integer vectors, pruned by Ptolemaic pivots.

For four points of a Euclidean space Ptolemy's inequality bounds the distance of a vector x and a centroid c
from below by their distances to two pivots p and s: |d(x,p) d(c,s) - d(x,s) d(c,p)| / d(p,s). The vectors' distances
to a few fixed pivots are worked out once and kept beside them; a round measures only the centroids' own.
Every vector is measured exactly to the centroid of the smallest bound, then to all whose bound does not
exceed that. Bounds are rounded down by more than their error, distances are integers, so results are
those of the plain method.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from .common import written

#: Larger integers could give squared distances beyond a long.
LIMIT = 180_000_000
#: More than the relative error of a bound's few operations in double precision.
SLACK = 1e-13
#: Rows whose bounds are worked out together.
BLOCK = 4096


def pivot_pairs(points: np.ndarray, pivots: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Up to ``pivots`` different points, each the farthest from those before, and the pairs of neighbours among
    them; no pair when all points are equal."""
    chosen = [0]
    nearest = squared(points, points[0])
    while len(chosen) < pivots and nearest.max(initial=0) > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(points, points[chosen[-1]]))
    n = len(chosen)
    pairs = sorted({(min(i, (i + 1) % n), max(i, (i + 1) % n)) for i in range(n)}) if n > 1 else []
    return points[chosen], pairs


def squared(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer ``points`` to one."""
    apart = points - point
    return np.einsum("ij,ij->i", apart, apart)


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of every point to every pivot, correctly rounded doubles."""
    return np.sqrt(np.stack([squared(points, p) for p in pivots], axis=1).astype(np.float64))


class Bounds:
    """Lower bounds of the distances to a round's centroids."""

    def __init__(self, centroids: np.ndarray, pivots: np.ndarray, pairs: list[tuple[int, int]]):
        self.own = distances(centroids, pivots)
        between = distances(pivots, pivots)
        self.pairs = [(p, s, between[p, s]) for p, s in pairs]

    def of(self, cached: np.ndarray) -> np.ndarray:
        """Squared bounds, never above the squared distance; ``cached`` has the vectors' pivot distances."""
        best = np.zeros((len(cached), len(self.own)))
        for p, s, base in self.pairs:
            one = cached[:, p, None] * self.own[None, :, s]
            other = cached[:, s, None] * self.own[None, :, p]
            apart = (np.abs(one - other) - SLACK * (one + other)) / base
            np.maximum(best, apart, out=best)
        return best * best * (1 - SLACK)


def assign(vectors: np.ndarray, cached: np.ndarray, centroids: np.ndarray, bounds: Bounds) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, squared distance) of each vector; the smaller number wins a tie."""
    nearest = np.zeros(len(vectors), np.int64)
    least = np.zeros(len(vectors), np.int64)
    for at in range(0, len(vectors), BLOCK):
        rows = vectors[at:at + BLOCK]
        below = bounds.of(cached[at:at + BLOCK])
        first = below.argmin(axis=1)
        apart = rows - centroids[first]
        best, who = np.einsum("ij,ij->i", apart, apart), first.copy()
        for c in range(len(centroids)):
            left = np.flatnonzero((below[:, c] <= best) & (first != c))
            found = squared(rows[left], centroids[c])
            better = (found < best[left]) | ((found == best[left]) & (c < who[left]))
            best[left[better]], who[left[better]] = found[better], c
        nearest[at:at + BLOCK], least[at:at + BLOCK] = who, best
    return nearest, least


# -- Spark ---------------------------------------------------------------------------------------------

def integer_vectors(rows: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(``key``, ``v``) of the usable vectors: ``dims`` components, each ``floor(scale * x)`` with x as a double.

    Others (NULL, of another length, with a NULL, NaN or infinite component) are left out.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = rows.select(F.col(f"`{key}`").alias("key"), v.alias("x")).where((F.size(v) == dims) & ~bad)

    def whole(x):
        scaled = F.floor(x * F.lit(float(scale)))
        return F.when(F.abs(x * F.lit(float(scale))) <= LIMIT, scaled).otherwise(F.raise_error(
            F.lit(f"a component beyond {LIMIT} / {scale}: its squared distances may not fit a long"))).cast("int")

    return kept.select("key", F.transform("x", whole).alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """An Arrow list column of equal lengths as a matrix; batches may be slices."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def cluster(rows: DataFrame, clusters: int = 40, rounds: int = 5, key: str = "vec_id", vector: str = "embedding",
            dims: int = 64, scale: int = 256, seed: str = "2", pivots: int = 8) -> DataFrame:
    """(key, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``) of every usable vector.

    Centroids start as the ``clusters`` vectors of the smallest sha256 of ``<seed>:<key>`` (equal keys: of the
    smallest vector; a NULL key is the empty text), all of them where there are fewer. Each of ``rounds`` rounds
    assigns all vectors and moves every non-empty centroid to ``floor(sum / count)``. ``distance`` is
    squared and exact; ties go to the smaller number. Unusable vectors have no row; NULL keys come back as
    NULL; repeated rows count and come back as often as they stand there; other columns are not read; a
    table without a usable vector gives no rows. Finite components beyond ``LIMIT / scale`` raise an error.

    A round reads the kept integers and pivot distances and shuffles at most ``clusters * (dims + 1)`` numbers per
    task; the driver holds as many.
    """
    spark = rows.sparkSession
    schema = StructType([
        StructField(key, rows.schema[key].dataType), StructField("cluster", IntegerType()),
        StructField("distance", LongType()), StructField("cluster_inertia", LongType()),
        StructField("inertia", LongType()), StructField("centroid_sha256", StringType())])
    whole = written(integer_vectors(rows, key, vector, dims, scale), "cluster-vectors")
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))).cast("binary"), 256)
    start = whole.select(named.alias("name"), "v").orderBy("name", "v").limit(clusters).collect()  # at most ``clusters`` rows
    if not start:
        return spark.createDataFrame([], schema)
    centroids = np.array([r["v"] for r in start], np.int64)
    points, pairs = pivot_pairs(centroids, pivots)
    kept = written(_with_pivots(whole, points), "cluster-pivots")
    for _ in range(rounds):
        sums = _sums(kept, centroids, points, pairs).groupBy("cluster", "i").agg(
            F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # a row a cluster and component
        counts = {r["cluster"]: int(r["total"]) for r in sums if r["i"] == dims}
        for r in sums:
            if r["i"] < dims:
                centroids[r["cluster"], r["i"]] = int(r["total"]) // counts[r["cluster"]]
    found = written(_assigned(kept, centroids, points, pairs), "cluster-found")
    inertia = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    whole_inertia = sum(int(r["total"]) for r in inertia)
    facts = spark.createDataFrame([(
        r["cluster"], int(r["total"]), whole_inertia,
        hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest())
        for r in inertia], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(  # at most one row a cluster
        F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _with_pivots(whole: DataFrame, points: np.ndarray) -> DataFrame:
    dims = points.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = distances(_matrix(batch.column(1), dims).astype(np.int64), points)
            offsets = pa.array(np.arange(0, far.size + 1, len(points), dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(far.ravel()))], names=["key", "v", "far"])

    return whole.select("key", "v").mapInArrow(run, StructType([*whole.schema.fields, StructField("far", ArrayType(DoubleType()))]))


def _sums(kept: DataFrame, centroids: np.ndarray, points: np.ndarray, pairs: list) -> DataFrame:
    """Per task, cluster and component ``i``: the sum of the vectors nearest to the centroid; their number comes
    as one more component."""
    centroids, dims = centroids.copy(), points.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(centroids, points, pairs)
        total = np.zeros((len(centroids), dims + 1), np.int64)

        def rows():
            some = np.flatnonzero(total[:, dims])
            return pa.RecordBatch.from_arrays([
                pa.array(np.repeat(some, dims + 1).astype(np.int32)),
                pa.array(np.tile(np.arange(dims + 1, dtype=np.int32), len(some))),
                pa.array(total[some].ravel())], names=["cluster", "i", "total"])

        for batch in batches:
            vectors = _matrix(batch.column(0), dims).astype(np.int64)
            nearest, _ = assign(vectors, _matrix(batch.column(1), len(points)), centroids, bounds)
            for c in np.unique(nearest):
                own = vectors[nearest == c]
                total[c, :dims] += own.sum(axis=0)
                total[c, dims] += len(own)
            if total[:, dims].sum() > 1 << 34:  # the sums stay within a long
                yield rows()
                total[:] = 0
        yield rows()

    return kept.select("v", "far").mapInArrow(run, "cluster int, i int, total long")


def _assigned(kept: DataFrame, centroids: np.ndarray, points: np.ndarray, pairs: list) -> DataFrame:
    centroids, dims = centroids.copy(), points.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = Bounds(centroids, points, pairs)
        for batch in batches:
            vectors = _matrix(batch.column(1), dims).astype(np.int64)
            nearest, least = assign(vectors, _matrix(batch.column(2), len(points)), centroids, bounds)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nearest.astype(np.int32)), pa.array(least)], names=["key", "cluster", "distance"])

    return kept.select("key", "v", "far").mapInArrow(run, StructType([
        kept.schema["key"], StructField("cluster", IntegerType()), StructField("distance", LongType())]))

"""Centroid clustering by equal-average equal-variance search, in exact integers.

Components become ``floor(64 * x)``. The starting centroids are the vectors whose
``sha256("1:<vec_id>")`` is smallest. A round assigns every vector to its nearest centroid
and moves each centroid that has vectors to their componentwise ``floor(sum / count)``.

The search keeps the centroids sorted by component sum. From a vector's own sum it goes
outward on both sides. With n components, sums S and squared deviations from the mean
D (both times n, so integers), and an exact distance d found so far:

* equal average: ``(Sx - Sc)**2 > n * d`` ends a side, as later centroids lie further out;
* equal variance: ``(Sx - Sc)**2 + (sqrt(Dx) - sqrt(Dc))**2 > n * d`` skips a centroid.

What remains gets its exact integer distance; of equal distances the smaller number wins.
The square roots are doubles, so the second test has a margin and never skips a winner.

A task holds one Arrow batch and the k centroids. Sums leave it as limbs of 32 bits, one
row per cluster, component and limb, and Spark adds them. Only those k centroids, a
parameter, reach the driver.

Defined cases: a vector that is null, has another length, or holds a null or non-finite
component is left out; fewer than k vectors give as many centroids; rows of equal hash
(the same id) start in the order of their components, rows without an id come last;
repeated rows each count; any finite component is exact, but a distance or inertia too
large for a long is null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

CENTROIDS = 16
ROUNDS = 3
DIMENSIONS = 64

# Components up to this size keep n * distance and its parts within 63 bits for 64 components.
_NARROW = 1 << 24
_LIMB = 32


def _usable(dimensions: int):
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.col("embedding").isNotNull() & (F.size("embedding") == dimensions) & ~bad


def usable_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """Written table of vec_id and embedding of the vectors that take part."""
    return written(vectors.select("vec_id", "embedding").filter(_usable(dimensions)), "vectors")


def to_integers(values: np.ndarray, dimensions: int) -> np.ndarray:
    """floor(64 * x), one row per vector: int64 if all are narrow, else Python integers."""
    values = values.astype(np.float64).reshape(-1, dimensions)
    if not values.size or np.abs(values).max() < _NARROW / 64:
        return np.floor(values * 64).astype(np.int64)
    whole = [math.floor(64 * x) if abs(x) < 1e300 else 64 * int(x) for x in values.ravel().tolist()]
    return np.array(whole, dtype=object).reshape(values.shape)


class Search:
    """Nearest of a fixed set of integer centroids for many vectors."""

    def __init__(self, centroids: list[list[int]]):
        narrow = all(abs(x) < _NARROW for c in centroids for x in c)
        points = np.array(centroids, dtype=np.int64 if narrow else object)
        sums = points.sum(axis=1)
        self.order = np.array(sorted(range(len(points)), key=lambda i: (sums[i], i)))
        self.points, self.sums = points[self.order], sums[self.order]
        self.spread = self._deviation(self.points, self.sums)
        self.tested = 0  # distances computed, for tests

    @staticmethod
    def _deviation(rows: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """sqrt(n * sum of squared deviations), from exact integers."""
        exact = rows.shape[1] * (rows * rows).sum(axis=1) - sums * sums
        return np.array([_root(int(x)) for x in exact]) if exact.dtype == object else np.sqrt(exact.astype(np.float64))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance) of each vector."""
        if vectors.dtype == object or self.points.dtype == object:
            return self._nearest_wide(vectors)
        n, k = vectors.shape[1], len(self.order)
        sums = vectors.sum(axis=1)
        spread = self._deviation(vectors, sums)
        place = np.searchsorted(self.sums, sums)
        best = np.full(len(vectors), np.iinfo(np.int64).max // n, np.int64)
        number = np.full(len(vectors), k, np.int64)
        sides = [(1, place, np.arange(len(vectors))), (-1, place - 1, np.arange(len(vectors)))]
        for step in range(k):
            further = []
            for way, start, rows in sides:
                at = start[rows] + way * step
                inside = (at >= 0) & (at < k)
                rows, at = rows[inside], at[inside]
                gap = (sums[rows] - self.sums[at]) ** 2
                near = gap <= n * best[rows]
                rows, at, gap = rows[near], at[near], gap[near]
                further.append((way, start, rows))
                bound = gap + (spread[rows] - self.spread[at]) ** 2
                left = bound * (1 - 1e-9) - 1 <= n * best[rows].astype(np.float64)
                rows, at = rows[left], at[left]
                self.tested += len(rows)
                found, named = ((vectors[rows] - self.points[at]) ** 2).sum(axis=1), self.order[at]
                better = (found < best[rows]) | ((found == best[rows]) & (named < number[rows]))
                best[rows[better]], number[rows[better]] = found[better], named[better]
            sides = further
            if not any(len(rows) for _, _, rows in sides):
                break
        return number, best

    def _nearest_wide(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same search in Python integers, with the mean test alone."""
        n, points, sums = vectors.shape[1], self.points.astype(object), self.sums.astype(object)
        number, best = [], []
        for x in vectors.astype(object):
            total, found = sum(x), None
            for c in sorted(range(len(points)), key=lambda c: abs(total - sums[c])):
                if found and (total - sums[c]) ** 2 > n * found[0]:
                    break
                here = (sum((a - b) ** 2 for a, b in zip(x, points[c], strict=True)), int(self.order[c]))
                found = min(found, here) if found else here
            best.append(found[0])
            number.append(found[1])
        return np.array(number, np.int64), np.array(best, dtype=object)


def _root(x: int) -> float:
    try:
        return math.sqrt(x)
    except OverflowError:
        return float(math.isqrt(x)) if x < 1 << 2000 else math.inf


def _vectors_of(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return to_integers(batch.column("embedding").flatten().to_numpy(zero_copy_only=False), dimensions)


def _limbs(cluster: int, sums: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """(cluster, component, limb, value): value * 2**(32 * limb) adds up to the sum."""
    for component, left in enumerate(sums):
        sign, left, limb = (-1, -left, 0) if left < 0 else (1, left, 0)
        while left:
            yield cluster, component, limb, sign * (left & 0xFFFFFFFF)
            left, limb = left >> _LIMB, limb + 1


def _partial_sums(centroids: list[list[int]]) -> Callable:
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, k, n = Search(centroids), len(centroids), len(centroids[0])
        sums, counts = [[0] * n for _ in range(k)], [0] * k
        for batch in batches:
            vectors = _vectors_of(batch, n)
            number, _ = search.nearest(vectors)
            for c in np.unique(number).tolist():
                own = vectors[number == c]
                counts[c] += len(own)
                sums[c] = [a + int(b) for a, b in zip(sums[c], own.sum(axis=0), strict=True)]
        rows = [r for c in range(k) for r in ((c, -1, 0, counts[c]), *_limbs(c, sums[c])) if counts[c]]
        yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in (zip(*rows) if rows else [[]] * 4)], names=["cluster", "component", "limb", "value"])

    return of_task


def _assigned(centroids: list[list[int]]) -> Callable:
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for batch in batches:
            number, best = search.nearest(_vectors_of(batch, len(centroids[0])))
            wide = best.dtype == object
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), pa.array(number.astype(np.int32)),
                pa.array([x if x < 1 << 63 else None for x in best], pa.int64()) if wide else pa.array(best, pa.int64()),
            ], names=["vec_id", "cluster", "distance"])

    return of_task


def first_centroids(vectors: DataFrame, k: int, dimensions: int) -> list[list[int]]:
    digest = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.withColumn("digest", digest).orderBy(F.col("digest").asc_nulls_last(), "embedding").limit(k).select("embedding").collect()
    return [[int(x) for x in to_integers(np.array(r.embedding, np.float64), dimensions)[0]] for r in rows]


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round."""
    summed = vectors.mapInArrow(_partial_sums(centroids), "cluster bigint, component bigint, limb bigint, value bigint")
    sums = [[0] * len(centroids[0]) for _ in centroids]
    counts = [0] * len(centroids)
    for r in summed.groupBy("cluster", "component", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        if r.component < 0:
            counts[r.cluster] = int(r.value)
        else:
            sums[r.cluster][r.component] += int(r.value) << (_LIMB * r.limb)
    return [[x // count for x in total] if count else old for old, total, count in zip(centroids, sums, counts, strict=True)]


def clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> DataFrame:
    """One row per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark, used = vectors.sparkSession, usable_vectors(vectors, dimensions)
    centroids = first_centroids(used, k, dimensions)
    if not centroids:
        return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    for _ in range(rounds):
        centroids = moved(used, centroids)
    result = written(used.mapInArrow(_assigned(centroids), f"vec_id {used.schema['vec_id'].dataType.simpleString()}, cluster int, distance bigint"), "assigned")
    digests = [(c, hashlib.sha256(",".join(map(str, point)).encode()).hexdigest()) for c, point in enumerate(centroids)]
    # One row per centroid, of which there are at most k.
    held = result.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), F.count_if(F.col("distance").isNull()).alias("wide")).collect()
    whole = sum(r.total or 0 for r in held) if not any(r.wide for r in held) else None
    fits = lambda x: int(x) if x is not None and x < 1 << 63 else None
    per = spark.createDataFrame(
        [(r.cluster, fits(r.total if not r.wide else None), fits(whole), dict(digests)[r.cluster]) for r in held],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return result.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

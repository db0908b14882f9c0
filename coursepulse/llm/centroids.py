"""Centroid clustering of integer vectors by equal-average equal-variance nearest-centroid search.

A component ``c`` counts as the integer ``floor(scale * c)``. For a vector ``x`` of ``d`` components with sum
``S`` and spread ``W = sqrt(d * |x|^2 - S^2)`` (d times its standard deviation), and a centroid ``c`` alike,

    d * |x - c|^2  >=  (S_x - S_c)^2                        (means)
    d * |x - c|^2  >=  (S_x - S_c)^2 + (W_x - W_c)^2        (means and deviations)

The centroids are sorted by their sums. A vector starts at the centroid of the nearest sum and goes outward, always to
the nearer side; it stops where the first bound alone exceeds its best distance, since all that lie further out exceed it too,
skips a centroid by the second bound, and takes the distances that are left in integers. Bounds only
reject what is strictly further, the second one with a margin for its rounding, so equal distances are
all compared and the smaller centroid number wins.

A round reads the table once. A task sends the sums and numbers of its vectors by cluster, as (cluster,
component) rows, so a cluster or a repeated vector of any size moves as one row per component and task; the new centroids
(``k`` x ``d`` integers, ``k`` is a parameter) are exact floors of decimal sums and go with the next tasks.

Defined results: null vectors, vectors of another length and those with null, NaN or infinite components
are left out; the first centroids are the vectors with the smallest sha256 of ``seed:id`` (a null id
counts as empty), then the smallest components; with fewer vectors than ``k``, each is a centroid; repeated rows are vectors of their
own; an empty table gives an empty result; other columns are ignored. Components of any size are exact: a slice
with large ones is computed in Python integers; a distance that is no 64-bit integer is an error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursepulse.llm.scratch import written

K = 16
DIMS = 64
ROUNDS = 3
SCALE = 64
SLICE_ROWS = 4_096
_SMALL = 1 << 26  # components below have sums of squared differences that fit 64 bits, up to 256 components
_LONG = (1 << 63) - 1


# --- one slice of vectors ---------------------------------------------------------------------------

def integer_vectors(column: pa.Array, dims: int = DIMS, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """``(rows, vectors)``: which rows are kept, and their ``floor(scale * c)`` as integers (Python's, where large)."""
    size = np.asarray(pc.fill_null(pc.list_value_length(column), -1)).astype(np.int64)
    rows = np.flatnonzero(size == dims)
    flat = column.take(pa.array(rows)).flatten().cast(pa.float64())
    values = np.asarray(pc.fill_null(flat, math.nan)).reshape(-1, dims)
    whole = np.isfinite(values).all(axis=1)
    rows, values = rows[whole], values[whole]
    if values.size and np.abs(values).max() * scale >= _SMALL:
        exact = [int(v) * scale if abs(v) >= 2 ** 53 else math.floor(scale * v) for v in values.ravel().tolist()]
        return rows, np.array(exact, dtype=object).reshape(values.shape)
    return rows, np.floor(scale * values).astype(np.int64)


class Centroids:
    """The centroids in the order of their sums, with the search."""

    def __init__(self, centroids: list[list[int]]):
        self.d = len(centroids[0])
        big = max((abs(v) for c in centroids for v in c), default=0) >= _SMALL or self.d > 256
        order = sorted(range(len(centroids)), key=lambda i: (sum(centroids[i]), i))
        self.number = np.array(order, np.int64)
        self.at = np.array([centroids[i] for i in order], dtype=object if big else np.int64).reshape(len(order), self.d)
        self.sums, self.spread = self.moments(self.at)

    def moments(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums, and ``sqrt(d * squares - sum^2)``: the radicand is exact, the root is rounded."""
        s = x.sum(axis=1)
        radicand = self.d * (x * x).sum(axis=1) - s * s
        return s, np.sqrt(radicand.astype(np.float64))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """``(centroid number, squared distance, distances computed)`` of every row of ``x``."""
        if x.dtype == object or self.at.dtype == object:
            x = x.astype(object)
        n, k, d = len(x), len(self.at), self.d
        sums, spread = self.moments(x)
        best = np.full(n, -1, dtype=x.dtype)
        number = np.full(n, -1, np.int64)
        up = np.searchsorted(self.sums, sums)  # next centroid outward on either side
        down = up - 1
        on = np.arange(n)
        computed = 0
        while len(on):
            u, w, s = up[on], down[on], sums[on]
            has_u, has_w = u < k, w >= 0
            above = np.abs(self.sums[np.minimum(u, k - 1)] - s)
            below = np.abs(s - self.sums[np.maximum(w, 0)])
            take_up = has_u & (~has_w | (above <= below))
            c = np.where(take_up, u, w)
            far = np.where(take_up, above, below)
            go = (has_u | has_w) & ((number[on] < 0) | (far * far <= d * best[on]))
            on, c, far, take_up = on[go], c[go], far[go], take_up[go]
            up[on] += take_up
            down[on] -= ~take_up
            bound = far.astype(np.float64) ** 2 + (spread[on] - self.spread[c]) ** 2
            near = (number[on] < 0) | (bound * (1 - 1e-9) - 1e-3 * (1 + self.spread[c]) <= (d * best[on]).astype(np.float64))
            i, c = on[near], c[near]
            step = x[i] - self.at[c]
            distance = (step * step).sum(axis=1)
            computed += len(i)
            better = ((number[i] < 0) | (distance < best[i]) | ((distance == best[i]) & (self.number[c] < number[i]))).astype(bool)
            best[i[better]] = distance[better]
            number[i[better]] = self.number[c[better]]
        return number, best, computed


def _slices(batches, dims: int, scale: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """``(ids, integer vectors)`` of the kept rows, ``SLICE_ROWS`` at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            b = batch.slice(at, SLICE_ROWS)
            rows, x = integer_vectors(b.column(1), dims, scale)
            if len(rows):
                yield b.column(0).take(pa.array(rows)), x


# --- rounds ------------------------------------------------------------------------------------------

def _cluster_sums(vectors: DataFrame, centroids: list[list[int]], dims: int, scale: int) -> list:
    """``(cluster, component, sum, number)`` of the vectors by their nearest centroid."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        search, sums, count = Centroids(centroids), {}, {}
        for _, x in _slices(batches, dims, scale):
            number, _, _ = search.nearest(x)
            for c in np.unique(number).tolist():
                part = x[number == c]
                sums[c] = sums.get(c, 0) + part.sum(axis=0).astype(object)
                count[c] = count.get(c, 0) + len(part)
        rows = [(c, j, Decimal(int(v)), count[c]) for c in sorted(sums) for j, v in enumerate(sums[c])]
        cluster, component, total, n = zip(*rows) if rows else ((),) * 4
        yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(component, pa.int32()),
                                          pa.array(total, pa.decimal128(38, 0)), pa.array(n, pa.int64())],
                                         names=["cluster", "component", "total", "n"])

    parts = vectors.mapInArrow(run, "cluster int, component int, total decimal(38,0), n long")
    return parts.groupBy("cluster", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()


def first_centroids(vectors: DataFrame, k: int, seed: int, dims: int, scale: int) -> list[list[int]]:
    """The ``k`` kept vectors with the smallest sha256 of ``seed:id``, in that order (a top-k of the table)."""
    c = F.col("embedding")
    kept = vectors.where((F.size(c) == dims) & F.coalesce(F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < math.inf)), F.lit(False)))
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = kept.select(name.alias("name"), "embedding").orderBy("name", "embedding").limit(k).collect()
    column = pa.array([r.embedding for r in rows], pa.list_(pa.float64()))
    return [[int(v) for v in x] for x in integer_vectors(column, dims, scale)[1]] if rows else []


def fit(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = 1,
        id_col: str = "vec_id", vector_col: str = "embedding") -> list[list[int]]:
    """The final centroids, by number; ``k`` lists of ``dims`` integers."""
    src = _source(vectors, id_col, vector_col)
    centroids = first_centroids(src, k, seed, dims, scale)
    for _ in range(rounds if centroids else 0):
        for cluster, component, total, n in _cluster_sums(src, centroids, dims, scale):
            centroids[cluster][component] = int(total) // n
    return centroids


def _source(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return vectors.select(vectors[id_col].alias("id"), vectors[vector_col].cast("array<double>").alias("embedding"))


def assign(vectors: DataFrame, centroids: list[list[int]], dims: int = DIMS, scale: int = SCALE, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance`` of every kept vector against given centroids."""
    src = _source(vectors, id_col, vector_col)
    kind = src.schema["id"].dataType.simpleString()
    schema = f"vec_id {kind}, cluster int, distance long"
    if not centroids:
        return src.limit(0).selectExpr("id AS vec_id", "0 AS cluster", "0L AS distance")

    def run(batches) -> Iterator[pa.RecordBatch]:
        search = Centroids(centroids)
        for ids, x in _slices(batches, dims, scale):
            number, distance, _ = search.nearest(x)
            if distance.dtype == object and distance.max() > _LONG:
                raise OverflowError("a squared distance is no 64-bit integer")
            yield pa.RecordBatch.from_arrays([ids, pa.array(number.astype(np.int32)), pa.array(distance.astype(np.int64))],
                                             names=["vec_id", "cluster", "distance"])

    return src.mapInArrow(run, schema)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = 1,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector.

    The last assignment is written once; its sums by cluster (at most ``k`` rows) are joined to it.
    """
    spark = vectors.sparkSession
    centroids = fit(vectors, k, rounds, dims, scale, seed, id_col, vector_col)
    rows, _ = written(assign(vectors, centroids, dims, scale, id_col, vector_col), "clusters")
    by = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    inertia = {r["cluster"]: int(r["s"]) for r in by}
    total = sum(inertia.values())
    if total > _LONG:
        raise OverflowError("the inertia is no 64-bit integer")
    table = spark.createDataFrame(
        [(c, inertia[c], total, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c in sorted(inertia)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

"""Boosted trees whose rounds follow one another in one task, over shared rows of binned features (``operators.trees``).

``pyspark.ml`` runs a job for every level of every round, and a grid of 200 rounds has tens of thousands of levels that each
take longer to schedule than to compute when rows are few. Here a task runs all rounds of one fold and depth. The method is
the library's: a first regression tree on the labels -1 and 1, then trees on the negative gradients of the logistic loss,
weighted by the step size, each split the one that lowers the squared error most, a least number of rows a child. It has no
random numbers; bins are cut once for all folds. The model after fewer rounds is the beginning of the one after more.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursepulse.operators.trees import MAX_BINS, ROWS_AT_A_TIME, Shared, Tree, TreeSize, bins_of
from coursepulse.session import cut_lineage

#: The functions below run in tasks whether or not the executors have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows up to which boosted trees are fitted by ``pyspark.ml``, and the most bytes of bins for a task that runs all rounds.
LEAST_ROWS, CHAIN_BYTES = 500, 8 << 20
#: Statistics held at a time.
CELLS_AT_A_TIME = 1 << 18
#: A node whose variance is below this is not split, as in ``pyspark.ml``.
EPSILON = float(np.finfo(float).eps)


def grow(rows: np.ndarray, target: np.ndarray, bins: int, depth: int, least: int) -> Tree:
    """The regression tree over the rows of bins; ``share`` of a node is its mean target, ``gain`` the squared error saved."""
    features = rows.shape[1]
    x, t = rows, target.astype(float)
    columns = np.arange(features) * bins
    n, s, q = (np.array([v]) for v in (float(len(t)), t.sum(), (t * t).sum()))
    parts: list[tuple[np.ndarray, ...]] = []
    levels = [0]
    may = _open(n, s, q, least) & (depth > 0)
    sizes = np.array([len(t)])[may]
    for level in range(depth + 1):
        nodes, open_ = len(n), np.flatnonzero(may)
        levels.append(levels[-1] + nodes)
        feature, cut = np.full(nodes, -1, np.int16), np.zeros(nodes, np.uint8)
        left, gain = np.zeros(nodes, np.int32), np.zeros(nodes)
        parts.append((feature, cut, left, s / np.maximum(n, 1.0), gain))
        if not len(open_):
            break
        begin = np.concatenate([[0], np.cumsum(sizes)])
        k, at_a_time = len(open_), max(1, CELLS_AT_A_TIME // (features * bins))
        right, found = np.empty(len(x), dtype=bool), np.zeros(k, dtype=bool)
        b = 0
        while b < k:
            a, most = b, int(np.searchsorted(begin, begin[b] + ROWS_AT_A_TIME, side="right")) - 1
            b = min(a + at_a_time, max(a + 1, most), k)
            lo, hi, some = begin[a], begin[b], b - a
            xs, ts, of, at = x[lo:hi], t[lo:hi], sizes[a:b], open_[a:b]
            key = (xs + columns + np.repeat(np.arange(some) * (features * bins), of)[:, None]).ravel()
            cells = some * features * bins
            ln = np.cumsum(np.bincount(key, minlength=cells).reshape(some, features, bins), axis=2).astype(float)
            ls = np.cumsum(np.bincount(key, weights=np.repeat(ts, features), minlength=cells).reshape(some, features, bins), axis=2)
            rn, rs = n[at][:, None, None] - ln, s[at][:, None, None] - ls
            score = ls * ls / np.maximum(ln, 1.0) + rs * rs / np.maximum(rn, 1.0)
            score[(ln < least) | (rn < least)] = -np.inf
            best = score.reshape(some, -1).argmax(axis=1)
            saved = score.reshape(some, -1)[np.arange(some), best] - s[at] * s[at] / n[at]
            ok = saved > 1e-13 * q[at]
            f, c = best // bins, best % bins
            feature[at], cut[at], gain[at], found[a:b] = np.where(ok, f, -1), c, np.where(ok, saved, 0.0), ok
            right[lo:hi] = xs[np.arange(hi - lo), np.repeat(f, of)] > np.repeat(c, of)
        split = np.flatnonzero(found)
        if not len(split):
            break
        left[open_[split]] = levels[-1] + 2 * np.arange(len(split))
        # the rows of each split node, those to the left first, in their order
        stays = np.repeat(found, sizes)
        l_rows, r_rows = np.flatnonzero(stays & ~right), np.flatnonzero(stays & right)
        l_ends, r_ends = np.searchsorted(l_rows, begin), np.searchsorted(r_rows, begin)
        lefts, rights = np.diff(l_ends), np.diff(r_ends)
        order = np.empty(len(l_rows) + len(r_rows), dtype=np.int64)
        order[np.arange(len(l_rows)) + np.repeat(r_ends[:-1], lefts)] = l_rows
        order[np.arange(len(r_rows)) + np.repeat(l_ends[1:], rights)] = r_rows
        sizes = np.stack([lefts, rights], axis=1)[split].ravel()
        t = t.take(order)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        n, s, q = sizes.astype(float), np.add.reduceat(t, starts), np.add.reduceat(t * t, starts)
        may = _open(n, s, q, least) & (level + 1 < depth)
        keep = np.repeat(may, sizes)
        x, t, sizes = x.take(order[keep], axis=0), t[keep], sizes[may]
    return Tree(*(np.concatenate(p) for p in zip(*parts)), levels)


def _open(n: np.ndarray, s: np.ndarray, q: np.ndarray, least: int) -> np.ndarray:
    """Nodes with rows for two children whose targets differ."""
    return (n >= 2 * least) & (q / np.maximum(n, 1.0) - (s / np.maximum(n, 1.0)) ** 2 >= EPSILON)


def rounds_of(shared: Shared, fold: int | None, rounds: int, depth: int, least: int, step: float) -> Iterator[tuple[Tree, float]]:
    """The trees over the rows outside ``fold`` (all rows without one), one a round, and their weights."""
    some = slice(None) if fold is None else np.flatnonzero(shared.fold != fold)
    x, y = shared.rows[some], 2.0 * shared.y[some] - 1.0
    margin = np.zeros(len(y))
    for number in range(rounds):
        with np.errstate(over="ignore"):
            target = 4 * y / (1 + np.exp(2 * y * margin)) if number else y
        tree, weight = grow(x, target, shared.bins, depth, least), step if number else 1.0
        margin += weight * tree.shares(x, None)
        yield tree, weight


def suits(estimator: GBTClassifier, df: DataFrame, grid: Sequence[str], label: str, fold_col: str) -> bool:
    """Whether the points of ``grid`` can be fitted by one task a fold and depth: ``pyspark.ml``'s own settings, labels 0 and
    1, so many rows that it pays and so few that the levels of a tree need not be spread over tasks."""
    if not isinstance(estimator, GBTClassifier) or set(grid) - {"maxIter", "maxDepth"}:
        return False
    own = {"lossType": "logistic", "featureSubsetStrategy": "all", "subsamplingRate": 1.0, "maxBins": MAX_BINS, "minInfoGain": 0.0,
           "minWeightFractionPerNode": 0.0}
    if any(estimator.getOrDefault(k) != v for k, v in own.items()) or estimator.isSet("weightCol"):
        return False
    y = F.col(label).cast("double")
    n, fit, folds = df.agg(F.count(F.lit(1)), F.count_if(y.isin(0.0, 1.0)), F.count(fold_col)).first()
    if n <= LEAST_ROWS or fit < n or folds < n:
        return False
    return n * len(df.select(vector_to_array(estimator.getFeaturesCol())).first()[0]) <= CHAIN_BYTES


_SCHEMA = ("depth int, fold int, rounds int, f1 double, number int, levels int, nodes int, gains array<double>, "
           "feature binary, cut binary, left binary, value binary")


def fitted(shared: Broadcast, spark: SparkSession, points: Sequence[dict], folds: int, least: int, step: float) -> DataFrame:
    """One row a tree of the fits on all rows, and one a fold, depth and number of rounds with the F1 of class 1 on the fold."""
    asked = sorted({p["maxIter"] for p in points})
    # the longest fits first: short ones fill the cores at the end
    units = [(d, fold) for d in sorted({p["maxDepth"] for p in points}, reverse=True) for fold in (None, *range(folds))]

    def chain(unit: tuple[int, int | None]) -> Iterator[tuple]:
        depth, fold = unit
        s = shared.value
        out = s.rows[s.fold == fold] if fold is not None else None
        y = s.y[s.fold == fold] == 1 if fold is not None else None
        margin = 0.0
        for i, (t, weight) in enumerate(rounds_of(s, fold, asked[-1], depth, least, step)):
            if fold is None:
                split = t.feature >= 0
                gains = np.bincount(t.feature[split], weights=t.gain[split], minlength=s.rows.shape[1])
                yield (depth, None, None, None, i, t.depth, len(t.feature), gains.tolist(),
                       *(bytearray(v.tobytes()) for v in (t.feature, t.cut, t.left, t.share * weight)))
                continue
            margin = margin + weight * t.shares(out, None)
            if i + 1 in asked:
                p = margin > 0
                n = int(y.sum() + p.sum())
                yield depth, fold, i + 1, 2.0 * int((y & p).sum()) / n if n else 0.0, *[None] * 8

    rows = spark.sparkContext.parallelize(units, len(units)).flatMap(chain)
    return cut_lineage(spark.createDataFrame(rows, _SCHEMA))


def fold_scores(kept: DataFrame, points: Sequence[dict], folds: int) -> list[list[float]]:
    """``scores[point][fold]`` of the rows of :func:`fitted`."""
    of = {(r["depth"], r["rounds"], r["fold"]): r["f1"] for r in kept.where("fold is not null").select("depth", "rounds", "fold", "f1").collect()}
    return [[of[p["maxDepth"], p["maxIter"], fold] for fold in range(folds)] for p in points]


class GrownBoosted:
    """The boosted trees of one point over all rows; what callers use of ``GBTClassificationModel``."""

    def __init__(self, kept: DataFrame, point: dict, cuts: list[np.ndarray], features: str):
        own = (F.col("depth") == point["maxDepth"]) & (F.col("number") < point["maxIter"])
        self.kept, self.cuts, self.features = kept.where(own), cuts, features
        rows = sorted(self.kept.select("number", "levels", "nodes", "gains").collect())
        self.trees = [TreeSize(r["levels"], r["nodes"]) for r in rows]
        total = np.sum([r["gains"] for r in rows], axis=0)
        self.featureImportances = Vectors.dense(total / total.sum() if total.sum() else total)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``rawPrediction`` (the margin of either class), ``probability`` and ``prediction``."""
        rows = sorted(self.kept.select("number", "feature", "cut", "left", "value").collect(), key=lambda r: r["number"])
        trees = df.sparkSession.sparkContext.broadcast([tuple(map(bytes, r[1:])) for r in rows])
        cuts = self.cuts

        @F.pandas_udf("double")
        def margins(values: pd.Series) -> pd.Series:
            x = bins_of(np.vstack(values.to_numpy()), cuts) if len(values) else np.empty((0, len(cuts)), np.uint8)
            out = np.zeros(len(x))
            for f, c, l, v in trees.value:
                out += Tree(np.frombuffer(f, np.int16), np.frombuffer(c, np.uint8), np.frombuffer(l, np.int32), np.frombuffer(v), None, []
                            ).shares(x, None)
            return pd.Series(out)

        m = F.col("__margin")
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-2 * m))
        return df.withColumn("__margin", margins(vector_to_array(self.features))).withColumns({
            "rawPrediction": array_to_vector(F.array(-m, m)), "probability": array_to_vector(F.array(F.lit(1.0) - p, p)),
            "prediction": F.when(m > 0, 1.0).otherwise(0.0)}).drop("__margin")

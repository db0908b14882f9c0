"""Random forests whose trees are grown side by side, each by one task, over shared rows of binned features.

``pyspark.ml`` grows the trees of a forest together, level by level, and every partition sends dense statistics of every
open node; with deep trees over many rows these statistics, not the rows, are what the time and the memory go to. Here
the rows are cut into at most 32 bins a feature, one byte each, and shared with all tasks; a task keeps a tree's rows
ordered by node, so a level costs one pass over them. The trees are those of ``pyspark.ml``'s method: Poisson(1) weights
for each row, ``ceil(sqrt(n))`` features drawn anew for every node, Gini impurity of the weighted classes, a least number
of rows a child, and subtrees whose leaves all predict the same class merged.

The random numbers of a tree follow from the seed, the fold and the number of the tree alone. So a forest of 100 trees is
the first half of the one of 200, and a tree of depth 10 is the one of depth 30 cut at level 10: a grid over both needs
one forest a fold. Nothing here depends on how rows are partitioned, as they are ordered by their key.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursepulse.session import cut_lineage

#: The functions below run in tasks whether or not the executors have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BINS = 32
#: Quantiles asked of each feature, from which the bins are made, and the accuracy they are asked with.
PROBES, ACCURACY = 1_024, 20_000
#: Rows up to which a forest is fitted by ``pyspark.ml``, and the most bytes of bins that are shared with all tasks.
LEAST_ROWS, SHARED_BYTES = 2_000, 32 << 20
#: Nodes and rows whose statistics are held at a time, so that they stay in the processor's cache.
NODES_AT_A_TIME, ROWS_AT_A_TIME = 512, 65_536
#: Draws of class 1 are counted in multiples of this beside the draws of both classes (exact below 2 ** 26 rows).
PACK = float(1 << 26)
#: A share in a prediction as a whole number, so that sums do not depend on their order.
ONE = 1 << 40


# ---------------------------------------------------------------- bins
def cut_points(probes: Sequence[float], most: int = MAX_BINS) -> np.ndarray:
    """At most ``most - 1`` thresholds between the values in ``probes`` (evenly spaced quantiles): all midpoints of few
    values, else those that come nearest to equal shares, as ``pyspark.ml`` places them."""
    values, counts = np.unique(np.asarray(probes, dtype=float), return_counts=True)
    middles = (values[1:] + values[:-1]) / 2
    if len(middles) < most:
        return middles
    below = np.cumsum(counts)[:-1]
    stride, at, target = counts.sum() / most, [], counts.sum() / most
    for i in range(1, len(below) + 1):
        here = below[i] if i < len(below) else counts.sum()
        if abs(below[i - 1] - target) < abs(here - target):
            at.append(i - 1)
            target += stride
    return middles[at[:most - 1]]


def bins_of(values: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """One byte a value: the number of the column's thresholds below it."""
    out = np.empty(values.shape, dtype=np.uint8)
    for f, c in enumerate(cuts):
        out[:, f] = np.searchsorted(c, values[:, f], side="left")
    return out


# ---------------------------------------------------------------- one tree
@dataclass
class Tree:
    """Nodes in order of levels. ``feature`` is -1 at leaves; rows with a bin up to ``cut`` go to ``left``, the others to
    the node after it. ``share`` is the weighted share of class 1, ``gain`` the weighted gain of the split."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    share: np.ndarray
    gain: np.ndarray
    levels: list[int]

    def stops(self, depth: int) -> np.ndarray:
        """Nodes at which a tree of ``depth`` levels ends, with subtrees of one predicted class merged (bottom up)."""
        end = self.levels[min(depth + 1, len(self.levels) - 1)]
        same = np.where(self.share[:end] > 0.5, 1, 0).astype(np.int8)
        for level in range(min(depth, len(self.levels) - 2) - 1, -1, -1):
            a, b = self.levels[level], self.levels[level + 1]
            inner = a + np.flatnonzero(self.feature[a:b] >= 0)
            x, y = same[self.left[inner]], same[self.left[inner] + 1]
            same[inner] = np.where(x == y, x, -1)
        return same >= 0

    def shares(self, rows: np.ndarray, depth: int | None) -> np.ndarray:
        """Share of class 1 (``share``) in the leaf of every row of bins; ``depth`` is None for a tree that is ``ended``."""
        stop = self.feature < 0 if depth is None else self.stops(depth)
        out = np.empty(len(rows), dtype=self.share.dtype)
        for at in range(0, len(rows), ROWS_AT_A_TIME):
            x = rows[at:at + ROWS_AT_A_TIME]
            flat, width = x.ravel(), x.shape[1]
            node = np.zeros(len(x), dtype=np.int32)
            live = np.arange(len(x), dtype=np.int32)
            here = node
            while True:
                go = ~stop[here]
                if not go.all():
                    live, here = live[go], here[go]
                if not len(live):
                    break
                here = self.left[here] + (flat[live * width + self.feature[here]] > self.cut[here])
                node[live] = here
            out[at:at + len(x)] = self.share[node]
        return out

    def ended(self, depth: int) -> Tree:
        """The tree of ``depth`` levels with its merged subtrees: only nodes that rows reach."""
        stop = self.stops(depth)
        reached = np.zeros(len(stop), dtype=bool)
        reached[0] = True
        for a, b in zip(self.levels, self.levels[1:]):
            if b > len(stop):
                break
            inner = a + np.flatnonzero(reached[a:b] & ~stop[a:b])
            reached[self.left[inner]] = reached[self.left[inner] + 1] = True
        to = np.concatenate([[0], np.cumsum(reached)])
        levels = [0, *(int(to[b]) for b in self.levels[1:] if b <= len(stop))]
        leaf = stop[reached]
        return Tree(np.where(leaf, -1, self.feature[:len(stop)][reached]).astype(np.int16), self.cut[:len(stop)][reached],
                    to[np.where(leaf, 0, self.left[:len(stop)][reached])].astype(np.int32), self.share[:len(stop)][reached],
                    np.where(leaf, 0, self.gain[:len(stop)][reached]), [x for i, x in enumerate(levels) if not i or x > levels[i - 1]])

    @property
    def depth(self) -> int:
        return len(self.levels) - 2

    def importances(self, features: int) -> np.ndarray:
        """Gains of the splits by feature, adding up to 1 (0 without a split)."""
        split = self.feature >= 0
        out = np.bincount(self.feature[split], weights=self.gain[split], minlength=features)
        return out / out.sum() if out.sum() else out


def _best_splits(h0: np.ndarray, h1: np.ndarray, w0: float, w1: float, least: int) -> tuple[np.ndarray, ...]:
    """For draws ``(nodes, features, bins)`` of both classes: draws of both that the best split sends left, number of its
    feature, its last bin to the left, its weighted gain, and whether a split is allowed."""
    a, m, b = h0.shape
    n0, n1 = np.cumsum(h0, axis=2), np.cumsum(h1, axis=2)
    t0, t1 = n0[:, :1, -1:], n1[:, :1, -1:]
    n = n0 + n1
    few = (n < least) | (t0 + t1 - n < least)
    l0, l1 = n0 * w0, n1 * w1
    r0, r1 = t0 * w0 - l0, t1 * w1 - l1
    with np.errstate(divide="ignore", invalid="ignore"):
        left = l0 * l1 / (l0 + l1)
        right = r0 * r1 / (r0 + r1)
        score = left + right
    score[few | np.isnan(score)] = np.inf
    score, some = score.reshape(a, m * b), np.arange(a)
    at = score.argmin(axis=1)
    # the gain of the best one from its whole numbers, in full precision
    c0, c1 = (x.reshape(a, m * b)[some, at].astype(float) for x in (n0, n1))
    t0, t1 = t0.reshape(a).astype(float), t1.reshape(a).astype(float)
    gain = 2 * (_impurity(t0 * w0, t1 * w1) - _impurity(c0 * w0, c1 * w1) - _impurity((t0 - c0) * w0, (t1 - c1) * w1))
    ok = np.isfinite(score[some, at]) & (gain > 1e-12 * (t0 * w0 + t1 * w1))
    return c0, c1, at // b, at % b, gain, ok


def _impurity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Half the weighted Gini impurity of two classes."""
    return a * b / np.maximum(a + b, 1e-300)


def grow(rows: np.ndarray, y: np.ndarray, bag: np.ndarray, weights: Sequence[float], bins: int, depth: int, least: int,
         rng: np.random.Generator) -> Tree:
    """A tree over the rows of bins with the classes ``y`` and the numbers of draws ``bag``."""
    features = rows.shape[1]
    m = math.ceil(math.sqrt(features))
    w0, w1 = float(weights[0]), float(weights[1])
    live = np.flatnonzero(bag)
    x, bag = rows.take(live, axis=0), bag[live].astype(np.float64)
    ones = y[live] * bag
    n1 = np.array([ones.sum()])
    n0 = np.array([bag.sum()]) - n1
    draws = bag + ones * PACK  # both numbers in one, for one count
    may = _open(n0, n1, least) & (depth > 0)
    sizes = np.array([len(x)])[may]
    parts: list[tuple[np.ndarray, ...]] = []
    levels = [0]
    for level in range(depth + 1):
        nodes, open_ = len(n0), np.flatnonzero(may)
        levels.append(levels[-1] + nodes)
        feature, cut = np.full(nodes, -1, np.int16), np.zeros(nodes, np.uint8)
        left, gain = np.zeros(nodes, np.int32), np.zeros(nodes)
        parts.append((feature, cut, left, (n1 * w1 / np.maximum(n0 * w0 + n1 * w1, 1e-300)).astype(np.float32), gain))
        if not len(open_):
            break
        begin = np.concatenate([[0], np.cumsum(sizes)])
        k = len(open_)
        right, ok_all = np.empty(len(x), dtype=bool), np.zeros(k, dtype=bool)
        c0, c1 = np.zeros(k), np.zeros(k)  # draws of both classes that go left
        b = 0
        while b < k:
            a, most = b, int(np.searchsorted(begin, begin[b] + ROWS_AT_A_TIME, side="right")) - 1
            b = min(a + NODES_AT_A_TIME, max(a + 1, most), k)
            lo, hi, some = begin[a], begin[b], b - a
            drawn = np.argpartition(rng.random((some, features), dtype=np.float32), m - 1, axis=1)[:, :m] if m < features \
                else np.tile(np.arange(features), (some, 1))
            flat, base = x[lo:hi].ravel(), np.arange(0, (hi - lo) * features, features)
            of, w = sizes[a:b], draws[lo:hi]
            slot = np.repeat(np.arange(some) * bins, of)
            h = np.empty((some, m, bins))
            for j in range(m):
                key = np.repeat(drawn[:, j], of)
                key += base
                np.add(flat.take(key), slot, out=key)
                h[:, j] = np.bincount(key, weights=w, minlength=some * bins).reshape(some, bins)
            h1 = np.floor(h / PACK)
            h0 = h - h1 * (PACK + 1)
            if some >= 64:  # nodes of few rows: their numbers are small
                h0, h1 = h0.astype(np.float32), h1.astype(np.float32)
            c0[a:b], c1[a:b], j, c, g, ok = _best_splits(h0, h1, w0, w1, least)
            f = drawn[np.arange(some), j]
            at = open_[a:b]
            feature[at], cut[at], gain[at], ok_all[a:b] = np.where(ok, f, -1), c, g, ok
            right[lo:hi] = flat.take(base + np.repeat(f, of)) > np.repeat(c.astype(np.uint8), of)
        gain[feature < 0] = 0
        split = np.flatnonzero(ok_all)
        if not len(split):
            break
        left[open_[split]] = levels[-1] + 2 * np.arange(len(split))
        p0, p1 = n0[open_[split]], n1[open_[split]]
        n0 = np.stack([c0[split], p0 - c0[split]], axis=1).ravel()
        n1 = np.stack([c1[split], p1 - c1[split]], axis=1).ravel()
        may = _open(n0, n1, least) & (level + 1 < depth)
        # rows of children that may be split stay: of each node those to the left first, in their order
        goes = np.zeros((2, k), dtype=bool)
        goes[:, split] = may.reshape(-1, 2).T
        l_rows = np.flatnonzero(np.repeat(goes[0], sizes) & ~right)
        r_rows = np.flatnonzero(np.repeat(goes[1], sizes) & right)
        l_ends, r_ends = np.searchsorted(l_rows, begin), np.searchsorted(r_rows, begin)
        lefts, rights = np.diff(l_ends), np.diff(r_ends)
        order = np.empty(len(l_rows) + len(r_rows), dtype=np.int64)
        order[np.arange(len(l_rows)) + np.repeat(r_ends[:-1], lefts)] = l_rows
        order[np.arange(len(r_rows)) + np.repeat(l_ends[1:], rights)] = r_rows
        x, draws = x.take(order, axis=0), draws.take(order)
        sizes = np.stack([lefts, rights], axis=1)[split].ravel()[may]
    return Tree(*(np.concatenate(p) for p in zip(*parts)), levels)


def _open(n0: np.ndarray, n1: np.ndarray, least: int) -> np.ndarray:
    """Nodes of two classes with enough draws for two children."""
    return (n0 + n1 >= 2 * least) & (n0 > 0) & (n1 > 0)


# ---------------------------------------------------------------- forests
@dataclass
class Shared:
    """Rows of bins in the order of their hashes, with classes, folds and the weights of both classes."""

    rows: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    weights: tuple[float, float]
    bins: int

    def tree(self, seed: int, number: int, fold: int | None, depth: int, least: int) -> Tree:
        """Tree ``number`` of the forest over the rows outside ``fold`` (all rows without one)."""
        some = slice(None) if fold is None else np.flatnonzero(self.fold != fold)
        rng = np.random.default_rng([seed, 0 if fold is None else fold + 1, number])
        y = self.y[some]
        return grow(self.rows[some], y, rng.poisson(1.0, len(y)), self.weights, self.bins, depth, least, rng)


def suits(estimator: RandomForestClassifier, df: DataFrame, grid: Sequence[str], label: str, fold_col: str
          ) -> tuple[float, float] | None:
    """Weights of the classes 0 and 1 where the forests of ``grid`` can be grown over shared rows, else None.

    That is for a forest with ``pyspark.ml``'s own settings, of two classes, each of which has one weight, and of so many
    rows that it pays and so few that they can be shared."""
    if not isinstance(estimator, RandomForestClassifier) or set(grid) - {"numTrees", "maxDepth"}:
        return None
    own = {"impurity": "gini", "featureSubsetStrategy": "auto", "subsamplingRate": 1.0, "maxBins": MAX_BINS,
           "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0, "bootstrap": True}
    if any(estimator.getOrDefault(k) != v for k, v in own.items()):
        return None
    weight = F.col(estimator.getWeightCol()) if estimator.isSet("weightCol") else F.lit(1.0)
    classes = df.groupBy(F.col(label).cast("double").alias("y")).agg(
        F.count(F.lit(1)).alias("n"), F.min(weight).alias("a"), F.max(weight).alias("b"), F.count(F.when(weight.isNotNull(), F.col(fold_col))).alias("w")).limit(3).collect()
    n = sum(r["n"] for r in classes)
    if n <= LEAST_ROWS or any(r["y"] not in (0.0, 1.0) or r["a"] != r["b"] or r["w"] != r["n"] for r in classes):
        return None
    features = len(df.select(vector_to_array(estimator.getFeaturesCol())).first()[0])
    if n * features > SHARED_BYTES:
        return None
    by = {int(r["y"]): float(r["a"]) for r in classes}
    return by.get(0, 1.0), by.get(1, 1.0)


def binned(df: DataFrame, features: str, label: str, fold_col: str, weights: tuple[float, float]) -> tuple[Shared, list[np.ndarray]]:
    """The rows of ``df`` cut into bins, and the thresholds of each feature."""
    values = vector_to_array(features)
    wide = len(df.select(values).first()[0])
    asked = F.array(*[F.lit(i / PROBES) for i in range(PROBES + 1)])
    probes = df.select(values.alias("v")).agg(
        *[F.percentile_approx(F.get("v", F.lit(i)), asked, ACCURACY).alias(f"p{i}") for i in range(wide)]).first()
    cuts = [cut_points([v for v in p if not math.isnan(v)]) for p in probes]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, wide)
            got = {"k": b.column("k").to_numpy(), "y": b.column("y").to_numpy().astype(np.uint8),
                   "fold": b.column("fold").to_numpy().astype(np.int32), "rows": bins_of(x, cuts)}
            yield pa.RecordBatch.from_pydict({n: pa.array([v.tobytes()], pa.binary()) for n, v in got.items()})

    others = [F.col(f"`{c}`") for c in df.columns if c != features]
    parts = df.select(F.xxhash64(*others, values).alias("k"), F.col(label).cast("double").alias("y"),
                      F.col(fold_col).cast("int").alias("fold"), values.alias("v")
                      ).mapInArrow(cut, "k binary, y binary, fold binary, rows binary").collect()
    k, y, fold, rows = (np.concatenate([np.frombuffer(r[n], dtype=t) for r in parts])
                        for n, t in (("k", np.int64), ("y", np.uint8), ("fold", np.int32), ("rows", np.uint8)))
    order = np.argsort(k, kind="stable")
    rows = rows.reshape(-1, wide)[order]
    return Shared(rows, y[order], fold[order], weights, max(len(c) for c in cuts) + 1), cuts


def _chunks(counts: Sequence[int], cores: int, forests: int) -> list[tuple[int, int]]:
    """Ranges of trees for the tasks, none of which crosses a number of trees in ``counts``."""
    size = max(1, max(counts) * forests // (8 * cores))
    ends = sorted({0, *counts})
    return [(i, min(i + size, b)) for a, b in zip(ends, ends[1:]) for i in range(a, b, size)]


def fold_scores(shared: Broadcast, spark: SparkSession, points: Sequence[dict], folds: int, seed: int, least: int
                ) -> list[list[float]]:
    """F1 of class 1 of each point's forest on each fold that it was grown without: ``scores[point][fold]``."""
    counts, depths = sorted({p["numTrees"] for p in points}), sorted({p["maxDepth"] for p in points})
    sc = spark.sparkContext
    chunks = _chunks(counts, sc.defaultParallelism, folds)
    units = [(fold, a, b) for a, b in chunks for fold in range(folds)]

    def votes(unit: tuple[int, int, int]) -> Iterator[tuple]:
        fold, a, b = unit
        s = shared.value
        out = s.rows[s.fold == fold]
        sums = {d: np.zeros(len(out), dtype=np.int64) for d in depths}
        for number in range(a, b):
            tree = s.tree(seed, number, fold, depths[-1], least)
            for d in depths:
                sums[d] += np.rint(tree.shares(out, d).astype(float) * ONE).astype(np.int64)
        first = next(c for c in counts if b <= c)
        for d in depths:
            yield (fold, d), {first: sums[d]}

    def both(x: dict, y: dict) -> dict:
        return {c: x[c] + y[c] if c in x and c in y else x.get(c, y.get(c)) for c in {*x, *y}}

    def scores(got: tuple) -> list[tuple]:
        (fold, d), sums = got
        s = shared.value
        y, total, out = s.y[s.fold == fold] == 1, 0, []
        for c in counts:
            total = total + sums[c]
            p = total * 2 > c * ONE  # as ``pyspark.ml``, class 0 where both have equal shares
            n = int(y.sum() + p.sum())
            out.append(((fold, d, c), 2.0 * int((y & p).sum()) / n if n else 0.0))
        return out

    got = dict(sc.parallelize(units, len(units)).flatMap(votes).reduceByKey(both, folds * len(depths)).flatMap(scores).collect())
    return [[got[fold, p["maxDepth"], p["numTrees"]] for fold in range(folds)] for p in points]


@dataclass
class TreeSize:
    depth: int
    numNodes: int


class GrownForest:
    """A forest over all rows, kept as one row a tree; what callers use of ``RandomForestClassificationModel``."""

    def __init__(self, kept: DataFrame, cuts: list[np.ndarray], features: str):
        self.kept, self.cuts, self.features = kept, cuts, features
        rows = sorted(kept.select("number", "depth", "nodes", "importances").collect())
        self.trees = [TreeSize(r["depth"], r["nodes"]) for r in rows]
        total = np.sum([r["importances"] for r in rows], axis=0)
        self.featureImportances = Vectors.dense(total / total.sum() if total.sum() else total)

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``rawPrediction`` (sums of the trees' shares), ``probability`` and ``prediction``."""
        rows = self.kept.select("feature", "cut", "left", "share").collect()
        trees = df.sparkSession.sparkContext.broadcast([tuple(map(bytes, r)) for r in rows])
        cuts, n = self.cuts, len(rows)

        @F.pandas_udf("long")
        def votes(values: pd.Series) -> pd.Series:
            x = bins_of(np.vstack(values.to_numpy()), cuts) if len(values) else np.empty((0, len(cuts)), np.uint8)
            out = np.zeros(len(x), dtype=np.int64)
            for f, c, l, s in trees.value:
                t = Tree(np.frombuffer(f, np.int16), np.frombuffer(c, np.uint8), np.frombuffer(l, np.int32), np.frombuffer(s, np.float32), None, [])
                out += np.rint(t.shares(x, None).astype(float) * ONE).astype(np.int64)
            return pd.Series(out)

        one = F.col("__votes") / float(ONE)
        return df.withColumn("__votes", votes(vector_to_array(self.features))).withColumns({
            "rawPrediction": array_to_vector(F.array(F.lit(float(n)) - one, one)),
            "probability": array_to_vector(F.array(F.lit(1.0) - one / n, one / n)),
            "prediction": F.when(F.col("__votes") * 2 > n * ONE, 1.0).otherwise(0.0)}).drop("__votes")


def whole_forest(shared: Broadcast, spark: SparkSession, cuts: list[np.ndarray], features: str, point: dict, seed: int,
                 least: int) -> GrownForest:
    """The forest of one point over all rows."""
    wide = len(cuts)

    def grown(chunk: tuple[int, int]) -> Iterator[tuple]:
        for number in range(*chunk):
            t = shared.value.tree(seed, number, None, point["maxDepth"], least).ended(point["maxDepth"])
            yield (number, t.depth, len(t.feature), t.importances(wide).tolist(),
                   *(bytearray(x.tobytes()) for x in (t.feature, t.cut, t.left, t.share)))

    chunks = _chunks([point["numTrees"]], spark.sparkContext.defaultParallelism, 1)
    rows = spark.sparkContext.parallelize(chunks, len(chunks)).flatMap(grown)
    kept = cut_lineage(spark.createDataFrame(rows, "number int, depth int, nodes int, importances array<double>, "
                                                   "feature binary, cut binary, left binary, share binary"))
    return GrownForest(kept, cuts, features)

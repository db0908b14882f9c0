"""Boosted trees whose rounds one task runs: against brute force and against the fits of ``pyspark.ml``."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from coursepulse.operators import boosting, trees
from coursepulse.operators import model as mdl


def test_every_split_saves_the_most_and_leaves_hold_means(monkeypatch):
    monkeypatch.setattr(boosting, "CELLS_AT_A_TIME", 64)  # several portions a level
    rng = np.random.default_rng(4)
    x = rng.integers(0, 8, (400, 4)).astype(np.uint8)
    t = x[:, 0] * 0.3 + (x[:, 1] > 4) * x[:, 2] * 0.2 + rng.random(400)
    tree = boosting.grow(x, t, 8, 4, 10)
    error = lambda v: ((v - v.mean()) ** 2).sum()
    seen = []

    def walk(node, rows, depth):
        seen.append(node)
        assert tree.share[node] == pytest.approx(t[rows].mean())
        best = 0.0
        for f in range(4):
            for c in range(7):
                l = x[:, f] <= c
                if depth < 4 and (rows & l).sum() >= 10 and (rows & ~l).sum() >= 10:
                    best = max(best, error(t[rows]) - error(t[rows & l]) - error(t[rows & ~l]))
        assert tree.gain[node] == pytest.approx(best, abs=1e-9)
        if tree.feature[node] >= 0:
            l = x[:, tree.feature[node]] <= tree.cut[node]
            walk(tree.left[node], rows & l, depth + 1)
            walk(tree.left[node] + 1, rows & ~l, depth + 1)

    walk(0, np.ones(400, dtype=bool), 0)
    assert sorted(seen) == list(range(len(tree.feature))) and len(seen) > 15 and tree.depth == 4


def test_equal_targets_and_no_rows():
    x = np.arange(60, dtype=np.uint8).reshape(-1, 1) % 8
    assert boosting.grow(x, np.ones(60), 8, 5, 10).share.tolist() == [1.0]
    assert len(boosting.grow(x[:0], np.ones(0), 8, 5, 10).feature) == 1


@pytest.fixture(scope="module")
def table(spark):
    """Few values a feature, so that the library's bins of every fold are the same."""
    rng = np.random.default_rng(6)
    x = rng.integers(0, 12, (700, 4)).astype(float)
    y = (x[:, 0] + 0.5 * x[:, 1] * (x[:, 2] > 5) + 5 * rng.random(700) > 11).astype(float)
    df = spark.createDataFrame([(i, *map(float, v), float(c)) for i, (v, c) in enumerate(zip(x, y))],
                               "id long, a double, b double, c double, d double, label double")
    df = mdl.assemble(df, ["a", "b", "c", "d"]).withColumn("fold", mdl.fold_column(["id"], 3))
    df = mdl.in_few_partitions(df.select("id", "label", "fold", "features"))
    yield df
    df.unpersist()


GRID = {"maxIter": (3, 6), "maxDepth": (2, 9)}


def test_rounds_run_without_a_job_a_level_and_give_the_library_s_models(spark, table, monkeypatch):
    """Every level of every round was a job; now one task runs a fold's rounds, and scores and the model are the same."""
    fit = GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda *a: pytest.fail("fitted level by level"))
    out = mdl.tune(mdl.boosted("label"), table, GRID, folds=3, rounds="maxIter")
    monkeypatch.setattr(GBTClassifier, "fit", fit)
    assert [p for p, _ in out.points] == [{"maxIter": n, "maxDepth": d} for n in (3, 6) for d in (2, 9)]
    monkeypatch.setattr(boosting, "LEAST_ROWS", 10_000)
    was = mdl.tune(mdl.boosted("label"), table, GRID, folds=3, rounds="maxIter")
    assert out.avgMetrics == pytest.approx(was.avgMetrics, abs=1e-12) and out.best == was.best
    own, old = out.bestModel, was.bestModel
    assert len(own.trees) == out.points[out.best][0]["maxIter"]
    assert np.allclose(own.featureImportances.toArray(), old.featureImportances.toArray(), atol=1e-9)
    assert [t.numNodes for t in own.trees] == [t.numNodes for t in old.trees]
    a, b = ({r["id"]: (r["score"], r["prediction"]) for r in mdl.score(m, table, "label", ["id"]).collect()} for m in (own, old))
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], abs=1e-9) for i in a)


def test_what_is_left_to_the_library(spark, table):
    of = lambda e, d, g=("maxIter", "maxDepth"): boosting.suits(e, d, g, "label", "fold")
    est = mdl.boosted("label")
    assert of(est, table)
    assert not of(est, table.limit(100)) and not of(est, table, ("stepSize",)) and not of(mdl.forest("label"), table)
    assert not of(mdl.boosted("label").setSubsamplingRate(0.5), table) and not of(mdl.boosted("label").setWeightCol("fold"), table)
    assert not of(est, table.withColumn("label", F.col("id") % 3))
    assert not of(est, table.withColumn("fold", F.when(F.col("id") > 5, F.col("fold"))))

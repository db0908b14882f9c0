"""Forests grown tree by tree over shared rows: against brute force, against ``pyspark.ml`` and within a grid search."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from coursepulse.operators import model as mdl
from coursepulse.operators import trees


def made(n=900, features=5, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 8, (n, features)).astype(np.uint8)
    return x, ((x[:, 0] + x[:, 1] + rng.integers(0, 6, n)) > 9).astype(np.uint8), rng.poisson(1.0, n)


def gini(n0, n1):
    return 1 - (n0 / (n0 + n1)) ** 2 - (n1 / (n0 + n1)) ** 2


def best_gain(x, y, w, n, least):
    """Largest weighted gain of any split of these rows, from its definition."""
    best, total = 0.0, w.sum()
    whole = gini(w[y == 0].sum(), w[y == 1].sum())
    for f in range(x.shape[1]):
        for c in range(x[:, f].max()):
            l = x[:, f] <= c
            if n[l].sum() >= least and n[~l].sum() >= least:
                parts = [w[s].sum() / total * gini(w[s & (y == 0)].sum(), w[s & (y == 1)].sum()) for s in (l, ~l)]
                best = max(best, whole - sum(parts))
    return best


def test_every_split_is_the_best_one_and_leaves_are_right(monkeypatch):
    """With all features at every node: gains, sizes and shares of every node, by recursion over the rows."""
    monkeypatch.setattr(trees.math, "ceil", lambda v: 5)
    monkeypatch.setattr(trees, "NODES_AT_A_TIME", 3)  # several portions a level
    x, y, bag = made()
    weights, least = (0.75, 1.5), 10
    t = trees.grow(x, y, bag, weights, 8, 6, least, np.random.default_rng(1))
    w = bag * np.where(y == 1, weights[1], weights[0])
    seen = []

    def walk(node, rows, depth):
        seen.append(node)
        a, b = w[rows & (y == 0)].sum(), w[rows & (y == 1)].sum()
        assert t.share[node] == pytest.approx(b / (a + b), rel=1e-6)
        some = rows & (bag > 0)
        best = best_gain(x[some], y[some], w[some], bag[some], least) if depth < 6 else 0.0
        if t.feature[node] < 0:
            assert best == pytest.approx(0, abs=1e-9)
            return
        assert t.gain[node] / (a + b) == pytest.approx(best, rel=1e-5)
        left = x[:, t.feature[node]] <= t.cut[node]
        walk(t.left[node], rows & left, depth + 1)
        walk(t.left[node] + 1, rows & ~left, depth + 1)

    walk(0, np.ones(len(y), dtype=bool), 0)
    assert sorted(seen) == list(range(len(t.feature))) and len(seen) > 15


@pytest.mark.parametrize("depth", [0, 1, 3, 7])
def test_a_cut_tree_is_the_one_grown_to_that_depth(depth):
    x, y, bag = made()
    deep, low = (trees.grow(x, y, bag, (1.0, 1.0), 8, d, 5, np.random.default_rng(9)) for d in (30, depth))
    assert deep.depth > 7
    assert np.array_equal(deep.shares(x, depth), low.shares(x, depth))
    for t in (deep, low):
        ended = t.ended(depth)
        assert np.array_equal(ended.shares(x, None), low.shares(x, depth)) and ended.depth <= depth
        assert np.allclose(ended.importances(5), low.ended(depth).importances(5))


def test_subtrees_of_one_class_are_merged():
    x, y, bag = made()
    t = trees.grow(x, y, bag, (1.0, 1.0), 8, 30, 5, np.random.default_rng(2))
    e = t.ended(30)
    inner = np.flatnonzero(e.feature >= 0)
    both = [(e.left[i], e.left[i] + 1) for i in inner if e.feature[e.left[i]] < 0 and e.feature[e.left[i] + 1] < 0]
    assert both and all((e.share[a] > 0.5) != (e.share[b] > 0.5) for a, b in both)
    assert len(e.feature) < len(t.feature)


def test_rows_of_one_class_and_no_rows():
    x, y, bag = made()
    for t in (trees.grow(x, y * 0, bag, (1.0, 1.0), 8, 5, 5, np.random.default_rng(2)),
              trees.grow(x, y, bag * 0, (1.0, 1.0), 8, 5, 5, np.random.default_rng(2))):
        assert len(t.feature) == 1 and t.shares(x, 5).tolist() == [0.0] * len(x) and t.importances(5).tolist() == [0.0] * 5


def test_cut_points():
    assert trees.cut_points([1.0, 1.0, 2.0, 5.0]).tolist() == [1.5, 3.5]
    assert trees.cut_points([4.0] * 9).tolist() == []
    many = trees.cut_points(np.arange(1000.0))
    assert len(many) == 31 and np.ptp(np.diff(many)) <= 1.0 + 1e-9
    x = np.array([[0.0, 3.5], [2.0, 3.6], [1.5, float("nan")]])
    assert trees.bins_of(x, [np.array([1.5]), np.array([1.5, 3.5])]).tolist() == [[0, 1], [1, 2], [0, 2]]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = rng.random((6000, 4)).round(2)
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.4 * rng.random(6000) > 1.0).astype(float)
    df = spark.createDataFrame([(i, *map(float, v), float(c)) for i, (v, c) in enumerate(zip(x, y))],
                               "id long, a double, b double, c double, d double, label double")
    df = mdl.balanced_weights(mdl.assemble(df, ["a", "b", "c", "d"]), "label").withColumn("fold", mdl.fold_column(["id"], 3))
    df = df.select("id", "label", "weight", "fold", "features").persist()
    yield df
    df.unpersist()


GRID = {"numTrees": (4, 8), "maxDepth": (3, 12)}


def test_many_rows_are_searched_without_a_job_a_level(spark, table, monkeypatch):
    """A forest over many rows had a job with dense statistics for every level of every fit; now trees are grown by tasks."""
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda *a: pytest.fail("fitted level by level"))
    out = mdl.tune(mdl.forest("label"), table, GRID, folds=3)
    assert [p for p, _ in out.points] == [{"numTrees": n, "maxDepth": d} for n in (4, 8) for d in (3, 12)]
    best = out.points[out.best][0]
    assert len(out.bestModel.trees) == best["numTrees"] and max(t.depth for t in out.bestModel.trees) <= best["maxDepth"]
    assert sum(out.bestModel.featureImportances.toArray()) == pytest.approx(1.0)
    scored = mdl.score(out.bestModel, table, "label", ["id"])
    m = mdl.classification_metrics(scored).first()
    assert m["f1"] > 0.8 and m["auc"] > 0.9 and scored.count() == 6000
    assert scored.where("prediction <> if(score > 0.5, 1.0, 0.0)").count() == 0
    assert mdl.feature_importance(out.bestModel, ["a", "b", "c", "d"], 2).first()["feature"] == "a"


def test_scores_of_points_are_those_of_their_own_forests(spark, table):
    """Each point's mean F1 from trees grown one by one for that point and fold alone."""
    weights = trees.suits(mdl.forest("label"), table, ["numTrees"], "label", "fold")
    shared, cuts = trees.binned(table, "features", "label", "fold", weights)
    out = mdl.tune(mdl.forest("label"), table, GRID, folds=3)
    for p, mean in out.points:
        scores = []
        for fold in range(3):
            held, y = shared.rows[shared.fold == fold], shared.y[shared.fold == fold] == 1
            votes = sum(shared.tree(7, k, fold, p["maxDepth"], 10).shares(held, p["maxDepth"]).astype(float) for k in range(p["numTrees"]))
            hit = votes > p["numTrees"] / 2
            scores.append(2 * (hit & y).sum() / (hit.sum() + y.sum()))
        assert mean == pytest.approx(sum(scores) / 3, abs=1e-12)
    assert np.bincount(shared.fold).sum() == 6000 and len({t.tobytes() for t in (shared.rows[:9], shared.rows[9:18])}) == 2


def test_the_same_forest_however_rows_are_partitioned(spark, table):
    weights = trees.suits(mdl.forest("label"), table, ["numTrees"], "label", "fold")
    a, b = (trees.binned(table.repartition(n), "features", "label", "fold", weights)[0] for n in (1, 7))
    assert all(np.array_equal(getattr(a, c), getattr(b, c)) for c in ("rows", "y", "fold"))


def test_it_scores_as_the_library_does(spark, table):
    """The same method with other random numbers: scores and importances close to those of ``pyspark.ml``."""
    est = mdl.forest("label")
    grid = {"numTrees": (30,), "maxDepth": (6,)}
    own = mdl.tune(est, table, grid, folds=3)
    alone = est.copy({est.numTrees: 30, est.maxDepth: 6}).fit(table)
    f1 = np.mean([mdl.PositiveF1("label").evaluate(est.copy({est.numTrees: 30, est.maxDepth: 6}).fit(table.where(f"fold <> {i}"))
                                                   .transform(table.where(f"fold = {i}"))) for i in range(3)])
    assert own.points[0][1] == pytest.approx(f1, abs=0.015)
    assert np.abs(own.bestModel.featureImportances.toArray() - alone.featureImportances.toArray()).max() < 0.06
    nodes = [sum(t.numNodes for t in m.trees) for m in (own.bestModel, alone)]
    assert nodes[0] == pytest.approx(nodes[1], rel=0.1)
    p = [{r["id"]: r["score"] for r in mdl.score(m, table, "label", ["id"]).collect()} for m in (own.bestModel, alone)]
    assert np.corrcoef(*([x[i] for i in range(6000)] for x in p))[0, 1] > 0.98


def test_what_is_left_to_the_library(spark, table):
    est = mdl.forest("label")
    of = lambda e, d, g=("numTrees", "maxDepth"): trees.suits(e, d, g, "label", "fold")
    w = of(est, table)
    assert w == pytest.approx(tuple(table.where(f"label = {y}").first()["weight"] for y in (0, 1)))
    assert of(est, table.limit(100)) is None
    assert of(est, table, ("minInstancesPerNode",)) is None
    assert of(mdl.forest("label").setMaxBins(16), table) is None
    assert of(mdl.boosted("label"), table) is None
    assert of(est, table.withColumn("label", F.col("id") % 3)) is None
    assert of(est, table.withColumn("weight", F.col("weight") + F.col("id") % 2)) is None
    assert of(est, table.withColumn("label", F.when(F.col("id") > 5, F.col("label")))) is None
    assert of(est, table.withColumn("fold", F.when(F.col("id") > 5, F.col("fold")))) is None


@pytest.fixture
def flagship(spark, table, monkeypatch):
    """The queries of the tuned forest over ``table``, with a small grid and without fits by the library."""
    from coursepulse.plans import q_model

    x = table.select(F.lit("AAA").alias("code_module"), F.lit("2013J").alias("code_presentation"), F.col("id").alias("id_student"),
                     F.col("label").alias("responce"), *[F.get(vector_to_array("features"), F.lit(i)).alias(c) for i, c in enumerate("abcd")])
    monkeypatch.setattr(q_model, "_flagship_sets", lambda *a: (x, x, list("abcd")))
    monkeypatch.setattr(q_model, "FOREST_GRID", GRID)
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda *a: pytest.fail("fitted level by level"))
    return q_model


def test_query_of_the_test_metrics(spark, flagship):
    m = flagship.m11_forest_test_metrics(spark, "").collect()
    assert len(m) == 1 and m[0]["f1"] > 0.8 and m[0]["auc"] > 0.9


def test_query_of_the_grid(spark, flagship):
    rows = flagship.m8_forest_grid_search(spark, "").collect()
    assert [(r["num_trees"], r["max_depth"]) for r in rows] == [(4, 3), (4, 12), (8, 3), (8, 12)]
    assert all(0.7 < r["mean_f1"] <= 1 for r in rows)


def test_query_of_the_properties(spark, flagship):
    r = flagship.m8_m10_forest_properties(spark, "").first()
    assert r["n_points"] == 4 and r["all_scored"] and r["importance"] == pytest.approx(1.0)
    assert r["all_features_named"] and r["trees_as_chosen"] and r["n_train"] == 6000

"""Model helpers on a small synthetic table: PCA, block PCA, tuning (forest and boosted trees),
best-of, importance ranking and scoring."""

import pytest
from pyspark.sql import functions as F

from coursepulse.operators import model as mdl


@pytest.fixture(scope="module")
def table(spark):
    rows = []
    for i in range(240):
        a, b, c = (i % 7) / 7.0, (i % 11) / 11.0, (i % 5) / 5.0
        label = 1.0 if a + 0.3 * b > 0.6 else 0.0
        rows.append((i, a, b, c, a + b, label))
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, label double")
    return df.withColumn("fold", mdl.fold_column(["id"], 3))


def test_pca_fit(spark, table):
    _, var, load = mdl.pca_fit(table, ["a", "b", "c", "d"], 3)
    ratios = [r["explained_variance_ratio"] for r in var.orderBy("component").collect()]
    assert len(ratios) == 3 and ratios == sorted(ratios, reverse=True) and sum(ratios) <= 1 + 1e-9
    assert load.count() == 12


def test_block_pca_columns(spark, table):
    blocks = {"p": (["a", "b"], 1), "q": (["c", "d"], 5)}
    src = table.select("id", "label", "a", "b", "c", "d")
    out = mdl.apply_block_pca(mdl.block_pca(src, blocks), src, blocks)
    assert out.columns == ["id", "label", "p1", "q1", "q2"]
    assert out.count() == 240


def test_tune_best_of_importance_and_score(spark, table):
    tr = mdl.balanced_weights(mdl.assemble(table, ["a", "b", "c", "d"]), "label")
    forest = mdl.tune(mdl.forest("label"), tr, {"numTrees": (5, 10), "maxDepth": (2, 4)}, folds=3)
    boosted = mdl.tune(mdl.boosted("label"), tr, {"maxIter": (2, 3), "maxDepth": (2,)}, folds=3, rounds="maxIter")
    name, best, score = mdl.best_of({"forest": forest, "boosted": boosted})
    assert score == max(max(forest.avgMetrics), max(boosted.avgMetrics))
    imp = mdl.feature_importance(forest.bestModel, ["a", "b", "c", "d"], 2).collect()
    assert len(imp) == 2 and imp[0]["importance"] >= imp[1]["importance"]
    scored = mdl.score(best, tr, "label", ["id"])
    assert scored.columns == ["id", "label", "score", "prediction"]
    m = mdl.classification_metrics(scored).first()
    assert 0.0 <= m["auc"] <= 1.0 and m["f1"] > 0.5
    assert scored.where(F.col("score").isNull()).count() == 0


def trees_of(model):
    return model.toDebugString.split("\n", 1)[1]


def test_boosted_prefix_is_the_separate_fit(spark, table):
    tr = mdl.in_few_partitions(mdl.assemble(table, ["a", "b", "c"]))
    g = mdl.boosted("label")
    long, short = (g.copy({g.maxIter: k, g.maxDepth: 3}).fit(tr) for k in (7, 4))
    cut = mdl.boosted_prefix(long, 4)
    assert trees_of(cut) == trees_of(short) and trees_of(cut) != trees_of(long)
    assert cut.featureImportances == short.featureImportances
    scored = [{r["id"]: (r["rawPrediction"], r["prediction"]) for r in m.transform(tr).collect()} for m in (cut, short)]
    assert scored[0] == scored[1]


@pytest.mark.parametrize("make,grid,rounds", [
    (mdl.forest, {"numTrees": (4, 8), "maxDepth": (2, 12, 25)}, None),
    (mdl.boosted, {"maxIter": (2, 5), "maxDepth": (2, 12, 25)}, "maxIter")])
def test_shared_fits_give_every_point_its_own_model(spark, table, make, grid, rounds):
    """Fewer fits than points, and each point's model is the one that its parameters alone give."""
    tr = mdl.in_few_partitions(mdl.balanced_weights(mdl.assemble(table, ["a", "b", "c", "d"]), "label"))
    est = make("label")
    points = [dict(zip(grid, v)) for v in __import__("itertools").product(*grid.values())]
    models, n = mdl._fit_grid(est, tr, points, rounds)
    assert n == (2 if rounds else 4)  # depths 12 and 25 share one, depth 2 is reached
    for p, m in zip(points, models):
        alone = est.copy({getattr(est, k): v for k, v in p.items()}).fit(tr)
        assert trees_of(m) == trees_of(alone)
    scores = mdl._fold_scores(models, tr.where("fold = 1"), "label")
    f1 = mdl.PositiveF1("label")
    assert scores == [f1.evaluate(m.transform(tr.where("fold = 1"))) for m in models]


def test_forest_keeps_node_ids_and_grows_the_same_trees(spark, table):
    """A level's job does not carry the trees grown so far; the model is the one without kept ids."""
    tr = mdl.in_few_partitions(mdl.balanced_weights(mdl.assemble(table, ["a", "b", "c", "d"]), "label"))
    kept = mdl.forest("label").setNumTrees(6)
    assert kept.getCacheNodeIds()
    m, n = kept.fit(tr), kept.copy({kept.cacheNodeIds: False}).fit(tr)
    assert trees_of(m) == trees_of(n) and m.featureImportances == n.featureImportances


def test_only_the_best_forest_is_fitted_on_all_rows(spark, table):
    tr = mdl.in_few_partitions(mdl.balanced_weights(mdl.assemble(table, ["a", "b", "c", "d"]), "label"))
    grid = {"numTrees": (3, 6), "maxDepth": (2, 3)}
    out = mdl.tune(mdl.forest("label"), tr, grid, folds=3)
    assert out.fits == 3 * 4 + 1
    est, best = mdl.forest("label"), out.points[out.best][0]
    alone = est.copy({getattr(est, k): v for k, v in best.items()}).fit(tr)
    assert trees_of(out.bestModel) == trees_of(alone)
    f1 = mdl.PositiveF1("label")
    for p, mean in out.points:
        scores = [f1.evaluate(est.copy({getattr(est, k): v for k, v in p.items()}).fit(tr.where(f"fold <> {i}"))
                              .transform(tr.where(f"fold = {i}"))) for i in range(3)]
        assert mean == sum(scores) / 3


def test_boosted_points_are_fitted_on_all_rows_beside_the_folds(spark, table):
    """Rounds follow one another, so no whole fit is left to the end; the best model is the separate fit's."""
    tr = mdl.in_few_partitions(mdl.assemble(table, ["a", "b", "c"]))
    out = mdl.tune(mdl.boosted("label"), tr, {"maxIter": (2, 4), "maxDepth": (2, 3)}, folds=3, rounds="maxIter")
    assert out.fits == (3 + 1) * 2
    est, best = mdl.boosted("label"), out.points[out.best][0]
    alone = est.copy({getattr(est, k): v for k, v in best.items()}).fit(tr)
    assert trees_of(out.bestModel) == trees_of(alone)


def test_kept_copies_give_every_core_a_partition():
    from types import SimpleNamespace as Of

    of = lambda master, cores: Of(sparkContext=Of(master=master, defaultParallelism=cores))
    assert mdl.kept_copies(of("local-cluster[3,2,3000]", 6), 1) == 6
    assert mdl.kept_copies(of("spark://host:7077", 6), 4) == 2
    assert mdl.kept_copies(of("yarn", 400), 1) == 8 and mdl.kept_copies(of("yarn", 400), 900) == 1
    assert mdl.kept_copies(of("local[4]", 4), 1) == 1


def test_forest_properties_build_the_training_table_once(spark, table, monkeypatch):
    from coursepulse.plans import q_model

    x = table.withColumns({"code_module": F.lit("AAA"), "code_presentation": F.lit("2013J"), "id_student": F.col("id"),
                           "responce": F.col("label")}).drop("label", "fold")
    built = []
    monkeypatch.setattr(q_model, "_flagship_sets", lambda *a: built.append(a) or (x, x, ["a", "b", "c", "d"]))
    monkeypatch.setattr(q_model, "FOREST_GRID", {"numTrees": (2, 3), "maxDepth": (2,)})
    got = q_model.m8_m10_forest_properties(spark, "").first()
    assert got["n_points"] == 2 and got["n_train"] == 240 and got["trees_as_chosen"] and got["all_features_named"]
    assert len(built) == 1


def test_rounds_need_whole_rows(spark, table):
    with pytest.raises(ValueError):
        mdl.tune(mdl.boosted("label").setSubsamplingRate(0.5), table, {"maxIter": (2, 3)}, rounds="maxIter")


#: P(F > f) of the F distribution from its closed forms for these degrees of freedom.
@pytest.mark.parametrize("f,d1,d2,p", [
    (1.0, 1, 1, 0.5), (3.0, 1, 1, 1 / 3), (2.0, 2, 2, 1 / 3), (4.0, 2, 4, 1 / 9), (5.0, 2, 10, (1 + 2 * 5.0 / 10) ** -5),
    (0.5, 2, 200, (1 + 2 * 0.5 / 200) ** -100), (1.0, 7, 7, 0.5), (0.0, 3, 9, 1.0)])
def test_f_survival_against_closed_forms(f, d1, d2, p):
    from coursepulse.operators.stats import f_survival

    assert f_survival(f, d1, d2) == pytest.approx(p, rel=1e-12)


def test_feature_pipeline(spark, table):
    pipe = mdl.feature_pipeline(["a", "b", "c", "d"], "label").fit(table)
    out = pipe.transform(table).select("features").first()["features"]
    assert out.size == 4  # 2 components + 2 best features


SF = "/root/testdata/sf0.001"


def test_first_assessment_models(spark):
    """The whole flow with one small grid point a model."""
    from coursepulse.plans import q_model
    from coursepulse.sources import fixture_tables

    out = q_model.first_assessment_report(fixture_tables(spark, SF), folds=2,
                                          forest_grid={"numTrees": (3,), "maxDepth": (2,)},
                                          boosted_grid={"maxIter": (2,), "maxDepth": (2,)}).collect()
    assert {r["model"] for r in out} == {"forest", "boosted"}
    best = [r for r in out if r["best"]]
    assert len(best) == 1 and best[0]["mean_f1"] == max(r["mean_f1"] for r in out)
    assert all((r["precision"] is not None) == r["best"] for r in out)
    assert all(len(r["top"]) == 10 for r in out)


def test_components_are_fitted_on_the_training_terms(spark):
    from coursepulse.plans import q_model
    from coursepulse.sources import fixture_tables

    train, test, feats = q_model.first_assessment_sets(fixture_tables(spark, SF))
    means = train.agg(*[F.avg(c).alias(c) for c in feats if "pca" in c]).first()
    assert all(abs(v) < 1e-9 for v in means)
    assert train.columns == test.columns
    assert train.where(" or ".join(f"`{c}` is null" for c in feats)).count() == 0

"""Checked queries: metrics over a scored table (M11-M14, oracle-checked) and the model flows
(PCA, feature pipeline, tuned forests / boosted trees, importance: rows-only checks)."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursepulse.operators import model as mdl
from coursepulse.operators.clicks import clicks_before_first_assessment
from coursepulse.operators.encode import column_means, fill_mean
from coursepulse.operators.split import legacy_split, train_test_split
from coursepulse.plans import feature_pool as fp
from coursepulse.plans import flows
from coursepulse.plans.registry import query
from coursepulse.schema import K3, RESPONSE
from coursepulse.session import cut_lineage
from coursepulse.sources.fixture import fixture_tables

K3J = "code_module, code_presentation, id_student"
THRESHOLDS = mdl.threshold_grid()


def _raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return fixture_tables(spark, sf_dir)


# ---------------------------------------------------------------- deterministic scored table
def effort_scored(raw: dict[str, DataFrame], term: str = "2014J") -> DataFrame:
    """Scored table of one term from a fixed rule: score = logistic of the z-scored effort in [0, 32]
    (0 without clicks), prediction = score > 0.5; label = Fail vs Pass / Distinction."""
    test = {k: v for k, v in raw.items()}
    test["student_info"] = raw["student_info"].where(F.col("code_presentation") == term)
    test["student_vle"] = raw["student_vle"].where(F.col("code_presentation") == term)
    fd = fp.get_response(test, [["Pass", "Distinction"], ["Fail"]], response_name="label")
    fd.update(fp.get_effort(test, 0, 32))
    x = fd.merge().data.withColumn("effort", F.coalesce(F.col("effort"), F.lit(0)).cast("double"))
    # the mean, the deviation and every metric read the one row per student, not the click log again
    x = cut_lineage(x.select(*K3, "label", "effort"))
    mu, sd = x.agg(F.avg("effort"), F.stddev_samp("effort")).first()
    s = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.try_divide(F.col("effort") - F.lit(mu).cast("double"), F.lit(sd).cast("double"))))
    return x.select(*K3, "label", s.alias("score"),
                    F.when(s > 0.5, F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"))


SCORED = f"""
r AS (SELECT {K3J}, CASE WHEN final_result = 'Fail' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS label
  FROM student_info WHERE code_presentation = '2014J' AND final_result IN ('Pass', 'Distinction', 'Fail')),
e AS (SELECT {K3J}, sum(sum_click) FILTER (WHERE date BETWEEN 0 AND 32) AS effort FROM student_vle
  WHERE code_presentation = '2014J' GROUP BY ALL),
x AS (SELECT r.code_module, r.code_presentation, r.id_student, r.label, CAST(COALESCE(e.effort, 0) AS DOUBLE) AS effort
  FROM r LEFT JOIN e USING ({K3J})),
st AS (SELECT avg(effort) AS mu, stddev_samp(effort) AS sd FROM x),
sc AS (SELECT {K3J}, label, 1 / (1 + exp(-(effort - mu) / sd)) AS score FROM x, st),
scored AS (SELECT *, CASE WHEN score > 0.5 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction FROM sc)"""


@query("m11_scored_table", SCORED + "\nSELECT * FROM scored")
def m11_scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deterministic scored table the metric operators are checked on."""
    return effort_scored(_raw(spark, sf_dir))


@query("m11_classification_metrics", SCORED + """,
cnt AS (SELECT sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp,
  sum(CASE WHEN label = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN label = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS fn FROM scored),
rk AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rnk FROM scored),
auc AS (SELECT (sum(rnk) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1) * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
  / (count(*) FILTER (WHERE label = 1) * count(*) FILTER (WHERE label = 0)) AS auc FROM rk)
SELECT COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0) AS precision, COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0) AS recall,
 COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(2 * tp + fp + fn, 0), 0) AS f1, CAST(auc AS DOUBLE) AS auc FROM cnt, auc""")
def m11_classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall, F1 of class 1 and AUC (rank sum with averaged ties) of the scored table."""
    return mdl.classification_metrics(effort_scored(_raw(spark, sf_dir)))


@query("m12_roc_points", SCORED + """,
bys AS (SELECT score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg
  FROM scored GROUP BY score),
tot AS (SELECT sum(pos) AS p, sum(neg) AS n FROM bys),
cum AS (SELECT score, sum(neg) OVER (ORDER BY score DESC) AS fps, sum(pos) OVER (ORDER BY score DESC) AS tps FROM bys),
nb AS (SELECT *, lag(fps) OVER (ORDER BY score DESC) AS f0, lead(fps) OVER (ORDER BY score DESC) AS f2,
  lag(tps) OVER (ORDER BY score DESC) AS t0, lead(tps) OVER (ORDER BY score DESC) AS t2 FROM cum),
pts AS (SELECT score AS threshold, CAST(fps AS DOUBLE) / (SELECT n FROM tot) AS fpr, CAST(tps AS DOUBLE) / (SELECT p FROM tot) AS tpr
  FROM nb WHERE (SELECT count(*) FROM bys) <= 2 OR f0 IS NULL OR f2 IS NULL OR f0 - 2 * fps + f2 <> 0 OR t0 - 2 * tps + t2 <> 0)
SELECT * FROM pts UNION ALL SELECT (SELECT max(score) FROM scored) + 1, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)""")
def m12_roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ROC curve points (bends only, as scikit-learn's default) plus the origin (threshold = highest score + 1)."""
    pts = mdl.roc_points(effort_scored(_raw(spark, sf_dir)))
    # the first finite threshold is the highest score
    top = pts.where(F.col("threshold") < float("inf")).agg(F.max("threshold")).scalar() + F.lit(1.0)
    return pts.withColumn("threshold", F.when(F.col("threshold") == float("inf"), top).otherwise(F.col("threshold")))


@query("m13_confusion_matrix", SCORED + """,
grid AS (SELECT CAST(a AS DOUBLE) AS label, CAST(b AS DOUBLE) AS prediction FROM (VALUES (0), (1)) x(a), (VALUES (0), (1)) y(b))
SELECT g.label, g.prediction, CAST(count(s.label) AS BIGINT) AS n FROM grid g
LEFT JOIN scored s ON s.label = g.label AND s.prediction = g.prediction GROUP BY g.label, g.prediction""")
def m13_confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2 x 2 confusion counts of the scored table (zeros kept)."""
    return mdl.confusion_matrix(effort_scored(_raw(spark, sf_dir)))


_TLIST = "[" + ", ".join(f"CAST('{t!r}' AS DOUBLE)" for t in THRESHOLDS) + "]"
_F1 = SCORED + f""",
th AS (SELECT unnest({_TLIST}) AS threshold),
cnt AS (SELECT th.threshold, count(*) FILTER (WHERE s.score > th.threshold AND s.label = 1) AS tp,
  count(*) FILTER (WHERE s.score > th.threshold AND s.label = 0) AS fp,
  count(*) FILTER (WHERE NOT (s.score > th.threshold) AND s.label = 1) AS fn FROM th, scored s GROUP BY th.threshold),
f1t AS (SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(2 * tp + fp + fn, 0), 0) AS f1 FROM cnt)"""


@query("m14_threshold_f1", _F1 + "\nSELECT * FROM f1t")
def m14_threshold_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 of class 1 when predicting score > t for the 99 accumulated thresholds 0, 0.01, ..."""
    return mdl.threshold_f1(effort_scored(_raw(spark, sf_dir)))


@query("m14_best_threshold", _F1 + "\nSELECT * FROM f1t ORDER BY f1 DESC, threshold LIMIT 1")
def m14_best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first threshold with the best F1."""
    return mdl.best_threshold(mdl.threshold_f1(effort_scored(_raw(spark, sf_dir))))


# ---------------------------------------------------------------- model flows (rows-only)
def _shares_wide(raw: dict[str, DataFrame]) -> tuple[DataFrame, list[str]]:
    train, _ = train_test_split(raw)
    acts = flows.activity_values(raw["vle"])
    eng = flows.engagement(train["student_vle"], train["vle"], 30, activities=acts)
    return eng, acts


@query("m3_pca_activity_shares")
def m3_pca_activity_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PCA(10) of the per-segment activity shares of the training terms: explained variance."""
    eng, acts = _shares_wide(_raw(spark, sf_dir))
    _, var, _ = mdl.pca_fit(eng.na.fill(0.0, subset=acts), acts, 10)
    return var


@query("m3_pca_loadings")
def m3_pca_loadings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loadings of the first four components (absolute values: the sign is free)."""
    eng, acts = _shares_wide(_raw(spark, sf_dir))
    _, _, load = mdl.pca_fit(eng.na.fill(0.0, subset=acts), acts, 10)
    return load.where(F.col("component") <= 4).withColumn("loading", F.abs("loading"))


@query("m3_pca_properties", """
n AS (SELECT count(DISTINCT activity_type) AS k FROM vle)
SELECT CAST(k AS BIGINT) AS n_components, CAST(1 AS DOUBLE) AS explained, CAST(1 AS DOUBLE) AS least_norm,
 CAST(1 AS DOUBLE) AS greatest_norm FROM n""")
def m3_pca_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All components together explain everything, and each one's loadings have length 1."""
    eng, acts = _shares_wide(_raw(spark, sf_dir))
    _, var, load = mdl.pca_fit(eng.na.fill(0.0, subset=acts), acts, len(acts))
    norms = load.groupBy("component").agg(F.sqrt(F.sum(F.col("loading") * F.col("loading"))).alias("norm"))
    v = var.join(norms, "component")
    return v.agg(F.count(F.lit(1)).alias("n_components"), F.sum("explained_variance_ratio").alias("explained"),
                 F.min("norm").alias("least_norm"), F.max("norm").alias("greatest_norm"))


def segment_one_table(raw: dict[str, DataFrame], segment_days: int = 30) -> tuple[DataFrame, list[str], list[str]]:
    """Wide table of segment 1 for the first-assessment flow: clicks before the first assessment,
    demographics x engagement, segments <= 1, registration added (labelled rows)."""
    clicks = clicks_before_first_assessment(raw["student_vle"], raw["assessments"])
    info, groups = flows.demographics(raw["student_info"])
    acts = flows.activity_values(raw["vle"])
    eng = flows.engagement(clicks, raw["vle"], segment_days, activities=acts)
    data = flows.merge_and_process(info, eng).where(F.col(flows.SEG) <= 1)
    reg = raw["student_registration"].drop("date_unregistration")
    data = data.join(reg, K3, "left")
    invariant = ["num_of_prev_attempts", "studied_credits", "imd_band", "age_band", "date_registration"] + \
        [c for cols in groups.values() for c in cols]
    seg = flows.temporal_segment(data, 1, invariant)
    resource = [f"t1_{a}" for a in acts]
    daily = [f"t1_day_{d}" for d in range(1, segment_days + 1)]
    return seg, resource, daily


def first_assessment_sets(raw: dict[str, DataFrame], segment_days: int = 30
                          ) -> tuple[DataFrame, DataFrame, list[str]]:
    """Training and test rows of the first-assessment flow and the names of their features.

    The segment-1 table is split by term; the two PCA blocks (4 resource and 20 daily components) and
    the column means are fitted on the training terms and applied to both sides. A feature without
    any training value is left out, as an imputer does.
    """
    seg, resource, daily = segment_one_table(raw, segment_days)
    train, test = legacy_split(seg.na.fill(0.0, subset=resource + daily), raw["assessments"])
    train = cut_lineage(train)
    blocks = {"rescourse_pca": (resource, 4), "click_date_pca": (daily, 20)}
    pca = mdl.block_pca(train, blocks)
    train, test = (mdl.apply_block_pca(pca, x, blocks) for x in (train, test))
    names = [c for c in train.columns if c not in {*K3, RESPONSE}]
    means = column_means(train, names)
    feats = [c for c in names if c in means]
    return (*(fill_mean(x.select(*K3, RESPONSE, *[F.col(f"`{c}`") for c in feats]), feats, means)
              for x in (train, test)), feats)


@query("m4_block_pca")
def m4_block_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment-1 table of both splits with 4 resource and 20 daily components fitted on the training terms."""
    train, test, _ = first_assessment_sets(_raw(spark, sf_dir))
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


# students with a click in days 1..30 before the course's first assessment and a known outcome
_SEGMENT_ONE = f"""
fa AS (SELECT code_module, code_presentation, min(date) AS first_date FROM assessments GROUP BY ALL),
s1 AS (SELECT DISTINCT {K3J} FROM student_vle s JOIN fa USING (code_module, code_presentation)
  WHERE s.date < fa.first_date AND s.date BETWEEN 1 AND 30),
lab AS (SELECT {K3J}, CASE WHEN final_result = 'Fail' THEN 1 ELSE 0 END AS y FROM student_info
  WHERE final_result IN ('Pass', 'Distinction', 'Fail')),
seg1 AS (SELECT {K3J}, y, CASE WHEN code_presentation = '2014J' THEN 'test' ELSE 'train' END AS side
  FROM s1 JOIN lab USING ({K3J}))"""


@query("m4_block_pca_properties", _SEGMENT_ONE + """,
tr AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS n_fail FROM seg1 WHERE side = 'train')
SELECT 'rescourse_pca' AS block, CAST(4 AS BIGINT) AS n_components, n AS n_train, n_fail,
 CAST(0 AS DOUBLE) AS train_mean, true AS uncorrelated FROM tr
UNION ALL SELECT 'click_date_pca', CAST(20 AS BIGINT), n, n_fail, CAST(0 AS DOUBLE), true FROM tr""")
def m4_block_pca_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per block over the training rows: number of components, rows, failures, largest absolute mean of
    a component (0) and whether all neighbouring components are uncorrelated (covariance below 1e-9)."""
    train, _, feats = first_assessment_sets(_raw(spark, sf_dir))
    blocks = {b: sorted((c for c in feats if c.startswith(b)), key=lambda c: int(c[len(b):]))
              for b in ("rescourse_pca", "click_date_pca")}
    parts = [F.struct(
        F.lit(b).alias("block"), F.lit(len(cols)).cast("long").alias("n_components"),
        F.count(F.lit(1)).alias("n_train"), F.sum(RESPONSE).cast("long").alias("n_fail"),
        F.greatest(*[F.abs(F.avg(c)) for c in cols]).alias("train_mean"),
        (F.greatest(*[F.abs(F.covar_pop(x, y)) for x, y in zip(cols, cols[1:])]) < 1e-9).alias("uncorrelated"))
        for b, cols in blocks.items()]
    return train.agg(F.array(*parts).alias("x")).select(F.explode("x").alias("x")).select("x.*")


# ---------------------------------------------------------------- M7 / M9: tuned models before the first assessment
FOREST_GRID = {"numTrees": (100, 200), "maxDepth": (10, 30)}
BOOSTED_GRID = {"maxIter": (100, 200), "maxDepth": (10, 30)}


def grid_scores(cv, name: str) -> list[tuple[str, int, int, float]]:
    """``(model, trees, depth, mean F1)`` of each grid point of a tuned model."""
    return [(name, int(p.get("numTrees", p.get("maxIter"))), int(p["maxDepth"]), float(m)) for p, m in cv.points]


def tuned_before_first_assessment(raw: dict[str, DataFrame], models=("forest", "boosted"), folds: int = 5,
                                  forest_grid: dict | None = None, boosted_grid: dict | None = None):
    """The named models tuned on the training terms; returns them, the test rows and the features."""
    train, test, feats = first_assessment_sets(raw)
    rows = mdl.balanced_weights(mdl.assemble(train, feats), RESPONSE).withColumn("fold", mdl.fold_column(K3, folds))
    rows = mdl.in_few_partitions(rows.select(*K3, RESPONSE, "weight", "fold", "features"))
    made = {"forest": (mdl.forest, forest_grid or FOREST_GRID, None),
            "boosted": (mdl.boosted, boosted_grid or BOOSTED_GRID, "maxIter")}
    def search(name: str):
        make, grid, rounds = made[name]
        return mdl.tune(make(RESPONSE), rows, grid, label=RESPONSE, folds=folds, parallelism=8, rounds=rounds)

    # boosted rounds follow one another, so the forests' fits fill the cores beside them
    with ThreadPool(len(models)) as pool:
        tuned = dict(zip(models, pool.map(inheritable_thread_target(rows.sparkSession)(search), models)))
    rows.unpersist()
    return tuned, test, feats


def first_assessment_report(raw: dict[str, DataFrame], **grids) -> DataFrame:
    """Every grid point of the tuned forest and boosted trees with its mean F1; on the best model's best
    point also the test-term metrics. ``top`` names the model's ten most important features."""
    tuned, test, feats = tuned_before_first_assessment(raw, **grids)
    spark = test.sparkSession
    name, best, f1 = mdl.best_of(tuned)
    points = [p for n, cv in tuned.items() for p in grid_scores(cv, n)]
    chosen = next(i for i, p in enumerate(points) if p[0] == name and p[3] == f1)  # the first one, as ``Tuned.best``
    top = {n: [f for f, _ in sorted(zip(feats, cv.bestModel.featureImportances.toArray()),
                                    key=lambda x: (-x[1], x[0]))[:10]] for n, cv in tuned.items()}
    grid = spark.createDataFrame([(*p, i == chosen, top[p[0]]) for i, p in enumerate(points)],
                                 "model string, trees long, max_depth long, mean_f1 double, best boolean, top array<string>")
    m = mdl.classification_metrics(mdl.score(best, mdl.assemble(test, feats), RESPONSE, K3))
    return grid.join(F.broadcast(m.withColumn("best", F.lit(True))), "best", "left")


@query("m7_m9_first_assessment_models")
def m7_m9_first_assessment_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first-assessment flow end to end: split, block PCA, imputation, forest and boosted trees tuned
    over trees x depth with 5 folds, the better of the two scored on the test term."""
    return first_assessment_report(_raw(spark, sf_dir))


def _flagship_sets(spark: SparkSession, sf_dir: str):
    raw = _raw(spark, sf_dir)
    train, test = train_test_split(raw)
    fitted = fp.new_preprocessors()
    tr = fp.build_features(train, preprocessors=fitted)
    te = fp.build_features(test, preprocessors=fitted, refit=False)
    feats = [c for c in tr.columns if c not in K3 and c != "responce"]
    return tr.na.fill(0), te.na.fill(0), feats


@query("m5_feature_pipeline")
def m5_feature_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impute, standardise, PCA components next to the k best features, fitted on the training terms."""
    tr, te, feats = _flagship_sets(spark, sf_dir)
    pipe = mdl.feature_pipeline(feats, "responce").fit(tr)
    from pyspark.ml.functions import vector_to_array
    return pipe.transform(te).select(*K3, vector_to_array("features").alias("features"))


def tuned_forest(spark: SparkSession, sf_dir: str):
    """Forest tuned on the training terms, the test rows, the features and the number of training rows."""
    tr, te, feats = _flagship_sets(spark, sf_dir)
    tr = mdl.balanced_weights(mdl.assemble(tr, feats), "responce").withColumn("fold", mdl.fold_column(K3))
    # the 20 fits of the grid read the same assembled training rows
    tr = mdl.in_few_partitions(tr.select(*K3, "responce", "weight", "fold", "features"))
    cv = mdl.tune(mdl.forest("responce"), tr, FOREST_GRID, label="responce", parallelism=6)
    n_train = tr.count()
    tr.unpersist()
    return cv, te, feats, n_train


@query("m8_forest_grid_search")
def m8_forest_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random forest (balanced, 10 rows per leaf) tuned over trees x depth with 5 folds: mean F1 per grid point."""
    cv, _, _, _ = tuned_forest(spark, sf_dir)
    rows = [r[1:] for r in grid_scores(cv, "forest")]
    return spark.createDataFrame(rows, "num_trees long, max_depth long, mean_f1 double")


_LABELLED = f"""
lab AS (SELECT {K3J}, CASE WHEN final_result = 'Fail' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS y FROM student_info
  WHERE final_result IN ('Pass', 'Distinction', 'Fail') AND code_presentation IN ('2013B', '2013J', '2014B'))"""


@query("m6_balanced_weights", _LABELLED + """
SELECT y AS responce, CAST(count(*) AS BIGINT) AS n, sum(count(*)) OVER () / (2.0 * count(*)) AS weight,
 sum(count(*)) OVER () / CAST(2 AS DOUBLE) AS total_weight FROM lab GROUP BY y""")
def m6_balanced_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of each class of the training rows: every class weighs the same in total."""
    tr, _, _ = _flagship_sets(spark, sf_dir)
    return mdl.balanced_weights(tr, "responce").groupBy("responce").agg(
        F.count(F.lit(1)).alias("n"), F.avg("weight").alias("weight"), F.sum("weight").alias("total_weight"))


@query("m5_feature_pipeline_properties", _LABELLED + """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(1 AS BIGINT) AS n_lengths, true AS half_components, true AS centred,
 true AS falling_variance FROM lab""")
def m5_feature_pipeline_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted pipeline over its training rows: vectors of one length, k components and k selected features with
    k = min(floor(n / 2), 100), components with mean 0 and falling variance."""
    from pyspark.ml.functions import vector_to_array
    tr, _, feats = _flagship_sets(spark, sf_dir)
    k = min(len(feats) // 2, 100)
    x = mdl.feature_pipeline(feats, "responce").fit(tr).transform(tr).select(vector_to_array("features").alias("v"))
    size = F.size("v")
    # moments per component, in long form: k rows a training row, k rows in the end
    moments = x.select(F.posexplode(F.slice("v", 1, k)).alias("i", "c")).groupBy("i").agg(F.avg("c").alias("m"), F.var_pop("c").alias("s"))
    ordered = moments.agg(F.max(F.abs("m")).alias("m"), F.array_sort(F.collect_list(F.struct("i", "s"))).alias("s"))
    falling = ordered.select((F.col("m") < 1e-6).alias("centred"),
                             F.forall(F.sequence(F.lit(1), F.size("s") - 1),
                                      lambda i: F.get("s", i - 1)["s"] >= F.get("s", i)["s"] - 1e-9).alias("falling_variance"))
    return x.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(size).alias("n_lengths"),
                 (F.max(size) == 2 * k).alias("half_components")).crossJoin(F.broadcast(falling))  # one row each


@query("m8_m10_forest_properties", _LABELLED + """
SELECT CAST(4 AS BIGINT) AS n_points, true AS all_scored, CAST(1 AS DOUBLE) AS importance, true AS all_features_named,
 true AS trees_as_chosen, CAST(count(*) AS BIGINT) AS n_train FROM lab""")
def m8_m10_forest_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tuned forest: every grid point has a score in [0, 1], the best one's model has its trees, and the
    importances of all features add up to 1."""
    cv, _, feats, n_train = tuned_forest(spark, sf_dir)
    imp = mdl.feature_importance(cv.bestModel, feats, None)
    scores, best = cv.avgMetrics, cv.points[cv.best][0]
    return imp.agg(F.lit(len(scores)).cast("long").alias("n_points"), F.lit(all(0 <= v <= 1 for v in scores)).alias("all_scored"),
                   F.sum("importance").alias("importance"), (F.count_distinct("feature") == len(feats)).alias("all_features_named"),
                   F.lit(len(cv.bestModel.trees) == best["numTrees"]).alias("trees_as_chosen"),
                   F.lit(n_train).cast("long").alias("n_train"))


@query("m10_feature_importance")
def m10_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-10 feature importances of the tuned forest (a top-k report)."""
    cv, _, feats, _ = tuned_forest(spark, sf_dir)
    return mdl.feature_importance(cv.bestModel, feats, 10)


@query("m11_forest_test_metrics")
def m11_forest_test_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall, F1 and AUC of the tuned forest on the test term."""
    cv, te, feats, _ = tuned_forest(spark, sf_dir)
    scored = mdl.score(cv.bestModel, mdl.assemble(te, feats), "responce", K3)
    return mdl.classification_metrics(scored)

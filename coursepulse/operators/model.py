"""Models and their evaluation: PCA blocks, feature pipelines, forests / boosted trees with grid
search, feature importance, and metrics over a scored table.

Training runs through ``pyspark.ml`` (distributed tree induction, tree-aggregated Gramians for
PCA). The metrics read a scored table ``(label, score, prediction)`` and first reduce it to one
row per distinct score (or per threshold bucket), so the ordered steps (ROC, AUC) run over the
distinct scores with a range-partitioned running sum, never over all rows in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import (PCA, Imputer, StandardScaler, UnivariateFeatureSelector,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from coursepulse.functions.dims import few_rows
from coursepulse.functions.columns import safe_div
from coursepulse.operators import boosting
from coursepulse.operators import trees as grown
from coursepulse.operators.numbering import running_sums


# ---------------------------------------------------------------- thresholds (fixed rule)
def threshold_grid(step: float = 0.01, stop: float = 0.99) -> list[float]:
    """Thresholds 0, step, 2 step, ... accumulated while <= stop (accumulation drift kept)."""
    out, t = [], 0.0
    while t <= stop:
        out.append(t)
        t += step
    return out


# ---------------------------------------------------------------- M3 / M4 / M5
def pca_fit(df: DataFrame, cols: Sequence[str], k: int, center: bool = True):
    """PCA on ``cols``: returns the fitted pipeline, explained variance and loadings frames.

    Spark's PCA projects without centring; a mean-only scaler in front reproduces the centred
    projection of the usual definition.
    """
    k = min(k, len(cols))
    stages = [VectorAssembler(inputCols=list(cols), outputCol="__x", handleInvalid="keep")]
    src = "__x"
    if center:
        stages.append(StandardScaler(inputCol="__x", outputCol="__xc", withMean=True, withStd=False))
        src = "__xc"
    stages.append(PCA(k=k, inputCol=src, outputCol="pca"))
    model = Pipeline(stages=stages).fit(df)
    pca = model.stages[-1]
    spark = df.sparkSession
    var = spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(pca.explainedVariance.toArray())],
                                "component long, explained_variance_ratio double")
    mat = pca.pc.toArray()
    load = spark.createDataFrame([(j + 1, c, float(mat[i, j])) for i, c in enumerate(cols) for j in range(k)],
                                 "component long, feature string, loading double")
    return model, var, load


def block_pca(df: DataFrame, blocks: dict[str, tuple[Sequence[str], int]]) -> PipelineModel:
    """Centred PCA of each block of columns, fitted on ``df`` (applied by :func:`apply_block_pca`)."""
    stages = []
    for name, (cols, k) in blocks.items():
        stages += [VectorAssembler(inputCols=list(cols), outputCol=f"__{name}_x", handleInvalid="keep"),
                   StandardScaler(inputCol=f"__{name}_x", outputCol=f"__{name}_c", withMean=True, withStd=False),
                   PCA(k=min(k, len(cols)), inputCol=f"__{name}_c", outputCol=f"__{name}_p")]
    return Pipeline(stages=stages).fit(df)


def apply_block_pca(model: PipelineModel, df: DataFrame, blocks: dict[str, tuple[Sequence[str], int]]) -> DataFrame:
    """``df`` with each block of columns replaced by its components (``{block}{i}``), other columns kept."""
    replaced = {c for cols, _ in blocks.values() for c in cols}
    out = [F.col(f"`{c}`") for c in df.columns if c not in replaced]
    for name, (cols, k) in blocks.items():
        arr = vector_to_array(F.col(f"__{name}_p"))
        out += [arr[i].alias(f"{name}{i + 1}") for i in range(min(k, len(cols)))]
    return model.transform(df).select(*out)


def feature_pipeline(features: Sequence[str], label: str, max_features: int = 100) -> Pipeline:
    """Mean imputation, standardisation, then PCA components next to the k best features
    (ANOVA F against the class), k = min(floor(n / 2), max_features)."""
    k = min(math.floor(len(features) / 2), max_features)
    imputed = [f"__imp_{c}" for c in features]
    return Pipeline(stages=[
        Imputer(inputCols=list(features), outputCols=imputed, strategy="mean"),
        VectorAssembler(inputCols=imputed, outputCol="__raw"),
        StandardScaler(inputCol="__raw", outputCol="__std", withMean=True, withStd=True),
        PCA(k=k, inputCol="__std", outputCol="__pca"),
        UnivariateFeatureSelector(featuresCol="__std", labelCol=label, outputCol="__best",
                                  selectionMode="numTopFeatures")
        .setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(k),
        VectorAssembler(inputCols=["__pca", "__best"], outputCol="features"),
    ])


# ---------------------------------------------------------------- M6-M10
def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Class weight n / (n_classes * n_class) per row (scikit-learn's 'balanced')."""
    counts = {r[label]: r["count"] for r in few_rows(df.groupBy(label).count(), f"classes of {label}")}
    n, k = sum(counts.values()), len(counts)
    m = F.create_map(*[x for c, v in counts.items() for x in (F.lit(c), F.lit(n / (k * v)))])
    return df.withColumn(out, F.try_element_at(m, F.col(label)))


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def fold_column(keys: Sequence[str], folds: int = 5) -> F.Column:
    """Deterministic fold of each row from a hash of its key (no row order in Spark)."""
    return F.pmod(F.xxhash64(*keys), F.lit(folds)).cast("int")


class PositiveF1(Evaluator):
    """F1 of the positive class (label 1); 0 where a fold has neither such a label nor such a prediction."""

    def __init__(self, label: str = "label"):
        super().__init__()
        self.label = label

    def _evaluate(self, dataset: DataFrame) -> float:
        y, p = F.col(self.label) == 1, F.col("prediction") == 1
        hits, labelled, predicted = dataset.agg(F.count_if(y & p), F.count_if(y), F.count_if(p)).first()
        return 2.0 * hits / (labelled + predicted) if labelled + predicted else 0.0

    def isLargerBetter(self) -> bool:
        return True


def forest(label: str = "label", weight: str | None = "weight", seed: int = 7) -> RandomForestClassifier:
    # kept node ids: the same trees, but a level's job does not carry all trees grown so far
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", minInstancesPerNode=10, seed=seed,
                                cacheNodeIds=True)
    return rf.setWeightCol(weight) if weight else rf


def boosted(label: str = "label", seed: int = 7) -> GBTClassifier:
    return GBTClassifier(labelCol=label, featuresCol="features", minInstancesPerNode=10, seed=seed)


def kept_copies(spark: SparkSession, parts: int, most: int = 8) -> int:
    """Copies of ``parts`` kept partitions that give every core one, at most ``most``; one on a single machine."""
    sc = spark.sparkContext
    if sc.master == "local" or sc.master.startswith("local["):
        return 1
    return min(most, max(1, -(-sc.defaultParallelism // parts)))


def in_few_partitions(df: DataFrame, rows_per_partition: int = 20_000) -> DataFrame:
    """Training rows kept (memory, then disk) in partitions of about ``rows_per_partition`` rows.

    A tree fit runs one job a level over these rows, so many small partitions cost more than the work.
    Fits that run side by side go where the rows are kept, so fewer partitions than cores are kept on several executors.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    parts = -(-df.count() // rows_per_partition) or 1
    out = df.repartition(parts).persist(StorageLevel(True, True, False, False, kept_copies(df.sparkSession, parts)))
    out.count()
    df.unpersist()
    return out


@dataclass
class Tuned:
    """Outcome of a grid search: ``(parameters, mean score)`` of every point, and the best point's model on all rows."""

    points: list[tuple[dict, float]]
    bestModel: object
    fits: int

    @property
    def avgMetrics(self) -> list[float]:
        return [m for _, m in self.points]

    @property
    def best(self) -> int:
        """Number of the best point: the first one with the highest score."""
        return max(range(len(self.points)), key=lambda i: (self.points[i][1], -i))


def boosted_prefix(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The boosted model after its first ``rounds`` rounds.

    Every round fits the residuals of the rounds before it, so without row sampling or a validation set this is the
    model that a separate fit of that many rounds with the same seed gives.
    """
    sc, old = SparkContext._active_spark_context, model._java_obj
    jvm, trees, weights = sc._jvm, old.trees(), old.treeWeights()
    some = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    their = sc._gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        some[i], their[i] = trees[i], weights[i]
    java = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        old.uid(), some, their, old.numFeatures(), old.numClasses())
    out = GBTClassificationModel(java)
    for name in ("featuresCol", "labelCol", "predictionCol", "rawPredictionCol", "probabilityCol"):
        out._set(**{name: model.getOrDefault(name)})
    out._transfer_params_to_java()
    return out


def _fit_grid(estimator, rows: DataFrame, points: Sequence[dict], rounds: str | None) -> tuple[list, int]:
    """A model for every point, with as few fits as give all of them exactly, and the number of fits.

    Points that differ in ``rounds`` alone are prefixes of the longest fit. Trees that end above level ``maxDepth``
    grew without meeting it: a fit whose trees all do is the fit of every smaller ``maxDepth`` above their
    depth as well, so the depths are fitted from the largest down and only where trees reach the next one.
    """
    longest: dict[tuple, int] = {}
    rest = lambda p: tuple(sorted((k, v) for k, v in p.items() if k != rounds))
    for p in points:
        if rounds:
            longest[rest(p)] = max(longest.get(rest(p), 0), p[rounds])
    fitted: dict[tuple, object] = {}
    grown: dict[tuple, int] = {}
    n = 0
    for p in sorted(points, key=lambda p: -p.get("maxDepth", 0)):
        full = {**p, rounds: longest[rest(p)]} if rounds else p
        key = tuple(sorted(full.items()))
        if key in fitted:
            continue
        same = [k for k in fitted if {**dict(k), "maxDepth": 0} == {**full, "maxDepth": 0}]
        reuse = next((k for k in same if grown[k] < full["maxDepth"]), None)
        if reuse:
            fitted[key], grown[key] = fitted[reuse], grown[reuse]
            continue
        fitted[key] = estimator.copy({getattr(estimator, k): v for k, v in full.items()}).fit(rows)
        grown[key] = max(t.depth for t in fitted[key].trees)
        n += 1
    out = []
    for p in points:
        full = {**p, rounds: longest[rest(p)]} if rounds else p
        model = fitted[tuple(sorted(full.items()))]
        out.append(model if full == p else boosted_prefix(model, p[rounds]))
    return out, n


def _fold_scores(models: Sequence, held_out: DataFrame, label: str) -> list[float]:
    """F1 of class 1 of every model on the held-out rows, from one pass over them."""
    out, y, aggs = held_out, F.col(label) == 1, []
    for i, m in enumerate(models):
        own = m.copy()
        own.setPredictionCol(f"__p{i}")
        own.setRawPredictionCol(f"__r{i}")
        own.setProbabilityCol(f"__q{i}")
        out = own.transform(out).drop(f"__r{i}", f"__q{i}")
        p = F.col(f"__p{i}") == 1
        aggs += [F.count_if(y & p), F.count_if(y) + F.count_if(p)]
    got = out.agg(*[a.alias(f"a{k}") for k, a in enumerate(aggs)]).first()
    return [2.0 * got[2 * i] / got[2 * i + 1] if got[2 * i + 1] else 0.0 for i in range(len(models))]


def _tune_shared(forest_, df: DataFrame, points: Sequence[dict], label: str, fold_col: str, folds: int,
                 weights: tuple[float, float]) -> Tuned:
    """``tune`` for a forest over many rows: one forest a fold holds those of all points (``operators.trees``)."""
    spark, features = df.sparkSession, forest_.getFeaturesCol()
    points = [{k: p.get(k, forest_.getOrDefault(k)) for k in ("numTrees", "maxDepth")} for p in points]
    rows, cuts = grown.binned(df, features, label, fold_col, weights)
    shared, seed, least = spark.sparkContext.broadcast(rows), forest_.getSeed() % (1 << 63), forest_.getMinInstancesPerNode()
    scores = grown.fold_scores(shared, spark, points, folds, seed, least)
    out = Tuned([(p, sum(s) / folds) for p, s in zip(points, scores)], None, folds + 1)
    out.bestModel = grown.whole_forest(shared, spark, cuts, features, points[out.best], seed, least)
    shared.destroy()
    return out


def _tune_chains(boosted_, df: DataFrame, points: Sequence[dict], label: str, fold_col: str, folds: int) -> Tuned:
    """``tune`` for boosted trees: one task a fold and depth runs all rounds (``operators.boosting``)."""
    spark, features = df.sparkSession, boosted_.getFeaturesCol()
    points = [{k: p.get(k, boosted_.getOrDefault(k)) for k in ("maxIter", "maxDepth")} for p in points]
    rows, cuts = grown.binned(df, features, label, fold_col, (1.0, 1.0))
    shared = spark.sparkContext.broadcast(rows)
    kept = boosting.fitted(shared, spark, points, folds, boosted_.getMinInstancesPerNode(), boosted_.getStepSize())
    shared.destroy()
    scores = boosting.fold_scores(kept, points, folds)
    out = Tuned([(p, sum(s) / folds) for p, s in zip(points, scores)], None, (folds + 1) * len({p["maxDepth"] for p in points}))
    out.bestModel = boosting.GrownBoosted(kept, points[out.best], cuts, features)
    return out


def tune(estimator, df: DataFrame, grid: dict, label: str = "label", fold_col: str = "fold",
         folds: int = 5, parallelism: int = 4, rounds: str | None = None) -> Tuned:
    """Grid search over tree ensembles with the given folds, scored by the F1 of class 1 (``PositiveF1``).

    Every point of the grid is scored on every fold. ``rounds`` names the parameter of a boosted estimator that counts its
    rounds (``maxIter``): its values share fits (``_fit_grid``). Points that can share fits follow one another in a fold;
    the others and the folds run side by side, ``parallelism`` at a time. The best point alone is then fitted on all rows;
    with ``rounds``, which follow one another, all points are fitted on all rows beside the folds instead. Forests over
    more than ``trees.LEAST_ROWS`` rows are grown tree by tree instead of level by level (``operators.trees``), and boosted
    trees over more than ``boosting.LEAST_ROWS`` rows by one task a fold and depth (``operators.boosting``).
    """
    if rounds and (estimator.getSubsamplingRate() != 1.0 or estimator.isSet("validationIndicatorCol")):
        raise ValueError("rounds share fits only without row sampling and validation rows")
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    if rounds == "maxIter" and boosting.suits(estimator, df, list(grid), label, fold_col):
        return _tune_chains(estimator, df, points, label, fold_col, folds)
    if not rounds and (weights := grown.suits(estimator, df, list(grid), label, fold_col)):
        return _tune_shared(estimator, df, points, label, fold_col, folds, weights)

    groups: dict[tuple, list[int]] = {}
    for i, p in enumerate(points):
        groups.setdefault(tuple(v for k, v in p.items() if k not in ("maxDepth", rounds)), []).append(i)
    # the longest fits first: short ones fill the cores at the end
    work = [(fold, g) for _, g in sorted(groups.items(), reverse=True) for fold in ([None] if rounds else []) + [*range(folds)]]

    def fitted(unit: tuple[int | None, list[int]]) -> tuple[list, int]:
        fold, group = unit
        rows = df if fold is None else df.where(F.col(fold_col) != fold)
        models, n = _fit_grid(estimator, rows, [points[i] for i in group], rounds)
        return (models if fold is None else _fold_scores(models, df.where(F.col(fold_col) == fold), label)), n

    with ThreadPool(parallelism) as pool:
        done = pool.map(inheritable_thread_target(df.sparkSession)(fitted), work, chunksize=1)
    of = {(i, fold): x for (fold, group), (got, _) in zip(work, done) for i, x in zip(group, got)}
    means = [sum(of[i, fold] for fold in range(folds)) / folds for i in range(len(points))]
    out = Tuned(list(zip(points, means)), None, sum(n for _, n in done))
    if rounds:
        out.bestModel = of[out.best, None]
    else:
        out.bestModel = estimator.copy({getattr(estimator, k): v for k, v in points[out.best].items()}).fit(df)
        out.fits += 1
    return out


def best_of(models: dict[str, Tuned]) -> tuple[str, object, float]:
    """The tuned model with the highest mean cross-validated score."""
    name = max(models, key=lambda n: max(models[n].avgMetrics))
    return name, models[name].bestModel, max(models[name].avgMetrics)


def feature_importance(model, features: Sequence[str], top: int | None = 10) -> DataFrame:
    """Importances named by feature, largest first (top ``top``)."""
    spark = SparkSession.getActiveSession()
    imp = model.featureImportances.toArray()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")
    df = df.orderBy(F.desc("importance"), F.asc("feature"))
    return df.limit(top) if top else df


def score(model, df: DataFrame, label: str = "label", keys: Sequence[str] = ()) -> DataFrame:
    """Scored table: keys, label, probability of class 1, predicted class."""
    out = model.transform(df)
    return out.select(*keys, F.col(label).cast("double").alias("label"),
                      vector_to_array("probability")[1].alias("score"),
                      F.col("prediction").cast("double").alias("prediction"))


# ---------------------------------------------------------------- M11-M14 on a scored table
def _by_score(scored: DataFrame) -> DataFrame:
    """One row per distinct score: positives and negatives, and those of them predicted as 1."""
    y, p = F.col("label") == 1, F.col("prediction") == 1
    aggs = {"pos": F.count_if(y), "neg": F.count_if(~y)}
    if "prediction" in scored.columns:
        aggs |= {"tp": F.count_if(y & p), "fp": F.count_if(~y & p)}
    return scored.groupBy("score").agg(*[a.alias(n) for n, a in aggs.items()])


def _auc(cum: DataFrame) -> F.Column:
    # negatives strictly below this score = running sum of negatives minus this score's own
    term = F.col("pos") * (F.col("cum_neg") - F.col("neg")) + F.lit(0.5) * F.col("pos") * F.col("neg")
    return safe_div(F.sum(term).cast("double"), (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc")


def classification_metrics(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 of class 1 and ROC AUC (ties averaged) in one row, all of them from the
    running sums over the distinct scores (one pass over the scored table)."""
    cum = running_sums(_by_score(scored), ["score"], ["neg"])
    tot = cum.agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("pos").alias("pos"), _auc(cum))
    tp, fp, pos = F.col("tp"), F.col("fp"), F.col("pos")
    zero = F.lit(0.0)
    return tot.select(F.coalesce(safe_div(tp, tp + fp), zero).cast("double").alias("precision"),
                      F.coalesce(safe_div(tp, pos), zero).cast("double").alias("recall"),
                      F.coalesce(safe_div(2 * tp, pos + tp + fp), zero).cast("double").alias("f1"), "auc")


def roc_auc(scored: DataFrame) -> DataFrame:
    """AUC = P(score of a positive > score of a negative) + 0.5 P(equal), from per-score counts."""
    cum = running_sums(_by_score(scored.select("label", "score")), ["score"], ["neg"])
    return cum.agg(_auc(cum))


def roc_points(scored: DataFrame, drop_intermediate: bool = True) -> DataFrame:
    """ROC points at the distinct scores (descending thresholds) plus the origin (threshold inf).

    ``drop_intermediate`` keeps, as scikit-learn does, only the first and last point and the
    points where the curve bends: the next score adds other numbers of false or true positives than
    this one. The next score's numbers are handed on along the ordered partitions, without a join.
    """
    by = _by_score(scored.select("label", "score")).withColumn("desc_key", -F.col("score"))
    cum = running_sums(by, ["desc_key"], ["pos", "neg"], count_col="i", next_of=["pos", "neg"])
    # totals from the checkpointed per-score rows, not from another pass over the scored table
    tot = cum.agg(F.struct(F.sum("pos").alias("P"), F.sum("neg").alias("N"),
                           F.count(F.lit(1)).alias("M"))).scalar()
    pts = cum.select("i", F.col("score").alias("threshold"), F.col("cum_neg").alias("fps"), F.col("cum_pos").alias("tps"),
                     "pos", "neg", "next_pos", "next_neg")
    if drop_intermediate:
        bend = (F.col("next_neg") != F.col("neg")) | (F.col("next_pos") != F.col("pos"))
        pts = pts.where((tot["M"] <= 2) | (F.col("i") == 0) | F.col("next_pos").isNull() | bend)
    out = pts.select("threshold", safe_div(F.col("fps").cast("double"), tot["N"].cast("double")).alias("fpr"),
                     safe_div(F.col("tps").cast("double"), tot["P"].cast("double")).alias("tpr"))
    origin = scored.sparkSession.range(1).select(F.lit(float("inf")).alias("threshold"),
                                                 F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(out)


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """2 x 2 counts (label, prediction), zeros included, from one conditional aggregate."""
    y, p = F.col("label"), F.col("prediction")
    c = scored.agg(*[F.sum(F.when((y == a) & (p == b), 1).otherwise(0)).cast("long").alias(f"c{a}{b}")
                     for a in (0, 1) for b in (0, 1)])
    return c.select(F.explode(F.array(*[
        F.struct(F.lit(float(a)).alias("label"), F.lit(float(b)).alias("prediction"), F.col(f"c{a}{b}").alias("n"))
        for a in (0, 1) for b in (0, 1)])).alias("x")).select("x.*")


def threshold_f1(scored: DataFrame, thresholds: Sequence[float] | None = None) -> DataFrame:
    """F1 of class 1 when predicting ``score > t`` for each threshold t.

    Each row is reduced to the number of thresholds below its score (exact comparisons against
    the threshold values), counted per that number (at most len(thresholds)+1 rows), and the
    true / false positives of threshold i are the counts of the rows above it.
    """
    ts = list(thresholds) if thresholds is not None else threshold_grid()
    spark = scored.sparkSession
    arr = F.array(*[F.lit(float(t)) for t in ts])
    k = F.size(F.filter(arr, lambda t: F.col("score") > t))
    # rows are counted per distinct score first, so the thresholds are compared once a score
    per = _by_score(scored.select("label", "score")).groupBy(k.alias("k")).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # k takes at most len(ts) + 1 values: densify over that fixed range, then suffix sums over
    # those few rows give the positives / negatives predicted at each threshold
    ks = spark.range(len(ts) + 1).withColumnRenamed("id", "k")
    dense = ks.join(F.broadcast(per), "k", "left").na.fill(0, ["pos", "neg"])
    above = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    suffix = dense.select((F.col("k") - 1).alias("i"), F.sum("pos").over(above).alias("tp"),
                          F.sum("neg").over(above).alias("fp"),
                          F.sum("pos").over(Window.partitionBy()).alias("n_pos"))
    grid = spark.createDataFrame([(i, float(t)) for i, t in enumerate(ts)], "i long, threshold double")
    g = grid.join(F.broadcast(suffix), "i", "inner")
    tp, fp, n_pos = F.col("tp"), F.col("fp"), F.col("n_pos")
    f1 = F.coalesce(safe_div((2 * tp).cast("double"), (2 * tp + fp + (n_pos - tp)).cast("double")), F.lit(0.0))
    return g.select("threshold", tp.alias("tp"), fp.alias("fp"), f1.alias("f1"))


def best_threshold(f1_table: DataFrame) -> DataFrame:
    """The first threshold reaching the best F1 (a top-1 report)."""
    return f1_table.orderBy(F.desc("f1"), F.asc("threshold")).limit(1)

"""Feature pool: predefined feature batches, response, click features and the merged feature table.

All fit statistics of one source table are computed in one aggregate job (numeric) plus one
counting job (categorical / ordinal top values); the transformed features of one table are fused
into one ``select`` and different tables are joined on the key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from coursepulse.operators import checks, clicks, regularity
from coursepulse.operators.encode import CategoricalData, NumericData, OrdinalData, response_column
from coursepulse.operators.features import DuplicateIndex, Feature, FeatureDict
from coursepulse.schema import (CATEGORICAL_BATCH, K3, KEYS, NUMERIC_BATCH, ORDINAL_BATCH,
                                ORDINAL_ORDERS, REGULARITY_PREFIX, RESPONSE, TIME_METRICS)


def _top_values(df: DataFrame, cols: Sequence[str], n: int, allowed: dict[str, list[str]]) -> dict[str, list]:
    """Top ``n`` non-null values per column (count desc, value asc) in one job."""
    if not cols:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v")) for c in cols]))
    long = df.select(pairs.alias("p")).select("p.k", "p.v").where(F.col("v").isNotNull())
    for c, values in allowed.items():
        long = long.where((F.col("k") != c) | F.col("v").isin(values))
    counts = long.groupBy("k", "v").count()
    rn = F.row_number().over(Window.partitionBy("k").orderBy(F.desc("count"), F.asc("v")))
    rows = counts.withColumn("rn", rn).where(F.col("rn") <= n).orderBy("k", "rn").collect()
    out: dict[str, list] = {c: [] for c in cols}
    for r in rows:
        out[r["k"]].append(r["v"])
    return out


def extract_column(raw: dict[str, DataFrame], table: str, column: str, check_keys: bool = True) -> DataFrame:
    """One column of a table with the table's key columns; the key must be unique."""
    df = raw[table]
    keys = KEYS[table]
    if check_keys:
        checks.assert_unique_keys(df, keys)
    return df.select(*keys, column)


def _fits(df: DataFrame, keys: Sequence[str], mine: Sequence[tuple[str, object]], check_keys: bool) -> list[Callable[[], None]]:
    """The jobs that fit the preprocessors of one table's columns: one pass for key uniqueness and the
    statistics of every numeric column, one for the top values of the others."""
    num = [(c, p) for c, p in mine if isinstance(p, NumericData)]
    cat = [(c, p) for c, p in mine if isinstance(p, CategoricalData)]
    ordi = [(c, p) for c, p in mine if isinstance(p, OrdinalData)]
    check = check_keys and not checks.known_unique(df, keys)

    def statistics() -> None:
        aggs = [F.count(F.lit(1)).alias("__rows"), F.count_distinct(*keys).alias("__keys")] if check else []
        for c, _ in num:
            aggs += [F.avg(c).alias(f"{c}__mu"), F.stddev_samp(c).alias(f"{c}__sd")]
        row = df.agg(*aggs).first()
        if check:
            if row["__rows"] != row["__keys"]:
                raise DuplicateIndex(list(keys))
            checks.mark_unique(df, keys)
        for c, p in num:
            p.params[c] = {"mu": row[f"{c}__mu"], "std": row[f"{c}__sd"]}

    def top_values() -> None:
        n = max([p.most_common for _, p in cat] + [1])
        tops = _top_values(df, [c for c, _ in cat + ordi], n, {c: p.order for c, p in ordi})
        for c, p in cat:
            p.params[c] = tops[c][: p.most_common]
        for c, p in ordi:
            p.params[c] = p.order.index(tops[c][0]) if tops[c] else 0

    return ([statistics] if check or num else []) + ([top_values] if cat or ordi else [])


def _side_by_side(spark: SparkSession, jobs: Sequence[Callable[[], None]]) -> None:
    """Run small jobs at once; the first error is raised."""
    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            done.result()


def get_feature_batch(raw: dict[str, DataFrame], feature_list: Sequence[tuple[str, str]],
                      preprocessors: Sequence, check_keys: bool = True, refit: bool = True) -> FeatureDict:
    """Extract, fit and encode each (table, column); the last preprocessor repeats for the rest.

    With ``refit=False`` preprocessors that were fitted before (on the training split) keep their
    parameters and only encode; a column that one has not seen is an error.
    """
    assigned = [(t, c, preprocessors[min(len(preprocessors) - 1, i)]) for i, (t, c) in enumerate(feature_list)]
    fits: list[Callable[[], None]] = []
    for table in dict.fromkeys(t for t, _, _ in assigned):
        mine = [(c, p) for t, c, p in assigned if t == table]
        if not refit:
            unseen = [c for c, p in mine if c not in p.params]
            if unseen:
                raise ValueError(f"preprocessors are not fitted for {unseen}")
        fits += _fits(raw[table], KEYS[table], mine if refit else [], check_keys)
    if fits:
        _side_by_side(raw[assigned[0][0]].sparkSession, fits)
    out = FeatureDict()
    for table, col, prep in assigned:
        out[col] = Feature(col, keys=KEYS[table], source=raw[table], columns=prep.columns(col))
    return out


def get_numeric_features_batch(raw: dict[str, DataFrame], **kw) -> FeatureDict:
    return get_feature_batch(raw, NUMERIC_BATCH, [NumericData()], **kw)


def get_categorical_features_batch(raw: dict[str, DataFrame], **kw) -> FeatureDict:
    return get_feature_batch(raw, CATEGORICAL_BATCH, [CategoricalData()], **kw)


def get_ordinal_features_batch(raw: dict[str, DataFrame], **kw) -> FeatureDict:
    preps = [OrdinalData(list(ORDINAL_ORDERS[t, c])) for t, c in ORDINAL_BATCH]
    return get_feature_batch(raw, ORDINAL_BATCH, preps, **kw)


def get_response(raw: dict[str, DataFrame], targets: Sequence[Sequence[str]],
                 response_name: str = RESPONSE, drop_other: bool = True) -> FeatureDict:
    """Response = index of the target group of ``final_result``; other labels dropped or NULL."""
    if not targets:
        raise ValueError("targets must name at least one group of labels")
    col = response_column(targets).alias(response_name)
    where = F.col("final_result").isin([x for g in targets for x in g]) if drop_other else None
    out = FeatureDict()
    out[response_name] = Feature(response_name, keys=K3, source=raw["student_info"], columns=[col], where=where)
    return out


def get_time_regularity(raw: dict[str, DataFrame], start: int, end: int,
                        metrics: Sequence[str] = TIME_METRICS) -> FeatureDict:
    daily = clicks.daily_clicks(raw["student_vle"])
    reg = regularity.time_regularity(daily, start, end, metrics)
    out = FeatureDict()
    for m in metrics:
        name = REGULARITY_PREFIX + m
        out[name] = Feature(name, keys=K3, source=reg, columns=[F.col(name)])
    return out


def get_effort(raw: dict[str, DataFrame], start: int, end: int) -> FeatureDict:
    eff = clicks.effort(clicks.daily_clicks(raw["student_vle"]), start, end)
    out = FeatureDict()
    out["effort"] = Feature("effort", keys=K3, source=eff, columns=[F.col("effort")])
    return out


def merge_features(fd: FeatureDict, names: Sequence[str] | None = None) -> DataFrame:
    """Left-fold merge with same-source fusion: one ``select`` per source table, one join per source.

    Equal to the plain left fold because every feature is unique on the key (checked at
    extraction) and the first feature fixes the row set.
    """
    chosen = list(names) if names else list(fd.keys())
    feats = [fd[n] for n in chosen]
    first = feats[0]
    groups: list[list[Feature]] = []
    for f in feats:
        for g in groups:
            if g[0]._source is f._source and f._where is None and f.keys == g[0].keys:
                g.append(f)
                break
        else:
            groups.append([f])
    merged = None
    for g in groups:
        fused = g[0].copy()
        for f in g[1:]:
            fused = fused.merge(f)
        merged = fused if merged is None else merged.merge(fused)
    order = [c for f in feats for c in f.value_columns]
    return merged.data.select(*first.keys, *order)


def new_preprocessors() -> list:
    """Unfitted preprocessors of the merged feature table, one for each column of its three batches."""
    num, cat = NumericData(), CategoricalData()
    ordinal = [OrdinalData(list(ORDINAL_ORDERS[t, c])) for t, c in ORDINAL_BATCH]
    return [num] * len(NUMERIC_BATCH) + [cat] * len(CATEGORICAL_BATCH) + ordinal


def build_features(raw: dict[str, DataFrame], targets=(("Pass", "Distinction"), ("Fail",)),
                   start: int = 0, end: int = 32, check_keys: bool = True,
                   preprocessors: Sequence | None = None, refit: bool = True) -> DataFrame:
    """Response, numeric / categorical / ordinal batches, time regularity and effort, merged on K3.

    ``preprocessors`` (from :func:`new_preprocessors`) are fitted in place; given again with
    ``refit=False`` they encode another split with the parameters of the first, so both splits have
    the same columns on the same scale.
    """
    fd = get_response(raw, targets)
    # the three predefined batches fitted together: one statistics pass and one top-values pass
    # per source table (each batch keeps its own preprocessors, as when fitted one by one)
    batch = get_feature_batch(raw, NUMERIC_BATCH + CATEGORICAL_BATCH + ORDINAL_BATCH,
                              list(preprocessors) if preprocessors else new_preprocessors(),
                              check_keys=check_keys, refit=refit)
    fd.update(batch)
    # regularity and effort come from one aggregate of the daily clicks per student, so they
    # fuse into one select and one join with the student rows
    daily = clicks.daily_clicks(raw["student_vle"])
    reg = regularity.time_regularity(daily, start, end, TIME_METRICS, with_effort=True)
    click_feats = FeatureDict()
    for m in TIME_METRICS:
        name = REGULARITY_PREFIX + m
        click_feats[name] = Feature(name, keys=K3, source=reg, columns=[F.col(name)])
    click_feats["effort"] = Feature("effort", keys=K3, source=reg, columns=[F.col("effort")])
    fd.update(click_feats)
    return merge_features(fd)

"""Composite flows of the legacy pipeline: demographics, engagement per segment, wide segments.

Engagement plan: clicks per day and per activity are conditional sums of one grouping on (student,
segment); a group is one row of fixed width, however many clicks a student has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursepulse.functions.columns import band_average, ln_or_null
from coursepulse.functions.dims import bounded_broadcast, few_rows, narrowed
from coursepulse.operators import checks
from coursepulse.operators.clicks import SITE_KEY
from coursepulse.operators.encode import map_outcome
from coursepulse.schema import FAIL_VS_PASS, K3, RESPONSE

SEG = "temperal_seg"
DAY = "temperal_seq"
KS = [*K3, SEG]
SUMMARIES = ["peak", "variation", "kurtosis", "longest_zeros", "longest_ones", "entropy"]


# ---------------------------------------------------------------- G13: demographic table
def demographics(student_info: DataFrame, outcome_map: dict = FAIL_VS_PASS,
                 one_hot: Sequence[str] = ("gender", "region", "highest_education", "disability"),
                 bands: Sequence[str] = ("imd_band", "age_band")) -> tuple[DataFrame, dict[str, list[str]]]:
    """Response from a fixed outcome map (unknown label raises), full one-hot named by value,
    band averages, labelled rows only. Returns the frame and the one-hot column names per feature."""
    values: dict[str, list[str]] = {}
    long = student_info.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("k"), F.col(c).alias("v")) for c in one_hot])).alias("p")).select("p.*")
    for r in few_rows(long.where(F.col("v").isNotNull()).distinct().orderBy("k", "v"), f"values of {', '.join(one_hot)}"):
        values.setdefault(r["k"], []).append(r["v"])
    taken: set[str] = set(student_info.columns)
    groups: dict[str, list[str]] = {}
    cols = []
    for c in one_hot:
        names = []
        for v in values.get(c, []):
            name = v if v not in taken else f"{c}_{v}"
            taken.add(name)
            names.append(name)
            cols.append(F.when(F.col(c) == v, F.lit(1.0)).otherwise(F.lit(0.0)).alias(name))
        groups[c] = names
    keep = [c for c in student_info.columns if c not in set(one_hot) | set(bands) | {"final_result"}]
    df = student_info.select(
        *keep,
        map_outcome("final_result", outcome_map).cast("double").alias(RESPONSE),
        *cols,
        *[band_average(F.col(b)).alias(b) for b in bands],
    ).where(F.col(RESPONSE).isNotNull())
    return df, groups


# ---------------------------------------------------------------- H8: engagement per segment
def segment_base(student_vle: DataFrame, vle: DataFrame, segment_days: int = 30) -> DataFrame:
    """Clicks with their site, aggregated to (K3, segment, day-in-segment, activity), partitioned on (K3, segment)."""
    sites = bounded_broadcast(narrowed(vle, *SITE_KEY, "activity_type"))
    seg = F.ceil(F.col("date") / F.lit(float(segment_days))).cast("long")
    return (
        student_vle.join(sites, SITE_KEY, "left")
        .select(*K3, seg.alias(SEG), (F.col("date") - (seg - 1) * segment_days).alias(DAY),
                "activity_type", "sum_click")
        .groupBy(*KS, DAY, "activity_type").agg(F.sum("sum_click").alias("c"))
        .repartition(*KS)
    )


def activity_values(vle: DataFrame) -> list[str]:
    """Activity types of the site table (a small dimension table), sorted."""
    known = vle.select("activity_type").where(F.col("activity_type").isNotNull()).distinct()
    return sorted(r[0] for r in few_rows(known, "activity types"))


def engagement(student_vle: DataFrame, vle: DataFrame, segment_days: int = 30, max_segment: int = 8,
               activities: Sequence[str] | None = None) -> DataFrame:
    """Per (K3, segment): clicks, activity shares, day shares ``day_1..day_n`` and their summaries.

    Activity shares ignore clicks of unknown sites (NULL if a segment has only those); day shares
    and summaries use all clicks. Segments above ``max_segment`` are dropped before the shuffle.

    Clicks per day and per activity are conditional sums of one grouping on (K3, segment), so the
    click log is reduced by partial aggregation and shuffled once; the summaries are expressions
    over the day columns of a row.
    """
    n = segment_days
    acts = list(activities) if activities is not None else activity_values(vle)
    days = range(1, n + 1)
    sites = bounded_broadcast(narrowed(vle, *SITE_KEY, "activity_type"))
    seg = F.ceil(F.col("date") / F.lit(float(n))).cast("long")
    c = F.col("sum_click")
    wide = (
        student_vle.where(seg < max_segment + 1)
        .join(sites, SITE_KEY, "left")
        .select(*K3, seg.alias(SEG), (F.col("date") - (seg - 1) * n).alias(DAY), "activity_type", "sum_click")
        .groupBy(*KS).agg(
            F.sum(c).alias("sum_click"),
            F.sum(F.when(F.col("activity_type").isNotNull(), c)).alias("__known"),
            *[F.sum(F.when(F.col("activity_type") == a, c)).alias(f"__a{i}") for i, a in enumerate(acts)],
            *[F.sum(F.when(F.col(DAY) == d, c)).alias(f"__d{d}") for d in days])
    )
    share = [F.try_divide(F.col(f"__d{d}").cast("double"), F.col("sum_click").cast("double")) for d in days]
    wide = wide.withColumn("__p", F.array(*share))  # NULL on days without a click
    mu = 1.0 / n

    def total(of) -> F.Column:
        return F.aggregate("__p", F.lit(0.0), lambda s, x: s + of(F.coalesce(x, F.lit(0.0))))

    def longest(clicked: bool) -> F.Column:
        start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))

        def step(s, x):
            run = F.when(x.isNotNull() if clicked else x.isNull(), s["run"] + 1).otherwise(0)
            return F.struct(run.alias("run"), F.greatest(s["best"], run).alias("best"))

        return F.aggregate("__p", start, step)["best"].cast("long")

    # the fourth-power sum and the squares as columns: the kurtosis uses the squares three times
    wide = wide.withColumns({"__s2": total(lambda x: F.pow(x - mu, F.lit(2))),
                             "__s4": total(lambda x: F.pow(x - mu, F.lit(4)))})
    s2, s4 = F.col("__s2"), F.col("__s4")
    adj = 3.0 * (n - 1) ** 2 / ((n - 2) * (n - 3))
    kurt = F.when(s2 <= 1e-14, F.lit(0.0)).otherwise(
        F.lit(float(n * (n + 1) * (n - 1))) * s4 / (F.lit(float((n - 2) * (n - 3))) * s2 * s2) - adj)
    var = (total(lambda x: x * x) - mu) / float(n - 1)
    known = F.nullif(F.col("__known"), F.lit(0)).cast("double")
    return wide.select(
        *KS, "sum_click",
        *[F.try_divide(F.when(F.col("__known").isNotNull(), F.coalesce(F.col(f"__a{i}"), F.lit(0))).cast("double"),
                       known).alias(a) for i, a in enumerate(acts)],
        *[F.coalesce(F.get("__p", F.lit(d - 1)), F.lit(0.0)).alias(f"day_{d}") for d in days],
        F.array_max("__p").alias("peak"),
        ln_or_null(var).alias("variation"),
        kurt.alias("kurtosis"),
        longest(False).alias("longest_zeros"),
        longest(True).alias("longest_ones"),
        (-total(lambda x: F.when(x > 0, x * F.log2(x)).otherwise(0.0))).alias("entropy"))


# ---------------------------------------------------------------- H9: info x engagement
def merge_and_process(info: DataFrame, engagement_df: DataFrame, check: bool = True) -> DataFrame:
    """Demographics LEFT engagement on K3; (K3, segment) must be unique; labelled rows only."""
    df = info.join(engagement_df, K3, "left")
    if check:
        checks.assert_unique_keys(df, KS)
    return df.where(F.col(RESPONSE).isNotNull())


def merge_indicator_counts(info: DataFrame, engagement_df: DataFrame) -> DataFrame:
    """Coverage of the info x engagement merge (rows per indicator value)."""
    return checks.indicator_counts(checks.merge_with_indicator(info, engagement_df, K3, "left"))


# ---------------------------------------------------------------- H6: cumulative wide segments
def temporal_segment(data: DataFrame, t: int, time_invariant: Sequence[str],
                     response: str = RESPONSE) -> DataFrame:
    """Wide table of segment ``t``: columns ``t{s}_{feature}`` for s = 1..t (segment 0 alone).

    Rows are the students present in any of those segments; time-invariant columns come from the
    segment-``t`` row (NULL for students without one); the response from their latest segment.
    One aggregate on K3 replaces the chain of outer merges.
    """
    if not 0 <= t <= 8:
        raise ValueError("segment must be in 0..8")
    ident = set(KS) | {response}
    varying = [c for c in data.columns if c not in ident and c not in set(time_invariant)]
    inv = [c for c in time_invariant if c in data.columns]
    segs = [0] if t == 0 else list(range(1, t + 1))
    src = data.where(F.col(SEG).isin(segs))
    aggs = [F.max_by(response, SEG).alias(response)]
    aggs += [F.first(F.when(F.col(SEG) == t, F.col(f"`{c}`")), ignorenulls=True).alias(c) for c in inv]
    aggs += [F.first(F.when(F.col(SEG) == s, F.col(f"`{c}`")), ignorenulls=True).alias(f"t{s}_{c}")
             for s in segs for c in varying]
    return src.groupBy(*K3).agg(*aggs)

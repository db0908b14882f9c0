"""Click-log operators: site joins, daily base, windows, sequences, schedules, segments.

Skew: the click table is the only large input. Every operator here first aggregates it map-side
(partial aggregation on (K3, date[, activity])) before any shuffle, so a single student or course
holding a large share of the clicks reaches the shuffle as at most one row per day (and activity)
per map task. Dimension tables (sites, schedules) are broadcast only with a proven row bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursepulse.functions.columns import day_in_segment, not_true, segment_of
from coursepulse.functions.dims import bounded_broadcast, mark_bounded, row_bound
from coursepulse.schema import K2, K3

SITE_KEY = ["code_module", "code_presentation", "id_site"]
SITE_COLUMNS = {"activity_type", "week_from", "week_to"}


def _sem(x: Column) -> Column:
    """Sample standard deviation over the root of the number of values; NULL for one value."""
    return F.stddev_samp(x) / F.sqrt(F.count(x))


def _skew(x: Column) -> Column:
    """Bias-corrected skewness: NULL below three values, 0 where all values are equal."""
    n = F.count(x).cast("double")
    return F.when(n >= 3, F.coalesce(F.skewness(x), F.lit(0.0)) * F.sqrt(n * (n - 1)) / (n - 2))


# pandas GroupBy.agg names -> Spark aggregate builders (sample std / var as in pandas). All but median and
# nunique are combined before the shuffle from a few numbers a group; nunique from a group's distinct values.
AGGREGATES = {
    "sum": F.sum,
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "median": F.median,
    "prod": lambda x: F.coalesce(F.product(x), F.lit(1.0)),
    "sem": _sem,
    "skew": _skew,
    "nunique": F.count_distinct,
}
# aggregates of the rows' order: the smallest or largest order key that carries the value along
ORDERED = {"first": F.min, "last": F.max}


def _sites(vle: DataFrame) -> DataFrame:
    cols = [c for c in vle.columns if c in SITE_COLUMNS or c in SITE_KEY]
    return bounded_broadcast(vle.select(*cols))


def clicks_with_sites(student_vle: DataFrame, vle: DataFrame, how: str = "left") -> DataFrame:
    """Clicks joined to their site on (code_module, code_presentation, id_site).

    ``how='left'`` keeps clicks of unknown sites with a NULL activity; ``'inner'`` drops them.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner' (use clicks_sites_outer for the full outer join)")
    return student_vle.join(_sites(vle), SITE_KEY, how)


def aggregate_clickstream(student_vle: DataFrame, vle: DataFrame | None = None,
                          by: Sequence[str] = ("date",), agg: str = "sum",
                          order: Sequence[str] = ("date", "id_site")) -> DataFrame:
    """Clicks aggregated per (K3, *by) with a pandas aggregate name.

    The site join is only made when ``by`` names a site column. Rows whose ``by`` value is NULL
    are dropped, as pandas ``groupby`` does, and NULL clicks are left out of every aggregate.
    Rows have no position in Spark, so ``first`` and ``last`` follow the columns ``order``: a NULL there
    comes before all values, and of rows that agree in all of them ``first`` takes the smallest and ``last`` the
    largest clicks. ``prod`` is a double, 1 where all clicks are NULL.
    """
    if agg not in AGGREGATES and agg not in ORDERED:
        raise ValueError(f"agg must be one of {sorted([*AGGREGATES, *ORDERED])}")
    by = list(by)
    src = student_vle
    if any(c in SITE_COLUMNS for c in by):
        if vle is None:
            raise ValueError("a site column is grouped on but no site table was given")
        src = clicks_with_sites(student_vle, vle, "left")
    if by:
        src = src.where(F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in by)))
    value = F.col("sum_click")
    if agg in ORDERED:
        keyed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], value.alias("value"))
        out = ORDERED[agg](F.when(value.isNotNull(), keyed))["value"]
    else:
        out = AGGREGATES[agg](value)
    return src.groupBy(*K3, *by).agg(out.alias("sum_click"))


def daily_clicks(student_vle: DataFrame) -> DataFrame:
    """Base table of the sequence features: one row per (K3, date) with the day's clicks."""
    return student_vle.groupBy(*K3, "date").agg(F.sum("sum_click").alias("sum_click"))


def in_window(start: int, end: int, date: Column | None = None) -> Column:
    """Inclusive day window [start, end]."""
    d = F.col("date") if date is None else date
    return d.between(F.lit(start), F.lit(end))


def clickstream_sequences(daily: DataFrame, start: int, end: int) -> DataFrame:
    """Per student with any click: dates and clicks inside [start, end], sorted by date.

    Students whose clicks all fall outside the window keep a row with empty arrays. The group
    state is bounded by the window length (at most one entry per day).
    """
    pairs = F.array_sort(F.collect_list(F.when(in_window(start, end), F.struct("date", "sum_click"))))
    return (
        daily.groupBy(*K3)
        .agg(pairs.alias("_seq"))
        .select(*K3,
                F.transform("_seq", lambda x: x["date"]).alias("timestamps"),
                F.transform("_seq", lambda x: x["sum_click"]).alias("intensity"))
    )


def effort(daily: DataFrame, start: int, end: int) -> DataFrame:
    """Total clicks inside [start, end] per student with any click; 0 when none falls inside."""
    inside = F.sum(F.when(in_window(start, end), F.col("sum_click")))
    return daily.groupBy(*K3).agg(F.coalesce(inside, F.lit(0)).cast("long").alias("effort"))


def test_schedule(assessments: DataFrame, max_n: int = 3) -> DataFrame:
    """First ``max_n`` assessment dates per course, ascending (NULL dates left out)."""
    bound = row_bound(assessments)
    if max_n == 1:
        out = assessments.groupBy(*K2).agg(F.array_compact(F.array(F.min("date"))).alias("dates"))
        return mark_bounded(out, bound) if bound is not None else out
    # equal dates are counted before the shuffle, and a course's list holds max_n dates at most
    days = assessments.groupBy(*K2, "date").agg(F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy(*K2).orderBy(F.asc_nulls_last("date"))) - F.col("n")
    kept = F.when(F.col("date").isNotNull() & (F.col("earlier") < max_n), F.struct(
        F.col("date"), F.array_repeat("date", F.least("n", F.lit(max_n) - F.col("earlier")).cast("int")).alias("same")))
    firsts = days.withColumn("earlier", earlier).groupBy(*K2).agg(F.array_sort(F.collect_list(kept)).alias("firsts"))
    out = firsts.select(*K2, F.flatten(F.col("firsts.same")).alias("dates"))
    return mark_bounded(out, bound) if bound is not None else out


def first_assessment(assessments: DataFrame) -> DataFrame:
    """Earliest assessment date per course."""
    out = assessments.groupBy(*K2).agg(F.min("date").alias("first_assessment_date"))
    bound = row_bound(assessments)
    return mark_bounded(out, bound) if bound is not None else out


def drop_precourse(student_vle: DataFrame) -> DataFrame:
    """Keep clicks on or after the course start (``date >= 0``)."""
    return student_vle.where(F.col("date") >= 0)


def clicks_before_first_assessment(student_vle: DataFrame, assessments: DataFrame) -> DataFrame:
    """Keep clicks strictly before the course's first assessment (courses without one drop out)."""
    first = bounded_broadcast(first_assessment(assessments))
    return (student_vle.join(first, K2, "left")
            .where(F.col("date") < F.col("first_assessment_date"))
            .drop("first_assessment_date"))


def clicks_up_to_test(student_vle: DataFrame, assessments: DataFrame, test_index: int = 0,
                      max_n: int = 3, start: int | None = 0) -> DataFrame:
    """Keep clicks up to the ``test_index``-th test date of the course (inclusive).

    ``start`` (default 0, the legacy behaviour) also drops earlier clicks; ``None`` keeps them.
    A course with fewer tests than ``test_index + 1`` has no end date and keeps no click.
    """
    sched = bounded_broadcast(test_schedule(assessments, max_n))
    cond = F.col("date") <= F.try_element_at(F.col("dates"), F.lit(test_index + 1))
    if start is not None:
        cond = cond & (F.col("date") >= F.lit(start))
    return student_vle.join(sched, K2, "left").where(cond).drop("dates")


def pre_test_clicks(clicks: DataFrame, assessments: DataFrame, registration: DataFrame,
                    unregistered_by: int = 7) -> DataFrame:
    """Clicks up to the first assessment, without students unregistered by day ``unregistered_by``.

    A missing unregistration date keeps the row (pandas ``not x <= 7`` semantics).
    Output carries ``date_assessment`` and ``date_unregistration``.
    """
    first = bounded_broadcast(first_assessment(assessments)).withColumnRenamed(
        "first_assessment_date", "date_assessment")
    reg = registration.select(*K3, "date_unregistration")
    return (
        clicks.join(first, K2, "left")
        .join(reg, K3, "left")
        .where((F.col("date") <= F.col("date_assessment"))
               & not_true(F.col("date_unregistration") <= F.lit(unregistered_by)))
    )


def with_segments(df: DataFrame, days: int = 30, seg_col: str = "temperal_seg",
                  day_col: str = "temperal_seq") -> DataFrame:
    """Add the segment number ``ceil(date / days)`` and the day inside the segment (1..days)."""
    return df.withColumn(seg_col, segment_of(F.col("date"), days)).withColumn(
        day_col, day_in_segment(F.col("date"), days))


def segment_effort(student_vle: DataFrame, days: int = 30) -> DataFrame:
    """Total clicks per (K3, segment)."""
    seg = segment_of(F.col("date"), days).alias("temperal_seg")
    return student_vle.groupBy(*K3, seg).agg(F.sum("sum_click").alias("sum_click"))


def activity_daily(student_vle: DataFrame, vle: DataFrame, how: str = "left") -> DataFrame:
    """Clicks per (K3, date, activity_type) after the site join (NULL activity kept for 'left')."""
    return (clicks_with_sites(student_vle, vle, how)
            .groupBy(*K3, "date", "activity_type")
            .agg(F.sum("sum_click").alias("sum_click")))


def left_join_many(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``left LEFT JOIN right`` for a right side with many (possibly very skewed) rows per key.

    Written as an inner join (whose skewed partitions adaptive execution can split on either
    side) plus the left rows without a match (anti join against the right side's distinct keys,
    which partial aggregation makes small). A plain left join cannot split the right side.
    """
    inner = left.join(right, list(on), "inner")
    unmatched = left.join(right.select(*on).distinct(), list(on), "left_anti")
    return inner.unionByName(unmatched, allowMissingColumns=True)

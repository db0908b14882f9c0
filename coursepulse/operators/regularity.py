"""Sequence features of the daily click log: time regularity, activity regularity, procrastination.

Definitions (the external package that defines them in the reference is not available):

* Time regularity (after Boroujeni et al., "How to Quantify Student's Regularity?", EC-TEL 2016),
  over the active days ``t = date - start`` inside [start, end], weekday ``t % 7``, week ``t div 7``:

  - ``pwd``: W(d) = active days on weekday d; ``(ln 7 - H(W)) * max W`` with H in nats.
  - ``ws1``: mean over pairs of active weeks of ``|A ∩ B| / max(|A|, |B|)`` (A = active weekdays).
  - ``ws2``: mean over pairs of ``1 - JSD(P, Q) / ln 2``, P = the week's click share per weekday.
  - ``ws3``: mean over pairs of ``1 - Σ ((p - q) / (p + q))² / |A ∪ B|`` on raw weekday clicks.
  - ``fwd``: ``((Σ cos 2πt/7)² + (Σ sin 2πt/7)²) / N``, N = end - start + 1.

  Fewer than two active weeks gives NULL ws*; no active day gives NULL for all five.
* Activity regularity over a fixed activity list: ``concentration = 1 - H2(activity shares) /
  log2(#activities)``; ``consistency = 1 - mean over active days of JSD(day shares, overall
  shares) / ln 2``.
* Procrastination: click-weighted mean of f(x), x = (date - start) / (end - start + 1), for
  f = x, 1 / (1 - x), log2(1 + x).

Plan: the click log is first reduced to one row per (student, day) by partial + final aggregation and from
there by grouping, without a window: ``pwd``, ``ws1``, ``fwd`` and ``concentration`` follow from sums, the others
from a student's list of weeks or of the activities of its days, a bound set by the window, not by
the data volume.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursepulse.functions.dims import bounded_broadcast
from coursepulse.operators.clicks import clicks_with_sites, in_window, test_schedule
from coursepulse.schema import ACTIVITIES, K2, K3, REGULARITY_PREFIX, TIME_METRICS

LN2 = math.log(2.0)
LN7 = math.log(7.0)


def _pair_mean(term: str, vectors: str) -> str:
    """SQL: mean of ``term(a, b)`` over pairs i < j of the ``n`` week vectors in ``vectors``."""
    inner = (f"aggregate(sequence(i + 1, n - 1), CAST(0 AS DOUBLE), "
             f"(acc2, j) -> acc2 + {term.format(a=f'{vectors}[i]', b=f'{vectors}[j]')})")
    return (f"CASE WHEN n < 2 THEN CAST(NULL AS DOUBLE) ELSE "
            f"aggregate(sequence(0, n - 2), CAST(0 AS DOUBLE), (acc, i) -> acc + {inner}) "
            f"/ (n * (n - 1) / 2.0D) END")


def _vsum(v: str) -> str:
    return f"aggregate({v}, CAST(0 AS DOUBLE), (s, x) -> s + x)"


# pairwise terms over two weeks {a}, {b}: shares of the weekdays (ws2), clicks of the weekdays (ws3; 0 = inactive)
WS2_TERM = ("(1.0D - aggregate(zip_with({a}, {b}, (p, q) -> "
            "CASE WHEN p > 0 THEN 0.5D * p * ln(2.0D * p / (p + q)) ELSE 0.0D END + "
            "CASE WHEN q > 0 THEN 0.5D * q * ln(2.0D * q / (p + q)) ELSE 0.0D END), "
            f"CAST(0 AS DOUBLE), (s, x) -> s + x) / {LN2!r}D)")
WS3_TERM = ("(1.0D - aggregate(zip_with({a}, {b}, (p, q) -> CASE WHEN p + q > 0 "
            "THEN pow((p - q) / (p + q), 2) ELSE 0.0D END), CAST(0 AS DOUBLE), (s, x) -> s + x) "
            "/ size(filter(zip_with({a}, {b}, (p, q) -> p + q), x -> x > 0)))")


def time_regularity(daily: DataFrame, start: int, end: int,
                    metrics: Sequence[str] = TIME_METRICS, prefix: str = REGULARITY_PREFIX,
                    with_effort: bool = False) -> DataFrame:
    """Time-regularity metrics per student with any click (NULL when no click is in the window).

    ``daily`` has one row per (student, day); days of 0 or NULL clicks are not active. ``with_effort`` also
    returns the clicks inside the window (``effort``) from the same aggregate.
    """
    unknown = set(metrics) - set(TIME_METRICS)
    if unknown:
        raise ValueError(f"unknown metrics: {sorted(unknown)}")
    # one exchange by student serves the weeks and the students
    by_week = daily.repartition(*K3).groupBy(*K3, _week(start, end)).agg(
        *_week_sums(start, end), F.sum(F.when(in_window(start, end), F.col("sum_click"))).alias("__inside"))
    effort = [F.expr("CAST(coalesce(sum(__inside), 0) AS LONG) AS effort")] if with_effort else []
    n_days = end - start + 1
    g = by_week.groupBy(*K3).agg(*_student_weeks(n_days, metrics), *effort)
    return _time_metrics(g, n_days, metrics, prefix).select(
        *K3, *[f"{prefix}{m}" for m in metrics], *(["effort"] if with_effort else []))


def _week(start: int, end: int) -> F.Column:
    """The week of an active day, NULL for all other rows."""
    return F.expr(f"CASE WHEN date BETWEEN {start} AND {end} AND sum_click > 0 THEN (date - {start}) div 7 END").alias("week")


def _week_sums(start: int, end: int) -> list[F.Column]:
    """Aggregates of a student's week: its active weekdays as 7 bits and the clicks of each weekday."""
    active, weekday = f"date BETWEEN {start} AND {end} AND sum_click > 0", f"pmod(date - {start}, 7)"
    by_day = ", ".join(f"CAST(coalesce(sum(CASE WHEN {active} AND {weekday} = {d} THEN sum_click END), 0) AS DOUBLE)" for d in range(7))
    return [F.expr(f"bit_or(CASE WHEN {active} THEN shiftleft(1, CAST({weekday} AS INT)) END) AS mask"),
            F.expr(f"array({by_day}) AS clicks")]


def _field(n_days: int) -> tuple[int, int]:
    """Bits that hold a number of weeks of the window, and how many such fields a long has."""
    bits = ((n_days + 6) // 7).bit_length()
    return bits, 63 // bits


def _student_weeks(n_days: int, metrics: Sequence[str]) -> list[F.Column]:
    """Aggregates of a student over its weeks, those that the metrics need: how many weeks there are (``weeks``), how many
    weeks of k active days hold weekday d, for 7 x 7 pairs in fields of a few longs (``k{k}_{part}``), and the clicks."""
    bits, per = _field(n_days)
    out = ["count(week) AS weeks"]
    for part in range(-(-7 // per)):
        spread = " + ".join(f"shiftleft(CAST(getbit(mask, {d}) AS LONG), {bits * (d - part * per)})"
                            for d in range(part * per, min(7, (part + 1) * per)))
        out += [f"coalesce(sum(CASE WHEN bit_count(mask) = {k} THEN {spread} END), 0L) AS k{k}_{part}" for k in range(1, 8)]
    if {"ws2", "ws3"} & set(metrics):
        out.append("array_sort(collect_list(CASE WHEN week IS NOT NULL THEN struct(week, clicks) END)) AS vectors")
    return [F.expr(x) for x in out]


def _weeks_of(k: int, d: int, n_days: int) -> str:
    """SQL: how many weeks of ``k`` active days hold weekday ``d``."""
    bits, per = _field(n_days)
    return f"(shiftright(k{k}_{d // per}, {bits * (d % per)}) & {(1 << bits) - 1})"


def _week_overlap(n_days: int) -> str:
    """SQL: sum over the pairs of a student's weeks of ``|A n B| / max(|A|, |B|)``, without visiting a pair.

    Weekday d adds 1 / k to every pair of weeks that both hold it, k being the larger number of active days: the
    pairs among the weeks of k days, and those of one such week and one of fewer days.
    """
    by_size = []
    for k in range(1, 8):
        pairs = []
        for d in range(7):
            fewer = "".join(f" + 2 * {_weeks_of(j, d, n_days)}" for j in range(1, k))
            n = _weeks_of(k, d, n_days)
            pairs.append(f"{n} * ({n} - 1{fewer})")
        by_size.append(f"CAST({' + '.join(pairs)} AS DOUBLE) / {2 * k}")
    return " + ".join(by_size)


def _time_metrics(g: DataFrame, n_days: int, metrics: Sequence[str], prefix: str) -> DataFrame:
    """``g`` (one row per student with the aggregates of ``_student_weeks``) with the time-regularity metrics."""
    days = [" + ".join(_weeks_of(k, d, n_days) for k in range(1, 8)) for d in range(7)]
    if {"pwd", "fwd"} & set(metrics):
        g = g.withColumn("held", F.expr(f"array({', '.join(f'CAST({n} AS DOUBLE)' for n in days)})"))
    if {"ws2", "ws3"} & set(metrics):
        g = g.withColumn("mats", F.expr("transform(vectors, x -> x.clicks)")).withColumn("n", F.size("mats"))
    if "ws2" in metrics:
        g = g.withColumn("shares", F.expr(f"transform(mats, v -> transform(v, x -> x / {_vsum('v')}))"))
    total = _vsum("held")
    wave = [" + ".join(f"held[{d}] * {f(2 * math.pi * d / 7)!r}D" for d in range(7)) for f in (math.cos, math.sin)]
    exprs = {
        "pwd": lambda: (f"CASE WHEN weeks > 0 THEN ({LN7!r}D + aggregate(held, CAST(0 AS DOUBLE), (s, c) -> s + CASE WHEN c > 0 "
                        f"THEN c / {total} * ln(c / {total}) ELSE 0.0D END)) * array_max(held) END"),
        "ws1": lambda: f"CASE WHEN weeks > 1 THEN ({_week_overlap(n_days)}) / (weeks * (weeks - 1) / 2) END",
        "ws2": lambda: _pair_mean(WS2_TERM, "shares"),
        "ws3": lambda: _pair_mean(WS3_TERM, "mats"),
        "fwd": lambda: f"CASE WHEN weeks > 0 THEN (pow({wave[0]}, 2) + pow({wave[1]}, 2)) / {float(n_days)!r}D END",
    }
    return g.withColumns({f"{prefix}{m}": F.expr(exprs[m]()) for m in metrics})


def _resolve_end(clicks: DataFrame, assessments: DataFrame | None, using_testing_dates: int,
                 user_defined_range: Sequence[int] | None) -> tuple[DataFrame, F.Column, F.Column]:
    """Attach the window end of each course; returns (frame, start column, end column)."""
    if user_defined_range:
        start, end = user_defined_range
        return clicks, F.lit(int(start)), F.lit(int(end))
    if assessments is None:
        raise ValueError("assessments are needed when no user-defined range is given")
    sched = bounded_broadcast(test_schedule(assessments, max_n=using_testing_dates + 1))
    out = clicks.join(sched, K2, "left")
    return out, F.lit(0), F.try_element_at(F.col("dates"), F.lit(using_testing_dates + 1))


def activity_regularity(student_vle: DataFrame, vle: DataFrame, assessments: DataFrame | None = None,
                        using_testing_dates: int = 0, user_defined_range: Sequence[int] | None = None,
                        activities: Sequence[str] = ACTIVITIES) -> DataFrame:
    """``concentration`` and ``consistency`` per student over clicks in [start, end]."""
    clicks = clicks_with_sites(student_vle.where(F.col("date") >= 0), vle, "inner")
    # days after the end are cut by the small schedule before anything is shuffled
    inside, start, end = _resolve_end(clicks, assessments, using_testing_dates, user_defined_range)
    inside = inside.where((F.col("date") >= start) & (F.col("date") <= end) & F.col("activity_type").isin(list(activities)))
    days = inside.groupBy(*K3, "date").agg(*_activity_sums(activities))
    g = days.groupBy(*K3).agg(*_student_sums(len(activities), "true"))
    return _activity_measures(g, len(activities)).select(*K3, "concentration", "consistency")


def _activity_sums(activities: Sequence[str]) -> list[F.Column]:
    """Aggregates of a day: the clicks of each activity, NULL without any."""
    return [F.sum(F.when(F.col("activity_type") == a, F.col("sum_click"))).alias(f"__a{i}") for i, a in enumerate(activities)]


def _student_sums(n_activities: int, counted: str) -> list[F.Column]:
    """Aggregates over the days that are ``counted`` (SQL): clicks per activity, days, and the clicks of the activities
    of every day with the day's total."""
    total = " + ".join(f"coalesce(__a{i}, 0)" for i in range(n_activities))
    entries = ", ".join(f"CASE WHEN __a{i} > 0 THEN struct({i} AS i, CAST(__a{i} AS DOUBLE) AS c) END" for i in range(n_activities))
    return [F.expr(x) for x in (
        *[f"sum(CASE WHEN {counted} THEN __a{i} END) AS __a{i}" for i in range(n_activities)],
        f"count_if({counted} AND {total} > 0) AS __days",
        f"collect_list(CASE WHEN {counted} THEN struct(CAST({total} AS DOUBLE) AS t, array_compact(array({entries})) AS own) END) AS __entries")]


def _activity_measures(g: DataFrame, n_activities: int) -> DataFrame:
    """``g`` (one row per student with the aggregates of ``_student_sums``) with both measures, for the students
    with a counted click.

    A day's divergence from the shares ``q`` of all days needs only the activities it has: each of the
    others adds ``q ln 2 / 2``, and the shares add up to 1.
    """
    sums = ", ".join(f"CAST(coalesce(__a{i}, 0) AS DOUBLE)" for i in range(n_activities))
    g = g.withColumn("__sums", F.expr(f"array({sums})")).withColumn("__all", F.expr(_vsum("__sums"))).where("__all > 0")
    g = g.withColumn("__q", F.expr("transform(__sums, x -> x / __all)"))
    entropy = "aggregate(__q, CAST(0 AS DOUBLE), (s, q) -> s - CASE WHEN q > 0 THEN q * log2(q) ELSE 0.0D END)"
    term = (f"x.c / d.t * ln(2.0D * x.c / d.t / (x.c / d.t + __q[x.i])) + "
            f"__q[x.i] * (ln(2.0D * __q[x.i] / (x.c / d.t + __q[x.i])) - {LN2!r}D)")
    jsd = f"aggregate(__entries, CAST(0 AS DOUBLE), (r, d) -> r + aggregate(d.own, CAST(0 AS DOUBLE), (s, x) -> s + {term}))"
    return g.withColumns({
        "concentration": F.expr(f"1.0D - {entropy} / {math.log2(n_activities)!r}D"),
        "consistency": F.expr(f"1.0D - 0.5D * ({jsd} + {LN2!r}D * __days) / __days / {LN2!r}D")})


PROCRASTINATION = {
    "proc1": lambda x: x,
    "proc2": lambda x: F.lit(1.0) / (F.lit(1.0) - x),
    "proc3": lambda x: F.log2(F.lit(1.0) + x),
}


def arrow_measure(f: Callable[[pd.Series], pd.Series]) -> Callable[[F.Column], F.Column]:
    """A measure for :func:`procrastination` from a function over a pandas series of x (run in Arrow batches)."""
    def on_batch(x: pd.Series) -> pd.Series:
        return pd.Series(f(x)).astype("float64")

    return F.pandas_udf(on_batch, "double")


def procrastination(student_vle: DataFrame, assessments: DataFrame | None = None,
                    using_testing_dates: int = 0, user_defined_range: Sequence[int] | None = None,
                    measures: Mapping[str, Callable[[F.Column], F.Column]] | None = None) -> DataFrame:
    """Click-weighted means of f(x) per student with a click on or after day 0 (NULL if none <= end).

    ``measures`` names other functions of x than ``PROCRASTINATION``, built from Column functions or by
    :func:`arrow_measure`. Days where f(x) is NULL or not a number weigh nothing.
    """
    clicks, start, end = _resolve_end(student_vle.where(F.col("date") >= 0), assessments, using_testing_dates,
                                      user_defined_range)
    if measures is None:
        # linear sums: the clicks need no daily total first
        return clicks.groupBy(*K3).agg(*_procrastination_means(F.col("sum_click"), start, end))
    inside = (F.col("date") >= start) & (F.col("date") <= end)
    # a student's day goes through the given functions once
    days = clicks.groupBy(*K3, "date").agg(F.sum(F.when(inside, F.col("sum_click"))).cast("double").alias("__w"),
                                           F.any_value(_elapsed(start, end)).alias("__x"))
    days = days.withColumns({f"__f{i}": F.nanvl(f(F.col("__x")).cast("double"), F.lit(None).cast("double"))
                             for i, f in enumerate(measures.values())})
    return days.groupBy(*K3).agg(*[
        F.try_divide(F.sum(F.col("__w") * F.col(f"__f{i}")), F.sum(F.when(F.col(f"__f{i}").isNotNull(), F.col("__w")))).alias(name)
        for i, name in enumerate(measures)])


def _elapsed(start: F.Column, end: F.Column) -> F.Column:
    return (F.col("date") - start).cast("double") / (end - start + 1).cast("double")


def _procrastination_means(clicks: F.Column, start: F.Column, end: F.Column) -> list[F.Column]:
    inside = (F.col("date") >= start) & (F.col("date") <= end)
    x, w = _elapsed(start, end), clicks.cast("double")
    return [(F.sum(F.when(inside, w * f(x))) / F.sum(F.when(inside, w))).alias(name)
            for name, f in PROCRASTINATION.items()]


def all_measures(student_vle: DataFrame, vle: DataFrame, assessments: DataFrame, start: int, end: int,
                 using_testing_dates: int = 0, activities: Sequence[str] = ACTIVITIES) -> DataFrame:
    """Time regularity over [start, end], activity regularity and procrastination up to a test date, for
    the students that have all three, from one scan of the clicks.

    The clicks from day 0 on are reduced to one row per (student, day) with the clicks of each activity and put
    together by student; two groupings there, by week and by student, give every measure.
    """
    if start < 0:
        raise ValueError("the shared base starts at day 0")
    clicks = clicks_with_sites(student_vle.where(F.col("date") >= 0), vle, "left")
    days = clicks.groupBy(*K3, "date").agg(F.sum("sum_click").alias("sum_click"), *_activity_sums(activities)).repartition(*K3)
    days, first, last = _resolve_end(days, assessments, using_testing_dates, None)
    n = len(activities)
    # without a test date no day is counted
    days = days.withColumn("__last", last)
    inside, x, w = F.col("date") <= F.col("__last"), _elapsed(first, F.col("__last")), F.col("sum_click").cast("double")
    weeks = days.groupBy(*K3, _week(start, end)).agg(
        *_week_sums(start, end), *_student_sums(n, "coalesce(date <= __last, false)"), F.sum(F.when(inside, w)).alias("__w"),
        *[F.sum(F.when(inside, w * f(x))).alias(f"__{name}") for name, f in PROCRASTINATION.items()])
    g = weeks.groupBy(*K3).agg(
        *_student_weeks(end - start + 1, TIME_METRICS), *[F.expr(f"sum(__a{i}) AS __a{i}") for i in range(n)],
        F.sum("__days").alias("__days"), F.flatten(F.collect_list("__entries")).alias("__entries"),
        *[(F.sum(f"__{name}") / F.sum("__w")).alias(name) for name in PROCRASTINATION])
    g = _time_metrics(_activity_measures(g, n), end - start + 1, TIME_METRICS, "")
    return g.select(*K3, *TIME_METRICS, "concentration", "consistency", *PROCRASTINATION)

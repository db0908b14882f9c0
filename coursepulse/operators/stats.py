"""Statistics over feature and click tables: shares, counts, curves, quantiles, ANOVA, correlation.

Quantiles are exact (pandas' linear interpolation) without holding a group in one task: the
value range of each target rank is narrowed by repeated equal-width histograms (one aggregate job
per round, a few hundred small rows to the driver), and only the final bucket, at most
``final_rows`` values, is read exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursepulse.functions.columns import safe_div
from coursepulse.functions.dims import bounded_broadcast, few_rows
from coursepulse.operators.numbering import running_sums
from coursepulse.schema import K3


# ---------------------------------------------------------------- B14
def sample_per_outcome(df: DataFrame, col: str, fraction: float, seed: int = 0,
                       keys: Sequence[str] | None = None) -> DataFrame:
    """Stratified sample with exactly ``round(fraction * n_class)`` rows of every class (as pandas'
    ``sample(frac=)`` per class), reproducible for a seed.

    Each row gets a uniform number from a hash of its key columns and the seed; the class's
    k-th smallest number is found with the distributed order statistic, and rows at or below it
    are kept. Nothing per class is collected; only one threshold per class reaches the driver.
    """
    keys = list(keys) if keys else list(df.columns)
    u = F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.lit(seed)).bitwiseAND(F.lit((1 << 53) - 1)).cast("double") \
        / F.lit(float(1 << 53))
    x = df.withColumn("__u", u)
    counts = few_rows(x.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")), f"classes of {col}")
    targets = [((r[col],), round(fraction * r["n"]) - 1) for r in counts if round(fraction * r["n"]) > 0]
    if not targets:
        return df.limit(0)
    cuts = order_statistics(x, "__u", targets, by=[col])
    thr = None
    for ((g,), _), t in zip(targets, cuts):
        thr = F.when(F.col(col) == g, F.lit(t)) if thr is None else thr.when(F.col(col) == g, F.lit(t))
    return x.where(F.col("__u") <= thr).drop("__u")


# ---------------------------------------------------------------- E23-E25
def class_shares(df: DataFrame, col: str) -> DataFrame:
    """Count and share of each class (the share window runs over the few grouped rows)."""
    c = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def withdrawal_counts(registration: DataFrame, info: DataFrame) -> DataFrame:
    """Withdrawn students in the info table and in the registration table; when they withdrew."""
    u = F.col("date_unregistration")
    n_withdrawn = info.agg(F.count_if(F.col("final_result") == "Withdrawn")).scalar()
    return registration.where(u.isNotNull()).agg(
        n_withdrawn.alias("n_withdrawn"),
        F.count(F.lit(1)).alias("n_unregistered"),
        F.count_if(u < 0).alias("n_before_start"),
        F.count_if(u == 0).alias("n_on_start"),
        F.count_if((u > 0) & (u < 7)).alias("n_first_week"),
        F.count_if(u < 7).alias("n_before_week2"))


def adjusted_outcome_shares(info: DataFrame, registration: DataFrame, before_day: int = 7) -> DataFrame:
    """Outcome shares after removing withdrawals that happened before day ``before_day``."""
    early = registration.agg(F.count_if(F.col("date_unregistration") < before_day)).scalar()
    counts = info.groupBy("final_result").agg(F.count(F.lit(1)).alias("n"))
    adj = counts.select("final_result", F.when(F.col("final_result") == "Withdrawn", F.col("n") - early)
                        .otherwise(F.col("n")).alias("n"))
    return adj.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


# ---------------------------------------------------------------- E26-E29
def dense_daily(daily: DataFrame, start: int, end: int) -> DataFrame:
    """Daily clicks of every student over every day in [start, end], 0 for days without clicks.

    The grid is generated per student (``sequence`` + ``explode``, at most end-start+1 rows each)
    and matched to the clicks by an aggregate, not by a join against a day table.
    """
    inside = F.col("date").between(start, end)
    per = daily.groupBy(*K3).agg(F.map_from_entries(F.collect_list(
        F.when(inside, F.struct("date", "sum_click")))).alias("m"))
    return per.select(*K3, F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"), "m").select(
        *K3, F.col("date").cast("long").alias("date"),
        F.coalesce(F.try_element_at("m", F.col("date").cast("long")), F.lit(0)).cast("long").alias("sum_click"))


def daily_wide(daily: DataFrame, start: int, end: int) -> DataFrame:
    """Daily clicks per student, one column ``d{date}`` per day of [start, end], zero-filled."""
    days = list(range(start, end + 1))
    agg = [F.coalesce(F.sum(F.when(F.col("date") == d, F.col("sum_click"))), F.lit(0)).cast("long")
           .alias(f"d{d}" if d >= 0 else f"d_neg{-d}") for d in days]
    return daily.groupBy(*K3).agg(*agg)


def first_days_percent(daily: DataFrame, days: int = 30) -> DataFrame:
    """Share (in %) of each of the first ``days`` days in the student's clicks of those days."""
    g = dense_daily(daily, 0, days - 1)
    tot = F.sum("sum_click").over(Window.partitionBy(*K3))
    return g.select(*K3, "date", F.coalesce(safe_div(F.col("sum_click") * 100.0, tot), F.lit(0.0)).alias("pct"))


def mean_daily_curve(dense: DataFrame, info: DataFrame, value: str = "sum_click",
                     outcome: str = "final_result") -> DataFrame:
    """Mean, sample std, standard error and count of a daily value per (outcome, day)."""
    j = dense.join(info.select(*K3, outcome), K3, "inner")
    out = j.groupBy(outcome, "date").agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
                                         F.count(F.lit(1)).alias("n"))
    return out.withColumn("sem", F.col("std") / F.sqrt(F.col("n")))


#: 2^32 times the cumulative probabilities of a Poisson variable of mean 1, from its definition.
POISSON_STEPS = [math.floor(math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1)) * 2 ** 32) for k in range(12)]
_DRAWS = 8  # replicate weights from one digest


def poisson_weights(keys: Sequence[str], replicates: int, seed: int = 0) -> Column:
    """Array of ``replicates`` Poisson(1) weights that depend on the key columns and the seed alone.

    Eight hexadecimal digits of sha256(``key|...|seed|block``) are a uniform 32-bit number; its place among the
    steps of the cumulative distribution is the weight. Null keys count as empty.
    """
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    blocks = F.transform(F.sequence(F.lit(0), F.lit((replicates - 1) // _DRAWS)),
                         lambda b: F.sha2(F.concat_ws("|", key, F.lit(str(seed)), b.cast("string")), 256))
    text = F.array_join(blocks, "")

    def weight(i):
        u = F.conv(F.substring(text, i * 8 + 1, F.lit(8)), 16, 10).cast("long")
        return sum((F.when(u >= step, 1).otherwise(0) for step in POISSON_STEPS), F.lit(0))

    return F.transform(F.sequence(F.lit(0), F.lit(replicates - 1)), weight)


def _outcome_days(daily: DataFrame, students: DataFrame, sums: dict[str, Column], totals: dict[str, Column],
                  start: int, end: int, outcome: str) -> DataFrame:
    """``sums`` per (outcome, day) next to ``totals`` per outcome, for every day of [start, end].

    Days without clicks add nothing to a sum, so no students x days grid is made: the totals over the
    students (one row an outcome) carry the days, and the sums are matched to them."""
    days = daily.join(students, K3, "inner").groupBy(outcome, F.col("date").cast("long").alias("date")).agg(
        *[c.alias(n) for n, c in sums.items()])
    per = students.groupBy(outcome).agg(*[c.alias(n) for n, c in totals.items()])
    grid = per.select("*", F.explode(F.sequence(F.lit(int(start)).cast("long"), F.lit(int(end)).cast("long"))).alias("date"))
    days = days.withColumnsRenamed({outcome: "__o", "date": "__d"})
    return grid.join(days, grid[outcome].eqNullSafe(days["__o"]) & (grid["date"] == days["__d"]), "left").drop("__o", "__d")


def daily_curve(daily: DataFrame, info: DataFrame, start: int, end: int, value: str = "sum_click",
                outcome: str = "final_result") -> DataFrame:
    """Mean, sample std, standard error and number of students of the daily clicks per (outcome, day) over
    all students with clicks, from sums and sums of squares (0 on days without clicks)."""
    students = daily.select(*K3).distinct().join(info.select(*K3, outcome), K3, "inner")
    x = F.col(value)
    d = _outcome_days(daily, students, {"s": F.sum(x), "q": F.sum((x * x).cast("decimal(38,0)"))}, {"n": F.count(F.lit(1))}, start, end, outcome)
    s, n = F.coalesce(F.col("s"), F.lit(0)).cast("decimal(38,0)"), F.col("n")
    q = F.coalesce(F.col("q"), F.lit(0)).cast("decimal(38,0)")
    spread = (n * q - s * s).cast("double") / n  # an exact difference: no digits cancel
    std = F.when(n > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1)))
    return d.select(outcome, "date", (s.cast("double") / n).alias("mean"), std.alias("std"), n.alias("n"),
                    (std / F.sqrt(n)).alias("sem"))


def bootstrap_bands(daily: DataFrame, info: DataFrame, start: int, end: int, replicates: int = 64, level: float = 0.95,
                    seed: int = 0, value: str = "sum_click", outcome: str = "final_result") -> DataFrame:
    """Mean daily clicks per (outcome, day) with a bootstrap confidence band over the students.

    A replicate draws every student Poisson(1) times (the limit of drawing with replacement), by weights from a hash
    of the student's key: the band does not depend on the partitions, and a replicate is one more
    weighted sum beside the plain one in a single aggregate. The band's ends are the interpolated quantiles
    of the replicates' means (replicates that draw nobody are left out; NULL where none is left).
    """
    students = daily.select(*K3).distinct().join(info.select(*K3, outcome), K3, "inner").withColumn(
        "w", poisson_weights(K3, replicates, seed))
    x, each = F.col(value), range(replicates)
    d = _outcome_days(daily, students, {"s": F.sum(x), **{f"s{b}": F.sum(x * F.col("w")[b]) for b in each}},
                      {"n": F.count(F.lit(1)), **{f"n{b}": F.sum(F.col("w")[b]) for b in each}}, start, end, outcome)
    zero = F.lit(0)
    means = F.array(*[safe_div(F.coalesce(F.col(f"s{b}"), zero).cast("double"), F.col(f"n{b}").cast("double")) for b in each])
    d = d.select(outcome, "date", (F.coalesce(F.col("s"), zero) / F.col("n")).cast("double").alias("mean"),
                 F.array_sort(F.filter(means, lambda m: m.isNotNull())).alias("m"))

    def quantile(p: float) -> Column:
        h = (F.size("m") - 1) * F.lit(p)
        low = F.floor(h).cast("int")
        a, b = F.get("m", low), F.get("m", F.least(low + 1, F.size("m") - 1))
        return F.when(F.size("m") > 0, a + (h - low) * (b - a))

    return d.select(outcome, "date", "mean", quantile((1 - level) / 2).alias("low"), quantile((1 + level) / 2).alias("high"))


def activity_date_profile(clicks_sites: DataFrame, info: DataFrame, outcome: str = "final_result") -> DataFrame:
    """Mean clicks per (outcome, activity, day), normalised to sum 1 within each outcome."""
    # mean over click rows = sum / count: both are summed per student first, so the student-key
    # join reads one row per (student, activity, day) instead of every click
    per = clicks_sites.groupBy(*K3, "activity_type", "date").agg(
        F.sum("sum_click").alias("s"), F.count(F.lit(1)).alias("c"))
    j = per.join(info.select(*K3, outcome), K3, "inner")
    m = j.groupBy(outcome, "activity_type", "date").agg((F.sum("s") / F.sum("c")).alias("mean_clicks"))
    tot = m.groupBy(outcome).agg(F.sum("mean_clicks").alias("tot"))
    return m.join(bounded_broadcast(tot, 10_000), outcome).select(
        outcome, "activity_type", "date", (F.col("mean_clicks") / F.col("tot")).alias("share"))


def sample_kurtosis(col: str) -> F.Column:
    """Bias-corrected excess kurtosis (pandas' definition) as an aggregate expression.

    From Spark's population excess kurtosis g2 over n values:
    G2 = ((n + 1) g2 + 6) (n - 1) / ((n - 2) (n - 3)); 0 for a constant column, NULL below 4 values.
    """
    x = F.col(col).cast("double")
    n = F.count(x).cast("double")
    g2 = F.kurtosis(x)
    g = ((n + 1) * g2 + 6) * (n - 1) / ((n - 2) * (n - 3))
    return (F.when(n < 4, F.lit(None).cast("double"))
            .when(F.var_pop(x) <= 1e-28, F.lit(0.0)).otherwise(g))


# ---------------------------------------------------------------- E30: histograms
def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Counts in ``bins`` equal-width bins of [lo, hi) (values at ``hi`` in the last bin)."""
    b = F.least(F.width_bucket(F.col(col), F.lit(float(lo)), F.lit(float(hi)), F.lit(bins)), F.lit(bins))
    return (df.where(F.col(col).between(lo, hi)).groupBy(*by, b.cast("long").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))


# ---------------------------------------------------------------- E30: densities
def silverman_width(n: int, std: float | None, dims: int = 1) -> float:
    """Silverman's width of a Gaussian kernel for ``n`` values of the given sample std (0 without spread)."""
    return (std or 0.0) * (4.0 / ((dims + 2) * n)) ** (1.0 / (dims + 4)) if n else 0.0


def _kernel(z: Column, width: float) -> Column:
    return F.exp(-(z * z) / F.lit(2.0 * width * width)) / F.lit(width * math.sqrt(2 * math.pi))


def _on_grid(df: DataFrame, col: str, step: float) -> Column:
    return F.round(F.col(col).cast("double") / F.lit(float(step))).cast("long")


def _spreads(df: DataFrame, cols: Sequence[str], steps: Sequence[float]) -> tuple[DataFrame, list[tuple]]:
    """Rows with all columns, as grid numbers ``__b0, __b1``; per column (n, std, first, last grid number)."""
    x = df
    for c in cols:
        x = x.where(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
    x = x.select(*[_on_grid(df, c, s).alias(f"__b{i}") for i, (c, s) in enumerate(zip(cols, steps))],
                 *[F.col(c).cast("double").alias(f"__x{i}") for i, c in enumerate(cols)])
    aggs = [a for i in range(len(cols)) for a in (F.stddev_samp(f"__x{i}"), F.min(f"__b{i}"), F.max(f"__b{i}"))]
    row = x.agg(F.count(F.lit(1)), *aggs).first()
    return x, [(row[0], *row[1 + 3 * i: 4 + 3 * i]) for i in range(len(cols))]


def _axis(first: int, last: int, step: float, width: float, cut: float, max_points: int) -> tuple[int, int]:
    reach = math.ceil(cut * width / step)
    if last - first + 1 + 2 * reach > max_points:
        raise ValueError(f"the grid has more than {max_points} points: take a wider step")
    return first - reach, last + reach


def density(df: DataFrame, col: str, step: float, width: float | None = None, cut: float = 3.0,
            max_points: int = 10_000) -> DataFrame:
    """Gaussian kernel density ``(x, density)`` of a column on the grid of multiples of ``step``.

    The rows are counted on the grid (NULL and NaN ignored; a value counts at the nearest multiple, exactly where it is one),
    and the kernel runs over the counts alone: at most ``max_points`` of them, however many rows.
    ``width`` is Silverman's by default (from one aggregate); the grid ends ``cut`` widths beyond the
    values. Without values, or without spread and width, the result is empty.
    """
    x, ((n, std, first, last),) = _spreads(df, [col], [step])
    width = silverman_width(n, std) if width is None else width
    if not n or not width > 0:
        return df.sparkSession.createDataFrame([], "x double, density double")
    lo, hi = _axis(first, last, step, width, cut, max_points)
    counts = x.groupBy("__b0").agg(F.count(F.lit(1)).alias("c"))
    points = counts.select("c", "__b0", F.explode(F.sequence(F.lit(lo).cast("long"), F.lit(hi).cast("long"))).alias("g"))
    near = _kernel((F.col("g") - F.col("__b0")) * F.lit(float(step)), width)
    return points.groupBy("g").agg((F.sum(F.col("c") * near) / F.lit(float(n))).alias("density")).select(
        (F.col("g") * F.lit(float(step))).alias("x"), "density")


def density2(df: DataFrame, cols: Sequence[str], steps: Sequence[float], widths: Sequence[float] | None = None,
             cut: float = 3.0, max_points: int = 1_000) -> DataFrame:
    """Product-kernel density ``(x, y, density)`` of two columns on the grid of multiples of ``steps``.

    Counted on the grid like :func:`density`; the kernel is separable, so the counts are spread along one axis
    first and the sums of that along the other: cells x points rows twice, not cells x grid.
    """
    x, spreads = _spreads(df, cols, steps)
    n = spreads[0][0]
    widths = [silverman_width(n, s[1], 2) for s in spreads] if widths is None else list(widths)
    if not n or not all(w > 0 for w in widths):
        return df.sparkSession.createDataFrame([], "x double, y double, density double")
    out = x.groupBy("__b0", "__b1").agg(F.count(F.lit(1)).cast("double").alias("c"))
    for i, other in ((0, "__b1"), (1, "__g0")):
        lo, hi = _axis(spreads[i][2], spreads[i][3], steps[i], widths[i], cut, max_points)
        near = _kernel((F.col(f"__g{i}") - F.col(f"__b{i}")) * F.lit(float(steps[i])), widths[i])
        out = out.withColumn(f"__g{i}", F.explode(F.sequence(F.lit(lo).cast("long"), F.lit(hi).cast("long")))).groupBy(
            f"__g{i}", other).agg(F.sum(F.col("c") * near).alias("c"))
    return out.select((F.col("__g0") * F.lit(float(steps[0]))).alias("x"), (F.col("__g1") * F.lit(float(steps[1]))).alias("y"),
                      (F.col("c") / F.lit(float(n))).alias("density"))


# ---------------------------------------------------------------- E22 / E30: exact quantiles
_WIDE = 1e6


def _bucket(x: Column, lo: float, hi: float, buckets: int) -> Column:
    """Bucket of ``x`` in [lo, hi], rising with x. Ranges over many orders of magnitude are cut at
    equal steps of the logarithm (negative values below zero below positive ones), so that the
    number of rounds follows the number of digits and not the range."""
    most = max(abs(lo), abs(hi))
    least = min(v for v in (abs(lo), abs(hi)) if v > 0)
    if lo < 0 < hi or lo == 0 or hi == 0 or most / least > _WIDE:
        tiny = 5e-324
        top, bottom = math.log(most), math.log(tiny)
        half = buckets // 2
        size = F.greatest(F.abs(x), F.lit(tiny))
        step = F.least(F.floor((F.log(size) - F.lit(bottom)) / F.lit((top - bottom) / (half - 1))), F.lit(half - 1)) + 1
        if lo >= 0 or hi <= 0:  # one sign: steps between the ends alone
            near = min(abs(lo), abs(hi)) or tiny
            bottom = math.log(near)
            step = F.greatest(F.lit(0), F.least(F.floor((F.log(size) - F.lit(bottom)) / F.lit((top - bottom) / (half - 1))),
                                                F.lit(half - 1))) + 1
        return F.when(x == 0, F.lit(0)).otherwise(F.signum(x) * step)
    width = hi / buckets - lo / buckets
    return F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(buckets - 1))


def order_statistics(df: DataFrame, col: str, targets: Sequence[tuple[tuple, int]], by: Sequence[str] = (),
                     buckets: int = 512, final_rows: int = 10_000) -> list:
    """Values of ``col`` (NULL and NaN ignored) at 0-based ranks, per ``by`` group.

    ``targets`` is a list of (group values, rank); the result lists the value of each target.
    Each round emits every row at most once per distinct open value range that contains it
    (ranges of different targets are disjoint after the first round), so no row is paired with
    every target.
    """
    by = list(by)
    data = df.select(*by, F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        def group_cond(g):
            cond = F.lit(True)
            for c, v in zip(by, g):
                cond = cond & F.col(c).eqNullSafe(F.lit(v))
            return cond

        rng = {tuple(r[c] for c in by): (r["lo"], r["hi"])
               for r in data.groupBy(*by).agg(F.min("x").alias("lo"), F.max("x").alias("hi")).collect()}
        state = [{"g": tuple(g), "rank": int(k), "lo": rng[tuple(g)][0], "hi": rng[tuple(g)][1],
                  "below": 0, "value": None} for g, k in targets]
        while open_ := [s for s in state if s["value"] is None]:
            before = [(s["lo"], s["hi"]) for s in open_]
            ranges = list(dict.fromkeys((s["g"], s["lo"], s["hi"]) for s in open_))
            rid = {r: i for i, r in enumerate(ranges)}
            entries = []
            for (g, lo, hi), i in rid.items():
                b = F.lit(0) if hi == lo else _bucket(F.col("x"), lo, hi, buckets)
                entries.append(F.when(group_cond(g) & F.col("x").between(F.lit(lo), F.lit(hi)),
                                      F.struct(F.lit(i).alias("rid"), b.cast("long").alias("b"))))
            hits = F.filter(F.array(*entries), lambda e: e.isNotNull())
            hist = (data.select("x", F.explode(hits).alias("e"))
                    .groupBy("e.rid", "e.b").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("bmin"),
                                                 F.max("x").alias("bmax")).collect())
            per: dict = {}
            for r in hist:
                per.setdefault(r["rid"], []).append((r["b"], r["n"], r["bmin"], r["bmax"]))
            finals = []
            for s in open_:
                need = s["rank"] - s["below"]
                acc = 0
                for _b, n, bmin, bmax in sorted(per.get(rid[(s["g"], s["lo"], s["hi"])], [])):
                    if acc + n > need:
                        if bmin == bmax:
                            s["value"] = bmin
                        else:
                            s["lo"], s["hi"], s["below"] = bmin, bmax, s["below"] + acc
                            if n <= final_rows:
                                finals.append(s)
                        break
                    acc += n
            if finals:
                # read every small final bucket of this round in one job
                fr = list(dict.fromkeys((s["g"], s["lo"], s["hi"]) for s in finals))
                fid = {r: i for i, r in enumerate(fr)}
                tags = F.filter(F.array(*[
                    F.when(group_cond(g) & F.col("x").between(F.lit(lo), F.lit(hi)), F.lit(i))
                    for (g, lo, hi), i in fid.items()]), lambda e: e.isNotNull())
                got: dict = {}
                for r in data.select("x", F.explode(tags).alias("fid")).collect():
                    got.setdefault(r["fid"], []).append(r["x"])
                for s in finals:
                    vals = sorted(got.get(fid[(s["g"], s["lo"], s["hi"])], []))
                    s["value"] = vals[s["rank"] - s["below"]]
            if [(s["lo"], s["hi"]) for s in open_] == before and all(s["value"] is None for s in open_):
                raise ArithmeticError(f"ranks of {col} cannot be narrowed further")
        return [s["value"] for s in state]
    finally:
        data.unpersist()


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Quantiles with linear interpolation (pandas default) per ``by`` group: (by..., q, value)."""
    by = list(by)
    present = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
    counts = few_rows(present.groupBy(*by).agg(F.count(F.lit(1)).alias("n")), "groups; for many groups see group_quantiles")
    targets, plan = [], []
    for r in counts:
        g = tuple(r[c] for c in by)
        n = r["n"]
        for q in probs:
            h = (n - 1) * q
            k = int(math.floor(h))
            plan.append((g, q, len(targets), len(targets) + 1, h - k))
            targets += [(g, k), (g, min(k + 1, n - 1))]
    vals = order_statistics(df, col, targets, by)
    rows = [(*g, float(q), vals[a] + frac * (vals[b] - vals[a])) for g, q, a, b, frac in plan]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    ddl = ", ".join([*(f"`{c}` {types[c]}" for c in by), "q double", "value double"])
    return df.sparkSession.createDataFrame(rows, ddl)


def group_quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Exact quantiles ``(by..., q, value)`` with linear interpolation for any number of groups.

    The values are counted per (group, value), put into ranges of that order and numbered by running sums over the
    ranges, so a group of any size is many partitions; a group's ranks start where its first value does. The
    number of jobs depends neither on the groups nor on the values. NULL and NaN are ignored.
    """
    by = list(by)
    x = F.col(col).cast("double")
    counts = df.select(*by, x.alias("__x")).where(F.col("__x").isNotNull() & ~F.isnan("__x")).groupBy(*by, "__x").agg(
        F.count(F.lit(1)).alias("__n"))
    ranks = running_sums(counts, [*by, "__x"], ["__n"], prefix="__upto_")
    ranks = ranks.select(*by, "__x", (F.col("__upto___n") - F.col("__n")).alias("__first"), F.col("__upto___n").alias("__end"))
    groups = ranks.groupBy(*by).agg(F.min("__first").alias("__base"), F.max("__end").alias("__top")).withColumnsRenamed(
        {c: f"__g_{c}" for c in by})
    same = F.lit(True)
    for c in by:
        same = same & ranks[c].eqNullSafe(groups[f"__g_{c}"])
    j = ranks.join(groups, same)
    total = F.col("__top") - F.col("__base")
    wanted = F.explode(F.array(*[F.lit(float(q)) for q in probs])).alias("q")
    j = j.select(*[ranks[c] for c in by], "__x", (F.col("__first") - F.col("__base")).alias("__first"),
                 (F.col("__end") - F.col("__base")).alias("__end"), total.alias("__total"), wanted)
    h = (F.col("__total") - 1) * F.col("q")
    low = F.floor(h)
    high = F.least(low + 1, F.col("__total") - 1)
    has = lambda k: (F.col("__first") <= k) & (k < F.col("__end"))
    hit = j.where(has(low) | has(high)).groupBy(*by, "q", (h - low).alias("__frac")).agg(
        F.max(F.when(has(low), F.col("__x"))).alias("a"), F.max(F.when(has(high), F.col("__x"))).alias("b"))
    return hit.select(*by, "q", (F.col("a") + F.col("__frac") * (F.col("b") - F.col("a"))).alias("value"))


# ---------------------------------------------------------------- M1 / M2
def anova_groups(df: DataFrame, metrics: Sequence[str], group: str) -> DataFrame:
    """One-way ANOVA F statistic of each metric across the groups (NULLs dropped per metric).

    One pass computes count, mean and sample variance per (group, metric) from the long form;
    the F statistic follows from those few rows.
    """
    long = df.select(group, F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])).alias("p")
    ).select(group, "p.metric", "p.v").where(F.col("v").isNotNull() & ~F.isnan("v"))
    g = long.groupBy("metric", group).agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"),
                                          F.var_samp("v").alias("var"))
    w = Window.partitionBy("metric")
    g = (g.withColumn("n_all", F.sum("n").over(w)).withColumn("k_groups", F.count(F.lit(1)).over(w))
         .withColumn("grand", F.sum(F.col("n") * F.col("mean")).over(w) / F.col("n_all")))
    k, n_all = F.first("k_groups"), F.first("n_all")
    out = g.groupBy("metric").agg(
        (F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), 2)) / (k - 1)).alias("msb"),
        (F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))) / (n_all - k)).alias("msw"),
        (k - 1).cast("long").alias("df_between"), (n_all - k).cast("long").alias("df_within"))
    return out.select("metric", safe_div(F.col("msb"), F.col("msw")).alias("f_stat"), "df_between", "df_within")


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny, eps = 1e-300, 3e-16
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 1000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbeta) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbeta) * _betacf(b, a, 1 - x) / b


def f_survival(f: float | None, d1: int, d2: int) -> float | None:
    """P(F > f) for the F distribution with (d1, d2) degrees of freedom."""
    if f is None or d1 <= 0 or d2 <= 0 or math.isnan(f):
        return None
    if math.isinf(f):
        return 0.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def anova(df: DataFrame, metrics: Sequence[str], group: str) -> DataFrame:
    """ANOVA F and p-value per metric; the p-value is computed from the few result rows."""
    rows = anova_groups(df, metrics, group).collect()
    out = [(r["metric"], r["f_stat"], f_survival(r["f_stat"], r["df_between"], r["df_within"]),
            r["df_between"], r["df_within"]) for r in rows]
    return df.sparkSession.createDataFrame(
        out, "metric string, f_stat double, p_value double, df_between long, df_within long")


def pairwise_corr(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of metrics over pairwise-complete rows, one aggregate."""
    aggs = []
    for i, a in enumerate(metrics):
        for b in metrics[i:]:
            ok = F.col(a).isNotNull() & F.col(b).isNotNull()
            aggs.append(F.corr(F.when(ok, F.col(a)), F.when(ok, F.col(b))).alias(f"{a}|{b}"))
    row = df.agg(*aggs)
    pairs = []
    for c in row.columns:
        a, b = c.split("|")
        pairs.append(F.struct(F.lit(a).alias("m1"), F.lit(b).alias("m2"), F.col(f"`{c}`").alias("r")))
        if a != b:  # the matrix is symmetric: both orders from the same aggregate
            pairs.append(F.struct(F.lit(b).alias("m1"), F.lit(a).alias("m2"), F.col(f"`{c}`").alias("r")))
    return row.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")

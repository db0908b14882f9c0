"""Checked queries: quantiles, class shares, withdrawal counts, daily curves, histograms, ANOVA, correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursepulse.operators import clicks, stats
from coursepulse.operators import distributions as dist
from coursepulse.operators.split import train_test_split
from coursepulse.plans.q_distributions import _ENT
from coursepulse.plans.q_regularity import METRICS, outcome_metrics, outcome_metrics_sql
from coursepulse.plans.registry import query
from coursepulse.schema import K3
from coursepulse.sources.fixture import fixture_tables

K3J = "code_module, code_presentation, id_student"
TRAIN_IN = "('2013B', '2013J', '2014B')"
DECILES = [i / 9 for i in range(10)]  # numpy.linspace(0, 1, 10)


def _raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return fixture_tables(spark, sf_dir)


def _ent(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return dist.entropies(dist.entropy_base(raw["student_vle"], raw["vle"], raw["assessments"], raw["student_info"],
                                            raw["student_registration"]))


# ---------------------------------------------------------------- E22
_QLIST = "[" + ", ".join(f"CAST({q!r} AS DOUBLE)" for q in DECILES) + "]"


@query("e22_entropy_deciles", _ENT + f"""
SELECT unnest({_QLIST}) AS q, unnest(quantile_cont(entropy_joint, {_QLIST})) AS value FROM ent""")
def e22_entropy_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles (linear interpolation) of the joint entropy at 0, 1/9, ..., 1."""
    return stats.exact_quantiles(_ent(spark, sf_dir), "entropy_joint", DECILES)


@query("e22_low_date_entropy", _ENT + """
SELECT * FROM ent WHERE entropy_date < (SELECT quantile_cont(entropy_date, 0.33) FROM ent)""")
def e22_low_date_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Students whose day entropy is below its 0.33 quantile."""
    ent = _ent(spark, sf_dir)
    q = stats.exact_quantiles(ent, "entropy_date", [0.33]).first()["value"]
    return ent.where(F.col("entropy_date") < F.lit(q))


@query("e22_top_date_entropy", _ENT + f"""
SELECT * FROM ent ORDER BY entropy_date DESC, {K3J} LIMIT 5""")
def e22_top_date_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five students with the highest day entropy (a top-k report)."""
    return _ent(spark, sf_dir).orderBy(F.desc("entropy_date"), *K3).limit(5)


# ---------------------------------------------------------------- E23-E25
@query("e23_outcome_shares", f"""
SELECT final_result, CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS share
FROM student_info WHERE code_presentation IN {TRAIN_IN} GROUP BY final_result""")
def e23_outcome_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count and share of each outcome among the training students."""
    train, _ = train_test_split(_raw(spark, sf_dir))
    return stats.class_shares(train["student_info"], "final_result")


@query("e23_term_shares", """
SELECT code_presentation, CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS share
FROM student_info GROUP BY code_presentation""")
def e23_term_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of students per term."""
    return stats.class_shares(_raw(spark, sf_dir)["student_info"], "code_presentation")


@query("e24_withdrawal_counts", f"""
SELECT (SELECT CAST(count(*) FILTER (WHERE final_result = 'Withdrawn') AS BIGINT) FROM student_info
  WHERE code_presentation IN {TRAIN_IN}) AS n_withdrawn,
 CAST(count(*) AS BIGINT) AS n_unregistered,
 CAST(count(*) FILTER (WHERE date_unregistration < 0) AS BIGINT) AS n_before_start,
 CAST(count(*) FILTER (WHERE date_unregistration = 0) AS BIGINT) AS n_on_start,
 CAST(count(*) FILTER (WHERE date_unregistration > 0 AND date_unregistration < 7) AS BIGINT) AS n_first_week,
 CAST(count(*) FILTER (WHERE date_unregistration < 7) AS BIGINT) AS n_before_week2
FROM student_registration WHERE code_presentation IN {TRAIN_IN} AND date_unregistration IS NOT NULL""")
def e24_withdrawal_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Withdrawals of the training terms: total, before, on and in the first week after the start."""
    train, _ = train_test_split(_raw(spark, sf_dir))
    return stats.withdrawal_counts(train["student_registration"], train["student_info"])


@query("e25_adjusted_outcome_shares", f"""
early AS (SELECT count(*) FILTER (WHERE date_unregistration < 7) AS e FROM student_registration WHERE code_presentation IN {TRAIN_IN}),
c AS (SELECT final_result, count(*) AS n FROM student_info WHERE code_presentation IN {TRAIN_IN} GROUP BY final_result),
a AS (SELECT final_result, CAST(CASE WHEN final_result = 'Withdrawn' THEN n - (SELECT e FROM early) ELSE n END AS BIGINT) AS n FROM c)
SELECT final_result, n, CAST(n AS DOUBLE) / sum(n) OVER () AS share FROM a""")
def e25_adjusted_outcome_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome shares after removing students who withdrew before the second week."""
    train, _ = train_test_split(_raw(spark, sf_dir))
    return stats.adjusted_outcome_shares(train["student_info"], train["student_registration"], 7)


# ---------------------------------------------------------------- E26-E29
_DENSE = f"""
d AS (SELECT {K3J}, date, sum(sum_click) AS c FROM student_vle GROUP BY ALL),
rng AS (SELECT min(date) AS lo, max(date) AS hi FROM student_vle),
stu AS (SELECT DISTINCT {K3J} FROM d),
dense AS (SELECT s.code_module, s.code_presentation, s.id_student, CAST(g.range AS BIGINT) AS date,
  CAST(COALESCE(d.c, 0) AS BIGINT) AS sum_click
  FROM stu s CROSS JOIN range((SELECT lo FROM rng), (SELECT hi FROM rng) + 1) g
  LEFT JOIN d ON d.code_module = s.code_module AND d.code_presentation = s.code_presentation
   AND d.id_student = s.id_student AND d.date = g.range)"""


def _dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    daily = clicks.daily_clicks(raw["student_vle"])
    lo, hi = raw["student_vle"].agg(F.min("date"), F.max("date")).first()
    return stats.dense_daily(daily, lo, hi)


def _daily_range(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, int, int]:
    raw = _raw(spark, sf_dir)
    lo, hi = raw["student_vle"].agg(F.min("date"), F.max("date")).first()
    return clicks.daily_clicks(raw["student_vle"]), raw["student_info"], lo, hi


@query("e26_dense_daily", _DENSE + "\nSELECT * FROM dense")
def e26_dense_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily clicks of every active student over every day of the log, zero-filled (long form)."""
    return _dense(spark, sf_dir)


@query("e27_first_days_percent", f"""
d AS (SELECT {K3J}, date, sum(sum_click) AS c FROM student_vle GROUP BY ALL),
stu AS (SELECT DISTINCT {K3J} FROM d),
g AS (SELECT s.code_module, s.code_presentation, s.id_student, CAST(r.range AS BIGINT) AS date, COALESCE(d.c, 0) AS c
  FROM stu s CROSS JOIN range(0, 30) r LEFT JOIN d ON d.code_module = s.code_module
  AND d.code_presentation = s.code_presentation AND d.id_student = s.id_student AND d.date = r.range)
SELECT {K3J}, date, COALESCE(CAST(c AS DOUBLE) * 100 / NULLIF(sum(c) OVER (PARTITION BY {K3J}), 0), 0) AS pct FROM g""")
def e27_first_days_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share in % of each of the first 30 days in a student's clicks of those days (0 if none)."""
    return stats.first_days_percent(clicks.daily_clicks(_raw(spark, sf_dir)["student_vle"]), 30)


@query("e28_mean_daily_curve", _DENSE + f"""
SELECT i.final_result, dense.date, avg(sum_click) AS mean, stddev_samp(sum_click) AS std, CAST(count(*) AS BIGINT) AS n,
 stddev_samp(sum_click) / sqrt(count(*)) AS sem
FROM dense JOIN student_info i USING ({K3J}) GROUP BY ALL""")
def e28_mean_daily_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean daily clicks per outcome and day over the zero-filled grid, with std and standard error."""
    daily, info, lo, hi = _daily_range(spark, sf_dir)
    return stats.daily_curve(daily, info, lo, hi)


_REPLICATES = 64
_HEX = f"array_to_string(list_transform(range({_REPLICATES} // 8), lambda b: sha256(k || '|0|' || b)), '')"
_WEIGHT = " + ".join(f"(u >= {step})::INT" for step in stats.POISSON_STEPS)


@query("e28_bootstrap_bands", f"""
d AS (SELECT {K3J}, date, sum(sum_click) AS c FROM student_vle GROUP BY ALL),
rng AS (SELECT min(date) AS lo, max(date) AS hi FROM student_vle),
stu AS (SELECT DISTINCT {K3J}, code_module || '|' || code_presentation || '|' || id_student AS k FROM d),
hx AS (SELECT stu.*, i.final_result, {_HEX} AS h FROM stu JOIN student_info i USING ({K3J})),
us AS (SELECT {K3J}, final_result, b, ('0x' || substr(h, 8 * b::INT + 1, 8))::BIGINT AS u FROM hx, range({_REPLICATES}) t(b)),
ws AS (SELECT {K3J}, final_result, b, {_WEIGHT} AS w FROM us),
ns AS (SELECT final_result, b, sum(w) AS n FROM ws GROUP BY ALL),
ss AS (SELECT ws.final_result, ws.b, d.date, sum(ws.w * d.c) AS s FROM ws JOIN d USING ({K3J}) GROUP BY ALL),
reps AS (SELECT ns.final_result, g.range AS date, coalesce(ss.s, 0)::DOUBLE / ns.n AS m
  FROM ns CROSS JOIN range((SELECT lo FROM rng), (SELECT hi FROM rng) + 1) g
  LEFT JOIN ss ON ss.final_result = ns.final_result AND ss.b = ns.b AND ss.date = g.range WHERE ns.n > 0),
band AS (SELECT final_result, date, quantile_cont(m, 0.025) AS low, quantile_cont(m, 0.975) AS high FROM reps GROUP BY ALL),
pn AS (SELECT final_result, count(*) AS n FROM hx GROUP BY ALL),
ps AS (SELECT i.final_result, d.date, sum(d.c) AS s FROM d JOIN student_info i USING ({K3J}) GROUP BY ALL)
SELECT band.final_result, CAST(band.date AS BIGINT) AS date, coalesce(ps.s, 0)::DOUBLE / pn.n AS mean, low, high
FROM band JOIN pn USING (final_result) LEFT JOIN ps USING (final_result, date)""")
def e28_bootstrap_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean daily clicks per outcome and day with the 95 % band of 64 Poisson bootstrap replicates."""
    daily, info, lo, hi = _daily_range(spark, sf_dir)
    return stats.bootstrap_bands(daily, info, lo, hi, _REPLICATES)


@query("e29_activity_date_profile", f"""
j AS (SELECT i.final_result, v.activity_type, s.date, s.sum_click FROM student_vle s
  JOIN vle v USING (code_module, code_presentation, id_site) JOIN student_info i USING ({K3J})),
m AS (SELECT final_result, activity_type, date, avg(sum_click) AS mean_clicks FROM j GROUP BY ALL)
SELECT final_result, activity_type, date, mean_clicks / sum(mean_clicks) OVER (PARTITION BY final_result) AS share FROM m""")
def e29_activity_date_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean clicks per (outcome, activity, day), normalised within each outcome."""
    raw = _raw(spark, sf_dir)
    cs = clicks.clicks_with_sites(raw["student_vle"], raw["vle"], "inner")
    return stats.activity_date_profile(cs, raw["student_info"])


# ---------------------------------------------------------------- E30
@query("e30_unregistration_histogram", """
r AS (SELECT date_unregistration AS x FROM student_registration WHERE date_unregistration IS NOT NULL),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM r)
SELECT CAST(least(floor((CAST(x AS DOUBLE) - lo) / (hi - lo) * 10) + 1, 10) AS BIGINT) AS bin, CAST(count(*) AS BIGINT) AS n
FROM r, b GROUP BY 1""")
def e30_unregistration_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten equal-width bins of the unregistration day (data behind the histogram)."""
    reg = _raw(spark, sf_dir)["student_registration"].where(F.col("date_unregistration").isNotNull())
    lo, hi = reg.agg(F.min("date_unregistration"), F.max("date_unregistration")).first()
    return stats.histogram(reg, "date_unregistration", lo, hi, 10)


_QUART = "[CAST(0 AS DOUBLE), CAST(0.25 AS DOUBLE), CAST(0.5 AS DOUBLE), CAST(0.75 AS DOUBLE), CAST(1 AS DOUBLE)]"


@query("e30_consistency_quartiles", outcome_metrics_sql() + f"""
SELECT "group", unnest({_QUART}) AS q, unnest(quantile_cont(consistency, {_QUART})) AS value FROM om
WHERE consistency IS NOT NULL GROUP BY 1""")
def e30_consistency_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box-plot quartiles of consistency per outcome group (exact, per group)."""
    om = outcome_metrics(_raw(spark, sf_dir))
    return stats.exact_quantiles(om, "consistency", [0.0, 0.25, 0.5, 0.75, 1.0], by=["group"])


@query("e30_unregistration_density", """
r AS (SELECT date_unregistration AS x FROM student_registration WHERE date_unregistration IS NOT NULL),
st AS (SELECT count(*) AS n, min(x) AS lo, max(x) AS hi, stddev_samp(x) * pow(4.0 / (3 * count(*)), 0.2) AS w FROM r),
g AS (SELECT unnest(range((lo - ceil(3 * w))::BIGINT, (hi + ceil(3 * w))::BIGINT + 1)) AS x FROM st)
SELECT g.x::DOUBLE AS x, sum(exp(-pow((g.x - r.x) / w, 2) / 2) / (w * sqrt(2 * pi()))) / max(n) AS density
FROM g, r, st GROUP BY g.x""")
def e30_unregistration_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kernel density of the unregistration day on whole days (Silverman width)."""
    return stats.density(_raw(spark, sf_dir)["student_registration"], "date_unregistration", 1.0)


@query("e30_entropy_density", _ENT + """,
r2 AS (SELECT round(entropy_date / 0.25) AS vx, round(entropy_acty / 0.25) AS vy, entropy_date, entropy_acty FROM ent
  WHERE entropy_date IS NOT NULL AND entropy_acty IS NOT NULL),
st AS (SELECT count(*) AS n, min(vx) AS lx, max(vx) AS hx, min(vy) AS ly, max(vy) AS hy,
  stddev_samp(entropy_date) * pow(1.0 / count(*), 1.0 / 6) AS wx, stddev_samp(entropy_acty) * pow(1.0 / count(*), 1.0 / 6) AS wy FROM r2),
gx AS (SELECT unnest(range((lx - ceil(3 * wx / 0.25))::BIGINT, (hx + ceil(3 * wx / 0.25))::BIGINT + 1)) AS gx FROM st),
gy AS (SELECT unnest(range((ly - ceil(3 * wy / 0.25))::BIGINT, (hy + ceil(3 * wy / 0.25))::BIGINT + 1)) AS gy FROM st)
SELECT gx * 0.25 AS x, gy * 0.25 AS y, sum(exp(-pow((gx - vx) * 0.25 / wx, 2) / 2 - pow((gy - vy) * 0.25 / wy, 2) / 2)
  / (wx * wy * 2 * pi())) / max(n) AS density FROM gx, gy, r2, st GROUP BY gx, gy""")
def e30_entropy_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joint density of day and activity entropy on a grid of quarters (Silverman widths)."""
    return stats.density2(_ent(spark, sf_dir), ["entropy_date", "entropy_acty"], [0.25, 0.25])


@query("e22_student_click_quartiles", f"""
d AS (SELECT {K3J}, date, sum(sum_click) AS c FROM student_vle GROUP BY ALL)
SELECT {K3J}, unnest({_QUART}) AS q, unnest(quantile_cont(c::DOUBLE, {_QUART})) AS value FROM d GROUP BY {K3J}""")
def e22_student_click_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles of the daily clicks of every student (a group a student)."""
    daily = clicks.daily_clicks(_raw(spark, sf_dir)["student_vle"])
    return stats.group_quantiles(daily, "sum_click", [0.0, 0.25, 0.5, 0.75, 1.0], K3)


# ---------------------------------------------------------------- M1 / M2
_ANOVA = outcome_metrics_sql() + f""",
long AS ({" UNION ALL ".join(f"SELECT '{m}' AS metric, \"group\" AS g, {m} AS v FROM om WHERE {m} IS NOT NULL AND NOT isnan({m})" for m in METRICS)}),
gs AS (SELECT metric, g, count(*) AS n, avg(v) AS mean, var_samp(v) AS var FROM long GROUP BY ALL),
an_tot AS (SELECT metric, sum(n) AS nn, count(*) AS k, sum(n * mean) / sum(n) AS grand FROM gs GROUP BY ALL),
an AS (SELECT gs.metric, (sum(gs.n * pow(gs.mean - an_tot.grand, 2)) / (max(an_tot.k) - 1))
  / (sum((gs.n - 1) * COALESCE(gs.var, 0)) / (max(an_tot.nn) - max(an_tot.k))) AS f_stat,
  CAST(max(an_tot.k) - 1 AS BIGINT) AS df_between, CAST(max(an_tot.nn) - max(an_tot.k) AS BIGINT) AS df_within
FROM gs JOIN an_tot USING (metric) GROUP BY gs.metric)"""


@query("m1_anova_f", _ANOVA + "\nSELECT * FROM an")
def m1_anova_f(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-way ANOVA F of each metric across Pass / Fail / Withdrawn (NULLs dropped per metric)."""
    return stats.anova_groups(outcome_metrics(_raw(spark, sf_dir)), METRICS, "group")


# three groups: with 2 and d degrees of freedom P(F > f) is (1 + 2 f / d) ^ (-d / 2)
@query("m1_anova_pvalue", _ANOVA + """
SELECT metric, f_stat, CASE df_between WHEN 2 THEN pow(1 + 2 * f_stat / df_within, -df_within / 2.0) END AS p_value, df_between, df_within FROM an""")
def m1_anova_pvalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ANOVA F with its p-value (F-distribution tail from the incomplete beta function)."""
    return stats.anova(outcome_metrics(_raw(spark, sf_dir)), METRICS, "group")


@query("m2_pairwise_corr", outcome_metrics_sql() + ",\npairs AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS m1, '{b}' AS m2, corr({a}, {b}) AS r FROM om" for i, a in enumerate(METRICS) for b in METRICS[i:])
    + ")\nSELECT * FROM pairs UNION ALL SELECT m2, m1, r FROM pairs WHERE m1 <> m2")
def m2_pairwise_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pearson correlation of every pair of the ten metrics over pairwise-complete rows."""
    return stats.pairwise_corr(outcome_metrics(_raw(spark, sf_dir)), METRICS)


@query("e26_daily_wide")
def e26_daily_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily clicks per student, one zero-filled column per day of the log (wide form; its column
    names depend on the day range, so it is checked by rows; e26_dense_daily is the long form)."""
    raw = _raw(spark, sf_dir)
    lo, hi = raw["student_vle"].agg(F.min("date"), F.max("date")).first()
    return stats.daily_wide(clicks.daily_clicks(raw["student_vle"]), lo, hi)

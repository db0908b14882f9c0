"""Checked queries: click filters (B), joins (D) and click aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursepulse.functions.columns import day_in_segment, segment_of
from coursepulse.functions.dims import mark_bounded, row_bound
from coursepulse.operators import checks, clicks
from coursepulse.operators.features import Feature
from coursepulse.operators.numbering import number_rows
from coursepulse.plans import feature_pool as fp
from coursepulse.plans.registry import query
from coursepulse.plans.sql_parts import K3S
from coursepulse.schema import K2, K3
from coursepulse.sources.fixture import fixture_tables

K3J = "code_module, code_presentation, id_student"
SCHED = f"""sched AS (SELECT code_module, code_presentation,
  list_sort(list(date) FILTER (WHERE date IS NOT NULL))[1:3] AS dates FROM assessments GROUP BY code_module, code_presentation)"""
FIRST = "fa AS (SELECT code_module, code_presentation, min(date) AS first_assessment_date FROM assessments GROUP BY ALL)"


def _raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return fixture_tables(spark, sf_dir)


# ---------------------------------------------------------------- B: click filters
@query("b5_drop_precourse", f"SELECT {K3S}, id_site, date, sum_click FROM student_vle WHERE date >= 0")
def b5_drop_precourse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks on or after the course start."""
    return clicks.drop_precourse(_raw(spark, sf_dir)["student_vle"])


@query("b6_clicks_up_to_first_test", SCHED + f""",
sv AS (SELECT s.*, sc.dates FROM student_vle s LEFT JOIN sched sc USING (code_module, code_presentation))
SELECT {K3S}, id_site, date, sum_click FROM sv WHERE date >= 0 AND date <= dates[1]""")
def b6_clicks_up_to_first_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks from day 0 up to the first test date of the course."""
    raw = _raw(spark, sf_dir)
    return clicks.clicks_up_to_test(raw["student_vle"], raw["assessments"], 0)


@query("b6_clicks_up_to_third_test", SCHED + f""",
sv AS (SELECT s.*, sc.dates FROM student_vle s LEFT JOIN sched sc USING (code_module, code_presentation))
SELECT {K3S}, id_site, date, sum_click FROM sv WHERE date >= 0 AND date <= dates[3]""")
def b6_clicks_up_to_third_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks from day 0 up to the third test date of the course."""
    raw = _raw(spark, sf_dir)
    return clicks.clicks_up_to_test(raw["student_vle"], raw["assessments"], 2)


@query("b7_before_first_assessment", FIRST + f"""
SELECT s.code_module, s.code_presentation, s.id_student, s.id_site, s.date, s.sum_click
FROM student_vle s JOIN fa USING (code_module, code_presentation) WHERE s.date < fa.first_assessment_date""")
def b7_before_first_assessment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks strictly before the first assessment of the course."""
    raw = _raw(spark, sf_dir)
    return clicks.clicks_before_first_assessment(raw["student_vle"], raw["assessments"])


@query("b8_pre_test_clicks", FIRST + f"""
SELECT s.code_module, s.code_presentation, s.id_student, s.id_site, s.date, s.sum_click,
 fa.first_assessment_date AS date_assessment, r.date_unregistration
FROM student_vle s LEFT JOIN fa USING (code_module, code_presentation)
LEFT JOIN student_registration r USING ({K3S})
WHERE s.date <= fa.first_assessment_date AND NOT COALESCE(r.date_unregistration <= 7, false)""")
def b8_pre_test_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks up to the first assessment without students unregistered by day 7 (NULL date kept)."""
    raw = _raw(spark, sf_dir)
    return clicks.pre_test_clicks(raw["student_vle"], raw["assessments"], raw["student_registration"]).select(
        *K3, "id_site", "date", "sum_click", "date_assessment", "date_unregistration")


@query("b13_pass_clicks_per_day", f"""
SELECT s.date, CAST(sum(s.sum_click) AS BIGINT) AS sum_click, CAST(count(DISTINCT s.id_student) AS BIGINT) AS n_students
FROM student_vle s JOIN student_info i USING ({K3S}) WHERE i.final_result = 'Pass' GROUP BY s.date""")
def b13_pass_clicks_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome filter: daily clicks and active students among students who passed."""
    raw = _raw(spark, sf_dir)
    daily = clicks.daily_clicks(raw["student_vle"])
    passed = raw["student_info"].where(F.col("final_result") == "Pass").select(*K3)
    return (daily.join(passed, K3, "left_semi").groupBy("date")
            .agg(F.sum("sum_click").alias("sum_click"), F.count(F.lit(1)).alias("n_students")))


@query("b14_sample_per_outcome")
def b14_sample_per_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded 10 % sample of the students of each outcome, exact size per outcome (a sampling
    operator: rows only)."""
    from coursepulse.operators.stats import sample_per_outcome
    si = _raw(spark, sf_dir)["student_info"]
    return sample_per_outcome(si, "final_result", 0.1, seed=7, keys=K3)


@query("b14_sample_sizes", """
SELECT final_result, CAST(round_even(0.1 * count(*), 0) AS BIGINT) AS n, CAST(round_even(0.1 * count(*), 0) AS BIGINT) AS n_students
FROM student_info GROUP BY final_result HAVING round_even(0.1 * count(*), 0) > 0""")
def b14_sample_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the 10 % sample per outcome, and how many of them are distinct students of the table."""
    si = _raw(spark, sf_dir)["student_info"]
    sample = b14_sample_per_outcome(spark, sf_dir)
    known = sample.join(si.select(*K3, "final_result"), [*K3, "final_result"], "left_semi").distinct()
    n = sample.groupBy("final_result").agg(F.count(F.lit(1)).alias("n"))
    return n.join(known.groupBy("final_result").agg(F.count(F.lit(1)).alias("n_students")), "final_result")


@query("b15_subject_numbers", f"""
SELECT {K3S}, CAST(row_number() OVER (ORDER BY {K3S}) - 1 AS BIGINT) AS subject
FROM (SELECT DISTINCT {K3S} FROM student_info)""")
def b15_subject_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct students numbered 0.. in key order (range-partitioned, offsets per partition)."""
    si = _raw(spark, sf_dir)["student_info"].select(*K3).dropDuplicates(K3)
    return number_rows(si, K3, "subject")


# ---------------------------------------------------------------- D: joins
@query("d1_clicks_by_activity", """
SELECT v.activity_type, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(s.sum_click) AS BIGINT) AS sum_click
FROM student_vle s LEFT JOIN vle v USING (code_module, code_presentation, id_site) GROUP BY v.activity_type""")
def d1_clicks_by_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks LEFT sites: clicks of unknown sites keep a NULL activity."""
    raw = _raw(spark, sf_dir)
    j = clicks.clicks_with_sites(raw["student_vle"], raw["vle"], "left")
    return j.groupBy("activity_type").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("sum_click").alias("sum_click"))


@query("d2_clicks_inner_sites", f"""
SELECT {K3S}, s.id_site, s.date, s.sum_click, v.activity_type
FROM student_vle s JOIN vle v USING (code_module, code_presentation, id_site)""")
def d2_clicks_inner_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks INNER sites (clicks of unknown sites dropped)."""
    raw = _raw(spark, sf_dir)
    return clicks.clicks_with_sites(raw["student_vle"], raw["vle"], "inner").select(
        *K3, "id_site", "date", "sum_click", "activity_type")


@query("d3_full_outer_indicator", """
SELECT CASE WHEN s.id_student IS NOT NULL AND v.activity_type IS NOT NULL THEN 'both'
 WHEN s.id_student IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS _merge, CAST(count(*) AS BIGINT) AS n
FROM student_vle s FULL OUTER JOIN vle v ON s.code_module = v.code_module AND s.code_presentation = v.code_presentation
 AND s.id_site = v.id_site GROUP BY 1""")
def d3_full_outer_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks FULL OUTER sites with the merge indicator, counted."""
    raw = _raw(spark, sf_dir)
    sites = raw["vle"].select(*clicks.SITE_KEY, "activity_type")
    j = checks.merge_with_indicator(raw["student_vle"], mark_bounded(sites, row_bound(raw["vle"])),
                                    clicks.SITE_KEY, "outer")
    return checks.indicator_counts(j)


@query("d4_info_registration", f"""
SELECT i.code_module, i.code_presentation, i.id_student, i.final_result, r.date_registration, r.date_unregistration
FROM student_info i JOIN student_registration r USING ({K3S})""")
def d4_info_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Info INNER registration on the student key."""
    raw = _raw(spark, sf_dir)
    return raw["student_info"].select(*K3, "final_result").join(
        raw["student_registration"].select(*K3, "date_registration", "date_unregistration"), K3, "inner")


@query("d7_active_students_by_outcome", f"""
SELECT i.final_result, CAST(count(*) AS BIGINT) AS n_students, CAST(sum(d.n_days) AS BIGINT) AS n_days
FROM student_info i JOIN (SELECT {K3S}, count(DISTINCT date) AS n_days FROM student_vle GROUP BY {K3S}) d USING ({K3S})
GROUP BY i.final_result""")
def d7_active_students_by_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Info INNER daily-click table: active students and active days per outcome."""
    raw = _raw(spark, sf_dir)
    days = clicks.daily_clicks(raw["student_vle"]).groupBy(*K3).agg(F.count(F.lit(1)).alias("n_days"))
    return (raw["student_info"].select(*K3, "final_result").join(days, K3, "inner")
            .groupBy("final_result").agg(F.count(F.lit(1)).alias("n_students"), F.sum("n_days").alias("n_days")))


@query("d8_students_clicks_sites", f"""
SELECT i.code_module, i.code_presentation, i.id_student, s.date, s.id_site, s.sum_click, v.activity_type
FROM (SELECT * FROM student_info WHERE final_result <> 'Withdrawn') i
LEFT JOIN student_vle s USING ({K3S})
LEFT JOIN vle v ON v.code_module = i.code_module AND v.code_presentation = i.code_presentation AND v.id_site = s.id_site""")
def d8_students_clicks_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-withdrawn students LEFT clicks LEFT sites (students without clicks kept once)."""
    raw = _raw(spark, sf_dir)
    st = raw["student_info"].where(F.col("final_result") != "Withdrawn").select(*K3)
    j = clicks.left_join_many(st, raw["student_vle"].select(*K3, "date", "id_site", "sum_click"), K3)
    return clicks.clicks_with_sites(j, raw["vle"], "left").select(*K3, "date", "id_site", "sum_click", "activity_type")


@query("d10_registration_indicator", f"""
SELECT CASE WHEN r.id_student IS NULL THEN 'left_only' ELSE 'both' END AS _merge, CAST(count(*) AS BIGINT) AS n
FROM student_info i LEFT JOIN student_registration r USING ({K3S}) GROUP BY 1""")
def d10_registration_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Info LEFT registration with the merge indicator, counted."""
    raw = _raw(spark, sf_dir)
    reg = raw["student_registration"].drop("date_unregistration")
    return checks.indicator_counts(checks.merge_with_indicator(raw["student_info"].select(*K3), reg, K3, "left"))


@query("d15_merge_outer", f"""
r AS (SELECT {K3S}, CAST(1 AS DOUBLE) AS responce FROM student_info WHERE final_result = 'Fail'),
e AS (SELECT {K3S}, CAST(sum(sum_click) FILTER (WHERE date BETWEEN 0 AND 32) AS BIGINT) AS effort FROM student_vle GROUP BY ALL)
SELECT COALESCE(r.code_module, e.code_module) AS code_module, COALESCE(r.code_presentation, e.code_presentation) AS code_presentation,
 COALESCE(r.id_student, e.id_student) AS id_student, r.responce, COALESCE(e.effort, CASE WHEN e.id_student IS NOT NULL THEN 0 END) AS effort
FROM r FULL OUTER JOIN e ON r.code_module = e.code_module AND r.code_presentation = e.code_presentation AND r.id_student = e.id_student""")
def d15_merge_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature merge with how='outer': failing students and click effort, union of both row sets."""
    raw = _raw(spark, sf_dir)
    resp = fp.get_response(raw, [["Fail"]])["responce"]
    eff = fp.get_effort(raw, 0, 32)["effort"]
    resp_fail = Feature("responce", resp.data.withColumn("responce", F.lit(1.0)), K3)
    return resp_fail.merge(eff, how="outer").data


@query("d15_merge_inner", f"""
r AS (SELECT {K3S}, CAST(1 AS DOUBLE) AS responce FROM student_info WHERE final_result = 'Fail'),
e AS (SELECT {K3S}, CAST(COALESCE(sum(sum_click) FILTER (WHERE date BETWEEN 0 AND 32), 0) AS BIGINT) AS effort FROM student_vle GROUP BY ALL)
SELECT {K3S}, r.responce, e.effort FROM r JOIN e USING ({K3S})""")
def d15_merge_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature merge with how='inner'."""
    raw = _raw(spark, sf_dir)
    resp = fp.get_response(raw, [["Fail"]])["responce"]
    resp_fail = Feature("responce", resp.data.withColumn("responce", F.lit(1.0)), K3)
    return resp_fail.merge(fp.get_effort(raw, 0, 32)["effort"], how="inner").data


# ---------------------------------------------------------------- E1-E7: click aggregates
@query("e1_clicks_by_date_sum", f"SELECT {K3S}, date, CAST(sum(sum_click) AS BIGINT) AS sum_click FROM student_vle GROUP BY {K3S}, date")
def e1_clicks_by_date_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return clicks.aggregate_clickstream(raw["student_vle"], raw["vle"], ["date"], "sum")


@query("e1_clicks_by_activity_mean", f"""
SELECT {K3S}, v.activity_type, avg(s.sum_click) AS sum_click FROM student_vle s JOIN vle v USING (code_module, code_presentation, id_site)
GROUP BY {K3S}, v.activity_type""")
def e1_clicks_by_activity_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return clicks.aggregate_clickstream(raw["student_vle"], raw["vle"], ["activity_type"], "mean")


@query("e1_clicks_by_date_activity_std", f"""
SELECT {K3S}, s.date, v.activity_type, stddev_samp(s.sum_click) AS sum_click
FROM student_vle s JOIN vle v USING (code_module, code_presentation, id_site) GROUP BY {K3S}, s.date, v.activity_type""")
def e1_clicks_by_date_activity_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return clicks.aggregate_clickstream(raw["student_vle"], raw["vle"], ["date", "activity_type"], "std")


@query("e1_clicks_by_site_median", f"""
SELECT {K3S}, id_site, CAST(median(sum_click) AS DOUBLE) AS sum_click FROM student_vle GROUP BY {K3S}, id_site""")
def e1_clicks_by_site_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return clicks.aggregate_clickstream(raw["student_vle"], raw["vle"], ["id_site"], "median")


@query("e1_clicks_count_var", f"""
SELECT {K3S}, CAST(count(sum_click) AS BIGINT) AS n, var_samp(sum_click) AS v, CAST(min(sum_click) AS BIGINT) AS lo,
 CAST(max(sum_click) AS BIGINT) AS hi FROM student_vle GROUP BY {K3S}""")
def e1_clicks_count_var(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four aggregates of a student's clicks from one scan."""
    return _raw(spark, sf_dir)["student_vle"].groupBy(*K3).agg(
        F.count("sum_click").alias("n"), F.var_samp("sum_click").alias("v"), F.min("sum_click").alias("lo"),
        F.max("sum_click").alias("hi"))


def _nth_sql(descending: bool) -> str:
    way = "DESC" if descending else "ASC"
    return f"""
r AS (SELECT s.*, v.activity_type, row_number() OVER (PARTITION BY {K3J}, v.activity_type
  ORDER BY s.date {way}, s.id_site {way}, s.sum_click {way}) AS nth FROM student_vle s JOIN vle v USING (code_module, code_presentation, id_site))
SELECT {K3S}, activity_type, sum_click FROM r WHERE nth = 1"""


@query("e1_first_clicks_by_activity", _nth_sql(False))
def e1_first_clicks_by_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks of a student's first row of each activity (by day, site, clicks)."""
    raw = _raw(spark, sf_dir)
    return clicks.aggregate_clickstream(raw["student_vle"], raw["vle"], ["activity_type"], "first")


@query("e1_last_clicks_by_activity", _nth_sql(True))
def e1_last_clicks_by_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks of a student's last row of each activity (by day, site, clicks)."""
    raw = _raw(spark, sf_dir)
    return clicks.aggregate_clickstream(raw["student_vle"], raw["vle"], ["activity_type"], "last")


@query("e1_clicks_by_date_prod", f"SELECT {K3S}, date, ln(product(sum_click)) AS sum_click FROM student_vle GROUP BY {K3S}, date")
def e1_clicks_by_date_prod(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product of a student's clicks per day, as its logarithm (6 decimals of the product itself are beyond a double)."""
    out = clicks.aggregate_clickstream(_raw(spark, sf_dir)["student_vle"], None, ["date"], "prod")
    return out.withColumn("sum_click", F.ln("sum_click"))


@query("e1_clicks_sem", f"SELECT {K3S}, stddev_samp(sum_click) / sqrt(count(sum_click)) AS sum_click FROM student_vle GROUP BY {K3S}")
def e1_clicks_sem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard error of the mean of a student's clicks."""
    return clicks.aggregate_clickstream(_raw(spark, sf_dir)["student_vle"], None, [], "sem")


@query("e1_clicks_skew", f"""
m AS (SELECT {K3S}, avg(sum_click) AS mean, CAST(count(*) AS DOUBLE) AS n FROM student_vle GROUP BY {K3S}),
c AS (SELECT {K3S}, max(n) AS n, sum(pow(sum_click - mean, 2)) / max(n) AS m2, sum(pow(sum_click - mean, 3)) / max(n) AS m3
  FROM student_vle JOIN m USING ({K3J}) GROUP BY {K3S})
SELECT {K3S}, CASE WHEN n < 3 THEN NULL WHEN m2 = 0 THEN 0.0
  ELSE m3 / pow(m2, 1.5) * sqrt(n * (n - 1)) / (n - 2) END AS sum_click FROM c""")
def e1_clicks_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bias-corrected skewness of a student's clicks."""
    return clicks.aggregate_clickstream(_raw(spark, sf_dir)["student_vle"], None, [], "skew")


@query("e1_clicks_by_date_nunique", f"""
SELECT {K3S}, date, CAST(count(DISTINCT sum_click) AS BIGINT) AS sum_click FROM student_vle GROUP BY {K3S}, date""")
def e1_clicks_by_date_nunique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of different click counts of a student per day."""
    return clicks.aggregate_clickstream(_raw(spark, sf_dir)["student_vle"], None, ["date"], "nunique")


def _seq_sql(start: int, end: int) -> str:
    return f"""
d AS (SELECT {K3S}, date, sum(sum_click) AS w FROM student_vle GROUP BY {K3S}, date)
SELECT {K3S},
 COALESCE(string_agg(CAST(date AS VARCHAR), ',' ORDER BY date) FILTER (WHERE date BETWEEN {start} AND {end}), '') AS timestamps,
 COALESCE(string_agg(CAST(w AS VARCHAR), ',' ORDER BY date) FILTER (WHERE date BETWEEN {start} AND {end}), '') AS intensity
FROM d GROUP BY {K3S}"""


@query("e2_sequences", _seq_sql(0, 32))
def e2_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per student: day and click sequences inside [0, 32], sorted (shown joined by commas)."""
    daily = clicks.daily_clicks(_raw(spark, sf_dir)["student_vle"])
    seq = clicks.clickstream_sequences(daily, 0, 32)
    return seq.select(*K3, F.array_join("timestamps", ",").alias("timestamps"),
                      F.array_join("intensity", ",").alias("intensity"))


@query("e2_sequences_narrow", _seq_sql(10, 12))
def e2_sequences_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of a 3-day window: students without a click inside keep empty sequences."""
    daily = clicks.daily_clicks(_raw(spark, sf_dir)["student_vle"])
    seq = clicks.clickstream_sequences(daily, 10, 12)
    return seq.select(*K3, F.array_join("timestamps", ",").alias("timestamps"),
                      F.array_join("intensity", ",").alias("intensity"))


def _effort_sql(start: int, end: int) -> str:
    return (f"SELECT {K3S}, CAST(COALESCE(sum(sum_click) FILTER (WHERE date BETWEEN {start} AND {end}), 0) AS BIGINT) "
            f"AS effort FROM student_vle GROUP BY {K3S}")


@query("e3_effort", _effort_sql(0, 32))
def e3_effort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total clicks in [0, 32] per student with any click."""
    return fp.get_effort(_raw(spark, sf_dir), 0, 32)["effort"].data


@query("e3_effort_single_day", _effort_sql(10, 10))
def e3_effort_single_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Effort of day 10 only: students active on other days only get 0."""
    return fp.get_effort(_raw(spark, sf_dir), 10, 10)["effort"].data


@query("e4_test_schedule", f"""
SELECT code_module, code_presentation, array_to_string(list_sort(list(date) FILTER (WHERE date IS NOT NULL))[1:3], ',') AS dates
FROM assessments GROUP BY code_module, code_presentation""")
def e4_test_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First three assessment dates per course (NULL dates left out)."""
    s = clicks.test_schedule(_raw(spark, sf_dir)["assessments"], 3)
    return s.select(*K2, F.array_join("dates", ",").alias("dates"))


@query("e5_first_assessment", "SELECT code_module, code_presentation, min(date) AS first_assessment_date FROM assessments GROUP BY ALL")
def e5_first_assessment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.first_assessment(_raw(spark, sf_dir)["assessments"])


@query("e6_segments", """
SELECT date, CAST(ceil(date / CAST(30 AS DOUBLE)) AS BIGINT) AS seg30,
 CAST(date - (ceil(date / CAST(30 AS DOUBLE)) - 1) * 30 AS BIGINT) AS day30,
 CAST(ceil(date / CAST(7 AS DOUBLE)) AS BIGINT) AS seg7,
 CAST(date - (ceil(date / CAST(7 AS DOUBLE)) - 1) * 7 AS BIGINT) AS day7
FROM (SELECT DISTINCT date FROM student_vle)""")
def e6_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment and day-in-segment of every click day, for 30- and 7-day segments."""
    d = F.col("date")
    days = _raw(spark, sf_dir)["student_vle"].select("date").distinct()
    return days.select("date", segment_of(d, 30).alias("seg30"), day_in_segment(d, 30).alias("day30"),
                       segment_of(d, 7).alias("seg7"), day_in_segment(d, 7).alias("day7"))


@query("e7_segment_effort", f"""
SELECT {K3S}, CAST(ceil(date / CAST(7 AS DOUBLE)) AS BIGINT) AS temperal_seg, CAST(sum(sum_click) AS BIGINT) AS sum_click
FROM student_vle GROUP BY ALL""")
def e7_segment_effort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks per (student, 7-day segment)."""
    return clicks.segment_effort(_raw(spark, sf_dir)["student_vle"], 7)

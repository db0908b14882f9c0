"""Checked queries: time regularity, activity regularity, procrastination and their outcome table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursepulse.operators import clicks, regularity
from coursepulse.plans import feature_pool as fp
from coursepulse.plans.registry import query
from coursepulse.plans.sql_parts import regularity_ctes
from coursepulse.schema import ACTIVITIES, K3, OUTCOME_GROUP
from coursepulse.sources.fixture import fixture_tables

K3J = "code_module, code_presentation, id_student"
SCHED = """sched AS (SELECT code_module, code_presentation,
  list_sort(list(date) FILTER (WHERE date IS NOT NULL))[1:3] AS dates FROM assessments GROUP BY code_module, code_presentation)"""
ACT_LIST = ", ".join(f"'{a}'" for a in ACTIVITIES)


def _raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return fixture_tables(spark, sf_dir)


def _time_sql(start: int, end: int) -> str:
    return f"""sv AS (SELECT * FROM student_vle),
{regularity_ctes('sv', start, end)}
SELECT {K3J}, pwd AS regularity_indicator_pwd, ws1 AS regularity_indicator_ws1, ws2 AS regularity_indicator_ws2,
 ws3 AS regularity_indicator_ws3, fwd AS regularity_indicator_fwd FROM r_all"""


@query("f1_time_regularity", _time_sql(0, 32))
def f1_time_regularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pwd, ws1, ws2, ws3, fwd over days [0, 32] for every student with a click."""
    return fp.merge_features(fp.get_time_regularity(_raw(spark, sf_dir), 0, 32))


@query("f1_time_regularity_shifted", _time_sql(3, 19))
def f1_time_regularity_shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time regularity over [3, 19] (weekdays counted from the window start; NULL without clicks inside)."""
    return fp.merge_features(fp.get_time_regularity(_raw(spark, sf_dir), 3, 19))


def _act_ctes(end_expr: str, start: int = 0) -> str:
    return f"""
ac AS (SELECT s.code_module, s.code_presentation, s.id_student, s.date, v.activity_type, sum(s.sum_click) AS c
  FROM student_vle s JOIN vle v USING (code_module, code_presentation, id_site) WHERE s.date >= 0 GROUP BY ALL),
b AS (SELECT ac.* FROM ac LEFT JOIN sched USING (code_module, code_presentation)
  WHERE ac.date >= {start} AND ac.date <= {end_expr} AND ac.activity_type IN ({ACT_LIST})),
tot AS (SELECT {K3J}, sum(c) AS t FROM b GROUP BY ALL),
acts AS (SELECT b.code_module, b.code_presentation, b.id_student, b.activity_type, CAST(sum(b.c) AS DOUBLE) / max(tot.t) AS q
  FROM b JOIN tot USING ({K3J}) GROUP BY ALL),
days AS (SELECT {K3J}, date, sum(c) AS dtot FROM b GROUP BY ALL),
grid AS (SELECT d.code_module, d.code_presentation, d.id_student, d.date, a.activity_type, a.q,
  CAST(COALESCE(b.c, 0) AS DOUBLE) / d.dtot AS p
  FROM days d JOIN acts a USING ({K3J}) LEFT JOIN b USING ({K3J}, date, activity_type)),
jsd AS (SELECT {K3J}, date, sum(CASE WHEN p > 0 THEN 0.5 * p * ln(2 * p / (p + q)) ELSE 0 END
  + CASE WHEN q > 0 THEN 0.5 * q * ln(2 * q / (p + q)) ELSE 0 END) AS j FROM grid GROUP BY ALL),
conc AS (SELECT {K3J}, 1 - (-sum(q * log2(q))) / log2({len(ACTIVITIES)}) AS concentration FROM acts GROUP BY ALL),
cons AS (SELECT {K3J}, 1 - avg(j) / ln(2) AS consistency FROM jsd GROUP BY ALL),
ar AS (SELECT * FROM conc JOIN cons USING ({K3J}))"""


def _act_sql(end_expr: str, start: int = 0) -> str:
    return f"{SCHED},{_act_ctes(end_expr, start)}\nSELECT * FROM ar"


@query("f7_activity_regularity", _act_sql("dates[1]"))
def f7_activity_regularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concentration and consistency over the clicks up to the first test date."""
    raw = _raw(spark, sf_dir)
    return regularity.activity_regularity(raw["student_vle"], raw["vle"], raw["assessments"], 0)


@query("f7_activity_regularity_range", _act_sql("20", start=5))
def f7_activity_regularity_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concentration and consistency over a user-defined day range [5, 20]."""
    raw = _raw(spark, sf_dir)
    return regularity.activity_regularity(raw["student_vle"], raw["vle"], user_defined_range=(5, 20))


def _proc_ctes(end_expr: str, start: int = 0) -> str:
    inside = f"date >= {start} AND date <= e"
    x = f"(CAST(date - {start} AS DOUBLE) / (e - {start} + 1))"
    return f"""
d AS (SELECT {K3J}, code_module AS m, date, CAST(sum(sum_click) AS DOUBLE) AS w FROM student_vle WHERE date >= 0 GROUP BY ALL),
j AS (SELECT d.*, {end_expr} AS e FROM d LEFT JOIN sched USING (code_module, code_presentation)),
pr AS (SELECT {K3J},
 sum(w * {x}) FILTER (WHERE {inside}) / sum(w) FILTER (WHERE {inside}) AS proc1,
 sum(w * (1 / (1 - {x}))) FILTER (WHERE {inside}) / sum(w) FILTER (WHERE {inside}) AS proc2,
 sum(w * log2(1 + {x})) FILTER (WHERE {inside}) / sum(w) FILTER (WHERE {inside}) AS proc3
FROM j GROUP BY {K3J})"""


def _proc_sql(end_expr: str, start: int = 0) -> str:
    return f"{SCHED},{_proc_ctes(end_expr, start)}\nSELECT * FROM pr"


@query("f10_procrastination", _proc_sql("dates[1]"))
def f10_procrastination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click-weighted mean of x, 1/(1-x), log2(1+x) with x = day / (first test day + 1)."""
    raw = _raw(spark, sf_dir)
    return regularity.procrastination(raw["student_vle"], raw["assessments"], 0)


@query("f10_procrastination_third_test", _proc_sql("dates[3]"))
def f10_procrastination_third_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Procrastination up to the third test date."""
    raw = _raw(spark, sf_dir)
    return regularity.procrastination(raw["student_vle"], raw["assessments"], 2)


@query("f10_procrastination_range", _proc_sql("20", start=5))
def f10_procrastination_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Procrastination over a user-defined range [5, 20]."""
    raw = _raw(spark, sf_dir)
    return regularity.procrastination(raw["student_vle"], user_defined_range=(5, 20))


@query("f10_procrastination_own_measures", f"""{SCHED},
d AS (SELECT {K3J}, date, CAST(sum(sum_click) AS DOUBLE) AS w FROM student_vle WHERE date >= 0 GROUP BY ALL),
j AS (SELECT d.*, dates[1] AS e, CAST(date AS DOUBLE) / (dates[1] + 1) AS x FROM d LEFT JOIN sched USING (code_module, code_presentation))
SELECT {K3J}, sum(w * x * x) FILTER (WHERE date <= e) / sum(w) FILTER (WHERE date <= e) AS quadratic,
 sum(CASE WHEN x >= 0.75 THEN w ELSE 0 END) FILTER (WHERE date <= e) / sum(w) FILTER (WHERE date <= e) AS late_share
FROM j GROUP BY {K3J}""")
def f10_procrastination_own_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two measures given by the caller: the mean of x * x, and the share of clicks in the last quarter (an Arrow function)."""
    raw = _raw(spark, sf_dir)
    return regularity.procrastination(raw["student_vle"], raw["assessments"], 0, measures={
        "quadratic": lambda x: x * x, "late_share": regularity.arrow_measure(lambda x: x >= 0.75)})


METRICS = ["pwd", "ws1", "ws2", "ws3", "fwd", "concentration", "consistency", "proc1", "proc2", "proc3"]


def outcome_metrics(raw: dict[str, DataFrame]) -> DataFrame:
    """Info INNER the students' regularity and procrastination measures, with the outcome group."""
    measures = regularity.all_measures(raw["student_vle"], raw["vle"], raw["assessments"], 0, 32)
    group = F.create_map(*[x for k, v in OUTCOME_GROUP.items() for x in (F.lit(k), F.lit(v))])
    df = measures.join(raw["student_info"].select(*K3, "final_result"), K3, "inner")
    return df.withColumn("group", F.try_element_at(group, F.col("final_result")))


def outcome_metrics_sql() -> str:
    t = _time_sql(0, 32).split("\nSELECT")[0]
    return f"""{SCHED},
{t},{_act_ctes("dates[1]")},{_proc_ctes("dates[1]")},
om AS (SELECT r.code_module, r.code_presentation, r.id_student, r.pwd, r.ws1, r.ws2, r.ws3, r.fwd, i.final_result,
  ar.concentration, ar.consistency, pr.proc1, pr.proc2, pr.proc3,
  CASE i.final_result WHEN 'Distinction' THEN 'Pass' ELSE i.final_result END AS "group"
  FROM r_all r JOIN student_info i USING ({K3J}) JOIN ar USING ({K3J}) JOIN pr USING ({K3J}))"""


@query("f11_outcome_metrics", outcome_metrics_sql() + "\nSELECT * FROM om")
def f11_outcome_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten regularity / procrastination metrics per student with the Pass / Fail / Withdrawn group."""
    return outcome_metrics(_raw(spark, sf_dir)).select(
        *K3, "pwd", "ws1", "ws2", "ws3", "fwd", "final_result", "concentration", "consistency",
        "proc1", "proc2", "proc3", "group")


"""Checked queries: shares and summaries per segment (E8-E14, H6-H9) and the entropy study."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursepulse.operators import distributions as dist
from coursepulse.plans import flows
from coursepulse.plans.registry import query
from coursepulse.schema import K3
from coursepulse.sources.fixture import fixture_tables

SEG_DAYS = 7  # the generated click log spans 30 days: 7-day segments give several segments
ACTS = ["forumng", "homepage", "oucontent", "quiz", "resource", "url"]  # activity types of the mapping
K3J = "code_module, code_presentation, id_student"


def _raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return fixture_tables(spark, sf_dir)


def _engagement_sql(n: int = SEG_DAYS, max_seg: int = 8) -> str:
    seg = f"CAST(ceil(s.date / CAST({n} AS DOUBLE)) AS BIGINT)"
    acts = ", ".join(f"COALESCE(max(share) FILTER (WHERE activity_type = '{a}'), 0) AS {a}" for a in ACTS)
    days = ", ".join(f"max(p) FILTER (WHERE day = {d}) AS day_{d}" for d in range(1, n + 1))
    return f"""
j AS (SELECT s.code_module, s.code_presentation, s.id_student, {seg} AS temperal_seg,
  s.date - ({seg} - 1) * {n} AS day, v.activity_type, s.sum_click
  FROM student_vle s LEFT JOIN vle v USING (code_module, code_presentation, id_site)),
eff AS (SELECT {K3J}, temperal_seg, sum(sum_click) AS tot FROM j GROUP BY ALL),
act AS (SELECT {K3J}, temperal_seg, activity_type, sum(sum_click) AS c FROM j WHERE activity_type IS NOT NULL GROUP BY ALL),
actp AS (SELECT {K3J}, temperal_seg, activity_type, CAST(c AS DOUBLE) / sum(c) OVER (PARTITION BY {K3J}, temperal_seg) AS share FROM act),
wide_act AS (SELECT {K3J}, temperal_seg, {acts} FROM actp GROUP BY ALL),
dd AS (SELECT {K3J}, temperal_seg, day, sum(sum_click) AS c FROM j GROUP BY ALL),
grid AS (SELECT e.code_module, e.code_presentation, e.id_student, e.temperal_seg, e.tot, g.range AS day
  FROM eff e CROSS JOIN range(1, {n + 1}) g),
dense AS (SELECT grid.*, CAST(COALESCE(dd.c, 0) AS DOUBLE) / grid.tot AS p FROM grid
  LEFT JOIN dd USING ({K3J}, temperal_seg, day)),
summ AS (SELECT {K3J}, temperal_seg, max(p) AS peak, ln(NULLIF(var_samp(p), 0)) AS variation,
  CASE WHEN var_pop(p) <= 1e-20 THEN 0 ELSE kurtosis(p) END AS kurtosis,
  -sum(CASE WHEN p > 0 THEN p * log2(p) ELSE 0 END) AS entropy, {days}
  FROM dense GROUP BY ALL),
flags AS (SELECT {K3J}, temperal_seg, day, p > 0 AS active,
  day - row_number() OVER (PARTITION BY {K3J}, temperal_seg, p > 0 ORDER BY day) AS grp FROM dense),
runs AS (SELECT {K3J}, temperal_seg, active, grp, count(*) AS len FROM flags GROUP BY ALL),
lr AS (SELECT {K3J}, temperal_seg, CAST(COALESCE(max(len) FILTER (WHERE NOT active), 0) AS BIGINT) AS longest_zeros,
  CAST(COALESCE(max(len) FILTER (WHERE active), 0) AS BIGINT) AS longest_ones FROM runs GROUP BY ALL),
eng AS (SELECT e.code_module, e.code_presentation, e.id_student, e.temperal_seg, CAST(e.tot AS BIGINT) AS sum_click,
  {", ".join(f"w.{a}" for a in ACTS)}, {", ".join(f"s.day_{d}" for d in range(1, n + 1))},
  s.peak, s.variation, s.kurtosis, l.longest_zeros, l.longest_ones, s.entropy
  FROM eff e LEFT JOIN wide_act w USING ({K3J}, temperal_seg) LEFT JOIN summ s USING ({K3J}, temperal_seg)
  LEFT JOIN lr l USING ({K3J}, temperal_seg) WHERE e.temperal_seg < {max_seg + 1})"""


@query("h8_engagement", _engagement_sql() + "\nSELECT * FROM eng")
def h8_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (student, 7-day segment): clicks, activity shares, day shares, peak, variation,
    kurtosis, longest inactive / active runs, entropy."""
    raw = _raw(spark, sf_dir)
    return flows.engagement(raw["student_vle"], raw["vle"], SEG_DAYS)


@query("h8_engagement_30day", _engagement_sql(30).replace("WHERE e.temperal_seg < 9", "WHERE e.temperal_seg < 9")
       + "\nSELECT * FROM eng")
def h8_engagement_30day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engagement with the default 30-day segments."""
    raw = _raw(spark, sf_dir)
    return flows.engagement(raw["student_vle"], raw["vle"], 30)


@query("e8_activity_shares", f"""
j AS (SELECT s.code_module, s.code_presentation, s.id_student, CAST(ceil(s.date / CAST(7 AS DOUBLE)) AS BIGINT) AS temperal_seg,
  v.activity_type, s.sum_click FROM student_vle s JOIN vle v USING (code_module, code_presentation, id_site)),
a AS (SELECT {K3J}, temperal_seg, activity_type, sum(sum_click) AS c FROM j GROUP BY ALL)
SELECT {K3J}, temperal_seg, activity_type, CAST(c AS DOUBLE) / sum(c) OVER (PARTITION BY {K3J}, temperal_seg) AS share FROM a""")
def e8_activity_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of clicks per activity type within each (student, segment), long form."""
    raw = _raw(spark, sf_dir)
    base = flows.segment_base(raw["student_vle"], raw["vle"], SEG_DAYS)
    from pyspark.sql import Window
    a = base.where(F.col("activity_type").isNotNull()).groupBy(*flows.KS, "activity_type").agg(F.sum("c").alias("c"))
    return a.select(*flows.KS, "activity_type", (F.col("c") / F.sum("c").over(Window.partitionBy(*flows.KS))).alias("share"))


@query("e13_longest_runs", _engagement_sql() + f"\nSELECT {K3J}, temperal_seg, longest_zeros, longest_ones FROM eng")
def e13_longest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longest run of inactive and of active days inside each segment."""
    raw = _raw(spark, sf_dir)
    return flows.engagement(raw["student_vle"], raw["vle"], SEG_DAYS).select(
        *flows.KS, "longest_zeros", "longest_ones")


@query("h9_merge_and_process", _engagement_sql() + f"""
SELECT i.code_module, i.code_presentation, i.id_student, i.num_of_prev_attempts, i.studied_credits,
 CASE i.final_result WHEN 'Fail' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS responce,
 e.temperal_seg, e.sum_click, e.peak, e.entropy, e.longest_ones
FROM student_info i LEFT JOIN eng e USING ({K3J}) WHERE i.final_result <> 'Withdrawn'""")
def h9_merge_and_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demographics LEFT engagement (students without clicks kept once with a NULL segment),
    unique (K3, segment), labelled rows only (selected columns)."""
    raw = _raw(spark, sf_dir)
    info, _ = flows.demographics(raw["student_info"])
    df = flows.merge_and_process(info, flows.engagement(raw["student_vle"], raw["vle"], SEG_DAYS))
    return df.select(*K3, "num_of_prev_attempts", "studied_credits", "responce", "temperal_seg", "sum_click",
                     "peak", "entropy", "longest_ones")


@query("d9_engagement_indicator", _engagement_sql() + f"""
SELECT CASE WHEN e.id_student IS NULL THEN 'left_only' ELSE 'both' END AS _merge, CAST(count(*) AS BIGINT) AS n
FROM student_info i LEFT JOIN eng e USING ({K3J}) GROUP BY 1""")
def d9_engagement_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of info LEFT engagement, counted by merge indicator."""
    raw = _raw(spark, sf_dir)
    eng = flows.engagement(raw["student_vle"], raw["vle"], SEG_DAYS)
    return flows.merge_indicator_counts(raw["student_info"].select(*K3), eng)


_SEG_VARYING = ["sum_click", "peak", "entropy"]


@query("h6_temporal_segment", _engagement_sql() + f""",
m AS (SELECT i.code_module, i.code_presentation, i.id_student, i.studied_credits,
  CASE i.final_result WHEN 'Fail' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS responce,
  e.temperal_seg, e.sum_click, e.peak, e.entropy
  FROM student_info i JOIN eng e USING ({K3J}) WHERE i.final_result <> 'Withdrawn')
SELECT {K3J}, max_by(responce, temperal_seg) AS responce,
 max(studied_credits) FILTER (WHERE temperal_seg = 2) AS studied_credits,
 {", ".join(f"max({c}) FILTER (WHERE temperal_seg = {s}) AS t{s}_{c}" for s in (1, 2) for c in _SEG_VARYING)}
FROM m WHERE temperal_seg IN (1, 2) GROUP BY ALL""")
def h6_temporal_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative wide table of segment 2: t1_* and t2_* columns, invariant columns from segment 2."""
    raw = _raw(spark, sf_dir)
    info, _ = flows.demographics(raw["student_info"])
    eng = flows.engagement(raw["student_vle"], raw["vle"], SEG_DAYS).select(*flows.KS, *_SEG_VARYING)
    data = info.select(*K3, "studied_credits", "responce").join(eng, K3, "inner")
    return flows.temporal_segment(data, 2, ["studied_credits"])


@query("h6_temporal_segment_0", _engagement_sql() + f""",
m AS (SELECT i.code_module, i.code_presentation, i.id_student,
  CASE i.final_result WHEN 'Fail' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS responce,
  e.temperal_seg, e.sum_click, e.peak, e.entropy
  FROM student_info i JOIN eng e USING ({K3J}) WHERE i.final_result <> 'Withdrawn')
SELECT {K3J}, max_by(responce, temperal_seg) AS responce,
 {", ".join(f"max({c}) AS t0_{c}" for c in _SEG_VARYING)}
FROM m WHERE temperal_seg = 0 GROUP BY ALL""")
def h6_temporal_segment_0(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment 0 (days before the start) stands alone."""
    raw = _raw(spark, sf_dir)
    info, _ = flows.demographics(raw["student_info"])
    eng = flows.engagement(raw["student_vle"], raw["vle"], SEG_DAYS).select(*flows.KS, *_SEG_VARYING)
    data = info.select(*K3, "responce").join(eng, K3, "inner")
    return flows.temporal_segment(data, 0, [])


# ---------------------------------------------------------------- entropy study
_ACT_BASE = f"""
ac AS (SELECT s.code_module, s.code_presentation, s.id_student, s.date, v.activity_type, sum(s.sum_click) AS sum_click
  FROM student_vle s JOIN vle v USING (code_module, code_presentation, id_site) WHERE s.date >= 0 GROUP BY ALL)"""


@query("e15_day_activity_maps", _ACT_BASE + f"""
SELECT {K3J}, date, string_agg(activity_type || '=' || CAST(sum_click AS VARCHAR), ',' ORDER BY activity_type) AS activities
FROM ac GROUP BY ALL""")
def e15_day_activity_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activity -> clicks map per student-day (shown as sorted entries)."""
    raw = _raw(spark, sf_dir)
    maps = dist.day_activity_maps(dist.activity_clicks(raw["student_vle"], raw["vle"]))
    entries = F.transform(F.map_entries("activities"),
                          lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return maps.select(*K3, "date", F.array_join(entries, ",").alias("activities"))


@query("e16_activity_matrix", _ACT_BASE + f""",
rows AS (SELECT {K3J}, date, '[' || array_to_string([{", ".join(
        "COALESCE(sum(sum_click) FILTER (WHERE activity_type = '" + a + "'), 0)" for a in
        ["forumng", "subpage", "oucontent", "homepage", "quiz", "resource", "url", "ouwiki", "externalquiz", "page",
         "oucollaborate", "questionnaire", "ouelluminate", "glossary", "dualpane", "dataplus", "folder",
         "sharedsubpage", "repeatactivity"])}], ',') || ']' AS r FROM ac GROUP BY ALL)
SELECT {K3J}, string_agg(CAST(date AS VARCHAR), ',' ORDER BY date) AS dates, string_agg(r, ';' ORDER BY date) AS matrix
FROM rows GROUP BY ALL""")
def e16_activity_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per student: day x activity click matrix over the fixed 19-activity list, days sorted."""
    raw = _raw(spark, sf_dir)
    m = dist.activity_matrix(dist.day_activity_maps(dist.activity_clicks(raw["student_vle"], raw["vle"])))
    rows = F.transform("matrix", lambda r: F.concat(F.lit("["), F.array_join(r, ","), F.lit("]")))
    return m.select(*K3, F.array_join("dates", ",").alias("dates"), F.array_join(rows, ";").alias("matrix"))


_BFT = f"""
fa AS (SELECT code_module, code_presentation, min(date) AS date_assessment FROM assessments GROUP BY ALL),
reg AS (SELECT i.code_module, i.code_presentation, i.id_student, r.date_unregistration,
  CASE i.final_result WHEN 'Pass' THEN 0 WHEN 'Distinction' THEN 0 WHEN 'Fail' THEN 1 WHEN 'Withdrawn' THEN 2 END AS final_result
  FROM student_info i JOIN student_registration r USING ({K3J})),
df AS (SELECT s.code_module, s.code_presentation, s.id_student, s.date, s.sum_click, v.activity_type, fa.date_assessment,
  reg.final_result, reg.date_unregistration
  FROM student_vle s LEFT JOIN vle v USING (code_module, code_presentation, id_site)
  LEFT JOIN fa USING (code_module, code_presentation) LEFT JOIN reg USING ({K3J})),
bft AS (SELECT {K3J}, date, activity_type, avg(date_assessment) AS date_assessment, sum(sum_click) AS sum_click,
  avg(final_result) AS final_result FROM df
  WHERE date <= date_assessment AND NOT COALESCE(date_unregistration <= 7, false) AND activity_type IS NOT NULL
  GROUP BY ALL)"""


def _bft(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return dist.entropy_base(raw["student_vle"], raw["vle"], raw["assessments"], raw["student_info"],
                             raw["student_registration"])


@query("e17_pre_test_aggregate", _BFT + "\nSELECT {k}, date, activity_type, date_assessment, CAST(sum_click AS BIGINT) AS sum_click, final_result FROM bft".format(k=K3J))
def e17_pre_test_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-test clicks per (student, day, activity): click sum, mean test date, mean outcome code."""
    return _bft(spark, sf_dir)


_JOINT = _BFT + f""",
src AS (SELECT * FROM bft WHERE date >= 0),
per AS (SELECT {K3J}, least(0, min(date)) AS d0, CAST(avg(date_assessment) AS BIGINT) AS d1, sum(sum_click) AS tot FROM src GROUP BY ALL),
acts AS (SELECT DISTINCT activity_type FROM bft),
grid AS (SELECT per.*, g.date, a.activity_type FROM per
  JOIN (SELECT range AS date FROM range(-400, 400)) g ON g.date BETWEEN per.d0 AND per.d1 CROSS JOIN acts a),
joint AS (SELECT grid.code_module, grid.code_presentation, grid.id_student, grid.date, grid.activity_type,
  CAST(COALESCE(src.sum_click, 0) AS BIGINT) AS clicks, CAST(grid.tot AS BIGINT) AS student_clicks,
  CAST(COALESCE(src.sum_click, 0) AS DOUBLE) / grid.tot AS p FROM grid LEFT JOIN src USING ({K3J}, date, activity_type))"""


@query("e18_joint_distribution", _JOINT + f"\nSELECT {K3J}, CAST(date AS BIGINT) AS date, activity_type, clicks, student_clicks, p FROM joint")
def e18_joint_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense day x activity distribution of every student's pre-test clicks (all students in one job)."""
    return dist.joint_distribution(_bft(spark, sf_dir))


@query("e19_marginal_by_activity", _JOINT + f"\nSELECT {K3J}, activity_type, CAST(sum(clicks) AS DOUBLE) / max(student_clicks) AS p FROM joint GROUP BY ALL")
def e19_marginal_by_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dist.marginal_by_activity(dist.joint_distribution(_bft(spark, sf_dir)))


@query("e19_marginal_by_date", _JOINT + f"\nSELECT {K3J}, CAST(date AS BIGINT) AS date, CAST(sum(clicks) AS DOUBLE) / max(student_clicks) AS p FROM joint GROUP BY ALL")
def e19_marginal_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dist.marginal_by_date(dist.joint_distribution(_bft(spark, sf_dir)))


@query("e20_flatten_joint", _JOINT + f"""
SELECT {K3J}, CAST(row_number() OVER (PARTITION BY {K3J} ORDER BY date, activity_type) - 1 AS BIGINT) AS pos, p FROM joint""")
def e20_flatten_joint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joint distribution as one day-major vector per student (shown as position, value)."""
    v = dist.joint_vectors(_bft(spark, sf_dir))
    return v.select(*K3, F.posexplode("vector").alias("pos", "p")).withColumn("pos", F.col("pos").cast("long"))


_ENT = _BFT + f""",
src AS (SELECT * FROM bft WHERE date >= 0),
cells AS (SELECT *, sum(sum_click) OVER (PARTITION BY {K3J}) AS t,
  CAST(sum_click AS DOUBLE) / sum(sum_click) OVER (PARTITION BY {K3J}) AS p FROM src),
ej AS (SELECT {K3J}, -sum(p * log2(p)) AS entropy_joint, avg(final_result) AS result FROM cells GROUP BY ALL),
ed AS (SELECT {K3J}, -sum(p * log2(p)) AS entropy_date FROM (SELECT {K3J}, date,
  CAST(sum(sum_click) AS DOUBLE) / max(t) AS p FROM cells GROUP BY ALL) GROUP BY ALL),
ea AS (SELECT {K3J}, -sum(p * log2(p)) AS entropy_acty FROM (SELECT {K3J}, activity_type,
  CAST(sum(sum_click) AS DOUBLE) / max(t) AS p FROM cells GROUP BY ALL) GROUP BY ALL),
ent AS (SELECT * FROM ej JOIN ed USING ({K3J}) JOIN ea USING ({K3J}))"""


@query("e21_entropies", _ENT + "\nSELECT * FROM ent")
def e21_entropies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Joint, day and activity entropy (base 2) of each student's pre-test clicks, with outcome code."""
    return dist.entropies(_bft(spark, sf_dir))


@query("e9_day_shares", f"""
j AS (SELECT s.code_module, s.code_presentation, s.id_student, CAST(ceil(s.date / CAST(7 AS DOUBLE)) AS BIGINT) AS temperal_seg,
  CAST(s.date - (ceil(s.date / CAST(7 AS DOUBLE)) - 1) * 7 AS BIGINT) AS temperal_seq, s.sum_click FROM student_vle s),
d AS (SELECT {K3J}, temperal_seg, temperal_seq, sum(sum_click) AS c FROM j GROUP BY ALL)
SELECT {K3J}, temperal_seg, temperal_seq, CAST(c AS DOUBLE) / sum(c) OVER (PARTITION BY {K3J}, temperal_seg) AS share FROM d""")
def e9_day_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of clicks per day inside each (student, 7-day segment), long form (days with clicks)."""
    from pyspark.sql import Window
    raw = _raw(spark, sf_dir)
    base = flows.segment_base(raw["student_vle"], raw["vle"], SEG_DAYS)
    d = base.groupBy(*flows.KS, flows.DAY).agg(F.sum("c").alias("c"))
    return d.select(*flows.KS, flows.DAY, (F.col("c") / F.sum("c").over(Window.partitionBy(*flows.KS))).alias("share"))

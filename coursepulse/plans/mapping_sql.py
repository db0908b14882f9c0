"""The generated-data mapping of ``coursepulse.sources.fixture`` written as SQL CTEs.

Only the generated tables are registered in the oracle engine, so every oracle query starts
with these CTEs. Types are cast to the fixed schema (BIGINT / DOUBLE / VARCHAR).
"""

MODULE = "CASE {k} % 3 WHEN 0 THEN 'AAA' WHEN 1 THEN 'BBB' ELSE 'CCC' END"
TERM = "CASE {k} % 4 WHEN 0 THEN '2013B' WHEN 1 THEN '2013J' WHEN 2 THEN '2014B' ELSE '2014J' END"

MAPPING_CTES = f"""
student_info AS (
 SELECT {MODULE.format(k='c_custkey')} AS code_module,
  {TERM.format(k='c_custkey')} AS code_presentation,
  CAST(c_custkey AS BIGINT) AS id_student,
  CASE WHEN c_custkey % 5 < 2 THEN 'F' ELSE 'M' END AS gender,
  n_name AS region,
  CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'No Formal quals' WHEN 'BUILDING' THEN 'Lower Than A Level'
   WHEN 'FURNITURE' THEN 'A Level or Equivalent' WHEN 'HOUSEHOLD' THEN 'HE Qualification'
   ELSE 'Post Graduate Qualification' END AS highest_education,
  CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 1000 THEN '0-10%' WHEN c_acctbal < 2000 THEN '10-20'
   WHEN c_acctbal < 3000 THEN '20-30%' WHEN c_acctbal < 4000 THEN '30-40%' WHEN c_acctbal < 5000 THEN '40-50%'
   WHEN c_acctbal < 6000 THEN '50-60%' WHEN c_acctbal < 7000 THEN '60-70%' WHEN c_acctbal < 8000 THEN '70-80%'
   WHEN c_acctbal < 9000 THEN '80-90%' ELSE '90-100%' END AS imd_band,
  CASE WHEN c_custkey % 7 < 4 THEN '0-35' WHEN c_custkey % 7 < 6 THEN '35-55' ELSE '55<=' END AS age_band,
  CAST(c_custkey % 5 AS BIGINT) AS num_of_prev_attempts,
  CAST(30 * (1 + c_nationkey % 5) AS BIGINT) AS studied_credits,
  CASE WHEN c_custkey % 10 = 0 THEN 'Y' ELSE 'N' END AS disability,
  CASE WHEN c_custkey % 11 < 5 THEN 'Pass' WHEN c_custkey % 11 < 8 THEN 'Fail'
   WHEN c_custkey % 11 < 10 THEN 'Withdrawn' ELSE 'Distinction' END AS final_result
 FROM customer JOIN nation ON c_nationkey = n_nationkey
),
courses AS (
 SELECT DISTINCT code_module, code_presentation, CAST(240 AS BIGINT) AS module_presentation_length
 FROM student_info
),
student_registration AS (
 SELECT code_module, code_presentation, id_student,
  CAST(CASE WHEN id_student % 13 = 0 THEN NULL ELSE -1 - (id_student % 90) END AS BIGINT) AS date_registration,
  CAST(CASE WHEN final_result = 'Withdrawn' THEN (id_student % 60) - 20 END AS BIGINT) AS date_unregistration
 FROM student_info
),
vle AS (
 SELECT CAST(s.id_site AS BIGINT) AS id_site, c.code_module, c.code_presentation,
  CASE s.id_site % 6 WHEN 0 THEN 'homepage' WHEN 1 THEN 'forumng' WHEN 2 THEN 'oucontent'
   WHEN 3 THEN 'quiz' WHEN 4 THEN 'resource' ELSE 'url' END AS activity_type
 FROM courses c CROSS JOIN (SELECT DISTINCT event_id % 20 AS id_site FROM events) s WHERE s.id_site < 19
),
student_vle AS (
 SELECT {MODULE.format(k='user_id')} AS code_module,
  {TERM.format(k='user_id')} AS code_presentation,
  CAST(user_id AS BIGINT) AS id_student, CAST(event_id % 20 AS BIGINT) AS id_site,
  CAST(dayofyear(ts) - 6 AS BIGINT) AS date, CAST(floor(value) AS BIGINT) + 1 AS sum_click
 FROM events
),
assessments AS (
 SELECT {MODULE.format(k='p_partkey')} AS code_module,
  {TERM.format(k='p_partkey')} AS code_presentation,
  CAST(p_partkey AS BIGINT) AS id_assessment,
  CAST(CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE 10 + p_size END AS BIGINT) AS date,
  CAST(10 AS DOUBLE) AS weight
 FROM part
),
student_assessment AS (
 SELECT CAST(l_partkey AS BIGINT) AS id_assessment, CAST(o_custkey AS BIGINT) AS id_student,
  CAST(min(l_quantity) AS BIGINT) AS date_submitted, CAST(0 AS BIGINT) AS is_banked,
  round(CAST(100 AS DOUBLE) - CAST(500 AS DOUBLE) * avg(l_discount), 2) AS score
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 WHERE l_partkey % 12 = o_custkey % 12
 GROUP BY l_partkey, o_custkey
)"""


def with_mapping(body: str) -> str:
    """Prefix an oracle query with the mapping CTEs.

    ``body`` either starts with more CTEs (``"name AS (...), ... SELECT ..."``) or is a plain
    ``SELECT``.
    """
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {MAPPING_CTES}\n{body}"
    return f"WITH {MAPPING_CTES},\n{body}"

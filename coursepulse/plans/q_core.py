"""Checked queries: sources, checks, split, encoders, responses and the merged feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursepulse.functions.columns import band_average
from coursepulse.operators import checks, encode
from coursepulse.operators.split import train_test_split
from coursepulse.plans import feature_pool as fp
from coursepulse.plans.registry import query
from coursepulse.plans.sql_parts import (K3S, TRAIN_IN, order_values, ordinal_mode_cte, regularity_ctes,
                                         top_values_cte)
from coursepulse.schema import K3, ORDINAL_ORDERS, TABLES, TEST_TERMS
from coursepulse.sources.fixture import fixture_tables


def collapse_one_hot(df: DataFrame, features: list[str]) -> DataFrame:
    """Comparison form of one-hot columns ``{f}_{value}``: the hot value (NULL for an all-zero row)."""
    out = df
    for f in features:
        cols = [c for c in df.columns if c.startswith(f + "_")]
        label = F.coalesce(*[F.when(F.col(f"`{c}`") == 1.0, F.lit(c[len(f) + 1:])) for c in cols]) \
            if cols else F.lit(None).cast("string")
        out = out.withColumn(f"{f}_onehot", label).drop(*cols)
    return out


# ---------------------------------------------------------------- A1: the seven tables
_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, "
    f"CAST(count(DISTINCT {'id_assessment' if t == 'student_assessment' else 'code_module'}) AS BIGINT) AS n_distinct_first "
    f"FROM {t}" for t in TABLES)


@query("a1_table_counts", _COUNTS_SQL)
def a1_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of every cohort table, and the distinct count of its leading key column."""
    raw = fixture_tables(spark, sf_dir)
    parts = []
    for t in TABLES:
        first = "id_assessment" if t == "student_assessment" else "code_module"
        parts.append(raw[t].agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                                F.countDistinct(first).alias("n_distinct_first")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("a1_student_vle_rows", "SELECT * FROM student_vle")
def a1_student_vle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole click table as loaded (fixed schema)."""
    return fixture_tables(spark, sf_dir)["student_vle"]


@query("a1_student_info_rows", "SELECT * FROM student_info")
def a1_student_info_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture_tables(spark, sf_dir)["student_info"]


@query("a1_dimension_rows", """
SELECT 'vle' AS t, CAST(id_site AS VARCHAR) AS k, code_module, code_presentation, activity_type AS v FROM vle
UNION ALL SELECT 'assessments', CAST(id_assessment AS VARCHAR), code_module, code_presentation, CAST(date AS VARCHAR) FROM assessments
UNION ALL SELECT 'courses', CAST(module_presentation_length AS VARCHAR), code_module, code_presentation, NULL FROM courses
UNION ALL SELECT 'student_registration', CAST(id_student AS VARCHAR), code_module, code_presentation,
  CAST(date_registration AS VARCHAR) || '/' || COALESCE(CAST(date_unregistration AS VARCHAR), '-') FROM student_registration
UNION ALL SELECT 'student_assessment', CAST(id_assessment AS VARCHAR), CAST(id_student AS VARCHAR), CAST(date_submitted AS VARCHAR),
  CAST(score AS VARCHAR) FROM student_assessment""")
def a1_dimension_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the smaller tables in one text form (types differ between tables)."""
    raw = fixture_tables(spark, sf_dir)
    s = lambda c: F.col(c).cast("string")
    return (
        raw["vle"].select(F.lit("vle").alias("t"), s("id_site").alias("k"), "code_module", "code_presentation",
                          F.col("activity_type").alias("v"))
        .unionByName(raw["assessments"].select(F.lit("assessments").alias("t"), s("id_assessment").alias("k"),
                                               "code_module", "code_presentation", s("date").alias("v")))
        .unionByName(raw["courses"].select(F.lit("courses").alias("t"), s("module_presentation_length").alias("k"),
                                           "code_module", "code_presentation", F.lit(None).cast("string").alias("v")))
        .unionByName(raw["student_registration"].select(
            F.lit("student_registration").alias("t"), s("id_student").alias("k"), "code_module", "code_presentation",
            F.concat(s("date_registration"), F.lit("/"), F.coalesce(s("date_unregistration"), F.lit("-"))).alias("v")))
        .unionByName(raw["student_assessment"].select(
            F.lit("student_assessment").alias("t"), s("id_assessment").alias("k"), s("id_student").alias("code_module"),
            s("date_submitted").alias("code_presentation"), s("score").alias("v")))
    )


# ---------------------------------------------------------------- B3: key uniqueness
@query("b3_duplicate_click_keys", f"""
SELECT {K3S}, id_site, date, CAST(count(*) AS BIGINT) AS n FROM student_vle
GROUP BY {K3S}, id_site, date HAVING count(*) > 1""")
def b3_duplicate_click_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated (student, site, day) keys of the click table with their multiplicity."""
    sv = fixture_tables(spark, sf_dir)["student_vle"]
    return checks.duplicate_keys(sv, [*K3, "id_site", "date"])


# ---------------------------------------------------------------- C1-C5: split
_SPLIT_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS n_total, "
    + (f"CAST(count(*) FILTER (WHERE code_presentation IN {TRAIN_IN}) AS BIGINT) AS n_train, "
       f"CAST(count(*) FILTER (WHERE code_presentation IS NULL OR code_presentation NOT IN {TRAIN_IN}) AS BIGINT) AS n_test "
       f"FROM {t}"
       if t != "student_assessment" else
       f"CAST(count(*) FILTER (WHERE id_assessment IN (SELECT id_assessment FROM assessments WHERE code_presentation IN {TRAIN_IN})) AS BIGINT) AS n_train, "
       f"CAST(count(*) FILTER (WHERE id_assessment IS NULL OR id_assessment NOT IN (SELECT id_assessment FROM assessments WHERE code_presentation IN {TRAIN_IN})) AS BIGINT) AS n_test "
       f"FROM {t}")
    for t in TABLES)


@query("c1_split_counts", _SPLIT_SQL)
def c1_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split every table by term (assessment ids for tables without a term); counts per side."""
    return checks.split_completeness(fixture_tables(spark, sf_dir))


_LEGACY_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, "
    + (f"CAST(count(*) FILTER (WHERE code_presentation IN {TRAIN_IN}) AS BIGINT) AS n_train, "
       f"CAST(count(*) FILTER (WHERE code_presentation IN ('2014J')) AS BIGINT) AS n_test FROM {t}"
       if t != "student_assessment" else
       f"CAST(count(*) FILTER (WHERE id_assessment IN (SELECT id_assessment FROM assessments WHERE code_presentation IN {TRAIN_IN})) AS BIGINT) AS n_train, "
       f"CAST(count(*) FILTER (WHERE id_assessment IN (SELECT id_assessment FROM assessments WHERE code_presentation IS NULL OR code_presentation NOT IN {TRAIN_IN})) AS BIGINT) AS n_test FROM {t}")
    for t in TABLES)


@query("c4_legacy_split_counts", _LEGACY_SQL)
def c4_legacy_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy split with explicit test terms: rows per side for every table."""
    return checks.split_completeness(fixture_tables(spark, sf_dir), test_terms=TEST_TERMS).drop("n_total")


# ---------------------------------------------------------------- G: encoders on the training terms
def _train(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return train_test_split(fixture_tables(spark, sf_dir))[0]


_NUM_SQL = f"""
si AS (SELECT * FROM student_info WHERE code_presentation IN {TRAIN_IN}),
sr AS (SELECT * FROM student_registration WHERE code_presentation IN {TRAIN_IN}),
st1 AS (SELECT avg(num_of_prev_attempts) AS mu1, stddev_samp(num_of_prev_attempts) AS sd1,
  avg(studied_credits) AS mu2, stddev_samp(studied_credits) AS sd2 FROM si),
st2 AS (SELECT avg(date_registration) AS mu3, stddev_samp(date_registration) AS sd3 FROM sr)"""


@query("g1_numeric_batch", _NUM_SQL + f""",
a AS (SELECT {K3S}, 'num_of_prev_attempts' AS feature,
  round((COALESCE(CAST(num_of_prev_attempts AS DOUBLE), mu1) - mu1) / NULLIF(sd1, 0), 6) AS value FROM si, st1
 UNION ALL SELECT {K3S}, 'studied_credits', round((COALESCE(CAST(studied_credits AS DOUBLE), mu2) - mu2) / NULLIF(sd2, 0), 6) FROM si, st1
 UNION ALL SELECT {K3S}, 'date_registration', round((COALESCE(CAST(date_registration AS DOUBLE), mu3) - mu3) / NULLIF(sd3, 0), 6) FROM sr, st2)
SELECT * FROM a""")
def g1_numeric_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean-filled z-scores of the numeric batch, fitted on the training terms (long form)."""
    fd = fp.get_numeric_features_batch(_train(spark, sf_dir))
    parts = [f.data.select(*K3, F.lit(name).alias("feature"), F.col(name).alias("value")) for name, f in fd.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_CAT_SQL = f"""
si AS (SELECT * FROM student_info WHERE code_presentation IN {TRAIN_IN}),
{top_values_cte('tg', 'si', 'gender')}, {top_values_cte('tr', 'si', 'region')}, {top_values_cte('td', 'si', 'disability')}"""


@query("g2_categorical_batch", _CAT_SQL + f"""
SELECT {K3S},
 CASE WHEN gender IN (SELECT v FROM tg) THEN gender END AS gender_onehot,
 CASE WHEN region IN (SELECT v FROM tr) THEN region END AS region_onehot,
 CASE WHEN disability IN (SELECT v FROM td) THEN disability END AS disability_onehot,
 CAST((SELECT count(*) FROM tg) + (SELECT count(*) FROM tr) + (SELECT count(*) FROM td) AS BIGINT) AS n_columns
FROM si""")
def g2_categorical_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-10 one-hot of gender, region, disability (collapsed to the hot value) + column count."""
    fd = fp.get_categorical_features_batch(_train(spark, sf_dir))
    df = fp.merge_features(fd)
    n_cols = len(df.columns) - len(K3)
    return collapse_one_hot(df, ["gender", "region", "disability"]).withColumn("n_columns", F.lit(n_cols).cast("long"))


_ORD = {c: ORDINAL_ORDERS["student_info", c] for c in ("highest_education", "imd_band", "age_band")}
_ORD_SQL = f"""
si AS (SELECT * FROM student_info WHERE code_presentation IN {TRAIN_IN}),
{ordinal_mode_cte('m1', 'si', 'highest_education', _ORD['highest_education'])},
{ordinal_mode_cte('m2', 'si', 'imd_band', _ORD['imd_band'])},
{ordinal_mode_cte('m3', 'si', 'age_band', _ORD['age_band'])}"""


def _ord_expr(col: str, mode: str, rows: str = "si") -> str:
    return (f"CAST(COALESCE((SELECT o.idx FROM {order_values(_ORD[col])} WHERE o.v = {rows}.{col}), "
            f"(SELECT idx FROM {mode})) AS BIGINT) AS {col}")


@query("g3_ordinal_batch", _ORD_SQL + f"""
SELECT {K3S}, {_ord_expr('highest_education', 'm1')}, {_ord_expr('imd_band', 'm2')}, {_ord_expr('age_band', 'm3')}
FROM si""")
def g3_ordinal_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordinal index of education, deprivation band and age band; NULL / unknown -> modal index."""
    return fp.merge_features(fp.get_ordinal_features_batch(_train(spark, sf_dir)))


@query("g9_response", f"""
SELECT {K3S}, CASE WHEN final_result IN ('Pass', 'Distinction') THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS responce
FROM student_info WHERE code_presentation IN {TRAIN_IN} AND final_result IN ('Pass', 'Distinction', 'Fail')""")
def g9_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response of the groups [[Pass, Distinction], [Fail]]; other labels dropped."""
    fd = fp.get_response(_train(spark, sf_dir), [["Pass", "Distinction"], ["Fail"]])
    return fd.merge().data


@query("g9_response_keep_other", f"""
SELECT {K3S}, CASE WHEN final_result = 'Pass' THEN CAST(0 AS DOUBLE) WHEN final_result IN ('Fail', 'Withdrawn') THEN CAST(1 AS DOUBLE)
 WHEN final_result = 'Distinction' THEN CAST(2 AS DOUBLE) END AS result_group
FROM student_info""")
def g9_response_keep_other(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three target groups, one label listed twice (the later group wins), other rows kept as NULL."""
    raw = fixture_tables(spark, sf_dir)
    fd = fp.get_response(raw, [["Pass", "Fail"], ["Fail", "Withdrawn"], ["Distinction"]],
                         response_name="result_group", drop_other=False)
    return fd.merge().data


@query("g11_band_average", f"""
SELECT {K3S},
 (SELECT avg(CAST(x AS DOUBLE)) FROM unnest(regexp_extract_all(imd_band, '(\\d+)', 1)) t(x)) AS imd_band,
 (SELECT avg(CAST(x AS DOUBLE)) FROM unnest(regexp_extract_all(age_band, '(\\d+)', 1)) t(x)) AS age_band
FROM student_info""")
def g11_band_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Band labels replaced by the mean of the numbers they contain (NULL kept)."""
    si = fixture_tables(spark, sf_dir)["student_info"]
    return si.select(*K3, band_average(F.col("imd_band")).alias("imd_band"),
                     band_average(F.col("age_band")).alias("age_band"))


@query("g13_demographics", f"""
SELECT {K3S}, num_of_prev_attempts, studied_credits,
 CASE final_result WHEN 'Fail' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS responce,
 gender AS gender_onehot, region AS region_onehot, highest_education AS highest_education_onehot,
 disability AS disability_onehot,
 (SELECT avg(CAST(x AS DOUBLE)) FROM unnest(regexp_extract_all(imd_band, '(\\d+)', 1)) t(x)) AS imd_band,
 (SELECT avg(CAST(x AS DOUBLE)) FROM unnest(regexp_extract_all(age_band, '(\\d+)', 1)) t(x)) AS age_band,
 CAST((SELECT count(DISTINCT gender) + count(DISTINCT region) + count(DISTINCT highest_education)
   + count(DISTINCT disability) FROM student_info) AS BIGINT) AS n_onehot
FROM student_info WHERE final_result <> 'Withdrawn'""")
def g13_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legacy demographic table: full one-hot (columns named by value), band averages, labelled rows."""
    from coursepulse.plans.flows import demographics
    si = fixture_tables(spark, sf_dir)["student_info"]
    df, groups = demographics(si)
    n = sum(len(v) for v in groups.values())
    for f, cols in groups.items():
        label = F.coalesce(*[F.when(F.col(f"`{c}`") == 1.0, F.lit(c)) for c in cols])
        df = df.withColumn(f"{f}_onehot", label).drop(*cols)
    return df.withColumn("n_onehot", F.lit(n).cast("long"))


@query("g14_label_encoding", """
SELECT activity_type, CAST(dense_rank() OVER (ORDER BY activity_type) - 1 AS BIGINT) AS activity_label
FROM (SELECT DISTINCT activity_type FROM vle)""")
def g14_label_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alphabetical integer label of each activity type."""
    vle = fixture_tables(spark, sf_dir)["vle"]
    return encode.label_index(vle.select("activity_type").distinct(), "activity_type", "activity_label")


# ---------------------------------------------------------------- H3 / H5: merged feature table
def _flag_ctes(terms: str) -> str:
    """Rows ``xi, xr, sv`` of ``terms`` and the encoders' statistics of the training terms."""
    return f"""
si AS (SELECT * FROM student_info WHERE code_presentation IN {TRAIN_IN}),
sr AS (SELECT * FROM student_registration WHERE code_presentation IN {TRAIN_IN}),
xi AS (SELECT * FROM student_info WHERE code_presentation IN {terms}),
xr AS (SELECT * FROM student_registration WHERE code_presentation IN {terms}),
sv AS (SELECT * FROM student_vle WHERE code_presentation IN {terms}),
st1 AS (SELECT avg(num_of_prev_attempts) AS mu1, stddev_samp(num_of_prev_attempts) AS sd1,
  avg(studied_credits) AS mu2, stddev_samp(studied_credits) AS sd2 FROM si),
st2 AS (SELECT avg(date_registration) AS mu3, stddev_samp(date_registration) AS sd3 FROM sr),
{top_values_cte('tg', 'si', 'gender')}, {top_values_cte('tr', 'si', 'region')}, {top_values_cte('td', 'si', 'disability')},
{ordinal_mode_cte('m1', 'si', 'highest_education', _ORD['highest_education'])},
{ordinal_mode_cte('m2', 'si', 'imd_band', _ORD['imd_band'])},
{ordinal_mode_cte('m3', 'si', 'age_band', _ORD['age_band'])},
{regularity_ctes('sv', 0, 32)}"""


_FLAG_SQL = _flag_ctes(TRAIN_IN)


def _flag_sql(terms: str) -> str:
    """The merged feature table of ``terms``, encoded with the statistics of the training terms."""
    return _flag_ctes(terms) + f"""
SELECT xi.code_module, xi.code_presentation, xi.id_student,
 CASE WHEN final_result IN ('Pass', 'Distinction') THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS responce,
 round((COALESCE(CAST(num_of_prev_attempts AS DOUBLE), mu1) - mu1) / NULLIF(sd1, 0), 6) AS num_of_prev_attempts,
 round((COALESCE(CAST(studied_credits AS DOUBLE), mu2) - mu2) / NULLIF(sd2, 0), 6) AS studied_credits,
 round((COALESCE(CAST(xr.date_registration AS DOUBLE), mu3) - mu3) / NULLIF(sd3, 0), 6) AS date_registration,
 CASE WHEN gender IN (SELECT v FROM tg) THEN gender END AS gender_onehot,
 CASE WHEN region IN (SELECT v FROM tr) THEN region END AS region_onehot,
 CASE WHEN disability IN (SELECT v FROM td) THEN disability END AS disability_onehot,
 {_ord_expr('highest_education', 'm1', 'xi')}, {_ord_expr('imd_band', 'm2', 'xi')}, {_ord_expr('age_band', 'm3', 'xi')},
 round(r.pwd, 6) AS regularity_indicator_pwd, round(r.ws1, 6) AS regularity_indicator_ws1,
 round(r.ws2, 6) AS regularity_indicator_ws2, round(r.ws3, 6) AS regularity_indicator_ws3,
 round(r.fwd, 6) AS regularity_indicator_fwd, r.effort
FROM xi CROSS JOIN st1 CROSS JOIN st2
LEFT JOIN xr ON xr.code_module = xi.code_module AND xr.code_presentation = xi.code_presentation AND xr.id_student = xi.id_student
LEFT JOIN r_all r ON r.code_module = xi.code_module AND r.code_presentation = xi.code_presentation AND r.id_student = xi.id_student
WHERE final_result IN ('Pass', 'Distinction', 'Fail')"""


@query("h5_build_features", _flag_sql(TRAIN_IN))
def h5_build_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: response + numeric / categorical / ordinal batches + time regularity + effort,
    fitted and merged on the training terms (one-hot shown collapsed)."""
    df = fp.build_features(_train(spark, sf_dir))
    return collapse_one_hot(df, ["gender", "region", "disability"])


@query("h5_build_features_test", _flag_sql("('2014J')"))
def h5_build_features_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table of the test term, encoded with the parameters fitted on the training terms."""
    train, test = train_test_split(fixture_tables(spark, sf_dir))
    fitted = fp.new_preprocessors()
    fp.build_features(train, preprocessors=fitted)
    df = fp.build_features(test, preprocessors=fitted, refit=False)
    return collapse_one_hot(df, ["gender", "region", "disability"])


@query("h3_merge_response_effort", f"""
sv AS (SELECT * FROM student_vle),
{regularity_ctes('sv', 0, 32)}
SELECT si.code_module, si.code_presentation, si.id_student,
 CASE WHEN final_result = 'Fail' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS responce, r.effort
FROM student_info si LEFT JOIN r_all r USING ({K3S})
WHERE final_result IN ('Pass', 'Distinction', 'Fail')""")
def h3_merge_response_effort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response merged with effort: the response fixes the rows, students without clicks get NULL."""
    raw = fixture_tables(spark, sf_dir)
    fd = fp.get_response(raw, [["Pass", "Distinction"], ["Fail"]])
    fd.update(fp.get_effort(raw, 0, 32))
    return fd.merge().data


# ---------------------------------------------------------------- G10 / G15 / H4 / A6
@query("g10_outcome_maps", f"""
SELECT {K3S},
 CASE final_result WHEN 'Fail' THEN CAST(1 AS DOUBLE) WHEN 'Withdrawn' THEN NULL ELSE CAST(0 AS DOUBLE) END AS fail_vs_pass,
 CAST(CASE final_result WHEN 'Withdrawn' THEN 0 WHEN 'Fail' THEN 1 ELSE 2 END AS BIGINT) AS three_level,
 CASE final_result WHEN 'Distinction' THEN 'Pass' ELSE final_result END AS outcome_group,
 CAST(CASE final_result WHEN 'Withdrawn' THEN 2 WHEN 'Fail' THEN 1 ELSE 0 END AS BIGINT) AS pass_fail_withdrawn
FROM student_info""")
def g10_outcome_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four fixed outcome maps of the legacy flows (an unknown label raises)."""
    from coursepulse.schema import FAIL_VS_PASS, OUTCOME_GROUP, PASS_FAIL_WITHDRAWN, THREE_LEVEL
    si = fixture_tables(spark, sf_dir)["student_info"]
    return si.select(*K3, encode.map_outcome("final_result", FAIL_VS_PASS).cast("double").alias("fail_vs_pass"),
                     encode.map_outcome("final_result", THREE_LEVEL).cast("long").alias("three_level"),
                     encode.map_outcome("final_result", OUTCOME_GROUP).alias("outcome_group"),
                     encode.map_outcome("final_result", PASS_FAIL_WITHDRAWN).cast("long").alias("pass_fail_withdrawn"))


_REG_COLS = ("regularity_indicator_pwd", "regularity_indicator_ws1", "regularity_indicator_ws2",
             "regularity_indicator_ws3", "regularity_indicator_fwd")


@query("g15_fill_zero", _FLAG_SQL + f"""
SELECT si.code_module, si.code_presentation, si.id_student,
 {", ".join(f"COALESCE(round(r.{m}, 6), 0) AS regularity_indicator_{m}" for m in ("pwd", "ws1", "ws2", "ws3", "fwd"))},
 CAST(COALESCE(r.effort, 0) AS BIGINT) AS effort
FROM si LEFT JOIN r_all r ON r.code_module = si.code_module AND r.code_presentation = si.code_presentation
 AND r.id_student = si.id_student WHERE final_result IN ('Pass', 'Distinction', 'Fail')""")
def g15_fill_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table of the training terms with missing click features set to 0."""
    df = fp.build_features(_train(spark, sf_dir))
    return encode.fill_zero(df.select(*K3, *_REG_COLS, "effort"))


@query("g15_impute_mean", _FLAG_SQL + f""",
f AS (SELECT si.code_module, si.code_presentation, si.id_student, {", ".join(f"r.{m}" for m in ("pwd", "ws1", "fwd"))}
 FROM si LEFT JOIN r_all r ON r.code_module = si.code_module AND r.code_presentation = si.code_presentation
 AND r.id_student = si.id_student WHERE final_result IN ('Pass', 'Distinction', 'Fail'))
SELECT {K3S}, {", ".join(f"COALESCE({m}, (SELECT avg({m}) FROM f)) AS regularity_indicator_{m}" for m in ("pwd", "ws1", "fwd"))}
FROM f""")
def g15_impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing regularity values replaced by the column mean (one aggregate for all columns)."""
    cols = ["regularity_indicator_pwd", "regularity_indicator_ws1", "regularity_indicator_fwd"]
    df = fp.build_features(_train(spark, sf_dir)).select(*K3, *cols)
    return encode.fill_mean(df, cols)


@query("h4_response_column", f"""
SELECT {K3S}, CASE WHEN final_result IN ('Pass', 'Distinction') THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS responce
FROM student_info WHERE code_presentation IN {TRAIN_IN} AND final_result IN ('Pass', 'Distinction', 'Fail')""")
def h4_response_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """y of the X / y split of the merged feature table (the first value column)."""
    from coursepulse.operators.features import split_xy
    _, y = split_xy(fp.build_features(_train(spark, sf_dir)), K3)
    return y


@query("a6_feature_table_sink", _FLAG_SQL + f"""
SELECT si.code_module, si.code_presentation, si.id_student,
 CASE WHEN final_result IN ('Pass', 'Distinction') THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS responce,
 r.effort, round(r.pwd, 6) AS regularity_indicator_pwd
FROM si LEFT JOIN r_all r ON r.code_module = si.code_module AND r.code_presentation = si.code_presentation
 AND r.id_student = si.id_student WHERE final_result IN ('Pass', 'Distinction', 'Fail')""")
def a6_feature_table_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table written as parquet partitioned by term (in the shared checkpoint folder) and read back."""
    import os
    import uuid

    from coursepulse.session import ensure_checkpoint_dir
    from coursepulse.sources.sinks import write_feature_table
    df = fp.build_features(_train(spark, sf_dir)).select(*K3, "responce", "effort", "regularity_indicator_pwd")
    path = os.path.join(ensure_checkpoint_dir(spark), f"feature-table-{uuid.uuid4().hex}")
    write_feature_table(df, path)
    return spark.read.parquet(path).select(*K3, "responce", "effort", "regularity_indicator_pwd")

"""The cohort tables as views over the driver's generated parquet tables.

No click data ships with the project, so the seven tables are derived from the generated
star-schema tables (customer, nation, part, lineitem, orders, events) by fixed rules. The
same rules are written as SQL for the DuckDB oracle in ``coursepulse.plans.mapping_sql``.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coursepulse.functions.dims import bounded_broadcast, few_rows, mark_bounded, row_bound
from coursepulse.operators import checks
from coursepulse.schema import KEYS

# --- fixed values of the mapping -------------------------------------------------------------------
MODULES = ["AAA", "BBB", "CCC"]  # by key % 3
TERMS = ["2013B", "2013J", "2014B", "2014J"]  # by key % 4
EDUCATION_BY_SEGMENT = {
    "AUTOMOBILE": "No Formal quals",
    "BUILDING": "Lower Than A Level",
    "FURNITURE": "A Level or Equivalent",
    "HOUSEHOLD": "HE Qualification",
}
EDUCATION_OTHER = "Post Graduate Qualification"
IMD_BANDS = ["0-10%", "10-20", "20-30%", "30-40%", "40-50%", "50-60%", "60-70%", "70-80%", "80-90%", "90-100%"]
SITE_ACTIVITY = ["homepage", "forumng", "oucontent", "quiz", "resource", "url"]  # by id_site % 6
SITES_PER_COURSE = 19  # site ids event_id % 20 below 19: site 19 has clicks but no site row
COURSE_LENGTH = 240
DAY_SHIFT = 6  # date = day of year - 6


def _pick(key: Column, values: list[str]) -> Column:
    m = key % len(values)
    expr = None
    for i, v in enumerate(values[:-1]):
        expr = F.when(m == i, v) if expr is None else expr.when(m == i, v)
    return expr.otherwise(values[-1])


def _module(key: Column) -> Column:
    return _pick(key, MODULES)


def _term(key: Column) -> Column:
    return _pick(key, TERMS)


# Columns of the generated tables that the mapping reads, with their stored types. Reading with a
# given schema skips the schema-discovery job and prunes the other columns at the scan.
SOURCE_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING",
    "part": "p_partkey BIGINT, p_size INT",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE, l_discount DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, value DOUBLE",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


# The course and site views have a few hundred rows by construction. One container (one call of
# ``fixture_tables``) reads them once and its plans embed them; nothing is kept across calls, so a
# later call sees the folder's present content.
SMALL_ROWS = 1_000
NATION_ROWS = 10_000


def _embedded(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df``, declared to have at most ``SMALL_ROWS`` rows, as rows held in the plan."""
    bound = row_bound(df)
    if bound is None or bound > SMALL_ROWS:
        return df
    rows = few_rows(df, "rows in a table declared to be small", bound)
    return mark_bounded(spark.createDataFrame(rows, df.schema), len(rows))


def student_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    n = bounded_broadcast(_read(spark, sf_dir, "nation").select("n_nationkey", "n_name"), NATION_ROWS)
    key = F.col("c_custkey")
    edu = None
    for seg, label in EDUCATION_BY_SEGMENT.items():
        cond = F.col("c_mktsegment") == seg
        edu = F.when(cond, label) if edu is None else edu.when(cond, label)
    edu = edu.otherwise(EDUCATION_OTHER)
    bal = F.col("c_acctbal")
    imd = F.when(bal < 0, F.lit(None).cast("string"))
    for i, band in enumerate(IMD_BANDS[:-1]):
        imd = imd.when(bal < (i + 1) * 1000, band)
    imd = imd.otherwise(IMD_BANDS[-1])
    m7, m11 = key % 7, key % 11
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "inner")
        .select(
            _module(key).alias("code_module"),
            _term(key).alias("code_presentation"),
            key.cast("long").alias("id_student"),
            F.when(key % 5 < 2, "F").otherwise("M").alias("gender"),
            F.col("n_name").alias("region"),
            edu.alias("highest_education"),
            imd.alias("imd_band"),
            F.when(m7 < 4, "0-35").when(m7 < 6, "35-55").otherwise("55<=").alias("age_band"),
            (key % 5).cast("long").alias("num_of_prev_attempts"),
            (F.lit(30) * (1 + F.col("c_nationkey") % 5)).cast("long").alias("studied_credits"),
            F.when(key % 10 == 0, "Y").otherwise("N").alias("disability"),
            F.when(m11 < 5, "Pass").when(m11 < 8, "Fail").when(m11 < 10, "Withdrawn")
            .otherwise("Distinction").alias("final_result"),
        )
    )


def courses(info: DataFrame) -> DataFrame:
    df = info.select(*["code_module", "code_presentation"]).distinct().withColumn(
        "module_presentation_length", F.lit(COURSE_LENGTH).cast("long"))
    return mark_bounded(df, len(MODULES) * len(TERMS))


def student_registration(info: DataFrame) -> DataFrame:
    sid = F.col("id_student")
    return info.select(
        "code_module", "code_presentation", "id_student",
        F.when(sid % 13 == 0, F.lit(None).cast("long")).otherwise(-1 - sid % 90).cast("long").alias("date_registration"),
        F.when(F.col("final_result") == "Withdrawn", sid % 60 - 20).cast("long").alias("date_unregistration"),
    )


def vle(spark: SparkSession, sf_dir: str, course_df: DataFrame) -> DataFrame:
    # Every course has every site id seen in the events (at most 19 ids), so the site list is a
    # scalar subquery of bounded size exploded per course: no cross product is formed.
    ev = _read(spark, sf_dir, "events")
    site = (F.col("event_id") % 20).alias("id_site")
    site_ids = ev.select(site).where(F.col("id_site") < SITES_PER_COURSE).agg(
        F.array_sort(F.collect_set("id_site")).alias("ids"))
    df = course_df.select(
        F.explode(site_ids.scalar()).alias("id_site"), "code_module", "code_presentation",
    ).select(
        F.col("id_site").cast("long").alias("id_site"), "code_module", "code_presentation",
        _pick(F.col("id_site"), SITE_ACTIVITY).alias("activity_type"),
    )
    return mark_bounded(df, len(MODULES) * len(TERMS) * SITES_PER_COURSE)


def student_vle(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    uid = F.col("user_id")
    return ev.select(
        _module(uid).alias("code_module"),
        _term(uid).alias("code_presentation"),
        uid.cast("long").alias("id_student"),
        (F.col("event_id") % 20).cast("long").alias("id_site"),
        (F.dayofyear("ts") - DAY_SHIFT).cast("long").alias("date"),
        (F.floor("value").cast("long") + 1).alias("sum_click"),
    )


def assessments(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        _module(key).alias("code_module"),
        _term(key).alias("code_presentation"),
        key.cast("long").alias("id_assessment"),
        F.when(key % 17 == 0, F.lit(None).cast("long")).otherwise(10 + F.col("p_size")).cast("long").alias("date"),
        F.lit(10.0).alias("weight"),
    )


def student_assessment(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_discount")
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey, "inner")
        .where(F.col("l_partkey") % 12 == F.col("o_custkey") % 12)
        .groupBy("l_partkey", "o_custkey")
        .agg(F.min("l_quantity").alias("q"), F.avg("l_discount").alias("d"))
        .select(
            F.col("l_partkey").cast("long").alias("id_assessment"),
            F.col("o_custkey").cast("long").alias("id_student"),
            F.col("q").cast("long").alias("date_submitted"),
            F.lit(0).cast("long").alias("is_banked"),
            F.round(F.lit(100.0) - F.lit(500.0) * F.col("d"), 2).alias("score"),
        )
    )


class _LazyTables(dict):
    """Table container that builds each view on first access (analysis of unused views skipped)."""

    def __init__(self, builders):
        super().__init__()
        self._builders = builders

    def __missing__(self, name):
        if name not in self._builders:
            raise KeyError(name)
        value = self._builders[name]()
        self[name] = value
        return value

    def _all(self):
        for name in self._builders:
            self[name]  # noqa: B018 - builds the view
        return self

    def keys(self):
        return dict.keys(self._all())

    def items(self):
        return dict.items(self._all())

    def values(self):
        return dict.values(self._all())

    def __iter__(self):
        return iter(dict.keys(self._all()))

    def __len__(self):
        return len(self._builders)

    def __contains__(self, name):
        return name in self._builders

    def get(self, name, default=None):
        return self[name] if name in self._builders else default


def fixture_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All seven cohort tables over the generated parquet at ``sf_dir`` (lazy; each view is
    analysed on first use)."""
    tables = _LazyTables({})

    def info():
        df = student_info(spark, sf_dir)
        checks.assert_unique_keys(df, KEYS["student_info"])
        return df

    def registration():
        # one row per row of student_info with the same key, which is checked there
        df = student_registration(tables["student_info"])
        checks.mark_unique(df, KEYS["student_registration"])
        return df

    tables._builders.update({
        "courses": lambda: _embedded(spark, courses(student_info(spark, sf_dir))),
        "assessments": lambda: assessments(spark, sf_dir),
        "student_info": info,
        "student_registration": registration,
        "student_assessment": lambda: student_assessment(spark, sf_dir),
        "vle": lambda: _embedded(spark, vle(spark, sf_dir, tables["courses"])),
        "student_vle": lambda: student_vle(spark, sf_dir),
    })
    return tables

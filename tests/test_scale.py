"""Checks of the scale-oriented plan pieces: bounded broadcast, skew-safe joins, distributed
running sums and grouped exact quantiles, and a student holding a large share of all clicks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from coursepulse.functions.dims import bounded_broadcast, mark_bounded, row_bound
from coursepulse.operators import checks, clicks, stats
from coursepulse.operators.numbering import number_rows, running_sums
from coursepulse.plans import flows
from tests.conftest import K3, clicks_df


def test_bounded_broadcast_checks_and_falls_back(spark):
    small = spark.range(10)
    assert row_bound(bounded_broadcast(small, 100)) == 10
    big = spark.range(1000)
    out = bounded_broadcast(big, 100)
    assert out is big  # above the bound: left to a shuffle join
    declared = mark_bounded(spark.range(5), 5)
    assert row_bound(bounded_broadcast(declared, 100)) == 5


def test_left_join_many_equals_left_join(spark):
    left = spark.createDataFrame([(i,) for i in range(6)], "k long")
    right = spark.createDataFrame([(0, v) for v in range(500)] + [(2, 1), (3, 7)], "k long, v long")
    a = sorted(tuple(r) for r in clicks.left_join_many(left, right, ["k"]).select("k", "v").collect())
    b = sorted(tuple(r) for r in left.join(right, "k", "left").select("k", "v").collect())
    assert a == b


def test_outer_indicator_with_small_side(spark):
    big = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (9, "w")], "k long, a string")
    small = mark_bounded(spark.createDataFrame([(1, "s1"), (3, "s3")], "k long, b string"), 2)
    got = {r["_merge"]: r["n"] for r in checks.indicator_counts(checks.merge_with_indicator(big, small, ["k"], "outer")).collect()}
    assert got == {"both": 2, "left_only": 2, "right_only": 1}


def test_running_sums_survive_union(spark):
    df = spark.createDataFrame([(float(i % 13), 1) for i in range(300)], "s double, one long")
    cum = running_sums(df, ["s"], ["one"], count_col="pos")
    other = spark.createDataFrame([(99.0, 0, 0, 0)], "s double, one long, cum_one long, pos long")
    u = other.unionByName(cum)  # partition numbers shift inside the union
    rows = u.where(F.col("s") < 99).orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(300))
    assert [r["cum_one"] for r in rows] == list(range(1, 301))


def test_number_rows_order(spark):
    df = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "k long")
    out = sorted((r["k"], r["rn"]) for r in number_rows(df, ["k"], "rn").collect())
    assert [rn for _, rn in out] == list(range(101))


def test_grouped_exact_quantiles(spark):
    rng = np.random.default_rng(3)
    data = [("a", float(x)) for x in rng.normal(size=700)] + [("b", float(x)) for x in rng.exponential(size=300)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {(r["g"], r["q"]): r["value"] for r in stats.exact_quantiles(df, "x", [0.1, 0.5, 0.95], by=["g"]).collect()}
    for g in ("a", "b"):
        xs = np.array([x for gg, x in data if gg == g])
        for q in (0.1, 0.5, 0.95):
            assert got[(g, q)] == pytest.approx(float(np.quantile(xs, q)))


def test_hot_student_engagement(spark):
    # one student holds most of the clicks: the results equal a direct computation
    rows = [(1, d % 14 + 1, 1, d % 3) for d in range(3000)] + [(2, 3, 5, 0), (3, 9, 2, 1)]
    cl = clicks_df(spark, rows)
    vle = spark.createDataFrame([(i, "AAA", "2013J", a) for i, a in enumerate(["quiz", "url", "page"])],
                                "id_site long, code_module string, code_presentation string, activity_type string")
    eng = {r["id_student"]: r for r in flows.engagement(cl, vle, segment_days=14).collect()}
    assert eng[1]["sum_click"] == 3000
    assert eng[1]["longest_ones"] == 14 and eng[1]["longest_zeros"] == 0
    assert eng[1]["quiz"] + eng[1]["url"] + eng[1]["page"] == pytest.approx(1.0)
    assert eng[2]["longest_zeros"] == 11 and eng[2]["peak"] == 1.0
    eff = {r["id_student"]: r["effort"] for r in clicks.effort(clicks.daily_clicks(cl), 1, 14).collect()}
    assert eff == {1: 3000, 2: 5, 3: 2}


def test_stratified_sample_exact_sizes(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3] if i % 10 else "a") for i in range(2000)], "id long, g string")
    s = stats.sample_per_outcome(df, "g", 0.1, seed=3, keys=["id"])
    got = {r["g"]: r["count"] for r in s.groupBy("g").count().collect()}
    want = {r["g"]: round(0.1 * r["count"]) for r in df.groupBy("g").count().collect()}
    assert got == want
    again = stats.sample_per_outcome(df, "g", 0.1, seed=3, keys=["id"])
    assert sorted(r["id"] for r in s.collect()) == sorted(r["id"] for r in again.collect())

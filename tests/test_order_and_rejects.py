"""Order-aware aggregates, carried neighbours, given measures, week overlaps and rejected values on small tables."""

import random
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from coursepulse.operators import clicks, regularity
from coursepulse.operators.model import roc_points
from coursepulse.operators.numbering import running_sums
from coursepulse.sources import load_csv_tables, load_csv_with_rejects
from tests.conftest import clicks_df


def test_aggregates_equal_pandas(spark):
    r = random.Random(3)
    rows = [(s, d, r.choice([1, 2, 2, 7, None]), r.randint(1, 5)) for s in range(30) for d in range(r.randint(1, 9))]
    rows += [(90, 1, 4, 1)] * 5 + [(91, 1, None, 1), (92, 0, 3, 2), (92, 0, 3, 2), (92, 0, 1, 2), (92, None, 8, 2)]
    df = clicks_df(spark, rows).repartition(5)
    pdf = pd.DataFrame(rows, columns=["id_student", "date", "sum_click", "id_site"])
    # the order of a row: NULL days first, then day, site, clicks
    pdf = pdf.sort_values(["date", "id_site", "sum_click"], na_position="first", kind="stable")
    for agg in ("prod", "sem", "skew", "nunique", "first", "last"):
        got = {x["id_student"]: x["sum_click"] for x in clicks.aggregate_clickstream(df, by=[], agg=agg).collect()}
        want = pdf.groupby("id_student")["sum_click"].agg(agg)
        for s, w in want.items():
            assert got[s] is None if pd.isna(w) else got[s] == pytest.approx(w, abs=1e-9), (agg, s)
    with pytest.raises(ValueError):
        clicks.aggregate_clickstream(df, agg="mode")
    assert clicks.aggregate_clickstream(df.limit(0), by=["date"], agg="first").collect() == []


def test_first_is_combined_before_the_shuffle(spark):
    df = clicks.aggregate_clickstream(clicks_df(spark, [(1, 1, 2)]), by=["date"], agg="first")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in p and "Window" not in p and p.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_next_row_across_partitions_and_batches(spark, parts):
    r = random.Random(parts)
    vals = [(i, r.choice([None, r.randint(0, 2 ** 60)]), r.random()) for i in range(300)]
    df = spark.createDataFrame(vals, "k long, v long, x double").repartition(3)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = running_sums(df, ["k"], [], count_col="i", partitions=parts, next_of=["v", "x"]).orderBy("k").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    assert [x["i"] for x in got] == list(range(300))
    assert [(x["next_v"], x["next_x"]) for x in got] == [v[1:] for v in vals[1:]] + [(None, None)]
    assert running_sums(df.limit(0), ["k"], [], next_of=["v"]).collect() == []
    texts = running_sums(df.withColumn("s", F.col("k").cast("string")), ["k"], ["k"], next_of=["s"]).orderBy("k").collect()
    assert [x["next_s"] for x in texts] == [str(i) for i in range(1, 300)] + [None]
    assert [x["cum_k"] for x in texts] == list(np.cumsum(range(300)))


def test_roc_bends_without_a_join(spark):
    r = random.Random(8)
    rows = [(float(r.random() < 0.4), round(r.random(), 2)) for _ in range(400)]
    df = spark.createDataFrame(rows, "label double, score double").repartition(4)
    out = roc_points(df)
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in p and "HashJoin" not in p and "Window" not in p
    n1 = sum(y for y, _ in rows)
    n0 = len(rows) - n1
    pts = [(sum(y == 0 and s >= t for y, s in rows), sum(y == 1 and s >= t for y, s in rows), t)
           for t in sorted({s for _, s in rows}, reverse=True)]
    keep = [q for i, q in enumerate(pts) if i in (0, len(pts) - 1)
            or any(pts[i - 1][k] - 2 * q[k] + pts[i + 1][k] for k in (0, 1))]
    want = [(float("inf"), 0.0, 0.0)] + [(t, f / n0, c / n1) for f, c, t in keep]
    got = sorted(map(tuple, out.collect()))
    assert len(got) == len(want) and np.allclose(got, sorted(want), rtol=0, atol=1e-12)


def test_week_overlap_equals_all_pairs(spark):
    r = random.Random(5)
    days = {s: sorted(r.sample(range(120), r.randint(1, 100))) for s in range(25)} | {77: [300], 78: [3], 79: list(range(7))}
    df = clicks_df(spark, [(s, d, r.randint(1, 9)) for s, ds in days.items() for d in ds] + [(80, 5, 0), (81, 5, None)])
    got = {x["id_student"]: x for x in regularity.time_regularity(df, 0, 119, ["ws1"], prefix="").collect()}
    for s, ds in days.items():
        weeks = {}
        for d in ds:
            if d < 120:
                weeks.setdefault(d // 7, set()).add(d % 7)
        pairs = [len(a & b) / max(len(a), len(b)) for a, b in combinations(weeks.values(), 2)]
        assert got[s]["ws1"] == (pytest.approx(np.mean(pairs)) if pairs else None)
    everything = {x["id_student"]: x for x in regularity.time_regularity(df, 0, 119, prefix="").collect()}
    for s in (77, 80, 81):  # no active day
        assert all(everything[s][m] is None for m in ("pwd", "ws1", "ws2", "ws3", "fwd"))
    p = regularity.time_regularity(df, 0, 119, ["ws1"])._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in p and "lambda" not in p and p.count("Exchange") == 1


def test_given_measures(spark):
    df = clicks_df(spark, [(1, 0, 2), (1, 3, 1), (1, 3, 1), (1, 9, 5), (2, 12, 1), (3, -1, 4)])
    measures = {"cube": lambda x: x ** 3, "late": regularity.arrow_measure(lambda x: x > 0.2),
                "some": lambda x: F.when(x > 0, 1 / x), "nan": regularity.arrow_measure(lambda x: x * np.nan)}
    got = {r["id_student"]: r for r in regularity.procrastination(df, user_defined_range=(0, 9), measures=measures).collect()}
    assert set(got) == {1, 2} and all(got[2][m] is None for m in measures)
    assert got[1]["cube"] == pytest.approx((2 * 0.3 ** 3 + 5 * 0.9 ** 3) / 9) and got[1]["late"] == pytest.approx(7 / 9)
    assert got[1]["some"] == pytest.approx((2 / 0.3 + 5 / 0.9) / 7) and got[1]["nan"] is None
    same = regularity.procrastination(df, user_defined_range=(0, 9), measures=regularity.PROCRASTINATION).collect()
    plain = regularity.procrastination(df, user_defined_range=(0, 9)).collect()
    flat = lambda rows: sorted((r["id_student"], *[-1 if r[m] is None else round(r[m], 12) for m in regularity.PROCRASTINATION]) for r in rows)
    assert flat(same) == flat(plain)


def test_rejected_values(spark, tmp_path):
    (tmp_path / "vle.csv").write_text("code_module,code_presentation,id_site,activity_type,week_from,week_to\n"
                                      "AAA,2013J,1,quiz,,3\nAAA,2013J,x2,quiz,one,3\nAAA,2013J,3,quiz\nAAA,2013J,4,url,1,2,9\n"
                                      "AAA,2013J,5,\"a, b\",1,2\n")
    (tmp_path / "courses.csv").write_text("code_module,code_presentation,module_presentation_length\nAAA,2013J,268\nBBB,2013J,9.5.1\n")
    tables, rejected = load_csv_with_rejects(spark, str(tmp_path), ["vle", "courses"])
    assert sorted(r["id_site"] for r in tables["vle"].collect()) == [1, 5] and tables["courses"].count() == 1
    assert dict(tables["vle"].dtypes) == dict(load_csv_tables(spark, str(tmp_path), ["vle"])["vle"].dtypes)
    got = {(r["table"], r["column"], r["value"], r["reason"].split()[0]) for r in rejected.collect()}
    assert got == {("vle", "id_site", "x2", "not"), ("vle", "week_from", "one", "not"), ("courses", "module_presentation_length", "9.5.1", "not"),
                   ("vle", None, "AAA,2013J,3,quiz", "wrong"), ("vle", None, "AAA,2013J,4,url,1,2,9", "wrong")}
    assert all(r["file"].endswith(f"{r['table']}.csv") for r in rejected.collect())


@pytest.mark.parametrize("name", ["f11_outcome_metrics", "f7_activity_regularity", "f10_procrastination"])
def test_measures_need_no_window(spark, name):
    from coursepulse.plans.registry import load_all

    assert "Window" not in load_all()[name].fn(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_week_counts_beyond_one_long(spark):
    # a window of 20 years: a count takes 11 bits, so the seven weekdays need two longs
    rows = [(1, 7 * w + d, 1) for w in range(1000) for d in range(w % 7 + 1)]
    got = regularity.time_regularity(clicks_df(spark, rows), 0, 7299, ["ws1", "pwd"], prefix="").first()
    sizes = [w % 7 + 1 for w in range(1000)]
    want = sum(min(a, b) / max(a, b) for a, b in combinations(sizes, 2)) / (1000 * 999 / 2)
    held = np.array([sum(s > d for s in sizes) for d in range(7)])
    share = held / held.sum()
    assert got["ws1"] == pytest.approx(want) and got["pwd"] == pytest.approx((np.log(7) + (share * np.log(share)).sum()) * held.max())

"""Hand-made goldens: tiny inputs with known outputs for the operators (FIXTURES.md section 3)."""

import math

import pytest
from pyspark.sql import functions as F

from coursepulse.functions.columns import band_average, day_in_segment, segment_of
from coursepulse.operators import clicks, distributions, encode, model, regularity, split, stats
from coursepulse.operators.features import Feature, FeatureAlreadyDefined, FeatureDict
from coursepulse.plans import feature_pool as fp
from coursepulse.plans import flows
from tests.conftest import K3, clicks_df


def _by_student(df, col):
    return {r["id_student"]: r[col] for r in df.collect()}


def test_b8_pre_test_filter(spark):
    cl = clicks_df(spark, [(1, 20, 1), (2, 20, 1), (3, 20, 1), (4, 21, 1)])
    asm = spark.createDataFrame([("AAA", "2013J", 1, 20)], "code_module string, code_presentation string, "
                                                           "id_assessment long, date long")
    reg = spark.createDataFrame([("AAA", "2013J", 1, None), ("AAA", "2013J", 2, 7), ("AAA", "2013J", 3, 8),
                                 ("AAA", "2013J", 4, None)],
                                "code_module string, code_presentation string, id_student long, date_unregistration long")
    kept = sorted(r["id_student"] for r in clicks.pre_test_clicks(cl, asm, reg).collect())
    assert kept == [1, 3]


def test_c1_split_nulls_go_to_test(spark):
    df = spark.createDataFrame([("2013B",), ("2014J",), (None,)], "code_presentation string")
    tr, te = split.train_test_split_df(df)
    assert [r[0] for r in tr.collect()] == ["2013B"]
    assert sorted(r[0] or "" for r in te.collect()) == ["", "2014J"]


def test_e3_effort_window_keeps_groups(spark):
    cl = clicks_df(spark, [(1, 40, 5), (2, 0, 3), (2, 32, 4), (2, 33, 9)])
    eff = _by_student(clicks.effort(clicks.daily_clicks(cl), 0, 32), "effort")
    assert eff == {1: 0, 2: 7}


def test_e3_effort_additive(spark):
    cl = clicks_df(spark, [(1, d, d + 1) for d in range(0, 40, 3)])
    daily = clicks.daily_clicks(cl)
    a = _by_student(clicks.effort(daily, 0, 10), "effort")[1]
    b = _by_student(clicks.effort(daily, 11, 30), "effort")[1]
    c = _by_student(clicks.effort(daily, 0, 30), "effort")[1]
    assert a + b == c


def test_e4_schedule(spark):
    asm = spark.createDataFrame([("AAA", "2013J", i, d) for i, d in enumerate([50, None, 10, 30, 20])],
                                "code_module string, code_presentation string, id_assessment long, date long")
    assert clicks.test_schedule(asm, 3).first()["dates"] == [10, 20, 30]


def test_e6_segments(spark):
    df = spark.createDataFrame([(d,) for d in [-30, -29, 0, 1, 30, 31]], "date long")
    out = df.select(segment_of(F.col("date"), 30).alias("s"), day_in_segment(F.col("date"), 30).alias("d")).collect()
    assert [r["s"] for r in out] == [-1, 0, 0, 1, 1, 2]
    assert [r["d"] for r in out] == [30, 1, 30, 1, 30, 1]


def test_e12_kurtosis_bias_corrected(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 2.5, 9, 4, 4.5]], "x double")
    assert df.agg(stats.sample_kurtosis("x")).first()[0] == pytest.approx(2.266623, abs=1e-6)


def test_e13_e14_runs_and_entropy(spark):
    # 5-day segments: student 1 active on days 2, 3; student 2 on all five days equally
    cl = clicks_df(spark, [(1, 2, 1), (1, 3, 1)] + [(2, d, 1) for d in range(1, 6)])
    vle = spark.createDataFrame([(1, "AAA", "2013J", "quiz")],
                                "id_site long, code_module string, code_presentation string, activity_type string")
    eng = flows.engagement(cl, vle, segment_days=5)
    rows = {r["id_student"]: r for r in eng.collect()}
    assert (rows[1]["longest_zeros"], rows[1]["longest_ones"]) == (2, 2)
    assert (rows[2]["longest_zeros"], rows[2]["longest_ones"]) == (0, 5)
    assert rows[1]["entropy"] == pytest.approx(1.0)
    cl3 = clicks_df(spark, [(3, 1, 2), (3, 2, 1), (3, 3, 1)])
    e3 = flows.engagement(cl3, vle, segment_days=5).first()
    assert e3["entropy"] == pytest.approx(1.5)
    assert e3["quiz"] == pytest.approx(1.0)
    assert e3["day_1"] == pytest.approx(0.5) and e3["day_5"] == 0.0


def test_e20_flatten(spark):
    joint = spark.createDataFrame([("AAA", "2013J", 1, 0, "a", .1), ("AAA", "2013J", 1, 0, "b", .2),
                                   ("AAA", "2013J", 1, 1, "a", .5), ("AAA", "2013J", 1, 1, "b", .2)],
                                  "code_module string, code_presentation string, id_student long, date long, "
                                  "activity_type string, p double")
    assert distributions.flatten_joint(joint).first()["vector"] == [.1, .2, .5, .2]


def test_e22_quantile(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 4, 9]], "x double")
    q = stats.exact_quantiles(df, "x", [0.33]).first()["value"]
    assert q == pytest.approx(1.99)


def test_e22_quantiles_many_rounds(spark):
    # heavy ties and a long tail force several narrowing rounds with a small final bucket
    vals = [float(i % 7) for i in range(3000)] + [1e6 * i for i in range(50)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0, 0.1, 0.33, 0.5, 0.9, 0.99, 1]
    got = stats.order_statistics(df, "x", [((), k) for k in (0, 100, 1500, 3049)], final_rows=10)
    srt = sorted(vals)
    assert got == [srt[0], srt[100], srt[1500], srt[3049]]
    import numpy as np
    exp = np.quantile(np.array(vals), probs)
    res = {r["q"]: r["value"] for r in stats.exact_quantiles(df, "x", probs).collect()}
    for p, e in zip(probs, exp):
        assert res[p] == pytest.approx(e)


def _daily(spark, days, weights=None):
    weights = weights or [1] * len(days)
    return clicks.daily_clicks(clicks_df(spark, [(1, d, w) for d, w in zip(days, weights)]))


def test_f2_pwd(spark):
    r = regularity.time_regularity(_daily(spark, [0, 7, 14]), 0, 20, ["pwd"], prefix="").first()
    assert r["pwd"] == pytest.approx(3 * math.log(7), abs=1e-6)


def test_f3_ws1(spark):
    r = regularity.time_regularity(_daily(spark, [0, 1, 8, 9]), 0, 13, ["ws1"], prefix="").first()
    assert r["ws1"] == pytest.approx(0.5)


def test_f4_ws2(spark):
    r = regularity.time_regularity(_daily(spark, [0, 7, 8]), 0, 13, ["ws2"], prefix="").first()
    assert r["ws2"] == pytest.approx(0.688722, abs=1e-6)


def test_f5_ws3(spark):
    r = regularity.time_regularity(_daily(spark, [0, 7, 8], [2, 1, 1]), 0, 13, ["ws3"], prefix="").first()
    assert r["ws3"] == pytest.approx(0.444444, abs=1e-6)


def test_f6_fwd(spark):
    r = regularity.time_regularity(_daily(spark, [0, 7, 14, 21]), 0, 27, ["fwd"], prefix="").first()
    assert r["fwd"] == pytest.approx(16 / 28)


def test_f_single_week_and_empty_window(spark):
    cl = clicks_df(spark, [(1, 1, 1), (1, 2, 1), (2, 40, 3)])
    out = {r["id_student"]: r for r in regularity.time_regularity(clicks.daily_clicks(cl), 0, 6, prefix="").collect()}
    assert out[1]["ws1"] is None and out[1]["pwd"] is not None
    assert all(out[2][m] is None for m in ["pwd", "ws1", "ws2", "ws3", "fwd"])


def test_f8_concentration(spark):
    vle = spark.createDataFrame([(i, "AAA", "2013J", a) for i, a in enumerate(regularity.ACTIVITIES)],
                                "id_site long, code_module string, code_presentation string, activity_type string")
    one = clicks_df(spark, [(1, 0, 5, 0)])
    all_eq = clicks_df(spark, [(2, 0, 1, i) for i in range(19)])
    out = {r["id_student"]: r for r in regularity.activity_regularity(
        one.unionByName(all_eq), vle, user_defined_range=(0, 10)).collect()}
    assert out[1]["concentration"] == pytest.approx(1.0)
    assert out[2]["concentration"] == pytest.approx(0.0, abs=1e-12)
    assert out[1]["consistency"] == pytest.approx(1.0)


def test_f10_procrastination(spark):
    r = regularity.procrastination(clicks_df(spark, [(1, 0, 1), (1, 1, 1)]), user_defined_range=(0, 3)).first()
    assert r["proc1"] == pytest.approx(0.125)
    assert r["proc2"] == pytest.approx(1.166667, abs=1e-6)
    assert r["proc3"] == pytest.approx(0.160964, abs=1e-6)


def test_g1_numeric(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (3.0,)], "x double")
    enc = encode.NumericData().fit(df, "x")
    assert [r[0] for r in df.select(enc.column("x")).collect()] == [-1.0, 0.0, 0.0, 1.0]


def test_g1_zero_std_is_null(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    enc = encode.NumericData().fit(df, "x")
    assert [r[0] for r in df.select(enc.column("x")).collect()] == [None, None]


def test_g2_top_n(spark):
    df = spark.createDataFrame([(v,) for v in "xxyyz"], "c string")
    enc = encode.CategoricalData(most_common=2).fit(df, "c")
    assert enc.params["c"] == ["x", "y"]
    rows = df.select(*enc.columns("c")).collect()
    assert [tuple(r) for r in rows][-1] == (0.0, 0.0)
    assert rows[0].asDict() == {"c_x": 1.0, "c_y": 0.0}


def test_g3_ordinal(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "b", None, "z", "a"]], "c string")
    enc = encode.OrdinalData(["a", "b", "c"]).fit(df, "c")
    assert [r[0] for r in df.select(enc.column("c")).collect()] == [1, 1, 1, 1, 0]


def test_g9_response(spark):
    info = spark.createDataFrame([("AAA", "2013J", i, v) for i, v in enumerate(["Pass", "Distinction", "Fail",
                                                                                 "Withdrawn"])],
                                 "code_module string, code_presentation string, id_student long, final_result string")
    fd = fp.get_response({"student_info": info}, [["Pass", "Distinction"], ["Fail"]])
    assert _by_student(fd.merge().data, "responce") == {0: 0.0, 1: 0.0, 2: 1.0}
    with pytest.raises(ValueError):
        fp.get_response({"student_info": info}, [])


def test_g11_band_average(spark):
    df = spark.createDataFrame([(v,) for v in ["0-35", "55<=", "10-20", "90-100%", None]], "b string")
    assert [r[0] for r in df.select(band_average(F.col("b"))).collect()] == [17.5, 55.0, 15.0, 95.0, None]


def test_h3_union_conflict_and_row_set(spark):
    a, b = FeatureDict(), FeatureDict()
    info = spark.createDataFrame([("AAA", "2013J", i, "Fail" if i == 0 else "Pass") for i in range(3)],
                                 "code_module string, code_presentation string, id_student long, final_result string")
    a["x"] = Feature("x", info.select(*K3, F.lit(1).alias("x")), K3)
    b["x"] = Feature("x", info.select(*K3, F.lit(2).alias("x")), K3)
    with pytest.raises(FeatureAlreadyDefined):
        a.update(b)
    fd = fp.get_response({"student_info": info}, [["Fail"]])
    fd["f"] = Feature("f", info.select(*K3, F.lit(5).alias("f")), K3)
    assert fd.merge().data.count() == 1
    assert fp.merge_features(fd).count() == 1
    with pytest.raises(ValueError):
        FeatureDict().merge()


def test_m1_anova(spark):
    df = spark.createDataFrame([(g, float(x)) for g, xs in (("a", [1, 2, 3]), ("b", [2, 3, 4]), ("c", [3, 4, 5]))
                                for x in xs], "group string, m double")
    r = stats.anova(df, ["m"], "group").first()
    assert r["f_stat"] == pytest.approx(3.0)
    assert r["p_value"] == pytest.approx(0.125, abs=1e-3)  # F(2, 6) tail at 3.0


def test_m11_m14_metrics(spark):
    sc = spark.createDataFrame([(0.0, 0.2, 0.0), (1.0, 0.6, 1.0), (1.0, 0.9, 1.0)],
                               "label double, score double, prediction double")
    m = model.classification_metrics(sc).first()
    assert (m["precision"], m["recall"], m["f1"], m["auc"]) == (1.0, 1.0, 1.0, 1.0)
    best = model.best_threshold(model.threshold_f1(sc)).first()
    assert best["f1"] == 1.0 and best["threshold"] == pytest.approx(0.20)
    assert len(model.threshold_grid()) == 99


def test_m12_m13_roc_confusion(spark):
    sc = spark.createDataFrame([(0.0, 0.1, 0.0), (0.0, 0.4, 0.0), (1.0, 0.35, 0.0), (1.0, 0.8, 1.0)],
                               "label double, score double, prediction double")
    pts = sorted((r["fpr"], r["tpr"]) for r in model.roc_points(sc).collect())
    assert pts == [(0.0, 0.0), (0.0, 0.5), (0.5, 0.5), (0.5, 1.0), (1.0, 1.0)]
    assert model.classification_metrics(sc).first()["auc"] == pytest.approx(0.75)
    cm = {(r["label"], r["prediction"]): r["n"] for r in model.confusion_matrix(sc).collect()}
    assert cm == {(0.0, 0.0): 2, (0.0, 1.0): 0, (1.0, 0.0): 1, (1.0, 1.0): 1}

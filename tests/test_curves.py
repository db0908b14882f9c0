"""Bootstrap bands, densities, quantiles of many groups and positional joint arrays on small tables."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from coursepulse.operators import distributions as dist
from coursepulse.operators import stats

K3 = ["code_module", "code_presentation", "id_student"]


@pytest.fixture(scope="module")
def log(spark):
    r = random.Random(4)
    daily = [("A", "T", s, d, r.randint(1, 9)) for s in range(40) for d in range(-2, 6) if r.random() < 0.4]
    info = [("A", "T", s, "Pass" if s % 3 else "Fail") for s in range(40)]
    return (spark.createDataFrame(daily, "code_module string, code_presentation string, id_student long, date long, sum_click long"),
            spark.createDataFrame(info, "code_module string, code_presentation string, id_student long, final_result string"),
            daily, dict((x[2], x[3]) for x in info))


def test_curve_equals_the_dense_grid(spark, log):
    daily, info, _, _ = log
    want = stats.mean_daily_curve(stats.dense_daily(daily, -2, 6), info)
    got = stats.daily_curve(daily, info, -2, 6)
    key = lambda r: (r["final_result"], r["date"])
    a, b = ({key(r): r for r in x.collect()} for x in (want, got))
    assert set(a) == set(b) and len(a) == 18  # day 6 has no clicks at all
    for k in a:
        assert [a[k][c] for c in ("mean", "std", "n", "sem")] == pytest.approx([b[k][c] for c in ("mean", "std", "n", "sem")], abs=1e-12)


def test_bootstrap_against_a_loop_and_over_partitions(spark, log):
    daily, info, rows, outcome = log
    reps, level = 24, 0.8
    steps = stats.POISSON_STEPS
    assert steps[0] / 2 ** 32 == pytest.approx(math.exp(-1)) and len(steps) == len(set(steps))
    weights = {}
    for s in {x[2] for x in rows}:
        text = "".join(hashlib.sha256(f"A|T|{s}|3|{b}".encode()).hexdigest() for b in range(3))
        weights[s] = [sum(int(text[8 * b:8 * b + 8], 16) >= t for t in steps) for b in range(reps)]
    assert 0.8 < np.mean(list(weights.values())) < 1.2
    per = defaultdict(lambda: [0] * reps)
    for _, _, s, d, c in rows:
        for b in range(reps):
            per[outcome[s], d][b] += weights[s][b] * c
    n = {o: [sum(w[b] for s, w in weights.items() if outcome[s] == o) for b in range(reps)] for o in ("Pass", "Fail")}
    one = stats.bootstrap_bands(daily.repartition(7), info.repartition(3), -2, 6, reps, level, seed=3).collect()
    two = stats.bootstrap_bands(daily.coalesce(1), info, -2, 6, reps, level, seed=3).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two)) and len(one) == 18
    for r in one:
        means = [per[r["final_result"], r["date"]][b] / n[r["final_result"]][b] for b in range(reps)]
        assert (r["low"], r["high"]) == pytest.approx(tuple(np.quantile(means, [0.1, 0.9])), abs=1e-12)


def test_density_equals_the_direct_sum(spark):
    r = random.Random(1)
    x = [r.choice([0, 1, 1, 2, 7, 20]) for _ in range(500)]
    df = spark.createDataFrame([(float(v), float(v % 3)) for v in x] + [(None, 1.0), (float("nan"), 2.0)], "x double, y double").repartition(5)
    w = stats.silverman_width(len(x), float(np.std(x, ddof=1)))
    got = stats.density(df, "x", 0.5).collect()
    for row in got:
        want = sum(math.exp(-((row["x"] - v) / w) ** 2 / 2) for v in x) / (len(x) * w * math.sqrt(2 * math.pi))
        assert row["density"] == pytest.approx(want, rel=1e-9)
    assert sum(r["density"] for r in got) * 0.5 == pytest.approx(1, abs=0.01)
    both = stats.density2(df, ["x", "y"], [1.0, 0.5], widths=[2.0, 0.7]).collect()
    for row in both:
        want = sum(math.exp(-((row["x"] - v) / 2.0) ** 2 / 2 - ((row["y"] - v % 3) / 0.7) ** 2 / 2) for v in x) / (len(x) * 1.4 * 2 * math.pi)
        assert row["density"] == pytest.approx(want, rel=1e-9)
    same = spark.createDataFrame([(5.0,)] * 3, "x double")
    assert stats.density(same, "x", 1.0).collect() == [] and stats.density(same.limit(0), "x", 1.0).collect() == []
    assert stats.density(same, "x", 1.0, width=1.0).count() == 7
    with pytest.raises(ValueError):
        stats.density(df, "x", 1e-9)


def test_quantiles_of_many_groups(spark):
    r = random.Random(2)
    rows = [(g if g else None, h, r.choice([r.random(), 1.0, 2.0])) for g in range(60) for h in "ab" for _ in range(r.randint(1, 9))]
    rows += [(5, "a", 3.0)] * 400 + [(1, "a", None), (1, "b", float("nan")), (99, "z", None)]
    df = spark.createDataFrame(rows, "g long, h string, v double").repartition(6)
    probs = [0.0, 0.1, 0.5, 0.97, 1.0]
    got = {(x["g"], x["h"], x["q"]): x["value"] for x in stats.group_quantiles(df, "v", probs, ["g", "h"]).collect()}
    by = defaultdict(list)
    for g, h, v in rows:
        if v is not None and v == v:
            by[g, h].append(v)
    want = {(*k, q): float(np.quantile(v, q)) for k, v in by.items() for q in probs}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    assert stats.group_quantiles(df.limit(0), "v", probs, ["g"]).collect() == []


def test_joint_arrays_keep_activities_of_days_before_the_start(spark):
    rows = [("A", "T", 1, 0, "quiz", 2.0, 3, 0.0), ("A", "T", 1, 2, "forum", 2.0, 1, 0.0), ("A", "T", 1, -4, "wiki", 2.0, 9, 0.0),
            ("A", "T", 2, 1, "quiz", 2.0, 4, 1.0), ("A", "T", 3, -1, "wiki", 2.0, 4, 1.0), ("A", "T", 4, 2, "quiz", -1.0, 4, 1.0)]
    base = spark.createDataFrame(rows, "code_module string, code_presentation string, id_student long, date long, activity_type string, "
                                       "date_assessment double, sum_click long, final_result double")
    got = {r["id_student"]: r for r in dist.joint_arrays(base).collect()}
    assert got[1]["acts"] == ["forum", "quiz", "wiki"] and set(got) == {1, 2}  # 3 has no click from day 0 on, 4 no day
    assert got[1]["cells"] == [0, 3, 0, 0, 0, 0, 1, 0, 0] and got[2]["cells"] == [0, 0, 0, 0, 4, 0, 0, 0, 0]
    neg = {r["id_student"]: r for r in dist.joint_arrays(base, ignore_neg_date=False).collect()}
    assert neg[1]["d0"] == -4 and len(neg[1]["cells"]) == 21 and neg[1]["cells"][2] == 9
    some = dist.joint_arrays(base, activities=["quiz"]).where(F.col("id_student") == 1).first()
    assert some["cells"] == [3, 0, 0] and some["tot"] == 4
    assert [tuple(r) for r in dist.joint_distribution(base).where("id_student = 1 and clicks > 0").select("date", "activity_type", "p").collect()
            ] == [(0, "quiz", 0.75), (2, "forum", 0.25)]
    assert dist.joint_vectors(base).where("id_student = 2").first()["vector"] == [0, 0, 0, 0, 1, 0, 0, 0, 0]

"""Wide value ranges, NaN, bad CSV values, encoders fitted on one split and applied to another."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from coursepulse.operators import stats
from coursepulse.operators.split import train_test_split
from coursepulse.plans import feature_pool as fp
from coursepulse.session import ensure_checkpoint_dir
from coursepulse.sources import fixture_tables, load_csv_tables

SF = "/root/testdata/sf0.001"


def test_order_statistics_over_many_orders_of_magnitude(spark):
    rows = [float(f"{s}1e{e}") for e in range(-300, 300) for s in ("", "-")] * 12 + [0.0] * 7
    df = spark.createDataFrame([(x,) for x in rows], "x double")
    want = sorted(rows)
    ranks = [0, 10, 7200, 7203, 7207, 9000, len(rows) - 1]
    assert stats.order_statistics(df, "x", [((), k) for k in ranks], final_rows=20) == [want[k] for k in ranks]


def test_order_statistics_ignore_nan(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, float("nan"), 4.0, None)] * 10, "x double")
    assert stats.order_statistics(df, "x", [((), 20), ((), 29)]) == [4.0, 4.0]
    assert stats.exact_quantiles(df, "x", [1.0]).first()["value"] == 4.0


def test_a_bad_csv_value_raises_unless_null_is_asked_for(spark):
    root = tempfile.mkdtemp(prefix="coursepulse-bad-")
    with open(os.path.join(root, "vle.csv"), "w") as f:
        f.write("id_site,code_module,code_presentation,activity_type\n1,AAA,2013J,quiz\nx7,AAA,2013J,quiz\n,AAA,2013J,quiz\n")
    with pytest.raises(PySparkException, match="id_site"):
        load_csv_tables(spark, root, ["vle"])["vle"].agg(F.sum("id_site")).collect()
    assert load_csv_tables(spark, root, ["vle"], bad_values="null")["vle"].where("id_site is null").count() == 2


def test_test_split_has_all_training_columns(spark):
    train, test = train_test_split(fixture_tables(spark, SF))
    fitted = fp.new_preprocessors()
    with pytest.raises(ValueError):
        fp.build_features(test, preprocessors=fitted, refit=False)
    a = fp.build_features(train, preprocessors=fitted)
    assert fp.build_features(test, preprocessors=fitted, refit=False).columns == a.columns


def test_no_machine_local_checkpoint_folder_on_a_cluster():
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


def test_few_rows_raises_instead_of_cutting(spark):
    from coursepulse.functions.dims import few_rows
    from coursepulse.operators.encode import top_categories

    assert len(few_rows(spark.range(5), "rows", 5)) == 5
    with pytest.raises(ValueError, match="more than 4 rows"):
        few_rows(spark.range(5), "rows", 4)
    many = spark.range(10_001).selectExpr("string(id) AS v")
    assert top_categories(many, "v", 2) == ["0", "1"]
    with pytest.raises(ValueError, match="values of v"):
        top_categories(many, "v", None)


def test_entropies_of_counts(spark):
    from coursepulse.operators.distributions import entropies

    rows = [(1, 0, "quiz", 4), (2, 0, "quiz", 1), (2, 0, "page", 1), (2, 3, "quiz", 2), (3, -1, "quiz", 5), (3, 2, "quiz", 1), (3, 99, "page", 7)]
    src = spark.createDataFrame([("A", "B", i, d, a, 10.5, c, 1.0) for i, d, a, c in rows],
                                "code_module string, code_presentation string, id_student long, date long, activity_type string, "
                                "date_assessment double, sum_click long, final_result double")
    got = {r.id_student: (r.entropy_joint, r.entropy_date, r.entropy_acty, r.result) for r in entropies(src).collect()}
    assert got[1] == (0, 0, 0, 1) and got[3] == (0, 0, 0, 1)
    assert got[2] == pytest.approx((1.5, 1.0, -0.75 * np.log2(0.75) + 0.5, 1))
    plan = entropies(src)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "collect_list" not in plan


def test_f_tail_against_printed_tables():
    from coursepulse.operators.stats import f_survival

    for f, d1, d2, p in [(4.9646, 1, 10, 0.05), (3.4928, 2, 20, 0.05), (5.6363, 5, 10, 0.01), (2.9223, 3, 30, 0.05), (4.1709, 1, 30, 0.05)]:
        assert f_survival(f, d1, d2) == pytest.approx(p, abs=2e-5)
    assert f_survival(3.0, 2, 7) == pytest.approx((1 + 6 / 7) ** -3.5)

"""Click distributions per student: activity maps and matrices, joint (day x activity) distribution,
marginals, flattening and entropies.

All per-student state is bounded by the number of days in the window times the number of activity
types; the click table itself is reduced by partial aggregation before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursepulse.functions.dims import bounded_broadcast
from coursepulse.operators.clicks import clicks_with_sites, first_assessment
from coursepulse.schema import ACTIVITIES, K2, K3, PASS_FAIL_WITHDRAWN


def activity_clicks(student_vle: DataFrame, vle: DataFrame) -> DataFrame:
    """Clicks on known sites from day 0, summed per (K3, date, activity_type)."""
    j = clicks_with_sites(student_vle.where(F.col("date") >= 0), vle, "inner")
    return j.groupBy(*K3, "date", "activity_type").agg(F.sum("sum_click").alias("sum_click"))


def day_activity_maps(act: DataFrame) -> DataFrame:
    """Per (K3, date): map activity -> clicks."""
    return act.groupBy(*K3, "date").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("activity_type", "sum_click")))).alias("activities"))


def activity_matrix(maps: DataFrame, activities: Sequence[str] = ACTIVITIES) -> DataFrame:
    """Per student: day x activity click matrix over a fixed activity list (0 when absent), by date."""
    acts = F.array(*[F.lit(a) for a in activities])
    row = F.transform(acts, lambda a: F.coalesce(F.try_element_at(F.col("activities"), a), F.lit(0)).cast("long"))
    per_day = maps.select(*K3, "date", row.alias("row"))
    rows = F.array_sort(F.collect_list(F.struct("date", "row")))
    return per_day.groupBy(*K3).agg(rows.alias("_r")).select(
        *K3, F.transform("_r", lambda x: x["date"]).alias("dates"),
        F.transform("_r", lambda x: x["row"]).alias("matrix"))


def entropy_base(student_vle: DataFrame, vle: DataFrame, assessments: DataFrame, info: DataFrame,
                 registration: DataFrame, unregistered_by: int = 7) -> DataFrame:
    """Clicks up to the first assessment (no early withdrawals), summed per (K3, date, activity) with
    the mean assessment date and mean outcome code (Pass/Distinction 0, Fail 1, Withdrawn 2).

    The per-course test date comes through a broadcast join and the clicks are aggregated before
    the per-student attributes are joined, so the student-key join sees at most one row per
    (student, day, activity); the per-student filter commutes with the aggregation.
    """
    first = bounded_broadcast(first_assessment(assessments)).withColumnRenamed(
        "first_assessment_date", "date_assessment")
    outcome = F.create_map(*[x for k, v in PASS_FAIL_WITHDRAWN.items() for x in (F.lit(k), F.lit(v))])
    reg = info.join(registration.select(*K3, "date_unregistration"), K3, "inner").select(
        *K3, "date_unregistration", F.try_element_at(outcome, F.col("final_result")).alias("final_result"))
    agg = (clicks_with_sites(student_vle, vle, "left").join(first, K2, "left")
           .where((F.col("date") <= F.col("date_assessment")) & F.col("activity_type").isNotNull())
           .groupBy(*K3, "date", "activity_type")
           .agg(F.avg("date_assessment").alias("date_assessment"), F.sum("sum_click").alias("sum_click")))
    keep = ~F.coalesce(F.col("date_unregistration") <= unregistered_by, F.lit(False))
    return (agg.join(reg, K3, "left").where(keep)
            .select(*K3, "date", "activity_type", "date_assessment", "sum_click",
                    F.col("final_result").cast("double").alias("final_result")))


def joint_arrays(base: DataFrame, ignore_neg_date: bool = True, activities: Sequence[str] | None = None) -> DataFrame:
    """Per student: ``d0`` (first day), ``acts`` (activities, sorted), ``tot`` (clicks) and ``cells``, the clicks of
    every (day, activity) from ``d0`` to int(mean assessment date) in one array, day-major, zeros included.

    The activities are those of the whole ``base``, also of clicks that ``ignore_neg_date`` leaves out (or the given
    list); they are one row that the plan itself computes. A student's sparse cells are sorted by their place in the array
    and the zeros before each are filled in: linear in days x activities, without a lookup by key.
    """
    src = base.where(F.col("date") >= 0) if ignore_neg_date else base
    acts = (F.array(*[F.lit(a) for a in activities]) if activities is not None else
            base.agg(F.array_sort(F.collect_set("activity_type"))).scalar())
    per = src.groupBy(*K3).agg(
        F.least(F.lit(0), F.min("date")).alias("d0"), F.avg("date_assessment").cast("long").alias("d1"),
        F.sum("sum_click").cast("long").alias("tot"),
        F.collect_list(F.struct(F.col("date"), F.col("activity_type"), F.col("sum_click").cast("long").alias("c"))).alias("raw"))
    per = per.where(F.col("d1") >= F.col("d0")).withColumn("acts", acts).withColumn("k", F.size("acts"))
    size = ((F.col("d1") - F.col("d0") + 1) * F.col("k")).cast("int")
    code = lambda x: F.array_position("acts", x["activity_type"])  # noqa: E731  (1-based, 0 where not listed)
    placed = F.transform(F.filter("raw", lambda x: (x["date"] <= F.col("d1")) & (code(x) > 0)), lambda x: F.struct(
        ((x["date"] - F.col("d0")) * F.col("k") + code(x) - 1).cast("int").alias("at"), x["c"].alias("c")))
    per = per.withColumn("placed", F.array_sort(placed)).withColumn("size", size)
    before = lambda i: F.when(i > 0, F.get("placed", i - 1)["at"]).otherwise(F.lit(-1))
    zeros = lambda n: F.array_repeat(F.lit(0).cast("long"), n)
    filled = F.flatten(F.transform("placed", lambda x, i: F.concat(zeros(x["at"] - before(i) - 1), F.array(x["c"]))))
    last = F.when(F.size("placed") > 0, F.element_at("placed", -1)["at"]).otherwise(F.lit(-1))
    return per.select(*K3, "d0", "acts", "tot", F.concat(filled, zeros(F.col("size") - last - 1)).alias("cells"))


def joint_distribution(base: DataFrame, ignore_neg_date: bool = True,
                       activities: Sequence[str] | None = None) -> DataFrame:
    """Dense joint distribution of a student's clicks over days x activities (zeros included).

    Days run from min(0, first day) to int(mean assessment date); activities are the ones present
    in the whole ``base`` (or the given list). One row per (K3, date, activity_type) with the cell's clicks
    (0 for an empty cell), the student's total and the share ``p = clicks / student_clicks``.
    """
    cells = joint_arrays(base, ignore_neg_date, activities).select(*K3, "d0", "acts", "tot", F.posexplode("cells").alias("at", "clicks"))
    k = F.size("acts")
    return cells.select(*K3, (F.col("d0") + F.floor(F.col("at") / k)).cast("long").alias("date"),
                        F.get("acts", F.col("at") % k).alias("activity_type"), "clicks", F.col("tot").alias("student_clicks"),
                        (F.col("clicks") / F.col("tot")).alias("p"))


def joint_vectors(base: DataFrame, ignore_neg_date: bool = True, activities: Sequence[str] | None = None) -> DataFrame:
    """The joint distribution as one day-major vector per student, straight from its array."""
    return joint_arrays(base, ignore_neg_date, activities).select(
        *K3, F.transform("cells", lambda c: c / F.col("tot")).alias("vector"))


def marginal_by_activity(joint: DataFrame) -> DataFrame:
    """Sum of the joint over the days (per activity), as summed clicks over the student's total."""
    return joint.groupBy(*K3, "activity_type").agg(
        (F.sum("clicks") / F.max("student_clicks")).alias("p"))


def marginal_by_date(joint: DataFrame) -> DataFrame:
    """Sum of the joint over the activities (per day), as summed clicks over the student's total."""
    return joint.groupBy(*K3, "date").agg((F.sum("clicks") / F.max("student_clicks")).alias("p"))


def flatten_joint(joint: DataFrame) -> DataFrame:
    """The joint as one vector per student, day-major then activity (sorted by name)."""
    v = F.array_sort(F.collect_list(F.struct("date", "activity_type", "p")))
    return joint.groupBy(*K3).agg(v.alias("_v")).select(*K3, F.transform("_v", lambda x: x["p"]).alias("vector"))


def entropies(base: DataFrame, ignore_neg_date: bool = True) -> DataFrame:
    """Joint, day and activity entropy (base 2) per student and the mean outcome code.

    With T the student's clicks, an entropy of counts c is ``log2(T) - sum(c log2 c) / T``, and zero cells of the
    dense joint add nothing. So each (day, activity) cell is counted once for its day and once for
    its activity, and sums of ``c log2 c`` over cells, days and activities give all three: two hash
    aggregates on the student key, no list per student, no join between partial results.
    """
    src = base.where(F.col("date") >= 0) if ignore_neg_date else base
    src = src.where(F.col("date") <= F.col("date_assessment").cast("long")).withColumn("date", F.col("date").cast("long"))
    cell = src.groupBy(*K3, "date", "activity_type").agg(F.sum("sum_click").alias("c"), F.max("final_result").alias("result"))
    by = F.explode(F.array(F.struct(F.col("date"), F.lit(None).cast("string").alias("activity")),
                           F.struct(F.lit(None).cast("long").alias("date"), F.col("activity_type").alias("activity"))))
    c_log_c = lambda c: F.when(F.col(c) > 0, F.col(c) * F.log2(F.col(c).cast("double"))).otherwise(0.0)
    sides = cell.select(*K3, "c", "result", c_log_c("c").alias("x"), by.alias("by")).groupBy(*K3, "by").agg(
        F.sum("c").alias("c"), F.sum("x").alias("x"), F.max("result").alias("result"))
    day = F.col("by.date").isNotNull()
    stu = sides.groupBy(*K3).agg(
        F.sum(F.when(day, F.col("c"))).alias("tot"), F.sum(F.when(day, F.col("x"))).alias("joint"),
        F.sum(F.when(day, c_log_c("c"))).alias("date"), F.sum(F.when(~day, c_log_c("c"))).alias("acty"),
        F.max("result").cast("double").alias("result"))
    entropy = lambda s: F.greatest(F.lit(0.0), F.log2(F.col("tot").cast("double")) - F.col(s) / F.col("tot"))
    whole = lambda s: F.when(F.col("tot") > 0, entropy(s)).alias(f"entropy_{s}")
    return stu.select(*K3, whole("joint"), whole("date"), whole("acty"), "result")

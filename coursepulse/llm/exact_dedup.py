"""Exact deduplication by distributed MSD radix partitioning.

Texts are equal when they are identical after deleting every ``[\\x20\\x09-\\x0D]``. The normalised
text is read as a length-prefixed string, whose most significant digit is its byte length, followed
by digits of 64, 1,024, 16,384, ... successive bytes. A round counts the documents of every
(group, digit), and a document leaves the recursion when it is alone or its text has ended; the rest
goes to the next round with the bytes that follow. Only bytes are compared; no digest decides.

A group's name is the smallest row number of its rows (rows are numbered in place, ids may repeat), so a group of any size moves as one count per task;
the join that brings a group's counts back to its documents has one row per key on one side, so
Spark can split a hot key on the other. Rounds are written to the shared checkpoint folder.

Defined results: null counts as the empty text, and all empty texts are equal; of equal texts the
one with the most code points in the original text stays, then the smallest id (null first); of rows
that repeat an id and its text one is kept; rows that repeat an id with another text are judged by their text; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coursepulse.llm.scratch import written

FIRST_DIGIT = 64
GROWTH = 16
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256`` (ids are integers)."""
    text = F.coalesce(docs[text_col], F.lit(""))
    plain = docs.select(docs[id_col].alias("doc_id"), F.char_length(text).alias("cp"), normalised(text).alias("t"),
                        F.monotonically_increasing_id().alias("row"))
    rest = plain.select("doc_id", "cp", "row", F.sha2("t", 256).alias("text_sha256"), F.encode("t", "UTF-8").alias("rest"))
    # the length is the first digit: a group holds texts of one length, so they all end together
    rest = rest.withColumn("grp", F.octet_length("rest").cast("long"))
    width, done = FIRST_DIGIT, []
    while True:
        digit = F.substring("rest", 1, width)
        split = rest.withColumn("digit", digit)
        groups = split.groupBy("grp", "digit").agg(
            F.count(F.lit(1)).alias("n"), F.min("row").alias("g_min"),
            F.min(F.struct((-F.col("cp")).alias("less"), F.col("doc_id").alias("id"))).alias("best"))
        groups = groups.where("n > 1").select(F.col("grp").alias("g_grp"), F.col("digit").alias("g_digit"), "n",
                                              "g_min", F.col("best.id").alias("best_id"))
        joined = split.join(groups, (split["grp"] == groups["g_grp"]) & (split["digit"] == groups["g_digit"]), "left")
        more = F.col("n").isNotNull() & (F.octet_length("rest") > width)
        out = joined.select(
            "doc_id", "cp", "row", "text_sha256", more.alias("more"),
            F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
            F.when(more, F.col("g_min")).alias("grp"),
            F.when(more, F.expr(f"substring(rest, {width + 1})")).alias("rest"))
        table, _ = written(out, "exact-dedup")
        done.append(table.where("not more").select("doc_id", "keep_id", "group_size", "text_sha256"))
        rest = table.where("more").select("doc_id", "cp", "row", "text_sha256", "rest", "grp")
        width *= GROWTH
        if rest.isEmpty():
            break
    rows = reduce(DataFrame.unionByName, done)
    again = F.row_number().over(W.partitionBy("doc_id", "text_sha256").orderBy("group_size"))
    return rows.withColumn("again", again).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("again") == 1)).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns (an id stays if one of its rows does)."""
    rows, _ = written(exact_groups(docs, id_col, text_col), "exact-dedup-rows")
    ids = rows.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    gone = ids.where("n > 1 OR NOT kept").select(F.col("doc_id").alias("gone_id"))
    out = docs.join(gone, docs[id_col].eqNullSafe(gone["gone_id"]), "left_anti")
    # ids are unique in a well-formed table; where some repeat, their rows are told apart by their texts
    often = ids.where("n > 1").select(F.col("doc_id").alias("again_id"))
    if often.isEmpty():
        return out
    names = docs.columns
    again = docs.join(often, docs[id_col].eqNullSafe(often["again_id"])).drop("again_id")
    again = again.select(F.struct(*[again[c] for c in names]).alias("r"), again[id_col].alias("i"), F.char_length(F.coalesce(again[text_col], F.lit(""))).alias("cp"),
                         F.sha2(normalised(again[text_col]), 256).alias("s"), again[text_col].alias("t"))
    kept = rows.where("kept").select(F.col("doc_id").alias("k_id"), F.col("text_sha256").alias("k_s")).distinct()
    again = again.join(kept, again["i"].eqNullSafe(kept["k_id"]) & (again["s"] == kept["k_s"]), "left_semi")
    one = again.groupBy("i", "s").agg(F.max_by("r", F.struct("cp", F.coalesce("t", F.lit("")))).alias("r"))
    return out.unionByName(one.select("r.*"))

"""Deletion of repeated line runs with a suffix array over line-ID sequences. DataFrame operations only.

The lines of a document that hold a word are a sequence of line IDs (128 bits of the line's hash).
Suffixes are ranked by prefix doubling: the rank of the ``2^(k+1)`` lines from a position on follows
from the ranks of the ``2^k`` lines there and ``2^k`` lines later; each round sorts the distinct pairs
of ranks over the cluster, and numbers them in that order. Positions with one rank at a level are an
LCP interval of at least so many lines, and two overlapping powers of two give the intervals of every
length between. Positions that stand alone in their interval have no repeated run and drop out.

A run is a copy when an equal run starts earlier, by document number and line. Deleted are the lines
that lie in a copied run of at least ``min_words`` words, which is to say in a least such run: one
that starts at a line and ends where it first has enough words, or that ends at a line and starts
where it last has enough. A least run has at most ``min_words`` lines, so ranks are needed up to that
length only, however long the documents and their repeated runs are.

Minima are aggregated before they are joined back, so a line that a third of all documents hold moves
as one row per task, and Spark can split its side of the join. Rounds are written to the shared
checkpoint folder.

Defined results: null counts as the empty text; lines without a word are never deleted; rows that
repeat an id and its text get the same result, and are no copies of each other; ids are integers
between -2^40 and 2^40, null comes first; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coursepulse.llm.scratch import remove, written

MIN_WORDS = 50
_WORD = r"[^\x20\x09-\x0D]+"


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, t, e, line_no, words, a, b, at``: lines with a word, numbered ``e`` in their text."""
    line = docs.select("doc_id", "t", F.posexplode(F.expr(
        r"filter(transform(split(text, '\n'), (x, i) -> struct(i AS line_no, x AS line)), s -> rlike(s.line, '[^\\x20\\x09-\\x0D]'))")))
    return line.select(
        "doc_id", "t", F.col("pos").alias("e"), "col.line_no", F.regexp_count("col.line", F.lit(_WORD)).alias("words"),
        F.xxhash64("col.line").alias("a"), F.xxhash64(F.lit(1), "col.line").alias("b"),
        F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"), F.col("col.line_no").alias("l")).alias("at"))


def _ranked(pairs: DataFrame) -> DataFrame:
    """``x, y, rank`` of the pairs that occur twice or more; ranks follow the order of the pairs."""
    again = pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("x", "y")
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return again.repartitionByRange(n, "x", "y").sortWithinPartitions("x", "y").withColumn(
        "rank", F.monotonically_increasing_id())


def _with_rank(rows: DataFrame, x, y, name: str) -> tuple[DataFrame, str]:
    """``rows`` with the rank of their pair (null where it stands alone), written."""
    keyed = rows.withColumn("x", x).withColumn("y", y)
    table, path = written(_ranked(keyed.where("x is not null and y is not null").select("x", "y")), "line-ranks")
    out = keyed.join(table.withColumnRenamed("rank", name), ["x", "y"], "left").drop("x", "y")
    got, where = written(out, "line-positions")
    remove(rows.sparkSession, path)
    return got, where


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, t, gone``: the numbers of the deleted lines, for documents ``doc_id, text, t`` that have any."""
    spark = docs.sparkSession
    doc = W.partitionBy("doc_id", "t")
    lines, _ = written(_lines(docs), "lines")
    table, old = written(_ranked(lines.select(F.col("a").alias("x"), F.col("b").alias("y"))), "line-ids")
    # only lines that occur again can lie in a run that does; rows that repeat a document count once
    rows = (lines.join(table.withColumnRenamed("rank", "r0"), (lines["a"] == table["x"]) & (lines["b"] == table["y"]))
            .select("doc_id", "t", "e", "line_no", "words", "at", "r0").dropDuplicates(["doc_id", "t", "e"])
            .withColumn("island", F.col("e") - F.row_number().over(doc.orderBy("e"))))
    island = W.partitionBy("doc_id", "t", "island")
    rows = rows.withColumn("upto", F.sum("words").over(island.orderBy("e"))).withColumn("before", F.col("upto") - F.col("words"))
    rows = (rows.withColumn("total", F.sum("words").over(island))
            .withColumn("ahead", F.count(F.lit(1)).over(island.orderBy("before").rangeBetween(0, min_words - 1)))
            .withColumn("behind", F.count(F.lit(1)).over(island.orderBy("upto").rangeBetween(-(min_words - 1), 0)))
            .where(F.col("total") >= min_words)
            .withColumn("ahead", F.when(F.col("total") >= F.col("before") + min_words, F.col("ahead")))
            .withColumn("behind", F.when(F.col("upto") >= min_words, F.col("behind")))
            .drop("total", "upto", "before", "words"))
    rows, path = written(rows, "line-positions")
    remove(spark, old)
    longest = rows.agg(F.max(F.greatest("ahead", "behind"))).first()[0] or 0
    level = 0
    while 2 << level <= longest:
        later = F.lead(f"r{level}", 1 << level).over(island.orderBy("e"))
        rows, new = _with_rank(rows.withColumn("later", later), F.col(f"r{level}"), F.col("later"), f"r{level + 1}")
        rows = rows.drop("later")
        remove(spark, path)
        path, level = new, level + 1

    # least runs by start and length; a run's interval is named by the ranks of its two powers of two
    runs = (rows.where("ahead is not null").select("doc_id", "t", F.col("e").alias("s"), F.col("ahead").alias("m"))
            .unionAll(rows.where("behind is not null").select("doc_id", "t", (F.col("e") - F.col("behind") + 1).alias("s"),
                                                              F.col("behind").alias("m"))).distinct())
    runs = runs.withColumn("k", F.length(F.bin("m")) - 1).withColumn("s2", F.expr("s + m - shiftleft(1, k)"))
    ranks = F.array(*[F.col(f"r{i}") for i in range(level + 1)])
    at = rows.select(F.col("doc_id").alias("d"), F.col("t").alias("dt"), "e", "at", ranks.alias("ranks"))

    def beside(left: DataFrame, place: str, names: dict[str, str]) -> DataFrame:
        right = at.select("d", "dt", "e", *[F.col(c).alias(n) for c, n in names.items()])
        return left.join(right, left["doc_id"].eqNullSafe(right["d"]) & (left["t"] == right["dt"])
                         & (left[place] == right["e"])).drop("d", "dt", "e")

    runs = beside(beside(runs, "s", {"at": "at", "ranks": "first"}), "s2", {"ranks": "second"})
    runs = (runs.withColumn("x", F.expr("first[k]")).withColumn("y", F.expr("second[k]"))
            .where("x is not null and y is not null").select("doc_id", "t", "s", "m", "at", "x", "y"))
    runs, runs_path = written(runs, "line-runs")
    earliest = runs.groupBy("m", "x", "y").agg(F.min("at").alias("origin"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    copied = (runs.join(earliest, ["m", "x", "y"]).where("at > origin")
              .groupBy("doc_id", "t", "s").agg(F.max(F.col("s") + F.col("m")).alias("end")))
    copied = copied.select(F.col("doc_id").alias("d"), F.col("t").alias("dt"), "s", "end")
    covered = (rows.select("doc_id", "t", "e", "line_no")
               .join(copied, rows["doc_id"].eqNullSafe(copied["d"]) & (rows["t"] == copied["dt"]) & (rows["e"] == copied["s"]), "left")
               .withColumn("reach", F.max("end").over(doc.orderBy("e"))).where("reach > e"))
    return covered.groupBy("doc_id", "t").agg(F.collect_list("line_no").alias("gone"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_deleted, text`` with the later copies deleted."""
    src = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    src = src.withColumn("t", F.xxhash64("text"))
    gone = deleted_lines(src, min_words).select(F.col("doc_id").alias("d"), F.col("t").alias("dt"), "gone")
    both = src.join(gone, src["doc_id"].eqNullSafe(gone["d"]) & (src["t"] == gone["dt"]), "left")
    both = both.withColumn("l", F.expr(r"split(text, '\n')"))
    left = F.expr(r"array_join(transform(array_except(sequence(0, size(l) - 1), gone), i -> l[i]), '\n')")
    return both.select("doc_id", F.size("l").cast("long").alias("n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_deleted"),
                       F.when(F.col("gone").isNull(), F.col("text")).otherwise(left).alias("text"))

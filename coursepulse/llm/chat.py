"""Chat formatting of reply trees. DataFrame operations only.

A tree's messages name the message they reply to. Root-to-leaf paths are enumerated by iterative
self-joins with doubled jumps: after ``k`` rounds a leaf is paired with its ``2^k`` nearest ancestors,
and the table of ``2^k``-step ancestors is joined with itself, so a path of any length takes
logarithmically many rounds and the pairs number as many as the paths have messages. Branches are
ranked by the sum of their messages' scores, and each chosen one is formatted as one conversation.

Template: ``<|role|>``, line end, text, ``<|end|>``, line end for every turn. Inside roles and texts
``&``, ``<`` and ``|`` are written ``&amp;``, ``&lt;`` and ``&bar;``, so no text can hold a mark of the
template or take one apart, and the escaping is undone without loss. The loss mask is a list of
spans (start, length in code points) over the assistant texts.

Defined results: null roles and texts count as empty; null scores as 0; messages whose parent is not
in the tree are roots; of rows that repeat a message's tree and node the smallest parent, the largest score and the
smallest (role, text) count; equal ranks go to the smaller leaf; a cycle of replies is an error; other
columns are ignored; an empty table gives an empty result. For a table of turns, rows of a
conversation are chained by turn, then role, then text; null turns come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coursepulse.llm.scratch import remove, written

END = "<|end|>\n"
MAX_ROUNDS = 40  # paths of up to 2^40 messages; more rounds mean a cycle


def escaped(c) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("|"), F.lit("&bar;"))


def unescaped(c) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&bar;"), F.lit("|")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def chain(turns: DataFrame) -> DataFrame:
    """Messages ``tree, node, parent, role, text, score`` of a table ``conv_id, turn, role, text``."""
    n = F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    return (turns.select("conv_id", "turn", "role", "text").withColumn("node", n)
            .select(F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                    "role", "text", F.lit(0.0).alias("score")))


def paths(messages: DataFrame) -> DataFrame:
    """``tree, leaf, node, up``: every leaf with itself and its ancestors, ``up`` steps above it.

    A round writes only the pairs that it finds; superseded jumps are deleted."""
    spark = messages.sparkSession
    messages = messages.groupBy("tree", "node").agg(F.min("parent").alias("parent"))
    ids = messages.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    inner = messages.where("parent is not null").select("tree", "node", "parent")
    jump = inner.join(ids, inner["tree"].eqNullSafe(ids["t"]) & (inner["parent"] == ids["n"])).select(
        "tree", "node", F.col("parent").alias("to"))
    jump, path = written(jump, "chat-jumps")
    parents = jump.select(F.col("tree").alias("t"), F.col("to").alias("n")).distinct()
    leaves = messages.join(parents, messages["tree"].eqNullSafe(parents["t"]) & (messages["node"] == parents["n"]), "left_anti")
    found, _ = written(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")), "chat-paths")
    for k in range(MAX_ROUNDS + 1):
        if jump.isEmpty():
            remove(spark, path)
            return found
        step = jump.select(F.col("tree").alias("t"), F.col("node").alias("n"), "to")
        more = found.join(step, found["tree"].eqNullSafe(step["t"]) & (found["node"] == step["n"])).select(
            "tree", "leaf", F.col("to").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        found = found.unionAll(written(more, "chat-paths")[0])
        far = jump.select("tree", "node", F.col("to").alias("via")).join(
            step, F.col("tree").eqNullSafe(step["t"]) & (F.col("via") == step["n"]))
        jump, new = written(far.select("tree", "node", "to"), "chat-jumps")
        remove(spark, path)
        path = new
    raise ValueError("the replies of a tree form a cycle")


def format_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``tree, leaf, branch_rank, branch_score, n_turns, formatted, loss_spans`` of each tree's best branches.

    Texts are read once, for the chosen branches; ranks need the scores alone."""
    # written once: every step reads messages, and a table of turns is chained with its texts
    messages, _ = written(messages.select("tree", "node", "parent", "role", "text", "score"), "chat-messages")
    src = messages.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    own = src.select(F.col("tree").alias("t"), F.col("node").alias("n"), "role", "text")
    found = paths(messages)
    score = messages.groupBy(F.col("tree").alias("t"), F.col("node").alias("n")).agg(
        F.max(F.coalesce(F.col("score").cast("double"), F.lit(0.0))).alias("score"))
    scored = found.join(score, found["tree"].eqNullSafe(score["t"]) & (found["node"] == score["n"])).groupBy("tree", "leaf").agg(
        F.sum("score").alias("branch_score"))
    rank = F.row_number().over(W.partitionBy("tree").orderBy(F.desc("branch_score"), "leaf"))
    chosen = scored.withColumn("branch_rank", rank).where(F.col("branch_rank") <= branches).select(
        F.col("tree").alias("t"), F.col("leaf").alias("l"), "branch_score", "branch_rank")
    best = found.join(chosen, found["tree"].eqNullSafe(chosen["t"]) & (found["leaf"] == chosen["l"])).drop("t", "l")
    turns = best.join(own, best["tree"].eqNullSafe(own["t"]) & (best["node"] == own["n"])).drop("t", "n")
    # one exchange by path serves the repeats, the running lengths and the grouping; texts are widened after it
    path = W.partitionBy("tree", "leaf").orderBy(F.desc("up"), "role", "text")
    turns = turns.withColumn("before", F.lag("up").over(path)).where("before IS NULL OR before <> up").drop("before")
    so_far = W.partitionBy("tree", "leaf").orderBy(F.desc("up")).rowsBetween(W.unboundedPreceding, W.currentRow)
    head, body = F.concat(F.lit("<|"), escaped(F.col("role")), F.lit("|>\n")), escaped(F.col("text"))
    end = F.sum(F.col("head") + F.col("length") + F.char_length(F.lit(END))).over(so_far)
    parts = (turns
             .select("tree", "leaf", "branch_score", "branch_rank", "up", "role", F.concat(head, body, F.lit(END)).alias("turn"),
                     F.char_length(head).alias("head"), F.char_length(body).cast("long").alias("length"))
             .withColumn("start", end - F.col("length") - F.char_length(F.lit(END)) + 1))
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("o"), "turn", "role", "start", "length")))
    grouped = parts.groupBy("tree", "leaf", "branch_rank", "branch_score").agg(ordered.alias("turns"))
    return grouped.select(
        "tree", "leaf", "branch_rank", "branch_score", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.col("turns.turn"), "").alias("formatted"),
        F.expr("transform(filter(turns, x -> x.role = 'assistant'), x -> struct(x.start AS start, x.length AS length))").alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text) and ``loss_text``, read from ``formatted`` and ``loss_spans`` alone."""
    part = F.expr(r"slice(split(formatted, '<\\|end\\|>\n'), 1, greatest(0, size(split(formatted, '<\\|end\\|>\n')) - 1))")

    def turn(x):
        role = F.regexp_extract(x, r"^<\|([^|]*)\|>\n", 1)
        return F.struct(unescaped(role).alias("role"),
                        unescaped(F.substring(x, F.char_length(role) + 6, F.char_length(x))).alias("text"))

    loss = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"], s["length"])))
    return formatted.withColumn("turns", F.transform(part, turn)).withColumn("loss_text", F.array_join(loss, ""))

"""Queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursepulse.llm import (
    centroids,
    chat,
    exact_dedup,
    html,
    jaccard_join,
    line_dedup,
    packing,
    pieces,
    quality,
    token_files,
    toxicity,
    warc,
    whitening,
)
from coursepulse.llm.scratch import scratch_path
from coursepulse.llm.shipping import ship_package


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality cascade for every document."""
    return quality.judge(_read(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in the packed sequences."""
    return packing.pack(_read(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document under merge-dropout, and what they decode to."""
    back = pieces.decode(pieces.encode(_read(spark, sf_dir, "documents")))
    digest = F.sha2("decoded", 256)
    return back.select("doc_id", "n_pieces", F.crc32("ids").alias("ids_crc32"), digest.alias("decoded_sha256"),
                       F.char_length("decoded").cast("long").alias("decoded_chars"),
                       (digest == F.col("text_sha256")).alias("lossless"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group and verdict of every document."""
    return exact_dedup.exact_groups(_read(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(_read(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to WARC archives in the shared folder and read back."""
    path = scratch_path(spark, "warc")
    warc.write_archive(_read(spark, sf_dir, "pages"), path)
    wrong = F.raise_error(F.concat_ws(" ", F.lit("page"), "page_id", F.lit(":"), "problem"))
    return warc.read_archive(spark, path).select(
        F.col("page_id").cast("long").alias("page_id"),
        F.when(F.col("problem").isNotNull(), wrong.cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later copies of repeated line runs."""
    return line_dedup.dedup_lines(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_deleted", F.char_length("text").cast("long").alias("kept_chars"),
        F.sha2("text", 256).alias("text_sha256"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, formatted and read back; conversation -7 holds control strings."""
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    back = chat.read_back(chat.format_paths(chat.chain(turns.unionByName(control))))
    digest = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(digest, 256).alias("turns_sha256"), F.char_length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated toxicity score of every document."""
    return toxicity.scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    return jaccard_join.join_documents(_read(spark, sf_dir, "documents"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after three rounds from 16 seeded centroids."""
    return centroids.cluster(_read(spark, sf_dir, "embeddings"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 16 whitened components of every vector."""
    return whitening.whiten(_read(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to token files in the shared folder and read back."""
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(_read(spark, sf_dir, "documents"), path)
    return token_files.read_tokens(spark, path)


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_best_fit_packing, op3_sentencepiece, op4_exact_dedup, op5_html_extraction,
    op6_warc, op7_line_dedup, op8_chat_formatting,
    op9_toxicity, op10_jaccard_join, op11_centroid_clustering, op12_embedding_whitening, op13_token_files)}


def _clustering_sql(rounds: int = centroids.ROUNDS, k: int = centroids.K) -> str:
    """Every round spelled out: nearest centroid of each vector, then the floors of the means."""
    parts = ["""WITH e AS (SELECT vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)) AS f FROM embeddings WHERE len(embedding) = 64),
v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(f, lambda c: c::BIGINT) AS x FROM e
      WHERE len(list_filter(f, lambda c: c IS NOT NULL AND isfinite(c))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS c, x FROM v QUALIFY c < %d)""" % k]
    for i in range(rounds + 1):
        parts.append(f"""d{i} AS (SELECT v.r, c.c, list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
      FROM v CROSS JOIN c{i} c),
a{i} AS MATERIALIZED (SELECT r, c, distance FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, c) = 1)""")
        if i < rounds:
            parts.append(f"""s{i} AS (SELECT a.c, j, sum(v.x[j]) AS s, count(*) AS n FROM a{i} a JOIN v USING (r), range(1, 65) t(j) GROUP BY ALL),
m{i} AS (SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS x FROM s{i} GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c, coalesce(m.x, o.x) AS x FROM c{i} o LEFT JOIN m{i} m USING (c))""")
    return ",\n".join(parts) + f"""
SELECT v.vec_id, a.c::INTEGER AS cluster, a.distance::BIGINT AS distance, (sum(a.distance) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (r) JOIN c{rounds} c USING (c)"""


ORACLE_SQL = {
    "op1_quality_rules": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
n AS (SELECT r, doc_id, text, w, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             length(regexp_replace(text, '\P{L}', '', 'g')) AS letters,
             length(regexp_replace(text, '\P{Lu}', '', 'g')) AS capitals FROM w),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
g AS (SELECT r, unnest(range(1, n_words - 3)) AS i, w FROM n WHERE n_words >= 5),
k AS (SELECT r, i, w[i:i + 4] AS k FROM g),
c AS (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM k),
v AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS j FROM c WHERE c > 1) GROUP BY r),
a AS (SELECT n.doc_id, n.n_words::BIGINT AS n_words, n.word_chars::BIGINT AS word_chars, n.n_symbols::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             coalesce(n_lines, 0) AS n_lines, letters, capitals
      FROM n LEFT JOIN lines USING (r) LEFT JOIN v USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 20 * n_words OR 100 * capitals > 50 * letters
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 100 * n_dup_lines > 50 * n_lines) AS kept
FROM b
""",
    "op4_exact_dedup": r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS cp,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY t ORDER BY cp DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY t) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g
""",
    "op10_jaccard_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM g
      UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id WHERE r.c < e.b)
SELECT doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(c) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
""",
    "op8_chat_formatting": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (SELECT *, '<|' || replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '|', '&bar;') || '|>' || chr(10)
             || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '|', '&bar;') || '<|end|>' || chr(10) AS t FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(t))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
""",
    "op6_warc": r"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
                  coalesce(html, '') AS html FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM q
""",
    "op11_centroid_clustering": _clustering_sql(),
}

"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import ctw, decontaminate, hadamard, html_extract, ngram_join, packing, paragraph_dedup, pfor, quality_cnn, quotes, repair, repetition, simhash
from gridloom.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def windows(size: str) -> str:
    """Words of ``size``-word windows that occur twice or more in their text, as (doc, position)."""
    return f"""SELECT DISTINCT doc, s + o AS pos FROM (
      SELECT doc, s, count(*) OVER (PARTITION BY doc, key) AS n, size FROM (
        SELECT doc, s, {size} AS size, array_to_string(list_slice(w, s, s + {size} - 1), ' ') AS key
        FROM (SELECT doc, w, n, unnest(range(1, n - {size} + 2)) AS s FROM t WHERE n >= {size}))), LATERAL (SELECT unnest(range(size)) AS o) WHERE n > 1"""


REPETITION_SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS doc, doc_id, w, len(w) AS n, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    len(coalesce(text, '')) - len(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols
  FROM (SELECT *, {WORDS} AS w FROM documents)),
r AS ({windows("8")}),
c AS (SELECT doc, count(*) AS words, sum(len(w[pos])) AS chars FROM r JOIN t USING (doc) GROUP BY doc),
long AS (SELECT DISTINCT doc FROM ({windows("greatest(24, n * 15 // 100 + 1)")})),
f AS (SELECT doc_id, n AS n_words, len(array_to_string(w, '')) AS word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(words, 0) AS n_repeat_words, coalesce(chars, 0) AS chars, long.doc IS NOT NULL AS too_long
  FROM t LEFT JOIN c USING (doc) LEFT JOIN long USING (doc))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * chars <= 30 * word_chars AND NOT too_long AS kept FROM f"""


@query("op8_repetition_rules", REPETITION_SQL)
def op8(spark, d):
    judged = repetition.repetition_rules(table(spark, d, "documents"), keep=["doc_id"])
    return judged.select("doc_id", *[f"rules.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


@query("op6_simhash_near_dedup")
def op6(spark, d):
    found = simhash.near_duplicates(table(spark, d, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("_print")), 16, "0").alias("fingerprint"), "component_id")


@query("op2_best_fit_packing")
def op2(spark, d):
    return packing.pack(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op9_token_files")
def op9(spark, d):
    uri = fresh_path(spark, "tokens")
    pfor.write_tokens(table(spark, d, "documents"), uri, public_tokenizers.path("word_bpe_49k.json"))
    return pfor.read_tokens(spark, uri)


def shingle_sql(name: str, key: str) -> str:
    words = rf"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
    return f"""SELECT DISTINCT {key}, array_to_string(list_slice(w, s, s + 4), ' ') AS h FROM (
      SELECT {key}, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM (SELECT {key}, {words} AS w FROM {name}) WHERE len(w) > 0)"""


CONTAINED_SQL = f"""
WITH d AS ({shingle_sql("documents", "doc_id")}), b AS ({shingle_sql("benchmark", "item_id")}), s AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id),
f AS (SELECT doc_id, item_id, count(*) AS n_found FROM d JOIN b USING (h) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_found, n_shingles FROM f JOIN s USING (item_id) WHERE 10 * n_found >= 8 * n_shingles"""


@query("op10_decontamination", CONTAINED_SQL)
def op10(spark, d):
    return decontaminate.contained(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("op1_html_extraction")
def op1(spark, d):
    return html_extract.extract(table(spark, d, "pages"), keep=["page_id", "url"])


QUOTES_SQL = r"""
WITH RECURSIVE m AS (SELECT row_number() OVER () AS id, * FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)),
x AS (SELECT id, conv_id, turn, s, line, regexp_extract(line, '^((?:>[ \t]?)+)', 1) AS marks
  FROM (SELECT id, conv_id, turn, unnest(l) AS line, unnest(range(len(l))) AS s FROM (SELECT id, conv_id, turn, string_split(coalesce(text, ''), chr(10)) AS l FROM m))),
y AS (SELECT id, conv_id, turn, s, len(regexp_replace(marks, '[^>]', '', 'g')) AS level, substr(line, len(marks) + 1) AS body,
  trim(regexp_replace(lower(substr(line, len(marks) + 1)), '[\x20\x09-\x0D]+', ' ', 'g')) AS plain FROM x),
t AS (SELECT id, coalesce(string_agg(body, chr(10) ORDER BY s) FILTER (level = 0), '') AS text, count(*) FILTER (level > 0) AS n_quoted, max(level) AS max_level FROM y GROUP BY id),
z AS (SELECT conv_id, turn, level, plain FROM y WHERE plain <> '' UNION SELECT conv_id, turn, level, string_agg(plain, ' ' ORDER BY s)
  FROM (SELECT *, s - row_number() OVER (PARTITION BY id, level ORDER BY s) AS g FROM y WHERE plain <> '') GROUP BY id, conv_id, turn, level, g),
a AS (SELECT conv_id, turn, plain, lv, min(choice) AS choice FROM (SELECT conv_id, turn, plain, level - 1 AS lv, 1 AS choice FROM z WHERE level > 0
  UNION ALL SELECT conv_id, turn, plain, 0, 2 FROM z WHERE level > 1) GROUP BY ALL),
p AS (SELECT a.conv_id, a.turn, a.plain, a.lv, a.choice, max(b.turn) AS source FROM a JOIN z b ON a.conv_id = b.conv_id AND a.plain = b.plain AND b.level = a.lv AND b.turn < a.turn GROUP BY ALL),
r AS (SELECT conv_id, turn, arg_max(source, row(-choice, n, source)) AS reply_to FROM (SELECT conv_id, turn, choice, source, count(*) AS n FROM p GROUP BY ALL) GROUP BY ALL),
up AS (SELECT conv_id, turn, reply_to AS thread, CAST(1 AS BIGINT) AS depth FROM r
  UNION ALL SELECT up.conv_id, up.turn, r.reply_to, depth + 1 FROM up JOIN r ON up.conv_id = r.conv_id AND up.thread = r.turn),
top AS (SELECT conv_id, turn, arg_max(thread, depth) AS thread, max(depth) AS depth FROM up GROUP BY ALL)
SELECT *, CASE WHEN conv_id IS NOT NULL AND turn IS NOT NULL THEN row_number() OVER (PARTITION BY conv_id, turn IS NULL
    ORDER BY thread, turn, role NULLS FIRST, text, n_quoted, max_level, reply_to NULLS FIRST) END AS position FROM (
  SELECT m.conv_id, m.turn, m.role, t.text, n_quoted, CAST(max_level AS BIGINT) AS max_level, reply_to, coalesce(top.thread, m.turn) AS thread, coalesce(top.depth, 0) AS depth
  FROM m JOIN t USING (id) LEFT JOIN r ON m.conv_id = r.conv_id AND m.turn = r.turn LEFT JOIN top ON m.conv_id = top.conv_id AND m.turn = top.turn)"""


@query("op7_quotation_linking", QUOTES_SQL)
def op7(spark, d):
    return quotes.link_quotes(table(spark, d, "conversations"))


@query("op5_context_tree_scores")
def op5(spark, d):
    return ctw.context_tree_scores(table(spark, d, "documents"), ctw.told_apart("doc_id", 5, 1))


@query("op4_quality_classifier")
def op4(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    network = quality_cnn.fit(docs, table(spark, d, "labels"), ~ctw.told_apart("doc_id", 4, 2))
    scored = quality_cnn.score(docs.withColumn("held_out", ctw.told_apart("doc_id", 4, 2)), network, keep=["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query("op3_substring_dedup")
def op3(spark, d):
    found = paragraph_dedup.stretches(paragraph_dedup.repeats(table(spark, d, "documents")))
    return found.select(F.col("_key").alias("doc_id"), "start", "stop", "class_id", "kept_in")


def assigned_sql(source: str, centroids: str) -> str:
    return f"""SELECT r, arg_min(c, row(d, c)) AS cluster, min(d) AS distance FROM (SELECT r, c, sum((v - w) * (v - w)) AS d
      FROM {source} JOIN {centroids} USING (i) GROUP BY r, c) GROUP BY r"""


def round_sql(k: int) -> str:
    return f"""a{k} AS MATERIALIZED ({assigned_sql('x', f'c{k}')}),
m{k} AS (SELECT cluster AS c, i, CAST(sum(v) AS HUGEINT) AS s, count(*) AS n FROM x JOIN a{k} USING (r) GROUP BY cluster, i),
c{k + 1} AS MATERIALIZED (SELECT c, i, CASE WHEN n IS NULL THEN w ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS w FROM c{k} LEFT JOIN m{k} USING (c, i)),"""


CLUSTER_SQL = f"""
WITH e AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
x AS MATERIALIZED (SELECT r, i, CAST(floor(64 * CAST(u AS DOUBLE)) AS BIGINT) AS v FROM (SELECT r, unnest(embedding) AS u, unnest(range(64)) AS i FROM e)),
s AS (SELECT r, row_number() OVER (ORDER BY h, f) - 1 AS c FROM (SELECT r, sha256('1:' || vec_id) AS h, list_transform(embedding, lambda u: floor(64 * CAST(u AS DOUBLE))) AS f FROM e) ORDER BY h, f LIMIT 16),
c0 AS MATERIALIZED (SELECT c, i, v AS w FROM x JOIN s USING (r)),
{round_sql(0)}
{round_sql(1)}
{round_sql(2)}
f AS MATERIALIZED ({assigned_sql('x', 'c3')}),
g AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM f GROUP BY cluster),
h AS (SELECT c AS cluster, sha256(string_agg(CAST(w AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c3 GROUP BY c)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, cluster_inertia, CAST((SELECT sum(distance) FROM f) AS BIGINT) AS inertia, centroid_sha256
FROM f JOIN e USING (r) JOIN g USING (cluster) JOIN h USING (cluster)"""


@query("op11_centroid_clustering", CLUSTER_SQL)
def op11(spark, d):
    return hadamard.cluster(table(spark, d, "embeddings")).withColumnRenamed("_key", "vec_id")


@query("op12_ngram_join")
def op12(spark, d):
    return ngram_join.similar(table(spark, d, "documents")).withColumnRenamed("_key", "doc_id")


@query("op13_conversation_repair")
def op13(spark, d):
    return repair.repair(table(spark, d, "conversations"), damage=True).withColumnRenamed("_conv", "conv_id")

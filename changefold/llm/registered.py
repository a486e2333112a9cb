"""The registered query of each text operator over the given tables, with its DuckDB oracle where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from public_tokenizers import path as vocabulary_path

from changefold.session import scratch

from . import bpe, clustering, decontaminate, languages, lm, passages, pii, search, sharding, simhash, spelling, tokenfiles, warc

VOCABULARY = "byte_bpe_50k.json"
SHARDS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    records = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    return sharding.place(records, "doc_id", [1.0] * SHARDS)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode_documents(docs, vocabulary_path(VOCABULARY), keep_ids=False)
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", languages.held_out("doc_id"))
    samples = languages.training_sample(docs.where(~F.col("held_out")))
    return languages.identify(docs.select("doc_id", "held_out", "text"), samples).select(
        "doc_id", "held_out", "lang_pred", "score")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        decontaminate.digest_items().alias("items_sha256"), decontaminate.is_contaminated().alias("contaminated"))


def op5_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = search.search(search.build_index(docs), docs.where(F.col("doc_id") % 100 == 0), k=10)
    return found.select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", lm.held_out("doc_id"))
    scored = lm.score_documents(docs, docs.where(~F.col("held_out")))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    kind = pages.schema["page_id"].dataType
    packages = warc.write_packages(pages, scratch(spark, "warc"))
    return warc.read_packages(packages).select(
        F.col("key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    vocabulary = bpe.vocabulary(docs, vocabulary_path(VOCABULARY))
    shards = tokenfiles.write_token_files(docs, vocabulary, scratch(spark, "token-files"))
    return tokenfiles.read_token_files(shards).select(
        F.col("key").alias("doc_id"), "start", F.size("token_ids").cast("long").alias("n_tokens"), "ids_crc32")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(table(spark, sf_dir, "documents"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find_personal_data(docs, pii.train(docs)).drop("text")


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (
  SELECT item, w, unnest(range(1, greatest(len(w) - 11, 2))) AS i FROM b WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS size, array_to_string(w[i:i + 12], ' ') AS win FROM starts),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT k, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT k, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT k, i, size, item FROM places JOIN windows USING (size, win)),
words AS (SELECT k, count(*) AS n_hit FROM (
  SELECT DISTINCT k, unnest(range(i, i + size)) AS word FROM hits) GROUP BY k),
items AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT k, item FROM hits) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (k) LEFT JOIN items USING (k)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_bpe": op2_bpe,
    "op3_language_id": op3_language_id,
    "op4_decontamination": op4_decontamination,
    "op5_search": op5_search,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_passages": op7_passages,
    "op8_warc": op8_warc,
    "op9_token_files": op9_token_files,
    "op10_simhash": op10_simhash,
    "op11_spelling": op11_spelling,
    "op12_pii": op12_pii,
    "op13_clustering": op13_clustering,
}
OP5_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
tf AS (SELECT k, term, count(*) AS n FROM (SELECT k, unnest(w) AS term FROM d) GROUP BY ALL),
whole AS (SELECT count(*) AS n, sum(len(w)) / count(*) AS average FROM d),
weights AS (SELECT term, ln(1 + ((SELECT n FROM whole) - count(*) + 0.5) / (count(*) + 0.5)) AS weight FROM tf GROUP BY term),
scores AS (
  SELECT q.k AS query, t.k AS k, sum(weight * t.n * 2.2 / (t.n + 1.2 * (0.25 + 0.75 * len(d.w) / (SELECT average FROM whole)))) AS score
  FROM tf q JOIN d qd ON qd.k = q.k AND qd.doc_id % 100 = 0 JOIN tf t ON t.term = q.term JOIN weights ON weights.term = q.term
  JOIN d ON d.k = t.k GROUP BY q.k, t.k),
ranked AS (
  SELECT query, d.doc_id, score,
    row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, d.doc_id NULLS FIRST) AS rank
  FROM scores JOIN d USING (k))
SELECT d.doc_id AS query_id, CAST(rank AS INTEGER) AS rank, ranked.doc_id AS doc_id, round(score, 6) AS score
FROM ranked JOIN d ON d.k = ranked.query WHERE rank <= 10
"""

OP8_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS d FROM p),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d) END AS first FROM q)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
  CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f
"""

OP13_START = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS k, vec_id, embedding FROM embeddings WHERE len(embedding) = 64
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
e AS MATERIALIZED (
  SELECT k, i, CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS HUGEINT) AS x FROM kept, range(1, 65) r(i)),
firsts AS MATERIALIZED (
  SELECT k, row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), ''))) - 1 AS c FROM kept
  QUALIFY c < 40),
c0 AS MATERIALIZED (SELECT c, i, x FROM firsts JOIN e USING (k))"""
OP13_ROUND = """,
d{r} AS MATERIALIZED (SELECT k, c, sum((e.x - m.x) * (e.x - m.x)) AS d FROM e JOIN c{r} m USING (i) GROUP BY k, c),
a{r} AS MATERIALIZED (SELECT k, c, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY k ORDER BY d, c) = 1)"""
OP13_MOVE = """,
m{r} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM a{r} JOIN e USING (k) GROUP BY c, i),
c{n} AS MATERIALIZED (
  SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, x) AS x FROM c{r} LEFT JOIN m{r} USING (c, i))"""
OP13_SQL = OP13_START + "".join(
    OP13_ROUND.format(r=r) + (OP13_MOVE.format(r=r, n=r + 1) if r < 5 else "") for r in range(6)) + """
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a5 JOIN kept USING (k)
JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c5 GROUP BY c) USING (c)
"""

ORACLES: dict[str, str] = {
    "op4_decontamination": OP4_SQL, "op5_search": OP5_SQL, "op8_warc": OP8_SQL, "op13_clustering": OP13_SQL}

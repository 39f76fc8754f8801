"""The registered query of each operator, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import (
    alignment, bpe, decontamination, html_extraction, language_id, minhash_dedup, secret_scans, signature_join,
    substring_dedup, topk, url_filters, warc, whitening,
)
from eventloom.llm.common import scratch, table

URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


OP1_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n
  FROM u
), r(rhost, rpath, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), m AS (
  SELECT n, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (n)
"""


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + least(len(w), 10) - 1) AS x, least(len(w), 10) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), places AS (
  SELECT n, w, unnest(range(1, len(w) + 1)) AS i FROM d
), hit AS (
  SELECT n, i, size, item_id FROM (
    SELECT n, i, size, list_slice(w, i, i + size - 1) AS x FROM places, (SELECT DISTINCT size FROM win) WHERE i + size - 1 <= len(w)
  ) JOIN win USING (size, x)
), pos AS (
  SELECT n, count(DISTINCT p) AS n_hit FROM (SELECT n, unnest(range(i, i + size)) AS p FROM hit) GROUP BY n
), items AS (
  SELECT n, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT n, item_id::VARCHAR AS id FROM hit) GROUP BY n
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (n) LEFT JOIN items USING (n)
"""


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "archives")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select(
        warc.page_id(F.col("record_id")).cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_id(F.col("refers_to")).cast("long").alias("refers_to"), "error",
    )


OP5_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages
), f AS (
  SELECT page_id, strlen(h)::BIGINT AS payload_bytes, min(page_id) OVER (PARTITION BY h) AS first,
    array_to_string(list_transform(range(8), lambda k: array_to_string(list_transform([15, 10, 5, 0],
      lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(x, (5 * k + 1)::INT, 5))::INT >> s) & 31) + 1, 1)), '')), '') AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, NULL::VARCHAR AS error
FROM f
"""


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.scan(table(spark, sf_dir, "documents"), secret_scans.train(spark))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """An installed tokenizer file (a parameter of the operators)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path(), keep=["doc_id"])
    return done.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs.select("doc_id", "text"), language_id.fit(docs), keep=["doc_id"])
    return found.select(
        "doc_id", language_id.held_out("doc_id").alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score")
    )


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("__id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("__id").eqNullSafe(F.col("component")).alias("kept"),
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return alignment.align_tokens(table(spark, sf_dir, "documents"), *paths)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = signature_join.similar_documents(table(spark, sf_dir, "documents"))
    return found.select(F.col("__id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_html_extraction": op2_html_extraction,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_warc": op5_warc,
    "op6_secret_scans": op6_secret_scans,
    "op7_bpe": op7_bpe,
    "op8_topk": op8_topk,
    "op9_language_id": op9_language_id,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op11_alignment": op11_alignment,
    "op12_whitening": op12_whitening,
    "op13_signature_join": op13_signature_join,
}
ORACLES = {
    "op1_url_filters": OP1_SQL,
    "op4_decontamination": OP4_SQL,
    "op5_warc": OP5_SQL,
    "op8_topk": OP8_SQL,
}

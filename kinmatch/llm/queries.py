"""The operators as queries over whole tables, with the columns that their contracts name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, fixity, language, line_dedup, mixing, ngram_join, packing, quality, secrets, urls, vector_dedup
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as WARC records against a replica of them with known damage."""
    replica = fixity.records(table(spark, sf_dir, "pages"))
    return fixity.audit(replica, fixity.damaged(replica)).drop("nodes_compared")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


#: Fixed rules of the query: (verdict, host and path).
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "lines_removed", "lines_kept")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    span = F.transform(F.sequence(F.lit(0), F.size("kinds") - 1), lambda i: F.concat_ws(":", F.get("kinds", i), F.get("starts", i), F.get("ends", i)))
    spans = F.when(F.size("kinds") > 0, span).otherwise(F.array().cast("array<string>"))
    found = found.withColumn("all", spans)
    count = lambda kind: F.size(F.filter("kinds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")
    base = F.array_join(F.filter("all", lambda s: F.substring_index(s, ":", 1).isin("assign", "access", "hex")), ",")
    return found.select("doc_id", *map(count, ("assign", "access", "hex")), F.sha2(base, 256).alias("base_sha256"), F.array_join("all", ",").alias("spans"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), k=3, percent=90)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.only(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.train(docs.where(~held_out))
    out = language.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.dedup(table(spark, sf_dir, "embeddings"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "votes", "posterior")


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_fixity, op2_packing, op3_urls, op4_line_dedup, op5_secrets, op6_ngram_join, op7_language, op8_vector_dedup, op9_mixing, op10_quality)}
ORACLE_SQL: dict[str, str] = {
    "op1_fixity": r"""
WITH r AS (
  SELECT page_id // 1000 AS file, page_id AS record,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
         || chr(13) || chr(10) || 'Content-Length: ' || octet_length(encode(coalesce(html, ''))) || chr(13) || chr(10) || chr(13) || chr(10)
         || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS payload
  FROM pages WHERE page_id IS NOT NULL),
d AS (
  SELECT CASE WHEN record % 97 = 3 THEN file + 1 ELSE file END AS file, CASE WHEN record % 97 = 2 THEN -record - 1 ELSE record END AS record,
         CASE WHEN record % 97 = 0 THEN '#' || substr(payload, 2) ELSE payload END AS payload
  FROM r WHERE record % 97 <> 1),
a AS (SELECT file, record, sha256(payload) AS hash, coalesce(sum(octet_length(encode(payload))) OVER (PARTITION BY file ORDER BY record ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at FROM r),
b AS (SELECT file, record, sha256(payload) AS hash, coalesce(sum(octet_length(encode(payload))) OVER (PARTITION BY file ORDER BY record ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at FROM d)
SELECT coalesce(a.file, b.file) AS file, coalesce(a.record, b.record) AS record,
       CASE WHEN b.hash IS NULL THEN 'missing' WHEN a.hash IS NULL THEN 'extra' ELSE 'changed' END AS state,
       a.hash AS left_hash, b.hash AS right_hash, a.at AS left_offset, b.at AS right_offset
FROM a FULL JOIN b ON a.file = b.file AND a.record = b.record WHERE a.hash IS DISTINCT FROM b.hash""",
}

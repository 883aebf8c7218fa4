"""The queries of this subpackage: name to function of (session, folder), and SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, caps, chat, fingerprints, mixing, pii, quality, simhash, spans, warc
from .common import table

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.deduplicated(table(spark, sf_dir, "documents"))


def archive_records(pages: DataFrame) -> DataFrame:
    """Archive records of a crawl of pages: a response for two pages of three, and a later revisit of each URL, one in five with the tag of another version."""
    own = pages.select("page_id", "url", F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"')).alias("tag"), F.octet_length(F.coalesce("html", F.lit(""))).cast("string").alias("length"))
    page = F.col("page_id")
    response = F.create_map(F.lit("ETag"), F.concat(F.lit("W/"), "tag"), F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.col("length"), F.lit("Date"), page.cast("string"))
    revisit = F.create_map(F.lit("ETag"), F.when(page % 5 == 0, F.lit('"other"')).otherwise(F.col("tag")), F.lit("Content-Length"), F.lit("0"), F.lit("Date"), (page + 1).cast("string"), F.lit("Cache-Control"), F.lit("max-age=60"))
    full = own.where(page % 3 != 0).select((page * 2).alias("record_id"), F.lit("response").alias("kind"), "url", (page * 10).alias("time"), response.alias("headers"))
    return full.unionByName(own.select((page * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), "url", (page * 10 + 5).alias("time"), revisit.alias("headers")))


def op2_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve(archive_records(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(":"), e["value"]))
    return found.select("record_id", "url_key", "resolved_id", "status", F.array_join(lines, "|").alias("headers"))


OP2_SQL = r"""
WITH own AS (
  SELECT page_id, '"' || md5(coalesce(html, '')) || '"' AS tag, CAST(strlen(coalesce(html, '')) AS VARCHAR) AS length,
    regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?@]*@)?', '') AS rest
  FROM pages
), cut AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), ':(80|443)$', ''), '^www\.', '') AS host,
    regexp_replace(regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/index\.html?$', '/'), '/+$', '') AS path,
    list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(?i)(utm_[a-z]+|fbclid|gclid|sessionid)(=|$)'))) AS query
  FROM own
), keyed AS (
  SELECT page_id, tag, length, host || path || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS url_key FROM cut
), revisits AS (
  SELECT page_id * 2 + 1 AS record_id, page_id, url_key, page_id * 10 + 5 AS time, CASE WHEN page_id % 5 = 0 THEN '"other"' ELSE tag END AS tag FROM keyed
), responses AS (
  SELECT page_id * 2 AS record_id, url_key, page_id * 10 AS time, tag, length FROM keyed WHERE page_id % 3 <> 0
), met AS (
  SELECT v.*, r.record_id AS response, r.tag AS stored_tag, r.length
  FROM revisits v ASOF LEFT JOIN responses r ON v.url_key = r.url_key AND v.time >= r.time
)
SELECT record_id, url_key, CASE WHEN stored_tag = tag THEN response END AS resolved_id,
  CASE WHEN response IS NULL THEN 'no_response' WHEN stored_tag = tag THEN 'resolved' ELSE 'validator_mismatch' END AS status,
  'cache-control:max-age=60|content-length:' || CASE WHEN stored_tag = tag THEN length || '|content-type:text/html' ELSE '0' END || '|date:' || CAST(page_id + 1 AS VARCHAR) || '|etag:' || tag AS headers
FROM met
"""


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents")).drop("key")


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("key")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found(table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.formatted(turns.unionByName(extra)))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_revisits, op3_fingerprints, op4_mixing, op5_embeddings, op6_quality, op7_pii, op8_chat, op9_simhash, op10_bpe)}
ORACLES = {"op2_revisits": OP2_SQL}

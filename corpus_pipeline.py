"""A training-corpus pipeline: quality, near-duplicates, personal data, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, as it changed them; the last returns
their token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm import bpe, mixing, pii, quality, simhash
from skein.llm.common import materialize, table
from skein.llm.queries import VOCABULARY

#: SQL cannot express the stages (discriminant, SimHash components, boosted trees, seeded draws, token ids).
ORACLE_SQL = None
#: Words that a worker of the last stage keeps: fewer, as the workers of the stages before it still hold memory.
KEPT_WORDS = 150_000


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shuffled within partitions; laying whole shards out takes another shuffle of all texts, beyond the disk that a stage may use."""
    return mixing.mixed_documents(docs, by_shard=False)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids, n_tokens, and whether the ids decode to the text."""
    both = bpe.encode_and_decode(docs.select("doc_id", "source", "text"), VOCABULARY, public_tokenizers.PATTERN, kept_words=KEPT_WORDS)
    return both.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [("quality", good_documents), ("near_duplicates", one_of_each_group), ("personal_data", without_personal_data), ("mixing", mixed), ("token_ids", token_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), spark)
    return STAGES[-1][1](spark, docs, sf_dir)

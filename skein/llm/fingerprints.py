"""Document fingerprints: bottom-k sketches of word-shingle hashes, in DataFrame functions only.

A sketch is the sorted array of the k least distinct hashes of a text's shingles. Sketches of parts merge to the
sketch of their union, and estimate resemblance, containment and the number of distinct shingles.

Odd inputs: a null text is the empty text and has the empty sketch; two empty sketches resemble each other fully; a
text of fewer words than a shingle has one shingle; equal texts have equal sketches; other columns may have any names;
an empty table gives none. In with_next(), null ids come last, rows of equal id are ordered by a hash of the text, then
by the text, and ids may be any 64-bit numbers, however they are spread.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, free_name, hex16, materialize, words

SHINGLE, K = 5, 128
#: Rows of a range of ids, and ranges at most, that with_next() deals rows to.
RANGE_ROWS, MOST_RANGES = 2048, 1 << 16


def shingle_hashes(word_hashes: Column, size: int = SHINGLE) -> Column:
    """Hashes of all runs of size word hashes; of the whole sequence if it is shorter."""
    n = F.size(word_hashes)
    runs = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(word_hashes, i + j) for j in range(size)]))
    return F.when(n == 0, F.array().cast("array<bigint>")).when(n < size, F.array(F.xxhash64(word_hashes))).otherwise(runs)


def with_sketch(df: DataFrame, text: Column, out: str, k: int = K, size: int = SHINGLE) -> DataFrame:
    """df with the sketch of a text as array<long> in out."""
    hashes = free_name(df, "word_hashes")
    hashed = df.withColumn(hashes, F.transform(words(text), lambda w: F.xxhash64(w)))
    runs = hashed.withColumn(hashes, shingle_hashes(F.col(hashes), size))
    return runs.withColumn(out, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)).drop(*({hashes} - {out}))


def sketch_of_parts(sketches: DataFrame, by: list[str], sketch: str = "sketch", k: int = K) -> DataFrame:
    """by and the sketch of the union of each group's parts, as if they had been sketched as one.

    The k least hashes of a group are among the k least of each of its parts: hashes are made distinct before and
    after the shuffle, and the k-th least is found by a row limit that runs below it, so that a group may have any
    number of parts."""
    each = sketches.select(*by, F.explode_outer(sketch).alias("_h")).distinct()
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.asc_nulls_last("_h")))
    least = each.withColumn("_r", rank).where(F.col("_r") <= k)
    return least.groupBy(*by).agg(F.sort_array(F.collect_list("_h")).alias(sketch))  # k hashes a group


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all, 0 to 1."""
    union = merge(a, b, k)
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(F.array_intersect(a, b), union)) / F.size(union))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else from the k-th least of evenly spread hashes."""
    place = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / place)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has, 0 to 1."""
    both = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_count(a, k)))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: hex16(h)), "")


def _ordered(df: DataFrame) -> DataFrame:
    """df (doc_id, hash) with key, which ascends as ids descend, nulls last, and equal ids' hashes ascend."""
    last = F.col("doc_id").isNull()
    down = F.when(last, F.lit(0).cast("long")).otherwise(F.bitwise_not(F.col("doc_id").cast("long")))  # reverses the order of all 64-bit numbers
    return df.withColumn("key", F.struct(last.cast("int").alias("last"), down.alias("down"), F.col("hash").alias("hash")))


def _ranges(rows: DataFrame) -> tuple[DataFrame, Column, int]:
    """(table, coarse place, ranges): first keys of ranges of about RANGE_ROWS rows in order of key, found by sorting keys alone.

    The table holds them as arrays of about the root of their number, by coarse place: at most MOST_RANGES keys in all."""
    spark = rows.sparkSession
    keys = materialize(rows.select("key.*"), spark)
    n = max(1, min(MOST_RANGES, keys.count() // RANGE_ROWS))
    parts = keys.repartitionByRange(n, "last", "down", "hash").groupBy(F.spark_partition_id()).agg(F.min(F.struct("last", "down", "hash")).alias("k"))
    heads = sorted(tuple(r["k"]) for r in parts.collect())  # at most MOST_RANGES rows
    discard(keys, spark)
    step = max(1, math.isqrt(len(heads)))
    key = "struct<last:int,down:bigint,hash:bigint>"
    fine = [(i, heads[at : at + step]) for i, at in enumerate(range(0, len(heads), step))]
    table = spark.createDataFrame(fine, f"coarse int, fine array<{key}>")
    firsts = F.array(*[F.struct(*[F.lit(v).cast(t) for v, t in zip(h, ("int", "long", "long"), strict=True)]).cast(key) for _, (h, *_) in fine]) if fine else F.array().cast(f"array<{key}>")
    return table, F.greatest(F.size(F.filter(firsts, lambda h: h <= F.col("key"))) - 1, F.lit(0)), step


def with_next(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, text, sketch, next_text, next_sketch: beside each document the one after it by descending doc_id, beside the last the first.

    Rows are dealt to ranges of the order, whose bounds come from the sorted ids themselves, so that clustered ids fill
    no range; rows of one id, or without any, are told apart by the text's hash. The first row of a range is also put,
    as a ghost, at the end of the range before it. Texts are shuffled once, and sketched after that."""
    rows = _ordered(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text")))
    table, coarse, step = _ranges(rows)
    total = table.agg(F.sum(F.size("fine"))).first()[0] or 1
    found = rows.withColumn("coarse", coarse).join(F.broadcast(table), "coarse")  # at most MOST_RANGES keys
    within = F.greatest(F.size(F.filter("fine", lambda h: h <= F.col("key"))), F.lit(1))
    found = found.withColumn("range", F.col("coarse") * step + within - 1).withColumn("head", F.element_at("fine", within) == F.col("key"))
    own = F.struct(F.col("range"), F.lit(False).alias("ghost"))
    ghost = F.struct(F.pmod(F.col("range") - 1, F.lit(total)).cast("int").alias("range"), F.lit(True).alias("ghost"))
    spread = found.select("doc_id", "text", "key", F.explode(F.when(F.col("head"), F.array(own, ghost)).otherwise(F.array(own))).alias("p"))
    placed = spread.select("doc_id", "text", "key", "p.range", "p.ghost").repartition("range")
    after = Window.partitionBy("range").orderBy("ghost", "key")
    sketched = with_sketch(placed, F.col("text"), "sketch", k)
    return sketched.withColumn("next_text", F.lead("text").over(after)).withColumn("next_sketch", F.lead("sketch").over(after)).where(~F.col("ghost")).select("doc_id", "text", "sketch", "next_text", "next_sketch")


def edited_likeness(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last third comes from the next document."""
    both = with_next(docs, k).withColumn("n_chars", F.char_length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    both = both.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - third), F.substring("next_text", F.lit(1), third)))
    both = both.withColumn("edited_sha256", F.sha2("edited", 256)).drop("text", "next_text")
    both = with_sketch(both, F.col("edited"), "edited_sketch", k)
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_count(F.col("sketch"), k).alias("distinct_shingles"),
        containment(F.col("edited_sketch"), F.col("sketch"), k).alias("edited_contained"),
    )

"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are put into one permuted stream of words, by a hash. What the mix takes of a source is the
first `target` words of its stream, repeated end to end: whole passes over the source, then a part. That stretch is cut
into blocks. A tree over the output shards deals the sources' exact block quotas: a node draws, from a multivariate
hypergeometric distribution seeded by the node, how many blocks of each source its left half gets. So each shard finds
its share of each source, and where that share begins, by walking down from the root, without the other shards. Blocks
go to shards in a permuted order, disjointly, and each shard's pieces are sorted by a hash.

There may be any number of sources: their table is a DataFrame, and broadcast only up to MOST_BROADCAST rows. The tree
draws for groups of GROUP sources first, then within each group, which is the same distribution; a task holds one group.

Odd inputs: null and blank texts have size 0 and are never taken; the null source comes last; documents of equal hash,
repeated rows among them, are ordered by id, then size, and are interchangeable after that; with no words at all
nothing is taken; an empty table gives none; other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, discard, materialize

SEED, MOST_TIMES = 20, 3
BLOCK_WORDS, SHARD_WORDS = 1024, 1 << 21
#: numpy draws from at most 1e9 items: blocks grow from so many words on.
MOST_BLOCKS = 500_000_000
#: Sources that one draw and one task holds; sources up to which their table is broadcast; shards that one task walks to.
GROUP, MOST_BROADCAST, WALKS = 20_000, 100_000, 256
#: Primes above MOST_BLOCKS, so without a common factor with any number of blocks.
PRIMES = [1000000007, 1000000009, 1000000021, 1000000033, 1000000087, 1000000093, 1000000097, 1000000103]


def size_of(text: Column) -> Column:
    """Words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _cut(total: int, low: int, high: int, shards: int) -> int:
    return total * high // shards - total * low // shards


def _half(node: tuple, counts: np.ndarray, n: int, memo: dict) -> np.ndarray:
    """How many items of each kind the left half of a node gets: n of all counts, drawn by the node's own seed."""
    if node not in memo:
        memo[node] = np.random.default_rng(node).multivariate_hypergeometric(counts, n, method="marginals")
    return memo[node]


def shard_quotas(groups: list[int], group: int, quotas: list[int], shards: int, shard: int, seed: int, memo: dict) -> tuple[np.ndarray, np.ndarray]:
    """(where the shard's share begins, its size) for each source of one group, by a walk from the root of the tree. groups are the quotas of all groups, quotas those of the group's sources."""
    total, low, high = sum(groups), 0, shards
    above, counts, begin = np.array(groups, np.int64), np.array(quotas, np.int64), np.zeros(len(quotas), np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        left_groups = _half((seed, low, high), above, _cut(total, low, middle, shards), memo)
        left = _half((seed, low, high, 1 + group), counts, int(left_groups[group]), memo)
        if shard < middle:
            high, above, counts = middle, left_groups, left
        else:
            low, above, counts, begin = middle, above - left_groups, counts - left, begin + left
    return begin, counts


def quota_table(sources: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """(s, shard, begin, n): each shard's share of each source's permuted blocks, for sources (s, blocks); each shard is found by itself."""
    sources = sources.select("s", "blocks", F.floor(F.col("s") / GROUP).alias("group"))
    groups = [r[1] for r in sorted(sources.groupBy("group").agg(F.sum("blocks")).collect())]  # a row for GROUP sources

    def walk(key: tuple, own: pa.Table) -> pa.Table:
        own, group, part = own.sort_by("s"), key[0].as_py(), key[1].as_py()
        names, quotas = own["s"].to_numpy(), own["blocks"].to_pylist()
        memo, out = {}, []
        for shard in range(part * WALKS, min(shards, (part + 1) * WALKS)):
            begin, n = shard_quotas(groups, group, quotas, shards, shard, seed, memo)
            some = np.flatnonzero(n)
            out.append(pa.table({"s": names[some], "shard": np.full(len(some), shard), "begin": begin[some], "n": n[some]}))
        return pa.concat_tables(out)

    parts = F.explode(F.sequence(F.lit(0), F.lit((shards - 1) // WALKS))).alias("part")
    return sources.select("s", "blocks", "group", parts).groupBy("group", "part").applyInArrow(walk, "s long, shard long, begin long, n long")


def sized(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, key (a hash of the text) and perm, the document's place in its source's permutation."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size_of(F.col("text")).alias("size"), F.xxhash64("text").alias("key"))
    return rows.withColumn("perm", F.xxhash64(F.lit(seed), "doc_id", "source"))


def numbered_sources(rows: DataFrame) -> DataFrame:
    """(s, source, rows, source_size, weight): sources numbered by code point, null last, with weights 1, 2, 3, repeating.

    Sorted in ranges; a range's first number is the sum of the rows of the ranges before it (a row for each range)."""
    spark = rows.sparkSession
    found = materialize(rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size")), spark)
    placed = materialize(found.orderBy(F.asc_nulls_last("source")).withColumn("at", F.monotonically_increasing_id()), spark)
    place, within = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    counts, before, first = sorted((r[0], r[1]) for r in placed.groupBy(place.alias("p")).count().collect()), 0, []
    for p, n in counts:
        first += [F.lit(p).cast("long"), F.lit(before).cast("long")]
        before += n
    s = (F.element_at(F.create_map(*first), place) if first else F.lit(0).cast("long")) + within
    out = placed.select(s.alias("s"), "source", "rows", "source_size", (s % 3 + 1).cast("double").alias("weight"))
    out._skein_path = placed._skein_path
    discard(found, spark)
    return out


def with_targets(sources: DataFrame, most_times: float = MOST_TIMES) -> DataFrame:
    """sources with target: shares of the total by weight; a target stops at most_times its source's size, and the excess is shared by weight among the rest until none is above.

    One sum over the sources a round tells the next share of a unit of weight; it only grows, and stands when no further source is above."""
    limit = F.lit(float(most_times)) * F.col("source_size")
    total, unit, closed = float(sources.agg(F.sum("source_size")).first()[0] or 0), 0.0, -1
    while True:
        above = F.col("weight") * F.lit(unit) > limit
        sums = sources.agg(F.count_if(above).alias("n"), F.sum(F.when(above, limit).otherwise(0.0)).alias("full"), F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if sums["n"] == closed or not sums["open"]:
            return sources.withColumn("target", F.when(above, limit).otherwise(F.col("weight") * F.lit(unit)))
        closed, unit = sums["n"], (total - sums["full"]) / sums["open"]


def mix(rows: DataFrame, seed: int = SEED, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces) for rows of sized().

    documents: rows with s, source_size, target and place, the word of its source's stream at which it begins.
    pieces: (s, place, pass, first_word, n_words, shard, ordinal): a run of words of one document that a shard takes; a
    shard's pieces are to be read by ordinal. A document's pieces over all shards are what the mix takes of it.
    """
    spark = rows.sparkSession
    known = with_targets(numbered_sources(rows)).withColumn("taken", F.bround("target").cast("long"))
    facts = known.agg(F.count(F.lit(1)).alias("n"), F.sum("source_size").alias("total"), F.sum("taken").alias("taken"), F.max("rows").alias("most")).first()
    block = max(block_words, -(-(facts["taken"] or 0) // MOST_BLOCKS))
    shards = max(1, round((facts["total"] or 0) / shard_words))
    known = known.withColumn("blocks", F.greatest(F.lit(0).cast("long"), F.expr(f"(taken + {block} - 1) div {block}")))
    some = F.greatest(F.lit(1).cast("long"), F.col("blocks"))
    prime = F.element_at(F.array(*[F.lit(p).cast("long") for p in PRIMES]), (F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(len(PRIMES))) + 1).cast("int"))
    known = known.select("s", "source", "source_size", "target", "taken", "blocks", prime.alias("factor"), F.pmod(F.xxhash64(F.lit(seed + 2), "source"), some).alias("shift"), F.greatest(F.lit(1).cast("long"), F.expr(f"blocks div {shards}")).alias("width"))
    known = materialize(known.withColumnRenamed("source", "source_"), spark)
    few = facts["n"] <= MOST_BROADCAST
    sources = F.broadcast(known) if few else known
    bits = max(0, (max(1, facts["most"] or 1) - 1).bit_length() + 1) // 2  # cells of a source, and documents of a cell: about the root of its documents
    placed = rows.join(sources, F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
    placed = placed.withColumn("cell", F.shiftrightunsigned("perm", 64 - bits) if bits else F.lit(0).cast("long"))
    cells = placed.groupBy("s", "cell").agg(F.sum("size").alias("cell_size"))
    before = Window.partitionBy("s").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("s", "cell", F.coalesce(F.sum("cell_size").over(before), F.lit(0)).alias("cell_place"))
    inside = Window.partitionBy("s", "cell").orderBy(F.shiftleft("perm", bits), "doc_id", "size", "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("within", F.sum("size").over(inside) - F.col("size")).join(cells, ["s", "cell"]).withColumn("place", F.col("cell_place") + F.col("within")).drop("within", "cell", "cell_place")
    passes = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.expr("(taken - place - 1) div source_size")))).alias("pass")
    runs = placed.where("size > 0 AND taken > place").select("s", "place", "size", "source_size", "taken", "blocks", "factor", "shift", "width", passes)
    runs = runs.withColumn("low", F.expr("pass * source_size + place")).withColumn("high", F.expr("least(low + size, taken)")).where("high > low")
    cut = runs.withColumn("b", F.explode(F.expr(f"sequence(low div {block}, (high - 1) div {block})")))
    cut = cut.withColumn("at", F.expr(f"greatest(low, b * {block})")).withColumn("n_words", F.expr(f"least(high, (b + 1) * {block}) - at"))
    cut = cut.withColumn("d", F.expr("(b * factor + shift) % blocks")).withColumn("bin", F.expr("d div width"))
    quota = quota_table(known.where("blocks > 0"), shards, seed).join(sources.select("s", "width"), "s")
    quota = quota.withColumn("bin", F.explode(F.expr("sequence(begin div width, (begin + n - 1) div width)"))).drop("width")
    pieces = cut.join(quota, ["s", "bin"]).where("d >= begin AND d < begin + n")
    ordinal = F.xxhash64(F.lit(seed + 1), "shard", "s", "d", "at")
    return placed, pieces.select("s", "place", "pass", F.expr("at - low").alias("first_word"), "n_words", "shard", ordinal.alias("ordinal"))


def taken_words(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Per document what the mix takes of it: doc_id, size, source_size, target, taken, key (a hash of the text), source, and the shard and place in it (ordinal) where its first piece comes; null if nothing is taken."""
    rows = materialize(sized(docs, seed), docs.sparkSession)
    placed, pieces = mix(rows, seed)
    each = pieces.groupBy("s", "place").agg(F.sum("n_words").alias("n"), F.min(F.struct("pass", "first_word", "shard", "ordinal")).alias("first"), F.lit(True).alias("some"))
    placed = placed.withColumn("some", F.col("size") > 0)
    return placed.join(each, ["s", "place", "some"], "left").select("doc_id", "size", "source_size", "target", F.coalesce("n", F.lit(0)).cast("long").alias("taken"), "key", "source", F.col("first.shard").alias("shard"), F.col("first.ordinal").alias("ordinal"))


def _identity(doc_id: Column, source: Column, key: Column) -> list[Column]:
    """Two hashes, 128 bits, of what makes rows repeats of each other; never null."""
    parts = [doc_id.isNull(), doc_id, source.isNull(), source, key]
    return [F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(SEED), *parts).alias("h2")]


def mixed_documents(docs: DataFrame, seed: int = SEED, by_shard: bool = True) -> DataFrame:
    """The mix as documents: a row for each whole pass over a document, and one with its first words for a part.

    Rows are laid out by shard (that takes one more shuffle of the texts; without by_shard a shard's rows lie in several
    partitions), and within it shuffled by ordinal, each pass by an ordinal of its own; a document that several shards
    share lies in the first. Repeated rows (same id, source and text) pool what is taken of them. All columns are kept;
    n_chars follows the text.
    """
    each = taken_words(docs, seed).select(*_identity(F.col("doc_id"), F.col("source"), F.col("key")), "size", "taken", F.struct("shard", "ordinal").alias("first"))
    each = each.groupBy("h1", "h2").agg(F.max("size").alias("size"), F.sum("taken").alias("taken"), F.min("first").alias("first")).where("taken > 0")
    rows = docs.select(F.struct("*").alias("row"), *_identity(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.xxhash64("text")))
    met = rows.join(each, ["h1", "h2"]).dropDuplicates(["h1", "h2"])
    copies = met.withColumn("pass", F.explode(F.expr("sequence(1L, (taken + size - 1) div size)")))
    rest, text = F.expr("taken - (pass - 1) * size"), F.col("row.text")
    pieces = F.slice(F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"), F.lit(1), rest.cast("int"))
    copies = copies.withColumn("place", F.xxhash64("first.ordinal", "pass"))
    laid = (copies.repartition("first.shard") if by_shard else copies).sortWithinPartitions("first.shard", "place")
    new = F.when(rest >= F.col("size"), text).otherwise(F.array_join(pieces, ""))
    changed = {"text": new} | ({"n_chars": F.char_length(new).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return laid.select([changed[c].alias(c) if c in changed else F.col("row").getField(c).alias(c) for c in docs.columns])

"""SimHash near-duplicates: Hamming links between fingerprints through Gray-order hierarchical indexes.

A fingerprint has 64 bits; bit i is set if over half of the hashes of the text's word shingles (repeats included) have
it. Fingerprints of at most two differing bits are linked; documents with equal or linked fingerprints form groups.

Distribution: two 64-bit words that differ in at most two bits agree in two of four 16-bit blocks. Each distinct
fingerprint goes to the six buckets named by two of its blocks; a bucket of more than HOT_BUCKET fingerprints is dealt
again by two of the four 8-bit blocks of the rest, so that no bucket holds more than 65,536. In a bucket the
fingerprints are sorted by Gray rank and put into a tree: a node keeps the bits that all below it share and that its
parent doesn't already keep. A search adds up differing bits from the root down and leaves whole groups as soon as
they exceed the distance. A bucket yields a spanning forest of its links, never all its pairs.

Odd inputs: null and blank texts have the fingerprint zero and are linked like any others; fewer words than a shingle
are one shingle; repeated rows belong to the same group; rows of equal id and other texts are documents of their own;
null ids are kept, in the group of their text, and a group with no id at all has a null component; other columns may
have any names; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import discard, hex16, materialize, slices
from .components import components

HOT_BUCKET, FANOUT, DISTANCE = 4096, 16, 2
PAIRS_OF_FOUR = [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)]
#: Query and node pairs that one step of a search holds at once.
FRONTIER = 1 << 21


def simhash_of(texts: list[str], shingle: int = 3) -> np.ndarray:
    """The texts' fingerprints, as signed numbers."""
    digest, hashes, counts = xxhash.xxh64_intdigest, [], []
    for text in texts:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if len(words) <= shingle:
            hashes += [digest(b" ".join(words), 42)] if words else []
            counts.append(min(1, len(words)))
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends[: len(words) - shingle] + 1).tolist()]
        hashes += [digest(joined[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
        counts.append(len(starts))
    out = np.zeros(len(texts), np.uint64)
    n = np.array(counts, np.int64)
    some = np.flatnonzero(n)
    if len(some):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begins = (np.cumsum(n) - n)[some]
        set_in = np.add.reduceat(bits, begins, axis=0, dtype=np.int64)
        out[some] = np.packbits(2 * set_in > n[some, None], axis=1, bitorder="little").view("<u8").ravel()
    return out.view(np.int64)


@F.arrow_udf(LongType())
def _fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for texts in slices(batch, 2 << 20):
            yield pa.array(simhash_of(texts))


def fingerprint(text: Column) -> Column:
    return _fingerprints(text)


def gray_rank(code: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence."""
    rank = code.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """A tree over fingerprints in Gray order; node = (mask, value): the shared bits that its parent lacks."""

    def __init__(self, codes: np.ndarray, fanout: int = FANOUT) -> None:
        codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        self.codes, self.fanout, levels = codes, fanout, []
        ands, ors = codes, codes
        while True:
            levels.append((~(ands ^ ors), ands))
            if len(ands) == 1:
                break
            at = np.arange(0, len(ands), fanout)
            ands, ors = np.bitwise_and.reduceat(ands, at), np.bitwise_or.reduceat(ors, at)
        self.levels, above = [], np.zeros(1, np.uint64)
        for mask, value in reversed(levels):
            self.levels.append((mask & ~np.repeat(above, fanout)[: len(mask)] if len(mask) > 1 else mask, value))
            above = mask

    def search(self, queries: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
        """Index of each query and of each code within the distance of it."""
        who, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        off = np.zeros(len(queries), np.int64)
        for depth, (mask, value) in enumerate(self.levels):
            if depth:
                node = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
                who, off = np.repeat(who, self.fanout), np.repeat(off, self.fanout)
                inside = node < len(mask)
                who, node, off = who[inside], node[inside], off[inside]
            off = off + np.bitwise_count((queries[who] ^ value[node]) & mask[node])
            near = off <= distance
            who, node, off = who[near], node[near], off[near]
        return who, node


def unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the classes of a[i] and b[i]; a label is the least index of its class."""
    while len(a):
        x, y = labels[a], labels[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while (labels != (up := labels[labels])).any():
            labels = up
    return labels


def forest(codes: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the classes of distinct codes under links of at most the distance."""
    if len(codes) == 2:
        near = np.bitwise_count(codes[0] ^ codes[1]) <= distance
        return codes[:1][[near]], codes[1:][[near]]
    index = GrayIndex(codes)
    codes, labels = index.codes, np.arange(len(codes))
    step = max(1, FRONTIER // max(len(codes), FANOUT))
    for at in range(0, len(codes), step):
        who, node = index.search(codes[at : at + step], distance)
        labels = unite(labels, who + at, node)
    child = np.flatnonzero(labels != np.arange(len(codes)))
    return codes[child], codes[labels[child]]


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within runs of equal (bucket, part); rows come sorted by them."""
    held = [np.zeros(0, np.int64)] * 3

    def emit(bucket: np.ndarray, part: np.ndarray, code: np.ndarray) -> Iterator[pa.RecordBatch]:
        edge = np.flatnonzero((bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])) + 1
        starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(bucket)]])
        several = ends - starts > 1
        found = [forest(code[a:b].view(np.uint64)) for a, b in zip(starts[several].tolist(), ends[several].tolist(), strict=True)]
        if found:
            yield pa.record_batch({"a": np.concatenate([x for x, _ in found]).view(np.int64), "b": np.concatenate([y for _, y in found]).view(np.int64)})

    for batch in batches:
        rows = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns, strict=True)]
        change = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1]))
        cut = change[-1] + 1 if len(change) else 0
        if cut:
            yield from emit(*(r[:cut] for r in rows))
        held = [r[cut:] for r in rows]
    if len(held[0]):
        yield from emit(*held)


def _blocks(code: str, width: int, offsets: list[int]) -> list[str]:
    return [f"(shiftrightunsigned({code}, {at}) & {(1 << width) - 1})" for at in offsets]


def hamming_links(codes: DataFrame, column: str = "fp") -> DataFrame:
    """(a, b): links that span the groups of the distinct numbers in column at Hamming distance two or less."""
    blocks = _blocks(column, 16, [0, 16, 32, 48])
    keys = [f"struct({k}L * 4294967296L + {blocks[i]} * 65536L + {blocks[j]} AS bucket, {blocks[x]} * 65536L + {blocks[y]} AS rest)" for k, (i, j) in enumerate(PAIRS_OF_FOUR) for x, y in [[z for z in range(4) if z not in (i, j)]]]
    dealt = codes.select(column, F.explode(F.expr(f"array({', '.join(keys)})")).alias("k")).select("k.bucket", "k.rest", F.col(column).alias("code"))
    hot = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_BUCKET).select("bucket", F.lit(True).alias("hot"))
    small = _blocks("rest", 8, [0, 8, 16, 24])
    parts = [f"{k}L * 65536L + {small[i]} * 256L + {small[j]}" for k, (i, j) in enumerate(PAIRS_OF_FOUR)]
    placed = dealt.join(hot, "bucket", "left").select("bucket", F.explode(F.expr(f"CASE WHEN hot THEN array({', '.join(parts)}) ELSE array(-1L) END")).alias("part"), "code")
    return placed.repartition("bucket", "part").sortWithinPartitions("bucket", "part").mapInArrow(_bucket_links, "a long, b long")


def _classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, classes): doc_id, key (a hash of the text) and fp of each row of docs; fp, root and component_id of each distinct fingerprint."""
    spark = docs.sparkSession
    prints = materialize(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("key"), fingerprint(F.col(text_col)).alias("fp")), spark)
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), spark)
    roots = components(hamming_links(distinct), "a", "b")
    placed = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialize(placed.join(ids, "root").select("fp", "root", "component_id"), spark)
    for done in (distinct, roots):
        discard(done, spark)
    return prints, named


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hex digits, component_id."""
    prints, named = _classes(docs)
    return prints.join(named, "fp").select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of docs for each group: that of its least id, ids that are null last; of rows of equal id that of the least hash of the text, then of the other columns."""
    spark = docs.sparkSession
    prints, named = _classes(docs)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    chosen = prints.join(named, "fp").groupBy("root").agg(F.min(place).alias("p")).select("root", F.col("p.doc_id").alias("id"), F.col("p.key").alias("key"))
    chosen = materialize(chosen, spark)
    discard(prints, spark)
    discard(named, spark)
    plain = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("row_id"), F.xxhash64("text").alias("row_key"), F.xxhash64(*[f"`{c}`" for c in plain]).alias("all"))
    met = rows.join(chosen, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_key") == F.col("key")))
    return met.withColumn("n", F.row_number().over(Window.partitionBy("root").orderBy("all"))).where("n = 1").select("row.*")

"""Embedding near-duplicates through spherical-cap filters.

A filter is a direction; a vector goes to each filter whose cap it lies in, i.e. whose inner product exceeds a
threshold. The directions are structured: a code deals the dimensions, after a random sign flip and permutation, to
blocks with a small codebook of Gaussian directions each, and a filter is one word of every block's codebook. A vector
is list-decoded: block by block, best words first, branches are left as soon as the best completion stays below the
threshold. Vectors that share a filter (and a label) are compared by cosine in double precision.

Each linked pair is counted in its least common filter only, so that pairs are never gathered: a bucket yields, for
each of its vectors, a number of links and a root within the bucket. Equal vectors are compared once and counted by
their number. A bucket of more than HOT_BUCKET vectors is dealt to pairs of chunks.

Odd inputs: vectors that are null, empty, zero, or hold null or non-finite numbers, and rows of null label, link with
nothing and are components of their own; vectors of unequal length are never compared; repeated rows are vectors of
their own, linked to each other; rows of null id are linked and counted, and a component takes its least id.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from .common import discard, materialize
from .components import components
from .simhash import unite

COSINE, SEED = 0.93, 5
#: Filters that a vector lies in, on average; codes; blocks of a code; vectors that a bucket holds, on average, at most.
FILTERS_EACH, CODES, BLOCKS, BUCKET = 32, 16, 2, 64
HOT_BUCKET, CHUNK = 4096, 1024


def plan(n: int) -> tuple[int, float]:
    """(words of a codebook, threshold) for labels of up to n vectors: the more, the smaller and the more caps."""
    share = min(0.02, BUCKET / max(1, n))
    words = math.ceil((FILTERS_EACH / share / CODES) ** (1 / BLOCKS))
    return words, NormalDist().inv_cdf(1 - share)


@functools.lru_cache(8)
def _codebooks(dims: int, words: int, seed: int) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """For each code, each block's dimensions and its codebook (dimensions x words)."""
    rng = np.random.default_rng([seed, dims, words])
    out = []
    for _ in range(CODES):
        order = rng.permutation(dims)
        out.append([(part, rng.standard_normal((len(part), words))) for part in np.array_split(order, BLOCKS)])
    return out


def decode(x: np.ndarray, words: int, threshold: float, seed: int = SEED) -> list[np.ndarray]:
    """The filters that each unit vector exceeds, ascending. The frontier holds (vector, prefix) pairs that may still exceed."""
    who_all, filter_all = [], []
    for code, blocks in enumerate(_codebooks(x.shape[1], words, seed)):
        scores = [x[:, part] @ book for part, book in blocks]
        best_after = np.zeros(len(x))
        bounds = [best_after]
        for s in scores[:0:-1]:
            best_after = best_after + s.max(axis=1)
            bounds.append(best_after)
        bounds.reverse()
        who, prefix, total = np.arange(len(x)), np.full(len(x), code), np.zeros(len(x))
        for s, bound in zip(scores, bounds, strict=True):
            sums = total[:, None] + s[who]
            row, word = np.nonzero(sums + bound[who, None] > threshold)
            total = sums[row, word]
            who, prefix = who[row], prefix[row] * words + word
        who_all.append(who)
        filter_all.append(prefix)
    who, found = np.concatenate(who_all), np.concatenate(filter_all)
    order = np.lexsort((found, who))
    return np.split(found[order], np.searchsorted(who[order], np.arange(1, len(x))))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _filters(words: int, threshold: float):
    @F.arrow_udf(ArrayType(IntegerType()))
    def filters(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            lengths = np.array(batch.value_lengths())
            out: list = [None] * len(batch)
            for dims in np.unique(lengths):
                at = np.flatnonzero(lengths == dims)
                for part in np.array_split(at, max(1, len(at) // 2048)):
                    got = decode(_unit(_matrix(batch.take(pa.array(part)))), words, threshold)
                    for i, f in zip(part.tolist(), got, strict=True):
                        out[i] = f
            yield pa.array(out, pa.list_(pa.int32()))

    return filters


def _membership(filters: list[np.ndarray], known: np.ndarray) -> np.ndarray:
    out = np.zeros((len(filters), len(known)), np.float32)
    for row, own in zip(out, filters, strict=True):
        row[np.searchsorted(known, own[np.isin(own, known)])] = 1
    return out


def _links(x: np.ndarray, filters: list[np.ndarray], weight: np.ndarray, chunk: np.ndarray, low: int, high: int, here: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(links, label) of each vector of a bucket: pairs between chunks low and high whose least common filter is here."""
    earlier = [f[f < here] for f in filters]
    links, labels = np.zeros(len(x), np.int64), np.arange(len(x))
    left, right = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
    for a in range(0, len(left), CHUNK):
        rows = left[a : a + CHUNK]
        for b in range(a if low == high else 0, len(right), CHUNK):
            columns = right[b : b + CHUNK]
            near = x[rows] @ x[columns].T >= cosine
            if low == high:
                near &= rows[:, None] < columns[None, :]
            if not near.any():
                continue
            known = np.intersect1d(np.concatenate([earlier[i] for i in rows]), np.concatenate([earlier[i] for i in columns]))
            if len(known):
                near &= _membership([earlier[i] for i in rows], known) @ _membership([earlier[i] for i in columns], known).T == 0
            i, j = np.nonzero(near)
            np.add.at(links, rows[i], weight[columns[j]])
            np.add.at(links, columns[j], weight[rows[i]])
            labels = unite(labels, rows[i], columns[j])
    return links, labels


def _buckets(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Buckets are runs of equal (label, dims, filter, low, high); rows come sorted by them."""
        held: pa.Table | None = None

        def bucket(part: pa.Table) -> pa.RecordBatch | None:
            if len(part) < 2:
                return None
            part = part.combine_chunks()
            x = _unit(_matrix(part["embedding"].chunk(0)))
            here, low, high = (part[c][0].as_py() for c in ("filter", "low", "high"))
            filters = [np.asarray(f.values) for f in part["filters"]]
            links, labels = _links(x, filters, part["w"].to_numpy(), part["chunk"].to_numpy(), low, high, here, cosine)
            some, node = np.flatnonzero(links), part["node"].to_numpy()
            return pa.record_batch({"node": node[some], "n": links[some], "root": node[labels[some]]}) if len(some) else None

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None and len(held) else table
            keys = [table[c].to_numpy() for c in ("label", "dims", "filter", "low", "high")]
            cuts = [0, *(np.flatnonzero(functools.reduce(np.logical_or, [k[1:] != k[:-1] for k in keys])) + 1).tolist()]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if (out := bucket(table.slice(a, b - a))) is not None:
                    yield out
            held = table.slice(cuts[-1])
        if held is not None and (out := bucket(held)) is not None:
            yield out

    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    valid = F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    rows = materialize(rows.withColumn("node", F.when(valid, F.xxhash64("label", "embedding"))), spark)
    reps = rows.where("node IS NOT NULL").groupBy("node").agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("w"), F.min("vec_id").alias("least"))
    reps = materialize(reps.withColumn("dims", F.size("embedding").cast("long")), spark)
    most = reps.groupBy("label", "dims").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    words, threshold = plan(most)
    dealt = reps.withColumn("filters", _filters(words, threshold)(F.col("embedding")))
    dealt = materialize(dealt.select("label", "dims", "node", "w", "embedding", "filters"), spark)
    keys = dealt.select("label", "dims", F.explode("filters").alias("filter"))
    hot = keys.groupBy("label", "dims", "filter").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_BUCKET).withColumn("chunks", F.ceil(F.col("n") / HOT_BUCKET))
    placed = dealt.withColumn("filter", F.explode("filters")).join(hot.drop("n"), ["label", "dims", "filter"], "left")
    placed = placed.withColumn("chunk", F.coalesce(F.pmod("node", "chunks"), F.lit(0).cast("long")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("chunks"), F.lit(1)) - 1)).alias("other")
    placed = placed.select("label", "dims", "filter", "chunk", "node", "w", "embedding", "filters", other)
    placed = placed.select("label", "dims", "filter", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "node", "w", "embedding", "filters")
    by = ["label", "dims", "filter", "low", "high"]
    found = placed.repartition(*by).sortWithinPartitions(*by).mapInArrow(_buckets(cosine), "node long, n long, root long")
    found = materialize(found, spark)
    roots = components(found, "node", "root")
    links = found.groupBy("node").agg(F.sum("n").alias("n"))
    named = reps.select("node", "w", "least").join(roots, "node", "left").join(links, "node", "left").select("node", "w", "least", "n", F.coalesce("root", "node").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component"))
    named = materialize(named.join(ids, "root").select("node", "component", (F.col("w") - 1 + F.coalesce("n", F.lit(0))).alias("links")), spark)
    discard(dealt, spark)
    out = rows.join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))

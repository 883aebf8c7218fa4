"""Substring dedup over sliding spans of sentences.

A text is cut into sentences after full stops, question and exclamation marks and line feeds; blank ones are passed
over. A sentence of more than MOST_WORDS words counts as several: it is cut before words whose hash is least among
their neighbours', so that a passage is cut alike wherever it stands, and every STEP words where that leaves long parts.
Every run of consecutive sentences of LEAST_WORDS words or more that two places share is found: from each sentence the
shortest such run is hashed, and up to each sentence likewise, and these cover every longer one. So a passage of over
50 words that repeats is found, wherever in a sentence it begins and ends, and shared lines of fewer words stay. A text
of fewer words than that is hashed as a whole. Hashes are joined over all documents; sentences that lie in a run which
occurred before, in this or another document, are removed. The first occurrence, by id, then place, stays, but for what
repeats within it. Sentences are compared by their words, lower-cased; of scripts without blanks two letters count as a
word.

A run may hold any share of all rows: those that hold over 1 / HOT_RUNS of a sample of rows (at most HOT_RUNS of them,
so that their list may be broadcast) are dealt to SALTS tasks by document, and the first of each task are compared once
more. The sample decides who does the work, never what is found.

Odd inputs: null and blank texts have no sentences and stay as they are; null ids come last; rows that repeat the id
and the text are one document and are treated alike; rows of equal id and unequal text are ordered by a hash; other
columns, whatever their names, are left out; an empty table gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import discard, materialize, slices

#: Words of the shortest run that counts; of the longest sentence that stays whole; of the parts of one without other cuts.
LEAST_WORDS, MOST_WORDS, STEP = 25, 16, 8
#: Rows of the sample that looks for hot runs; hot runs at most; tasks that each is dealt to.
SAMPLE, HOT_RUNS, SALTS = 1_000_000, 1000, 64
#: Words on each side that a word's hash is compared with.
AROUND = 3
SENTENCE = re.compile(r"(?<=[.!?\n。！？])(?=[^.!?\n。！？])")
WORD = re.compile(r"\S+")
#: Letters of words that no blanks part.
UNPARTED = re.compile(r"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]")


def _cuts(long: list[list[str]]) -> list[list[int]]:
    """For each long sentence the words before which it is cut: their hashes are less than those of the AROUND words before and no more than those of the AROUND words after."""
    h = np.array([xxhash.xxh64_intdigest(w) for words in long for w in words], np.uint64)
    least = np.ones(len(h), bool)
    for k in range(1, AROUND + 1):
        least[k:] &= h[k:] < h[:-k]
        least[:-k] &= h[:-k] <= h[k:]
    out, begin = [], 0
    for n in map(len, long):  # near its ends a sentence has no cuts, so that others' words don't matter
        own = [0, *(np.flatnonzero(least[begin + AROUND : begin + n - AROUND]) + AROUND).tolist(), n]
        out.append([c for a, b in zip(own, own[1:], strict=False) for c in ([a] if b - a <= MOST_WORDS else range(a, b - STEP // 2, STEP))][1:])
        begin += n
    return out


def sentences(text: str) -> tuple[list[str], list[list[str]]]:
    """The sentences of a text, long ones in parts, and the words of each; the sentences together are the text."""
    parts = SENTENCE.split(text) if text else []
    words = [s.lower().split() for s in parts]
    long = [i for i, w in enumerate(words) if len(w) > MOST_WORDS]
    if not long:
        return parts, words
    cuts = dict(zip(long, _cuts([words[i] for i in long]), strict=True))
    out, own = [], []
    for i, (part, w) in enumerate(zip(parts, words, strict=True)):
        if not (at := cuts.get(i)):
            out.append(part)
            own.append(w)
            continue
        starts = [m.start() for m in WORD.finditer(part)]
        for a, b in zip([0, *at], [*at, len(w)], strict=True):
            out.append(part[starts[a] if a else 0 : starts[b] if b < len(w) else len(part)])
            own.append(w[a:b])
    return out, own


def n_words(sentence: str, words: list[str]) -> int:
    return len(words) + (0 if sentence.isascii() else len(UNPARTED.findall(sentence)) // 2)


def runs(text: str) -> tuple[list[int], list[int]]:
    """Places and hashes of the text's runs. A place is the first sentence, times 2^32, plus the sentence after the last."""
    parts, words = sentences(text)
    at = [i for i, w in enumerate(words) if w]
    if not at:
        return [], []
    n = len(at)
    hashes = np.array([xxhash.xxh64_intdigest(" ".join(words[i])) for i in at], "<u8").tobytes()
    counts = np.cumsum([0, *(n_words(parts[i], words[i]) for i in at)])
    ends = np.searchsorted(counts, counts[:-1] + LEAST_WORDS)
    begins = np.searchsorted(counts, counts[1:] - LEAST_WORDS, "right") - 1
    found = sorted({(i, e) for i, e in enumerate(ends.tolist()) if e <= n} | {(b, i) for i, b in enumerate(begins.tolist(), 1) if b >= 0} or {(0, n)})
    return [(at[b] << 32) + at[e - 1] + 1 for b, e in found], [xxhash.xxh64_intdigest(hashes[8 * b : 8 * e]) - 2**63 for b, e in found]


@F.arrow_udf(ArrayType(StructType([StructField("at", LongType()), StructField("run", LongType())])))
def _runs(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for texts in slices(batch):
            found = [runs(text) for text in texts]
            offsets = np.cumsum([0, *(len(p) for p, _ in found)])
            at = pa.array([i for p, _ in found for i in p], pa.int64())
            values = pa.StructArray.from_arrays([at, pa.array([h for _, hs in found for h in hs], pa.int64())], ["at", "run"])
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def without(text: str, places: list[int]) -> tuple[str, int]:
    """The text without the sentences of the runs at places, and how many those are."""
    parts, _ = sentences(text)
    gone, places = np.zeros(len(parts) + 1, np.int64), np.array(places, np.int64)
    np.add.at(gone, places >> 32, 1)
    np.add.at(gone, places & (2**32 - 1), -1)
    stays = np.cumsum(gone)[:-1] == 0
    return "".join(p for p, s in zip(parts, stays.tolist(), strict=True) if s), int((~stays).sum())


@F.arrow_udf(StructType([StructField("text", StringType()), StructField("removed", IntegerType())]))
def _without(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for batch in batches:
        for at in range(0, len(batch[0]), 256):
            texts, places = (column.slice(at, 256) for column in batch)
            out = [without(t.as_py() or "", p.as_py()) if p.is_valid else (t.as_py(), 0) for t, p in zip(texts, places, strict=True)]
            yield pa.StructArray.from_arrays([pa.array([t for t, _ in out], pa.string()), pa.array([n for _, n in out], pa.int32())], ["text", "removed"])


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, text without repeated runs, n_sentences_removed, for every row of docs."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    found = rows.select("doc_id", "key", F.explode(_runs(F.col("text"))).alias("r")).select(F.col("r.run").alias("run"), "doc_id", "key", F.col("r.at").alias("at"))
    found = materialize(found, spark)
    total = found.count()
    few = found.sample(min(1.0, SAMPLE / max(1, total)), 1).groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    hot = few.where(F.col("n") > min(total, SAMPLE) / HOT_RUNS).where("n > 100").select("run", F.lit(True).alias("hot"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "key"), F.lit(SALTS))).otherwise(-1)
    dealt = found.join(F.broadcast(hot), "run", "left").withColumn("salt", salt).drop("hot")  # at most HOT_RUNS rows
    order = [F.asc_nulls_last("doc_id"), "key", "at"]
    place = F.row_number().over(Window.partitionBy("run", "salt").orderBy(*order)).alias("place")
    placed = materialize(dealt.select("run", "salt", "doc_id", "key", "at", place).where("place > 1 OR salt >= 0"), spark)
    firsts = placed.where("place = 1").withColumn("place", F.row_number().over(Window.partitionBy("run").orderBy(*order)))
    again = placed.where("place > 1").unionByName(firsts.where("place > 1")).select("doc_id", "key", "at")
    each = again.groupBy("doc_id", "key").agg(F.collect_set("at").alias("places")).select(F.col("doc_id").alias("id_"), F.col("key").alias("key_"), "places")
    each = materialize(each, spark)
    discard(found, spark)
    discard(placed, spark)
    met = rows.join(each, rows["doc_id"].eqNullSafe(each["id_"]) & (rows["key"] == each["key_"]), "left")
    return met.withColumn("w", _without("text", "places")).select("doc_id", F.col("w.text").alias("text"), F.col("w.removed").cast("long").alias("n_sentences_removed"))

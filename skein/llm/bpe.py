"""Byte-level BPE encoding and decoding by recursive DuckDB queries, run per batch of a partition.

encode() splits each text by the tokenizer's pattern and contracts each distinct word of a batch once: a recursive
query unnests every word that still changes into token-position rows, joins neighbours with the merge table,
contracts the word's leftmost pair of least rank, and goes on until no word changes. Further occurrences of that pair
are contracted in the same step where a merge of it can't make a pair of lesser rank (they would come next anyway), so
that a word of a million equal letters takes few steps. Before that, words are cut where no token of the vocabulary can
reach over: nothing is ever merged there, and a long word falls into short pieces. A query holds QUERY_WORDS pieces and
QUERY_BYTES bytes, or one longer piece; DuckDB spills to a folder of the task. decode() joins the batch's token-position
rows with the vocabulary, aggregates their bytes in order and cuts them into texts.

Results for odd inputs: a null text is the empty text (no ids); a null array of ids decodes to no bytes; ids outside
the vocabulary and null ids decode to nothing; an existing column with the output's name is replaced, no other column is
touched; repeated rows are encoded alike; texts and words of any length are encoded whole; an empty table gives none.
"""

from __future__ import annotations

import base64
import contextlib
import re
import shutil
import sys
import tempfile
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, slices

#: Pieces, and their bytes, that one recursive query contracts, tokens that one query decodes, characters of a text that are matched at once.
QUERY_WORDS, QUERY_BYTES, QUERY_TOKENS, PART = 65_536, 1 << 20, 262_144, 1 << 20
#: Distinct words that a worker keeps before it starts afresh (its memory; results are the same).
KEPT_WORDS = 500_000

#: A code is rank * 2^33 + position * 2 + 1 if only the leftmost pair of the rank may be contracted in a step. Of pairs that overlap, every other one from the left is.
CONTRACT = """
WITH RECURSIVE state AS (
  SELECT word, tokens, false AS done FROM start_words
  UNION ALL
  SELECT s.word,
    CASE WHEN spots IS NULL THEN s.tokens
      WHEN len(spots) = 1 THEN s.tokens[:spots[1] - 1] || [least_rank] || s.tokens[spots[1] + 2:]
      ELSE list_transform(range(1, spots[1]) || flatten(list_transform(range(1, len(spots) + 1), lambda k: [0] || range(spots[k] + 2, CASE WHEN k < len(spots) THEN spots[k + 1] ELSE len(s.tokens) + 1 END))),
        lambda i: CASE WHEN i = 0 THEN least_rank ELSE s.tokens[i] END) END,
    spots IS NULL
  FROM state s LEFT JOIN (
    SELECT word, (least // 8589934592)::INT AS least_rank,
      CASE WHEN len(places) = 1 THEN places WHEN least % 2 = 1 THEN places[:1] WHEN len(list_distinct(runs)) = len(runs) THEN places
        ELSE list_filter(places, lambda p, i: (i - list_position(runs, runs[i])) % 2 = 0) END AS spots
    FROM (
      SELECT *, list_transform(places, lambda p, i: p - i) AS runs
      FROM (
        SELECT word, least, list_transform(list_sort(list_filter(codes, lambda c: c // 8589934592 = least // 8589934592)), lambda c: (c // 2) % 4294967296) AS places
        FROM (
          SELECT word, min(code) AS least, list(code) AS codes
          FROM (
            SELECT word, m.rank * 8589934592 + p.position * 2 + m.alone AS code
            FROM (SELECT word, unnest(range(1, len(tokens))) AS position, unnest(tokens[:len(tokens) - 1]) AS token, unnest(tokens[2:]) AS next_token FROM state WHERE NOT done) p
            JOIN merges m ON m.pair = p.token::BIGINT * 2097152 + p.next_token
          )
          GROUP BY word
        )
      )
    )
  ) b ON s.word = b.word
  WHERE NOT s.done
)
SELECT word, tokens FROM state WHERE done ORDER BY word
"""
JOIN_BYTES = "SELECT string_agg(hex, '' ORDER BY position) AS hex FROM tokens JOIN vocabulary USING (id)"
AFTER_TEXT = re.compile(r"(?<=\S)(?= )")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class _Numbers(dict):
    """Gives each new word the next number and holds it in fresh until its ids are known."""

    def __init__(self) -> None:
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.fresh.append(key)
        return number


def _offsets(lengths: list[int]) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[i] .. starts[i] + lengths[i] - 1, for each i in turn."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def _reach(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Which two bytes are a token, and which three lie in one: a token that reaches over a place shows there as one of these."""
    data = np.frombuffer(b"".join(ranks), np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, ranks), np.int64, len(ranks))
    ends = np.repeat(np.cumsum(lengths), lengths)
    two, three = np.zeros(1 << 16, bool), np.zeros(1 << 24, bool)
    starts = (np.cumsum(lengths) - lengths)[lengths == 2]
    two[data[starts] << 8 | data[starts + 1]] = True
    inside = np.flatnonzero(np.arange(len(data)) + 2 < ends)
    three[data[inside] << 16 | data[inside + 1] << 8 | data[inside + 2]] = True
    return two, three


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str, kept_words: int = KEPT_WORDS) -> None:
        self.ranks, self.kept_words = ranks, kept_words
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.single = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        if (self.single < 0).any():
            raise ValueError("a byte-level vocabulary holds all 256 single bytes")
        self.two, self.three = _reach(ranks)
        self.spill = tempfile.mkdtemp(prefix="bpe-")  # scratch of this task alone
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": self.spill})
        triples = [(left, right, rank) for token, rank in ranks.items() for i in range(1, len(token)) if (left := ranks.get(token[:i])) is not None and (right := ranks.get(token[i:])) is not None]
        left, right, rank = np.array(triples or np.empty((0, 3)), np.int64).T
        early = np.unique(np.concatenate([left[left > rank], right[right > rank]]))  # merged tokens that take part in a merge of lesser rank
        self.db.register("arrow_merges", pa.table({"pair": left * 2097152 + right, "rank": rank, "alone": np.isin(rank, early).astype(np.int64)}))
        self.db.execute("CREATE TABLE merges AS FROM arrow_merges")
        ids = list(ranks.values())
        self.token_bytes = np.zeros(max(ids) + 2, np.int64)  # the last stands for ids outside the vocabulary
        self.token_bytes[ids] = list(map(len, ranks))
        self.db.register("arrow_vocabulary", pa.table({"id": pa.array(ids, pa.int32()), "hex": [token.hex() for token in ranks]}))
        self.db.execute("CREATE TABLE vocabulary AS FROM arrow_vocabulary")
        self._forget_words()

    def close(self) -> None:
        """Give memory and scratch back: workers outlive their tasks."""
        self._forget_words()
        self.db.close()
        shutil.rmtree(self.spill, ignore_errors=True)
        pa.default_memory_pool().release_unused()

    def _forget_words(self) -> None:
        self.numbers = _Numbers()
        self.word_starts = np.zeros(1, np.int64)
        self.word_ids = np.zeros(0, np.int32)

    def _words(self, text: str) -> Iterator[list[str]]:
        """The matches of the pattern, of a long text in parts that no match crosses: cut before a blank after no white space."""
        begin = 0
        while len(text) - begin > PART and (cut := AFTER_TEXT.search(text, begin + PART)):
            yield self.pattern.findall(text, begin, cut.start())
            begin = cut.start()
        yield self.pattern.findall(text, begin)

    def _pieces(self, words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
        """The words cut where no token reaches over, and how many pieces lie before each word."""
        data = b"".join(words)
        b = np.frombuffer(data, np.uint8).astype(np.int64)
        ends = _offsets(list(map(len, words)))
        over = np.zeros(len(b) + 1, bool)
        over[1:-1] = self.two[b[:-1] << 8 | b[1:]]
        near = self.three[b[:-2] << 16 | b[1:-1] << 8 | b[2:]]
        over[1:-2] |= near
        over[2:-1] |= near
        over[ends] = False
        places = np.flatnonzero(~over)
        at = places.tolist()
        return [data[i:j] for i, j in zip(at, at[1:], strict=False)], np.searchsorted(places, ends)

    def _contract(self, words: list[bytes]) -> list[bytes]:
        """Token ids, four bytes each, of each word that is no token itself."""
        if not words:
            return []
        pieces, before = self._pieces(words)
        numbers = {piece: i for i, piece in enumerate(dict.fromkeys(pieces))}
        known, sizes = list(numbers), np.fromiter(map(len, numbers), np.int64, len(numbers))
        out, begin, filled = [], 0, np.cumsum(sizes)
        while begin < len(known):
            full = int(np.searchsorted(filled, filled[begin] - sizes[begin] + QUERY_BYTES, "right"))
            end = max(begin + 1, min(full, begin + QUERY_WORDS))
            some = known[begin:end]
            tokens = pa.ListArray.from_arrays(_offsets(sizes[begin:end]).astype(np.int32), self.single[np.frombuffer(b"".join(some), np.uint8)])
            self.db.register("start_words", pa.table({"word": pa.array(range(len(some)), pa.int32()), "tokens": tokens}))
            got = self.db.sql(CONTRACT).to_arrow_table()["tokens"].combine_chunks()
            self.db.unregister("start_words")
            ends, data = (got.offsets.to_numpy() * 4).tolist(), got.values.to_numpy().tobytes()
            out.extend(data[a:b] for a, b in zip(ends, ends[1:], strict=False))
            begin = end
        ids, before = [out[numbers[piece]] for piece in pieces], before.tolist()
        return [ids[a] if b - a == 1 else b"".join(ids[a:b]) for a, b in zip(before, before[1:], strict=False)]

    def _learn(self) -> None:
        """Find the ids of the words in fresh."""
        raw = [word.encode("utf-8", "surrogatepass") for word in self.numbers.fresh]
        self.numbers.fresh.clear()
        ids = [rank.to_bytes(4, sys.byteorder) if (rank := self.ranks.get(word)) is not None else b"" for word in raw]
        several = [i for i, found in enumerate(ids) if not found]
        for i, found in zip(several, self._contract([raw[i] for i in several]), strict=True):
            ids[i] = found
        ends = _offsets(list(map(len, ids))) // 4
        self.word_starts = np.concatenate([self.word_starts, self.word_starts[-1] + ends[1:]])
        self.word_ids = np.concatenate([self.word_ids, np.frombuffer(b"".join(ids), np.int32)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of the texts' tokens, one after another."""
        if len(self.numbers) > self.kept_words:
            self._forget_words()
        number, parts, counts = self.numbers.__getitem__, [], []
        for text in texts:
            own = [np.fromiter(map(number, words), np.int32, len(words)) for words in self._words(text)]
            parts += own
            counts.append(sum(map(len, own)))
        if self.numbers.fresh:
            self._learn()
        numbers = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        starts = self.word_starts[numbers]
        lengths = self.word_starts[numbers + 1] - starts
        flat = self.word_ids[_ragged(starts, lengths)]
        return np.concatenate([[0], np.cumsum(lengths)])[_offsets(counts)], flat

    def decode(self, offsets: np.ndarray, flat: np.ndarray) -> list[bytes]:
        """The bytes of each list of ids."""
        outside = len(self.token_bytes) - 1
        flat = np.where((flat >= 0) & (flat < outside), flat, outside).astype(np.int32)
        parts = []
        for at in range(0, len(flat), QUERY_TOKENS):
            some = flat[at : at + QUERY_TOKENS]
            self.db.register("tokens", pa.table({"position": np.arange(len(some), dtype=np.int32), "id": some}))
            parts.append(bytes.fromhex(self.db.sql(JOIN_BYTES).fetchall()[0][0] or ""))
            self.db.unregister("tokens")
        data = b"".join(parts)
        ends = np.concatenate([[0], np.cumsum(self.token_bytes[flat])])[offsets].tolist()
        return [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _lists(offsets: np.ndarray, flat: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32)))


def encode(df: DataFrame, vocabulary_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """df with the token ids of text_col as array<int>. The vocabulary, a file of fixed size, is broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(vocabulary_path))

    @F.arrow_udf("array<int>")
    def token_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with contextlib.closing(Codec(shared.value, pattern)) as codec:
            for batch in batches:
                for texts in slices(batch):
                    yield _lists(*codec.encode(texts))

    return df.withColumn(ids_col, token_ids(F.col(text_col)))


def decode(df: DataFrame, vocabulary_path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """df with the bytes that ids_col stands for."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(vocabulary_path))

    @F.arrow_udf("binary")
    def token_bytes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with contextlib.closing(Codec(shared.value, pattern)) as codec:
            for batch in batches:
                for at in range(0, len(batch), 512):
                    part = batch.slice(at, 512)
                    flat = part.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                    yield pa.array(codec.decode(_offsets([len(v) if v.is_valid else 0 for v in part]), flat), pa.binary())

    return df.withColumn(bytes_col, token_bytes(F.col(ids_col)))


def encode_and_decode(df: DataFrame, vocabulary_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", bytes_col: str = "decoded", kept_words: int = KEPT_WORDS) -> DataFrame:
    """df with the token ids of text_col, and the bytes that those ids decode to, made by one worker."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(vocabulary_path))

    @F.arrow_udf("struct<ids: array<int>, bytes: binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        with contextlib.closing(Codec(shared.value, pattern, kept_words)) as codec:
            for batch in batches:
                for texts in slices(batch):
                    offsets, flat = codec.encode(texts)
                    yield pa.StructArray.from_arrays([_lists(offsets, flat), pa.array(codec.decode(offsets, flat), pa.binary())], ["ids", "bytes"])

    made = free_name(df, "both")
    return df.withColumn(made, both(F.col(text_col))).withColumns({ids_col: F.col(f"{made}.ids"), bytes_col: F.col(f"{made}.bytes")}).drop(made)


def digests(docs: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, digest of the ids, digest of the bytes that the ids decode to."""
    both = encode_and_decode(docs.select("doc_id", "text"), vocabulary_path, pattern)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )

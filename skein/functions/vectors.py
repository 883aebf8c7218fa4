"""Tf-idf vectors of texts in Arrow tables, made of those of their words: n-grams don't cross words, so a text's vector is the sum of its words'.

Tables have rows of two kinds. is_word: key is a word, parts are its n-grams, weights their tf-idf. Else key names a
text, parts are its distinct words, weights their numbers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries of a matrix that is held at once; texts of a product; frequent n-grams of a dense product.
MOST_ENTRIES, AT_ONCE, COLUMNS = 1 << 23, 128, 256


@dataclass
class Rows:
    """Sparse rows: entries of row r are at[r] to at[r + 1]."""

    at: np.ndarray
    ids: np.ndarray
    values: np.ndarray

    def take(self, rows: np.ndarray) -> Rows:
        sizes = (self.at[1:] - self.at[:-1])[rows]
        at = np.concatenate([[0], np.cumsum(sizes)])
        places = np.repeat(self.at[:-1][rows] - at[:-1], sizes) + np.arange(at[-1])
        return Rows(at, self.ids[places], self.values[places])

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), self.at[1:] - self.at[:-1])


def _rows(table: pa.Table, ids: np.ndarray) -> Rows:
    sizes = pc.list_value_length(table["parts"]).to_numpy()
    return Rows(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), ids, pc.list_flatten(table["weights"]).to_numpy())


def words_of(tables: list[pa.Table]) -> tuple[list[pa.Table], list[Rows], int]:
    """The word rows of each table, as tables and as sparse rows of n-grams numbered in common; their number."""
    words = [t.filter(t["is_word"]) for t in tables]
    grams = [pc.list_flatten(t["parts"]) for t in words]
    coded = pa.chunked_array([c for g in grams for c in g.chunks], pa.string()).combine_chunks().dictionary_encode()
    ids, cuts = coded.indices.to_numpy(), np.cumsum([len(g) for g in grams])[:-1]
    return words, [_rows(t, i) for t, i in zip(words, np.split(ids, cuts), strict=True)], len(coded.dictionary)


def texts_of(table: pa.Table, words: pa.Table) -> tuple[pa.Table, Rows]:
    """The text rows, and them as sparse rows of words (by their place in words)."""
    texts = table.filter(pc.invert(table["is_word"]))
    ids = pc.index_in(pc.list_flatten(texts["parts"]), value_set=words["key"].combine_chunks())
    return texts, _rows(texts, ids.to_numpy().astype(np.int64))


def grams_of(texts: Rows, words: Rows, n: int) -> Rows:
    """Texts as sparse rows of n-grams of length 1, each n-gram once, in order."""
    parts = words.take(texts.ids)
    keys = np.repeat(texts.owners(), parts.at[1:] - parts.at[:-1]) * n + parts.ids
    values = parts.values * np.repeat(texts.values, parts.at[1:] - parts.at[:-1])
    keys, back = np.unique(keys, return_inverse=True)
    sums, owner = np.bincount(back, values, len(keys)), keys // n
    rows = len(texts.at) - 1
    norm = np.sqrt(np.bincount(owner, sums * sums, rows))
    return Rows(np.searchsorted(owner, np.arange(rows + 1)), keys % n, sums / norm[owner])


def norms(texts: Rows, words: Rows, n: int) -> np.ndarray:
    parts = words.take(texts.ids)
    sizes = parts.at[1:] - parts.at[:-1]
    keys, back = np.unique(np.repeat(texts.owners(), sizes) * n + parts.ids, return_inverse=True)
    sums = np.bincount(back, parts.values * np.repeat(texts.values, sizes), len(keys))
    return np.sqrt(np.bincount(keys // n, sums * sums, len(texts.at) - 1))


def products(a: Rows, b: Rows, n: int, frequent: int) -> np.ndarray:
    """All products of the rows of a and b. n-grams of over `frequent` rows of b are multiplied as dense columns, the others entry by entry."""
    height, width = len(a.at) - 1, len(b.at) - 1
    df, owner_a, owner_b = np.bincount(b.ids, minlength=n), a.owners(), b.owners()
    order = np.argsort(b.ids, kind="stable")
    by_gram = Rows(np.concatenate([[0], np.cumsum(df)]), owner_b[order], b.values[order])
    rare = df[a.ids] <= frequent
    out = np.zeros((height, width))
    mine, ids, values = owner_a[rare], a.ids[rare], a.values[rare]
    ends = np.cumsum(df[ids])
    for x, y in ((x, y) for x, y in _slices(ends, MOST_ENTRIES // 4)):
        met = by_gram.take(ids[x:y])
        sizes = met.at[1:] - met.at[:-1]
        np.add.at(out.reshape(-1), np.repeat(mine[x:y], sizes) * width + met.ids, np.repeat(values[x:y], sizes) * met.values)
    wide = np.flatnonzero(df > frequent)
    for at in range(0, len(wide), COLUMNS):
        place = np.full(n, -1)
        place[wide[at : at + COLUMNS]] = np.arange(len(wide[at : at + COLUMNS]))
        dense = []
        for rows, owner in ((a, owner_a), (b, owner_b)):
            mine = place[rows.ids] >= 0
            dense.append(np.zeros((len(rows.at) - 1, COLUMNS)))
            dense[-1][owner[mine], place[rows.ids[mine]]] = rows.values[mine]
        out += dense[0] @ dense[1].T
    return out


def _slices(ends: np.ndarray, most: int):
    """Cuts of a running total into parts of about `most`."""
    x = 0
    while x < len(ends):
        y = max(x + 1, int(np.searchsorted(ends, (ends[x - 1] if x else 0) + most, "right")))
        yield x, y
        x = y


def _summed(texts: Rows, by_word: np.ndarray) -> np.ndarray:
    """For each text the sum of its words' rows times their numbers."""
    sizes = texts.at[1:] - texts.at[:-1]
    order = np.argsort(-sizes, kind="stable")
    starts, sizes, out = texts.at[:-1][order], sizes[order], np.zeros((len(order), by_word.shape[1]))
    for i in range(int(sizes[0]) if len(sizes) else 0):
        more = int(np.searchsorted(-sizes, -i, "left"))  # texts of over i words
        at = starts[:more] + i
        times, met = texts.values[at], by_word[texts.ids[at]]
        out[:more] += met if (times == 1).all() else met * times[:, None]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return out[back]


def nearest(k: int, least: float, frequent: int):
    """A function of two tables that gives (s1_key, cand_key, sim, place) of the k best candidates of each text of the left one.

    place is sim in millionths, rounded; equal places go by cand_key."""
    empty = pa.table({"s1_key": pa.array([], pa.string()), "cand_key": pa.array([], pa.string()), "sim": pa.array([], pa.float64()), "place": pa.array([], pa.int64())})

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (words_a, words_b), (a, b), n = words_of([left, right])
        (s1, x), (cand, y) = texts_of(left, words_a), texts_of(right, words_b)
        if not len(s1) or not len(cand):
            return empty
        down, across = 1 / norms(x, a, n), 1 / norms(y, b, n)
        s1_keys, cand_keys = s1["key"].combine_chunks(), cand["key"].combine_chunks()
        rank = np.empty(len(cand), np.int64)
        rank[pc.sort_indices(cand_keys.cast(pa.binary())).to_numpy()] = np.arange(len(cand))
        found = []

        def block(rows: np.ndarray, columns: np.ndarray) -> None:
            """Halves what would need too large a matrix of words."""
            mine, theirs = x.take(rows), y.take(columns)
            used, mine.ids = np.unique(mine.ids, return_inverse=True)
            other, theirs.ids = np.unique(theirs.ids, return_inverse=True)
            if len(used) * len(other) > MOST_ENTRIES and max(len(rows), len(columns)) > 1:
                wide = len(columns) > 1 and (len(other) > len(used) or len(rows) == 1)
                for half in np.array_split(columns if wide else rows, 2):
                    block(*((rows, half) if wide else (half, columns)))
                return
            dots = products(a.take(used), b.take(other), n, frequent)
            for at in range(0, len(rows), AT_ONCE):
                part = np.arange(at, min(at + AT_ONCE, len(rows)))
                by_word = np.ascontiguousarray((_summed(mine.take(part), dots) * down[rows[part], None]).T)
                sims = np.ascontiguousarray((_summed(theirs, by_word) * across[columns, None]).T)
                limit = np.full((len(sims), 1), least)
                if sims.shape[1] > k:
                    limit = np.maximum(limit, np.partition(sims, -k, axis=1)[:, -k, None] - 2e-6)
                r, c = np.nonzero(sims >= limit)
                sim = sims[r, c]
                place = np.floor(sim * 1e6 + 0.5).astype(np.int64)
                order = np.lexsort((rank[columns[c]], -place, r))
                r, c, sim, place = r[order], c[order], sim[order], place[order]
                keep = np.arange(len(r)) - np.searchsorted(r, r) < k
                found.append((rows[part[r[keep]]], columns[c[keep]], sim[keep], place[keep]))

        block(np.argsort(s1_keys.to_numpy(False)), np.arange(len(cand)))
        row, column, sim, place = (np.concatenate(c) for c in zip(*found, strict=True))
        return pa.table({"s1_key": s1_keys.take(pa.array(row)), "cand_key": cand_keys.take(pa.array(column)), "sim": sim, "place": place})

    return run


def cosines(name: str):
    """A function of two tables that gives (s1_id, cand_id, name) for the pairs among the rows of the left one: is_word is null, key the s1_id, parts cand_id and the keys of both texts."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        (words_a, words_b), (a, b), n = words_of([left, right])
        (s1, x), (cand, y) = texts_of(left, words_a), texts_of(right, words_b)
        pairs = left.filter(pc.is_null(left["is_word"]))
        parts = pc.list_flatten(pairs["parts"]).combine_chunks()
        i, j = (pc.index_in(parts[at::3], value_set=t["key"].combine_chunks()).to_numpy().astype(np.int64) for at, t in ((1, s1), (2, cand)))
        distinct, back = np.unique(i * max(1, len(cand)) + j, return_inverse=True)
        own, other, sims = grams_of(x, a, n), grams_of(y, b, n), np.zeros(len(distinct))
        for at in range(0, len(distinct), 1 << 14):
            some = distinct[at : at + (1 << 14)]
            mine, theirs = own.take(some // len(cand)), other.take(some % len(cand))
            owner = theirs.owners()
            keys, met = mine.owners() * n + mine.ids, owner * n + theirs.ids
            place = np.minimum(np.searchsorted(keys, met), len(keys) - 1)
            same = keys[place] == met
            sims[at : at + len(some)] = np.bincount(owner[same], mine.values[place[same]] * theirs.values[same], len(some))
        return pa.table({"s1_id": pairs["key"], "cand_id": parts[0::3], name: sims[back]})

    return run

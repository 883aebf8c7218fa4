"""Token ratios of two texts, 0 to 100, from the longest common subsequence; in Arrow batches."""

from __future__ import annotations

import functools
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_OTHER = re.compile(r"[\W_]")


def processed(text: str | None) -> str:
    return _OTHER.sub(" ", (text or "").lower()).strip()


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits of a column at once."""
    if a == b:
        return len(a)
    if not a or not b:
        return 0
    end = 0
    for x, y in zip(a, b):
        if x != y:
            break
        end += 1
    if end:  # a common beginning is part of a longest one
        return end + _rest(a[end:], b[end:])
    return _rest(a, b)


def _rest(a: str, b: str) -> int:
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    state = full = (1 << len(a)) - 1
    for c in b:
        hit = state & places.get(c, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def ratio(a: str, b: str) -> float:
    return 200.0 * _common(a, b) / (len(a) + len(b)) if a or b else 100.0


@functools.lru_cache(1 << 17)
def _words(text: str | None) -> tuple[str, list[str], frozenset[str], int]:
    """The words in order: all as one text; distinct, as a list and a set; the length of these as one text."""
    words = sorted(processed(text).split())
    own = list(dict.fromkeys(words))
    return " ".join(words), own, frozenset(own), sum(map(len, own)) + len(own) - 1


def token_sort(a: str | None, b: str | None) -> float:
    return ratio(_words(a)[0], _words(b)[0])


def _rests(a: str | None, b: str | None) -> float | tuple[str, str, int]:
    """The ratio of the sets of words, or what has to be compared for it: the words of one side only, and the length of the shared ones, which both texts begin with."""
    (_, x, in_x, length), (_, y, in_y, _) = _words(a), _words(b)
    if not x or not y:
        return 0.0
    only_x, only_y = " ".join([w for w in x if w not in in_y]), " ".join([w for w in y if w not in in_x])
    if not only_x or not only_y:
        return 100.0
    return only_x, only_y, length - len(only_x) - 1


def _of_rests(x: str, y: str, shared: int, common: int) -> float:
    with_x, with_y = shared + 1 + len(x), shared + 1 + len(y)
    out = 200.0 * (shared + 1 + common) / (with_x + with_y)
    return max(out, 200.0 * shared / (shared + min(with_x, with_y))) if shared > 0 else out


def token_set(a: str | None, b: str | None) -> float:
    found = _rests(a, b)
    return found if isinstance(found, float) else _of_rests(*found, _common(*found[:2]))


def _commons(pairs: list[tuple[str, str]]) -> list[int]:
    """_common of each pair; those of at most 64 letters at once, a letter of each at a time."""
    short = [i for i, (x, y) in enumerate(pairs) if len(x) <= 64 and len(y) <= 64]
    out = [0] * len(pairs)
    for i in set(range(len(pairs))).difference(short):
        out[i] = _common(*pairs[i])
    if short:
        a, b = (np.array([pairs[i][side] for i in short]) for side in (0, 1))
        a, b = (np.ascontiguousarray(c.view(np.uint32).reshape(len(short), -1).T) for c in (a, b))  # 0 behind a text's end
        state = np.full(len(short), ~np.uint64(0))
        for letter in b:
            hit = np.zeros(len(short), np.uint64)
            for i, own in enumerate(a):
                hit |= (own == letter).astype(np.uint64) << np.uint64(i)
            hit &= np.where(letter > 0, state, 0)
            state = (state + hit) | (state - hit)
        for i, n in zip(short, np.bitwise_count(~state).tolist(), strict=True):
            out[i] = n
    return out


def _distinct(a: pd.Series, b: pd.Series) -> tuple[dict[tuple, int], list[int]]:
    """The pairs of a batch, numbered, and the number of each row's."""
    numbers: dict[tuple, int] = {}
    return numbers, [numbers.setdefault(pair, len(numbers)) for pair in zip(a, b, strict=True)]


@F.pandas_udf(DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    pairs, rows = _distinct(a, b)
    found = [_rests(*pair) for pair in pairs]
    open_ = [i for i, x in enumerate(found) if not isinstance(x, float)]
    for i, common in zip(open_, _commons([found[i][:2] for i in open_]), strict=True):
        found[i] = _of_rests(*found[i], common)
    return pd.Series(np.array(found, float)[rows])


@F.pandas_udf(DoubleType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    pairs, rows = _distinct(a, b)
    return pd.Series(np.array([token_sort(*pair) for pair in pairs], float)[rows])

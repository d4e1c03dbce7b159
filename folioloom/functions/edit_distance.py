"""Edit distance by code points, exact, in bit-parallel steps.

A column of the table of prefixes' distances is kept as two bit vectors, where it rises and where it falls downwards; a
step of the longer text takes a few operations on them (Myers 1999, with Hyyro's carry between words). Pairs of which the
shorter text has up to WORDS words of 64 code points go through their steps side by side, in arrays; vectors of longer
ones are Python integers, one pair at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

WORDS = 16
#: Code points of texts that are taken at a time.
AT_ONCE = 2_000_000
ONE, TOP, FULL = np.uint64(1), np.uint64(63), np.uint64(0xFFFFFFFFFFFFFFFF)


def distance_of_long(short: str, long: str) -> int:
    """Of one pair, by integers as long as the shorter text."""
    start = 0
    while start < len(short) and short[start] == long[start]:
        start += 1
    end = 0
    while end < len(short) - start and short[-1 - end] == long[-1 - end]:
        end += 1
    short, long = short[start : len(short) - end], long[start : len(long) - end]
    if not short:
        return len(long)
    places: dict[str, int] = {}
    for k, c in enumerate(short):
        places[c] = places.get(c, 0) | 1 << k
    full, last = (1 << len(short)) - 1, 1 << len(short) - 1
    rises, falls, out = full, 0, len(short)
    for c in long:
        same = places.get(c, 0)
        vertical = same | falls
        across = (((same & rises) + rises) ^ rises) | same
        right, left = falls | ~(across | rises), rises & across
        out += bool(right & last) - bool(left & last)
        right, left = (right << 1 | 1) & full, left << 1 & full
        rises, falls = (left | ~(vertical | right)) & full, right & vertical
    return out


def _points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points, their starts and end)."""
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64), np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)


def _side_by_side(short: list[str], long: list[str]) -> np.ndarray:
    """Of pairs, those with the longer long text first; no text is empty."""
    n = len(short)
    p, p_at = _points(short)
    t, t_at = _points(long)
    m, sizes = np.diff(p_at), np.diff(t_at)
    words = -(-int(m.max()) // 64)
    pair = np.repeat(np.arange(n), m)
    place = np.arange(len(p)) - p_at[pair]
    keys, row = np.unique(pair << 21 | p, return_inverse=True)
    masks = np.zeros((words, len(keys) + 1), np.uint64)  # where each of a pair's letters stands; the last has none
    np.bitwise_or.at(masks, (place >> 6, row), ONE << (place & 63).astype(np.uint64))
    asked = np.repeat(np.arange(n), sizes) << 21 | t
    found = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    found[keys[found] != asked] = len(keys)

    # At step s a pair's word w is at column s - w of its table, so all words of all pairs move at once.
    rises, falls = np.full((words, n), FULL), np.zeros((words, n), np.uint64)
    up, down = np.ones((words + 1, n), np.uint64), np.zeros((words + 1, n), np.uint64)  # into each word, from the one before
    letter = np.full((words, n), len(keys))
    offset = (np.arange(words) * masks.shape[1])[:, None]
    last, bit, out, each = (m - 1) >> 6, ((m - 1) & 63).astype(np.uint64), m.copy(), np.arange(n)
    steps = int(sizes[0]) + words - 1
    active = np.searchsorted(-sizes, words - 1 - np.arange(steps), "left")  # pairs of which some word has columns left
    for s in range(steps):
        k, h = int(active[s]), min(words, s + 1)
        letter[1:h, :k] = letter[: h - 1, :k].copy()
        letter[0, :k] = np.where(s < sizes[:k], found[np.minimum(t_at[:k] + s, len(found) - 1)], len(keys))
        same, r, f = masks.ravel()[letter[:h, :k] + offset[:h]], rises[:h, :k], falls[:h, :k]
        above, below = up[:h, :k].copy(), down[:h, :k].copy()
        vertical = same | f
        same |= below
        across = (((same & r) + r) ^ r) | same
        right, left = f | ~(across | r), r & across
        here = np.flatnonzero((last[:k] <= s) & (s - last[:k] < sizes[:k]))
        w, b = last[here], bit[here]
        out[here] += (right[w, each[here]] >> b & ONE).astype(np.int64) - (left[w, each[here]] >> b & ONE).astype(np.int64)
        up[1 : h + 1, :k], down[1 : h + 1, :k] = right >> TOP, left >> TOP
        right, left = right << ONE | above, left << ONE | below
        rises[:h, :k], falls[:h, :k] = left | ~(vertical | right), right & vertical
    return out


def distances(left: Sequence[str], right: Sequence[str]) -> np.ndarray:
    """The edit distances of pairs."""
    out = np.zeros(len(left), np.int64)
    groups: dict[int, list[tuple[int, int, str, str]]] = {}
    for k, (a, b) in enumerate(zip(left, right, strict=True)):
        short, long = (a, b) if len(a) <= len(b) else (b, a)
        if not short or short == long:
            out[k] = len(long) if short != long else 0
        elif len(short) > 64 * WORDS:
            out[k] = distance_of_long(short, long)
        else:
            groups.setdefault((len(short) - 1 >> 6).bit_length(), []).append((-len(long), k, short, long))
    for pairs in groups.values():
        pairs.sort()
        start = 0
        while start < len(pairs):
            stop, total = start, 0
            while stop < len(pairs) and total < AT_ONCE:
                total += len(pairs[stop][2]) + len(pairs[stop][3])
                stop += 1
            _, places, short, long = zip(*pairs[start:stop], strict=True)
            out[list(places)] = _side_by_side(list(short), list(long))
            start = stop
    return out


@F.pandas_udf(IntegerType())
def _distance(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(distances(left.tolist(), right.tolist()), dtype="int32")


def edit_distance(left: Column, right: Column) -> Column:
    """The edit distance of two texts by code points; a null text counts as empty."""
    return _distance(F.coalesce(left, F.lit("")), F.coalesce(right, F.lit("")))

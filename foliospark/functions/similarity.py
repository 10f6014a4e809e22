"""Fuzzy similarity as Arrow UDFs (no built-in has Ratcliff-Obershelp matching)."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .text import BASES, LETTERS, MARKS, norm


_FOLD = str.maketrans(dict(zip(LETTERS, BASES)) | dict.fromkeys(MARKS))
_OTHER = re.compile("[^\x00-\x7f]+")


def unaccented(s: str) -> str:
    """``text.fold`` of one string, for code that runs in Python."""
    return _OTHER.sub(lambda m: m[0].translate(_FOLD), s.lower())


def plain(s: str) -> str:
    """``text.norm`` of one string, for code that runs in Python."""
    return re.sub("[^a-z0-9]", "", unaccented(s))


_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")  # Python's \s has four more


def tokens(s: str) -> list[str]:
    """``text.tokens`` of one string, for code that runs in Python."""
    return [w for w in _SPACE.split(s) if w]


PAIRS = 1 << 22
AT_ONCE = 1 << 18


def _diagonals(x: np.ndarray, y: np.ndarray, drop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(j - i, i, size) of all longest runs of equal codes other than ``drop`` in x from i and in y from j; None if they have over PAIRS pairs."""
    order = np.argsort(y, kind="stable")
    low, high = np.searchsorted(y[order], x), np.searchsorted(y[order], x, "right")
    count = high - low
    # Another code stands at all ends, in x and y not the same.
    a, b = np.full(len(x) + 2, -1, np.int64), np.full(len(y) + 2, -2, np.int64)
    a[1:-1], b[1:-1] = x, y
    if len(drop):
        count[np.isin(x, drop)] = 0
        a[np.isin(a, drop)] = -1
    ends = np.cumsum(count)
    if len(x) and ends[-1] > PAIRS:
        return None
    width, first, last, at = len(x) + 1, [], [], 0
    while at < len(x):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] - count[at] + AT_ONCE, "right")))
        c = count[at:to]
        i = np.repeat(np.arange(at, to), c)
        j = order[np.arange(len(i)) - np.repeat(np.cumsum(c) - c - low[at:to], c)]
        place = (j - i + len(x)) * width + i
        first.append(place[a[i] != b[j]])
        last.append(place[a[i + 2] != b[j + 2]])
        at = to
    first, last = (np.sort(np.concatenate([np.empty(0, np.int64), *v])) for v in (first, last))
    n = (last - first + 1).astype(np.int32)
    del last
    d = (first // width - len(x)).astype(np.int32)
    return d, (first % width).astype(np.int32), n


def blocks(x: np.ndarray, y: np.ndarray, autojunk: bool = False) -> list[tuple[int, int, int]]:
    """Matching blocks (i, j, size) of two arrays of codes (0 or more): those of ``difflib.SequenceMatcher(None, x, y, autojunk)`` in order, adjacent ones not joined.

    difflib walks over all pairs of equal elements for every block; here all runs are found once, and a block is the
    longest run (the first in x, then in y) within its rectangle. Elements that autojunk takes for popular start no block.
    """
    drop = np.empty(0, np.int64)
    if autojunk and len(y) >= 200:
        kinds, n = np.unique(y, return_counts=True)
        drop = kinds[n > len(y) // 100 + 1]
    runs = _diagonals(x, y, drop)
    if runs is None:
        return [tuple(b) for b in SequenceMatcher(None, x.tolist(), y.tolist(), autojunk).get_matching_blocks()[:-1]]
    found, todo = [], [(0, len(x), 0, len(y), *runs)]
    while todo:
        x0, x1, y0, y1, d, i, n = todo.pop()
        left = np.maximum(np.maximum(i, x0), y0 - d)
        size = np.minimum(np.minimum(i + n, x1), y1 - d) - left
        some = size > 0
        if not some.all():
            d, i, n, left, size = d[some], i[some], n[some], left[some], size[some]
        if len(d):
            best = np.flatnonzero(size == size.max())
            if len(best) > 1:
                best = best[left[best] == left[best].min()]  # of these the first has the least diagonal, so the least j
            at, to, k = int(left[best[0]]), int(left[best[0]] + d[best[0]]), int(size[best[0]])
        else:
            at, to, k = x0, y0, 0
        if len(drop):
            back = min(at - x0, to - y0)
            odd = np.flatnonzero(x[at - back : at] != y[to - back : to])
            back = back - int(odd[-1]) - 1 if len(odd) else back
            more = min(x1 - at - k, y1 - to - k)
            odd = np.flatnonzero(x[at + k : at + k + more] != y[to + k : to + k + more])
            more = int(odd[0]) if len(odd) else more
            at, to, k = at - back, to - back, k + back + more
        if k:
            found.append((at, to, k))
            if at > x0 and to > y0:
                todo.append((x0, at, y0, to, d, i, n))
            if at + k < x1 and to + k < y1:
                todo.append((at + k, x1, to + k, y1, d, i, n))
    return sorted(found)


def ratio(x: str, y: str) -> float:
    """``SequenceMatcher(None, x, y).ratio()``."""
    if x == y:
        return 1.0
    a, b = (np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) for s in (x, y))
    return 2.0 * sum(k for _, _, k in blocks(a, b, True)) / (len(a) + len(b))


def ratio_of(a: str, b: str) -> float:
    return ratio(plain(a), plain(b))


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else ratio(x, y) for x, y in zip(a, b)], dtype="float64")


def similar(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp ratio of the normal forms of two strings; null with null."""
    return _ratio(norm(a), norm(b))


def coverage_of(needle: str, hay: str, least: int = 3, lead: int = 5, spare: int = 10, good: float = 0.999) -> float:
    """Best share of the needle's characters that a window of the hay holds in order; 1.0 for an empty or contained needle.

    Every matching block of ``least`` characters places a window: it begins ``lead`` characters before the place that
    the block gives to the needle's start, and has the needle's length and ``spare`` more. A ``good`` share ends the search.
    """
    if not needle or needle in hay:
        return 1.0
    matched = lambda text: SequenceMatcher(None, needle, text, autojunk=False).get_matching_blocks()
    places = dict.fromkeys(max(0, x.b - x.a - lead) for x in matched(hay) if x.size >= least)
    best = 0.0
    for at in places:
        if best < good:
            best = max(best, sum(x.size for x in matched(hay[at : at + len(needle) + spare])) / len(needle))
    return best


@F.pandas_udf(DoubleType())
def _coverage(needle: pd.Series, hay: pd.Series) -> pd.Series:
    return pd.Series([coverage_of(n or "", h or "") for n, h in zip(needle, hay)], dtype="float64")


def coverage(needle: Column, hay: Column) -> Column:
    """1.0 for an empty or contained needle; only others are matched block by block (they alone reach Python's slow path)."""
    return _coverage(needle, hay)

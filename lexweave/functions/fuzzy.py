"""String similarity on a scale of 0 to 100, as pandas functions over pairs of columns."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit a character."""
    if len(a) < len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for i, c in enumerate(b):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full
    for c in a:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(b) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the common subsequence over both lengths; 100 for two empty strings."""
    return 100.0 if not a and not b else 200.0 * lcs(a, b) / (len(a) + len(b))


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter string with a stretch of the longer one of at most its length."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    n = len(short)
    return max(ratio(short, long[max(i, 0) : min(i + n, len(long))]) for i in range(1 - n, len(long)))


def token_sort_ratio(a: str, b: str, score=ratio) -> float:
    return score(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str, score=ratio) -> float:
    """The best ratio among the shared words and the shared words with either side's others."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not left or not right):
        return 100.0
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    return max([score(one, two)] + ([score(both, one), score(both, two)] if both else []))


def weighted_ratio(a: str, b: str) -> float:
    """The best of the plain, token and, for unequal lengths, partial ratios, each with its weight."""
    if not a or not b:
        return 0.0
    size = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if size < 1.5:
        return max(best, 0.95 * token_sort_ratio(a, b), 0.95 * token_set_ratio(a, b))
    scale = 0.9 if size <= 8 else 0.6
    return max(best, scale * partial_ratio(a, b), scale * 0.95 * token_sort_ratio(a, b, partial_ratio), scale * 0.95 * token_set_ratio(a, b, partial_ratio))


def _pairwise(score):
    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else round(score(x, y), 6) for x, y in zip(a, b, strict=True)], dtype="float64")

    return run


similarity = _pairwise(ratio)
weighted_similarity = _pairwise(weighted_ratio)

"""The few scalars that Spark has no expression for, as Arrow UDFs."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode NFKC; null stays null."""
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))


@F.pandas_udf(StringType())
def ascii_only(s: pd.Series) -> pd.Series:
    """NFKD without what isn't ASCII; null stays null."""
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())


def jaro_winkler_pair(a: str, b: str) -> float:
    """Jaro similarity over code points, raised by 0.1 for each of up to four equal leading ones if it is above 0.7."""
    if a == b:
        return 1.0
    la, lb = len(a), len(b)
    if not la or not lb:
        return 0.0
    window = max(la, lb) // 2 - 1
    window = max(window, 0)
    used = [False] * lb
    matched = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - window), min(lb, i + window + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                matched.append(ch)
                break
    m = len(matched)
    if not m:
        return 0.0
    other = [b[j] for j in range(lb) if used[j]]
    swaps = sum(x != y for x, y in zip(matched, other)) // 2
    sim = (m / la + m / lb + (m - swaps) / m) / 3
    if sim > 0.7:
        prefix = 0
        for x, y in zip(a[:4], b[:4]):
            if x != y:
                break
            prefix += 1
        sim += 0.1 * prefix * (1 - sim)
    return sim


#: Longest texts that are compared side by side; longer ones one pair at a time.
SIDE_BY_SIDE = (16, 32, 64, 128)


def _codes(texts: list[str], width: int, fill: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, one row each, filled up to the width; and their lengths."""
    sizes = np.array([len(t) for t in texts])
    out = np.full((len(texts), width), fill, np.uint32)
    out[np.arange(width) < sizes[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return out, sizes


def jaro_winkler_pairs(a: list[str], b: list[str], width: int) -> np.ndarray:
    """jaro_winkler_pair of many pairs at once, none longer than width or empty: one numpy step for each position."""
    (x, la), (y, lb) = _codes(a, width, 0xFFFFFFFE), _codes(b, width, 0xFFFFFFFF)
    rows, at = np.arange(len(a)), np.arange(width)
    window = np.maximum(np.maximum(la, lb) // 2 - 1, 0)[:, None]
    left, used = np.zeros(x.shape, bool), np.zeros(y.shape, bool)
    for i in range(int(la.max())):
        free = (y == x[:, i : i + 1]) & ~used & (np.abs(at - i) <= window)
        j = free.argmax(axis=1)
        hit = free[rows, j]
        left[:, i] = hit
        used[rows[hit], j[hit]] = True
    m = left.sum(axis=1)
    in_order = lambda z, mask: np.take_along_axis(z, np.argsort(~mask, axis=1, kind="stable"), axis=1)
    swaps = ((in_order(x, left) != in_order(y, used)) & (at < m[:, None])).sum(axis=1) // 2
    some = np.maximum(m, 1)
    sim = np.where(m > 0, (m / la + m / lb + (m - swaps) / some) / 3, 0.0)
    prefix = np.cumprod(x[:, :4] == y[:, :4], axis=1).sum(axis=1)
    return np.where(sim > 0.7, sim + 0.1 * prefix * (1 - sim), sim)


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of each pair, null if a side is; each distinct pair of a batch is compared once."""
    slots: dict[tuple[str, str], int] = {}
    where = [slots.setdefault((x, y), len(slots)) if x is not None and y is not None else -1 for x, y in zip(a, b)]
    pairs = list(slots)
    out = np.empty(len(pairs) + 1)
    out[-1] = np.nan
    widths = np.array([max(len(x), len(y)) if x and y and x != y else 0 for x, y in pairs] or [0])
    least = 0
    for width in SIDE_BY_SIDE:
        chosen = np.flatnonzero((widths > least) & (widths <= width))
        if len(chosen):
            out[chosen] = jaro_winkler_pairs([pairs[i][0] for i in chosen], [pairs[i][1] for i in chosen], width)
        least = width
    for i in np.flatnonzero((widths == 0) | (widths > least))[: len(pairs)]:
        out[i] = jaro_winkler_pair(*pairs[i])
    return pd.Series(out[where], dtype="float64").astype(object).where(np.array(where) >= 0, None) if -1 in where else pd.Series(out[where])

"""Weighted min-hash signatures by throwing darts.

Each element of a weighted set owns a Poisson process of darts over the plane
weight x rank, the same for every set it is in. A dart hits if its weight
coordinate lies below the element's weight in the set; it carries one of ``k``
coordinates, and of all hits of a coordinate the one of lowest rank is kept. Two
sets agree in a coordinate with the probability of their weighted Jaccard
similarity. Ranks are thrown in growing regions until every coordinate is hit, so a
set costs about k log k darts, however many elements it has.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

_FIRST_RANK = 0.25
_RANK_GROWTH = 1.4


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=512)
def _poisson_cdf(mean: float) -> np.ndarray:
    top = int(mean + 12 * math.sqrt(mean) + 16)
    k = np.arange(top + 1)
    logs = -mean + k * math.log(mean) - np.array([math.lgamma(i + 1) for i in k])
    return np.minimum(np.add.accumulate(np.exp(logs)), 1.0)[:-1]


def _rank_cell(j: int) -> tuple[float, float]:
    high = _FIRST_RANK * _RANK_GROWTH**j
    return (0.0 if j == 0 else high / _RANK_GROWTH), high


def _weight_cell(v: int) -> tuple[float, float]:
    return (0.0, 1.0) if v == 0 else (2.0 ** (v - 1), 2.0**v)


def _throw(best: np.ndarray, row: np.ndarray, element: np.ndarray, weight: np.ndarray, j: int, k: int) -> None:
    """Throw the darts of rank region ``j`` and keep the lowest ranks in ``best`` (rows x k)."""
    low, high = _rank_cell(j)
    for v in range(max(1, 1 + math.ceil(math.log2(max(weight.max(), 1.0))))):
        wlow, whigh = _weight_cell(v)
        use = slice(None) if v == 0 else np.flatnonzero(weight > wlow)
        r, e, w = row[use], element[use], weight[use]
        if not len(r):
            break
        cell = mix64(e + np.uint64((v * 4096 + j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        u = (cell >> np.uint64(11)) * 2.0**-53
        n = np.searchsorted(_poisson_cdf((whigh - wlow) * (high - low)), u, "right")
        total = int(n.sum())
        if not total:
            continue
        first = np.repeat(np.add.accumulate(n) - n, n)
        number = (np.arange(total) - first + 1).astype(np.uint64)
        h = mix64(np.repeat(cell, n) + number * np.uint64(0xD1B54A32D192ED03))
        rank = low + (high - low) * ((h >> np.uint64(11)) * 2.0**-53)
        coordinate = ((mix64(h) >> np.uint64(33)) * np.uint64(k)) >> np.uint64(31)
        at = np.repeat(r, n) * k + coordinate.astype(np.int64)
        if v or (w < 1).any():
            depth = wlow + (whigh - wlow) * ((mix64(h + np.uint64(1)) >> np.uint64(11)) * 2.0**-53)
            hit = depth < np.repeat(w, n)
            at, rank = at[hit], rank[hit]
        np.minimum.at(best, at, rank)


def signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int, k: int) -> np.ndarray:
    """Lowest ranks (rows x k, float64) of the sets given as (row, element, weight) triples.

    Equal ranks mean the same dart. Elements must be distinct within a row and
    weights positive; a row without elements keeps infinite ranks.
    """
    best = np.full(rows * k, np.inf)
    if not len(row):
        return best.reshape(rows, k)
    total = np.bincount(row, weights=weight, minlength=rows)
    want = k * (math.log(k) + 1.0) / np.maximum(total, 1e-12)
    levels = np.maximum(0, np.ceil(np.log(want / _FIRST_RANK) / math.log(_RANK_GROWTH))).astype(np.int64)
    open_ = total > 0
    j = 0
    while open_.any():
        own = open_[row]
        _throw(best, row[own], element[own], weight[own], j, k)
        ready = open_ & (levels <= j)
        if ready.any():
            done = np.isfinite(best.reshape(rows, k)[ready]).all(axis=1)
            open_[np.flatnonzero(ready)[done]] = False
        j += 1
    return best.reshape(rows, k)

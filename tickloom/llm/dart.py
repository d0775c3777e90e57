"""DartMinHash signatures of weighted sets, many sets at once.

Every element owns an endless strip of (weight, rank) with darts thrown into it at density one, the
same for every set that holds the element: their number and places come from hashes of the element
and of the dyadic cell of the strip. A set of an element with weight w sees the darts below w. Each
dart belongs to one of t coordinates, and a coordinate keeps its dart of lowest rank. Two sets agree
on a coordinate with a chance equal to their weighted Jaccard similarity. Cells are taken in the
order of rank until every coordinate of a set has its dart, so a set costs about its size plus
t log t, not size times t.
"""

import functools

import numpy as np
import pandas as pd

from .words import mix

# First rank cell; each next one doubles the rank reached.
FIRST_RANK = 0.25


@functools.lru_cache(64)
def _poisson_cdf(mean: float) -> np.ndarray:
    most = int(mean + 12 * mean**0.5 + 20)
    k = np.arange(most)
    logs = k * np.log(mean) - mean - np.concatenate([[0], np.cumsum(np.log(np.arange(1, most)))])
    return np.cumsum(np.exp(logs))


def _uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _cell(elements: np.ndarray, mean: float, seed: int):
    """(index of element, hash) of each dart in one cell of every element's strip."""
    salt = mix(np.array([seed], np.uint64))[0]
    base = mix(elements ^ salt)
    cdf = _poisson_cdf(mean)
    n = np.searchsorted(cdf, _uniform(base), side="right")
    owner = np.repeat(np.arange(len(elements)), n)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    return owner, mix(base[owner] + (nth.astype(np.uint64) + np.uint64(1)) * salt)


def signatures(sets: np.ndarray, elements: np.ndarray, weights, count: int, t: int) -> np.ndarray:
    """uint64 array [count, t]; ``sets`` (ascending) has the set of each element, ``weights`` its
    weight or is None for ones. A set without elements has zeros."""
    out = np.zeros(count * t, np.uint64)
    filled = np.zeros(count * t, bool)
    nothing = np.iinfo(np.uint64).max
    low, high, step = 0.0, FIRST_RANK, 0
    while len(sets):
        best = np.full(count * t, nothing, np.uint64)
        begin, width, level = 0.0, 1.0, 0
        open_sets, open_elements, open_weights = sets, elements, weights
        while len(open_sets):
            owner, dart = _cell(open_elements, (high - low) * width, step * 64 + level + 1)
            key = open_sets[owner] * t + ((dart >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)).astype(
                np.int64
            )
            hit = ~filled[key]
            if open_weights is not None:
                at = begin + width * _uniform(mix(dart + np.uint64(7)))
                hit &= at < open_weights[owner]
            # rank within the cell, then 24 bits that tell darts of equal rank apart
            np.minimum.at(best, key[hit], mix(dart[hit]) >> np.uint64(1))
            if open_weights is None:
                break
            begin, width, level = begin + width, begin + width, level + 1
            on = open_weights > begin
            open_sets, open_elements, open_weights = open_sets[on], open_elements[on], open_weights[on]
        new = best != nothing
        out[new] = best[new] ^ mix(np.array([step], np.uint64))[0]
        filled |= new
        undone = ~filled.reshape(count, t).all(axis=1)
        on = undone[sets]
        sets, elements = sets[on], elements[on]
        weights = None if weights is None else weights[on]
        low, high, step = high, high * 2, step + 1
    return out.reshape(count, t)


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """int64 bucket keys [sets, bands], each of ``rows`` coordinates."""
    count, t = signature.shape
    groups = signature.reshape(count, t // rows, rows)
    key = np.zeros((count, t // rows), np.uint64) + mix(np.arange(1, t // rows + 1, dtype=np.uint64))
    for j in range(rows):
        key = mix(key * np.uint64(31) + groups[:, :, j])
    return key.view(np.int64)


def distinct(owner: np.ndarray, hashes: np.ndarray):
    """First occurrence of every (owner, hash), in order, and how often it occurs."""
    codes, _ = pd.factorize(mix(hashes + mix(owner.astype(np.uint64))))
    n = np.bincount(codes) if len(codes) else np.zeros(0, np.int64)
    first = np.flatnonzero(~pd.Series(codes).duplicated().to_numpy())
    return first, n[codes[first]]

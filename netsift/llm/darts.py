"""DartMinHash signatures of weighted word shingles, in numpy.

Darts are thrown, by hashing alone, at the plane of weight and rank that belongs to each
element: cells of area one hold a Poisson(1) number of darts each, so any two documents
see the same darts for the same element. A dart counts for a document if it lies below
the element's weight and below the document's rank bound; each dart names one signature
coordinate, and the dart of lowest rank is kept there. Two signatures agree at a
coordinate with the weighted Jaccard similarity of the documents. The bound is set so that
about k ln k + 2k darts count, whatever the document's size; where a coordinate stays
empty the bound is doubled for that document.

The weight axis is cut at 1, 3, 7, ... (each piece twice as wide as the one before); the
rank axis of a piece is cut so that cells have area one.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash

from netsift.llm.common import utf8

_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_POISSON = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(18)])
REMEMBERED = 500_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered (speed only)."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = xxhash.xxh3_64_intdigest(utf8(word))
        if len(word) < 60:
            self[word] = value
        return value


def shingles(words: list[str], hashes: WordHashes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted, and how often each occurs; fewer words than ``size`` make one shingle."""
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    with np.errstate(over="ignore"):
        total = np.full(len(h) - size + 1, size, np.uint64)
        for i in range(size):
            total = mixed(total * _STEP + h[i : i + len(total)])
    return np.unique(total, return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sorted shingle multisets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    either = a[1].sum() + b[1].sum() - both
    return float(both / either) if either else 0.0


def _darts(element, weight, theta, owner, k, best):
    """Throws the darts of elements (hash, weight, rank bound and row of ``best`` each); keeps the lowest."""
    level = np.floor(np.log2(weight)).astype(np.int64) + 1
    at = np.repeat(np.arange(len(element)), level)
    nu = np.arange(len(at)) - np.repeat(np.cumsum(level) - level, level)
    rows = np.ceil(theta[at] * (1 << nu)).astype(np.int64)
    cell_of = np.repeat(np.arange(len(at)), rows)
    row = np.arange(len(cell_of)) - np.repeat(np.cumsum(rows) - rows, rows)
    nu, at = nu[cell_of], at[cell_of]
    cell = mixed(mixed(element[at] + _STEP * (nu + 1).astype(np.uint64)) + _STEP * (row + 1).astype(np.uint64))
    n = np.searchsorted(_POISSON, (cell >> np.uint64(11)) * 2.0**-53, side="right")
    dart_of = np.repeat(np.arange(len(cell)), n)
    j = np.arange(len(dart_of)) - np.repeat(np.cumsum(n) - n, n)
    dart = mixed(cell[dart_of] + _STEP * (j + 1).astype(np.uint64))
    nu, row, at = nu[dart_of], row[dart_of], at[dart_of]
    width = (1 << nu).astype(np.float64)
    rank = (row + (dart >> np.uint64(32)) * 2.0**-32) / width
    high = width - 1 + width * ((mixed(dart + _STEP) >> np.uint64(11)) * 2.0**-53)
    counts = (rank < theta[at]) & (high < weight[at])
    dart, rank, at = dart[counts], rank[counts], at[counts]
    coordinate = ((dart & np.uint64(0xFFFFFFFF)) * np.uint64(k)) >> np.uint64(32)
    # ranks are not negative, so their bits sort as they do; the dart's own hash follows as its name
    name = mixed(dart ^ _MIX1) >> np.uint64(32)
    value = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32)) | name
    np.minimum.at(best.reshape(-1), owner[at] * k + coordinate.astype(np.int64), value)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """One row of ``k`` 32-bit dart names per shingle multiset; a row of an empty one has no meaning."""
    best = np.full((len(sets), k), np.iinfo(np.uint64).max, np.uint64)
    size = np.array([s[1].sum() for s in sets], np.float64)
    theta = (k * math.log(k) + 2 * k) / np.maximum(size, 1)
    todo = np.flatnonzero(size)
    with np.errstate(over="ignore"):
        while len(todo):
            lengths = [len(sets[i][0]) for i in todo]
            owner = np.repeat(todo, lengths)
            _darts(np.concatenate([sets[i][0] for i in todo]), np.concatenate([sets[i][1] for i in todo]).astype(np.float64),
                   theta[owner], owner, k, best)
            todo = todo[(best[todo] == np.iinfo(np.uint64).max).any(1)]
            theta[todo] *= 2
        return (best & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key per band of each signature."""
    n, k = signature.shape
    parts = signature.reshape(n, bands, k // bands).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands)) * _STEP
        for i in range(parts.shape[2]):
            key = mixed(key + parts[:, :, i] * _STEP + _MIX2)
    return key.astype(np.int64)

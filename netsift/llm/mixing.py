"""Logistic mixing of hashed-context bit predictors, in numpy.

A word is coded byte by byte and bit by bit, in two parts: its head, which is its first two
bytes and sees the last two of the word before, and the rest, which sees the word so far.
So a part's cost depends on nothing but four bytes, or the word: each distinct head and word is
worked out once, however often and in however many documents it occurs.

Each of five contexts is hashed to 56 bits; the bit nodes of the byte that follows have counts
of zeros and ones, which give a prediction in the logistic domain. Predictions are added up
with weights chosen by a gate: how often the whole context was seen, whether the context of
four bytes was, and in which part. Everything is written for the bit that comes: the
prediction of the other one is its negative, and gates do not see the bit.

Weights are fitted by Newton steps on all training occurrences at once, each predicted
without itself; gradients and curvatures of any parts of the data add up.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

CONTEXTS = 5
GATES = 16
FOUR, WHOLE = 2, 3
PRIOR = 0.4
RIDGE = 30.0
END = b"\xff"  # a byte that UTF-8 never has
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_P = 0x100000001B3
_PI = pow(_P, -1, 1 << 64)
BATCH = 1 << 15  # coded bytes that are predicted at once
SLICE = 1 << 16  # bytes of strings whose keys are made at once


def first_weights() -> np.ndarray:
    weights = np.full((GATES, CONTEXTS), 0.2)
    weights[:, WHOLE] = 0.5
    return weights


_known_powers: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _known_powers or len(_known_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        with np.errstate(over="ignore"):
            _known_powers[:] = [
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, p, np.uint64)]), dtype=np.uint64) for p in (_P, _PI)
            ]
    return _known_powers


def _keys(flat: np.ndarray, lengths: np.ndarray, part: int) -> list[np.ndarray]:
    """Keys of the bytes from each string's third on: 56 bits of context and the byte, per context."""
    flat = flat.astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(lengths)), lengths)
    at = np.flatnonzero(np.arange(len(flat)) - starts[owner] >= 2)
    start = starts[owner[at]]
    power, inverse = _powers(len(flat) + 1)
    out = []
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((flat + np.uint64(1)) * power[: len(flat)])])
        last = start + 2 if part == 0 else np.maximum(at - 3, start)
        for k, first in enumerate((np.maximum(at - 1, start), np.maximum(at - 2, start), np.maximum(at - 4, start), start, last)):
            key = ((sums[at] - sums[first]) * inverse[first] + np.uint64(part * 8 + k + 1) * _B) * _B
            key = (key ^ (key >> np.uint64(29))) * _A
            out.append((key ^ (key >> np.uint64(32))) & ~np.uint64(255) | flat[at])
    return out


def _slices(flat: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Strings in runs of whole ones, of about ``SLICE`` bytes or a string that is longer."""
    ends = np.cumsum(lengths)
    cuts = np.unique(np.searchsorted(ends, np.arange(SLICE, len(flat), SLICE)) + 1)
    cuts = [0, *cuts[cuts < len(lengths)], len(lengths)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield flat[ends[a] - lengths[a] : ends[b - 1]], lengths[a:b]


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and which one each is: ``np.unique`` with an inverse, in less memory."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    where = np.empty(len(keys), np.uint32)
    where[order] = np.cumsum(new, dtype=np.uint32) - np.uint32(1)
    return keys[new], where


class Units:
    """Distinct heads (numbers of four bytes) and words, with their training counts."""

    def __init__(self, heads: np.ndarray, head_counts: np.ndarray, words: list[bytes], counts: np.ndarray):
        closed = [w + b" " for w in words]
        lengths = np.fromiter(map(len, closed), np.int64, len(closed))
        self.texts = [(heads.astype(">u4").view(np.uint8), np.full(len(heads), 4, np.int64)),
                      (np.frombuffer(b"".join(closed), np.uint8), lengths)]
        self.sizes = [len(heads), len(closed)]
        coded = np.concatenate([np.full(len(heads), 2, np.int64), np.maximum(lengths - 2, 0)])
        self.owner = np.repeat(np.arange(len(coded)), coded)
        self.often = np.concatenate([head_counts, counts]).astype(np.int64)[self.owner]
        self.head_bytes = 2 * len(heads)

    def keys(self):
        """For each context: distinct keys, their training counts, and which one each coded byte has."""
        found = [np.empty(len(self.owner), np.uint64) for _ in range(CONTEXTS)]
        at = 0
        for part, text in enumerate(self.texts):
            for some in _slices(*text):
                keys = _keys(*some, part)
                for own, key in zip(found, keys):
                    own[at : at + len(key)] = key
                at += len(keys[0])
        while found:
            key, where = distinct(found.pop(0))
            yield key, np.bincount(where, self.often, len(key)).astype(np.int64), where


def node_sums(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Counts at the nodes on each key's path: before its first bit, after it, ..., after its eighth.

    ``keys`` are distinct and sorted; one row of nine numbers for each.
    """
    out = np.empty((len(keys), 9), np.int64)
    for depth in range(9):
        node = keys >> np.uint64(8 - depth)
        starts = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(keys) else np.zeros(0, np.int64)
        sums = np.add.reduceat(counts, starts) if len(keys) else counts
        out[:, depth] = np.repeat(sums, np.diff(np.append(starts, len(keys))))
    return out


def stretched(nodes: np.ndarray, without: int) -> np.ndarray:
    """Predictions of the eight bits of each key, without that many occurrences of the key itself."""
    nodes = nodes.astype(np.float32)
    right = np.maximum(nodes[:, 1:] - np.float32(without), 0)
    return np.log((right + np.float32(PRIOR)) / (nodes[:, :-1] - nodes[:, 1:] + np.float32(PRIOR)))


class Predictor:
    """Predictions and gates of all coded bits of units; ``nodes`` come one context at a time, whole or in parts, as they are large."""

    def __init__(self, nodes: Iterable[np.ndarray | Iterable[np.ndarray]], where: list[np.ndarray], head_bytes: int, without: int):
        self.x = []
        for k, parts in enumerate(nodes):
            x, gates = [], []
            for counts in [parts] if isinstance(parts, np.ndarray) else parts:
                # rows side by side: they are looked up one at a time
                counts = np.ascontiguousarray(counts)
                x.append(stretched(counts, without))
                if k == WHOLE:
                    seen = counts[:, :-1] - without
                    gates.append((seen > 0).astype(np.uint8) + (seen > 3) + (seen > 60))
                elif k == FOUR:
                    gates.append((counts[:, :-1] > without).astype(np.uint8) * np.uint8(4))
            self.x.append(np.concatenate(x))
            if k == WHOLE:
                self.level = np.concatenate(gates)
            elif k == FOUR:
                self.four = np.concatenate(gates)
        self.where, self.head_bytes = where, head_bytes

    def batches(self, chosen: np.ndarray):
        """For each batch of coded bytes: those, predictions (bits by contexts), gates."""
        for a in range(0, len(chosen), BATCH):
            some = chosen[a : a + BATCH]
            at = [w[some] for w in self.where]
            x = np.stack([self.x[k][at[k]].ravel() for k in range(CONTEXTS)], 1)
            part = np.repeat((some >= self.head_bytes).astype(np.uint8) * np.uint8(8), 8)
            yield some, x, self.level[at[WHOLE]].ravel() + self.four[at[FOUR]].ravel() + part


def _sums(x: np.ndarray, gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.clip(np.einsum("ij,ij->i", x, weights.astype(np.float32)[gate]), -15, 15)


def gradients(units_often: np.ndarray, predictor: Predictor, weights: np.ndarray) -> np.ndarray:
    """Gradient and curvature of each gate over the training occurrences, one row of numbers per gate."""
    slope, curve = np.zeros((GATES, CONTEXTS)), np.zeros((GATES, CONTEXTS, CONTEXTS))
    for some, x, gate in predictor.batches(np.flatnonzero(units_often > 0)):
        order = np.argsort(gate, kind="stable")
        x, gate = x[order], gate[order]
        often = np.repeat(units_often[some], 8)[order].astype(np.float32)
        wrong = 1 / (1 + np.exp(_sums(x, gate, weights)))
        heavy = often * np.maximum(wrong * (1 - wrong), np.float32(1e-4))
        bounds = np.searchsorted(gate, np.arange(GATES + 1))
        for g in np.flatnonzero(np.diff(bounds)):
            rows = slice(bounds[g], bounds[g + 1])
            slope[g] += x[rows].T @ (often[rows] * wrong[rows])
            curve[g] += x[rows].T @ (x[rows] * heavy[rows, None])
    return np.concatenate([slope, curve.reshape(GATES, -1)], 1)


def step(weights: np.ndarray, summed: np.ndarray) -> np.ndarray:
    """A Newton step by added-up ``gradients``; a ridge holds gates that are hardly seen at their first weights."""
    slope, curve = summed[:, :CONTEXTS], summed[:, CONTEXTS:].reshape(GATES, CONTEXTS, CONTEXTS)
    slope = slope - RIDGE * (weights - first_weights())
    return weights + np.linalg.solve(curve + RIDGE * np.eye(CONTEXTS), slope[..., None])[..., 0]


def costs(owner: np.ndarray, n_units: int, predictor: Predictor, weights: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each unit."""
    out = np.zeros(n_units)
    for some, x, gate in predictor.batches(np.arange(len(owner))):
        each = np.logaddexp(0, -_sums(x, gate, weights)).reshape(-1, 8).sum(1, dtype=np.float64)
        out -= np.bincount(owner[some], each, n_units)
    return out

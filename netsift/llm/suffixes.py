"""Enhanced suffix arrays over many short strings, and their common-prefix intervals, in numpy.

``suffix_order`` sorts the given suffixes (each ends with its string); ``intervals`` scans
their common-prefix lengths with a stack, which visits every node of the common-prefix
interval tree once; ``maximal_repeats`` keeps the nodes whose occurrences are preceded by
different characters (or by the start of a string), so that no repeat is reported that
could be longer on either side. Each comes with all its occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def words8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number, in byte order; zeros follow the end."""
    w = np.concatenate([data, np.zeros(7, np.uint8)]).astype(np.uint64)
    w = (w[:-1] << np.uint64(8)) | w[1:]
    w = (w[:-2] << np.uint64(16)) | w[2:]
    return (w[:-4] << np.uint64(32)) | w[4:]


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].astype(np.uint64)


def prefix_ranks(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Order numbers of the ``length`` bytes from ``starts`` on; equal ones have equal numbers. Prefix doubling."""
    w = np.append(words8(data), np.zeros(length, np.uint64))
    if length <= 8:
        return _ranks(w[starts] >> np.uint64(8 * (8 - length)))
    rank, have = w, 8
    while have < length:
        if rank is w:
            dense = _ranks(rank)
        else:
            dense = rank
        step = min(have, length - have)
        other = np.append(dense[step:], np.zeros(step, np.uint64))
        joined = dense << np.uint64(32) | other
        have += step
        rank = _ranks(joined[starts]) if have == length else _ranks(joined)
    return rank


def suffix_order(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``starts`` of suffixes that share ``least`` bytes with another, in order, and the common
    prefix length of each with the one before it (0 where that is below ``least``).

    Every suffix reaches at least ``least`` bytes, up to its entry in ``ends``.
    """
    rank = prefix_ranks(data, starts, least)
    twice = np.bincount(rank.astype(np.int64))[rank.astype(np.int64)] > 1
    some = np.flatnonzero(twice)
    if not len(some):
        return some, np.empty(0, np.int64)
    left = ends[some] - starts[some] - least
    rest = np.arange(max(1, int(left.max())))
    at = np.minimum(starts[some][:, None] + least + rest, len(data) - 1)
    tails = np.where(rest < left[:, None], data[at].astype(np.int16), np.int16(-1))  # an end sorts first
    order = np.lexsort((*tails.T[::-1], rank[some]))
    tails, left = tails[order], left[order]
    same = (tails[1:] == tails[:-1]) & (tails[1:] >= 0)
    more = np.cumprod(same, axis=1).sum(1)
    ranked = rank[some][order]
    lcp = np.append(0, np.where(ranked[1:] == ranked[:-1], least + more, 0))
    return some[order], lcp


def intervals(lcp: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(length, first, last) of each common-prefix interval of at least two suffixes, inner ones before outer ones."""
    stack: list[tuple[int, int]] = []
    values = lcp.tolist()
    for i in range(1, len(values) + 1):
        now, first = values[i] if i < len(values) else 0, i - 1
        while stack and stack[-1][0] > now:
            length, first = stack.pop()
            yield length, first, i - 1
        if now and (not stack or stack[-1][0] < now):
            stack.append((now, first))


def maximal_repeats(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray, least: int
) -> Iterator[tuple[int, np.ndarray]]:
    """(length, indices into ``starts``) of each maximal repeat of at least ``least`` bytes, with all occurrences.

    ``firsts`` is where the string of each suffix starts: what stands there has no left
    neighbour, so it differs from every other.
    """
    order, lcp = suffix_order(data, starts, ends, least)
    at = starts[order]
    before = np.where(at > firsts[order], data[np.maximum(at - 1, 0)].astype(np.int64), -1 - np.arange(len(at)))
    # left[i]: the last place before i whose left neighbour differs from that of i
    change = np.append(0, np.cumsum(before[1:] != before[:-1]))
    for length, first, last in intervals(lcp):
        if change[first] != change[last]:
            yield length, order[first : last + 1]

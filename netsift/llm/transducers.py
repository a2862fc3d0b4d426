"""Weighted acyclic automata over words: each accepted phrase has a count.

A transducer is built incrementally from sorted phrases, as minimal automata are: the states of
the last phrase that the next one does not share are frozen, and a frozen state that equals an
earlier one is that one. Phrases that differ in the last word alone are added together. A count is the sum of the weights along the path; weights stand as far to
the front as the phrases that share an arc allow, so that equal endings stay equal.
"""

from __future__ import annotations

import itertools
import operator
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import zstandard

Phrase = tuple[bytes, ...]
LEAF = 0


class Transducer:
    """States are numbered so that arcs lead to smaller numbers; the last one is the start.

    ``arcs[s]`` is a tuple of (word, target, weight) in word order, ``ends[s]`` the weight of ending
    in ``s``, or -1.
    """

    def __init__(self, arcs: list[tuple], ends: list[int]):
        self.arcs, self.ends = arcs, ends

    @classmethod
    def build(cls, counted: Iterable[tuple[Phrase, int]]) -> Transducer:
        """``counted``: phrases in strictly rising order, each with its count."""
        runs = itertools.groupby(counted, key=lambda pc: pc[0][:-1])
        listed = ((stem, list(zip(*run))) for stem, run in runs)
        return cls.build_runs((stem, [p[-1] if p else None for p in phrases], counts) for stem, (phrases, counts) in listed)

    @classmethod
    def build_runs(cls, runs: Iterable[tuple[Phrase, Sequence[bytes | None], Sequence[int]]]) -> Transducer:
        """The same from runs: phrases with all words but the last in common, their last words and counts.

        The last word of the phrase without words is None.
        """
        arcs: list[tuple] = [()]
        ends: list[int] = [0]  # the state LEAF, where most phrases end
        register: dict[tuple, int] = {(0, ()): LEAF}
        open_arcs: list[list[list]] = [[]]
        open_ends: list[int] = [-1]
        last: Phrase | None = None

        def freeze(depth: int) -> None:
            """Freezes the open states below ``depth``."""
            while len(open_arcs) > depth:
                state = (open_ends.pop(), tuple([tuple(a) for a in open_arcs.pop()]))
                number = register.get(state)
                if number is None:
                    number = register[state] = len(arcs)
                    ends.append(state[0])
                    arcs.append(state[1])
                if open_arcs:
                    open_arcs[-1][-1][1] = number

        for stem, words, counts in runs:
            if words[0] is None:
                if last is not None:
                    raise ValueError("phrases come in strictly rising order")
                last, open_ends[0] = (), counts[0]
                continue
            if last is not None and (*stem, words[0]) <= last or any(map(operator.ge, words, words[1:])):
                raise ValueError("phrases come in strictly rising order")
            shared = 0
            if last is not None:
                for a, b in zip(last, stem):
                    if a != b:
                        break
                    shared += 1
                freeze(shared + 1)
            last = (*stem, words[-1])
            low = min(counts)
            rest, used = low, 0
            for depth in range(shared):
                arc = open_arcs[depth][-1]
                if arc[2] > rest:
                    # what the other phrases behind this arc have more moves on to the next state
                    more = arc[2] - rest
                    for later in open_arcs[depth + 1]:
                        later[2] += more
                    if open_ends[depth + 1] >= 0:
                        open_ends[depth + 1] += more
                    arc[2] = rest
                rest -= arc[2]
                used += arc[2]
            for word in stem[shared:]:
                open_arcs[-1].append([word, -1, rest])
                open_arcs.append([])
                open_ends.append(-1)
                used, rest = used + rest, 0
            open_arcs[-1] += [[w, LEAF, c - used] for w, c in zip(words, counts)]
            open_arcs.append([])
            open_ends.append(0)
        freeze(0)
        return cls(arcs, ends)

    def paths(self) -> Iterator[tuple[Phrase, int]]:
        """All phrases in rising order with their counts."""
        todo: list[tuple[int, Phrase, int]] = [(len(self.arcs) - 1, (), 0)]
        while todo:
            state, words, weight = todo.pop()
            if self.ends[state] >= 0:
                yield words, weight + self.ends[state]
            for word, target, more in reversed(self.arcs[state]):
                todo.append((target, (*words, word), weight + more))

    def prefixes(self) -> Iterator[tuple[Phrase, int, tuple[int | None, ...]]]:
        """Each phrase with its count and the counts of its first 1, 2, ... words (None: no phrase)."""
        todo: list[tuple[int, Phrase, int, tuple]] = [(len(self.arcs) - 1, (), 0, ())]
        while todo:
            state, words, weight, before = todo.pop()
            here = weight + self.ends[state] if self.ends[state] >= 0 else None
            if here is not None and words:
                yield words, here, before
            before = (*before, here) if words else ()
            for word, target, more in reversed(self.arcs[state]):
                todo.append((target, (*words, word), weight + more, before))

    def pack(self) -> bytes:
        words = sorted({a[0] for state in self.arcs for a in state})
        number = {w: i for i, w in enumerate(words)}
        flat = list(itertools.chain.from_iterable(self.arcs))
        labels, targets, weights = zip(*flat) if flat else ((), (), ())
        links = np.stack([np.fromiter(map(number.__getitem__, labels), "<i4", len(flat)), np.fromiter(targets, "<i4", len(flat))], 1)
        weights = np.fromiter(weights, "<i8", len(flat))
        table = b"\n".join(words)
        head = np.array([len(words), len(table), len(self.arcs), len(flat)], "<i8")
        sizes = np.array([len(s) for s in self.arcs], "<i4")
        parts = [head.tobytes(), table, sizes.tobytes(), np.array(self.ends, "<i8").tobytes(), links.tobytes(), weights.tobytes()]
        return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))

    @classmethod
    def unpack(cls, data: bytes) -> Transducer:
        data = zstandard.ZstdDecompressor().decompress(data)
        n_words, n_table, n_states, n_arcs = np.frombuffer(data, "<i8", 4).tolist()
        at = 32 + n_table
        words = data[32:at].split(b"\n") if n_words else []
        sizes = np.frombuffer(data, "<i4", n_states, at).tolist()
        at += 4 * n_states
        ends = np.frombuffer(data, "<i8", n_states, at).tolist()
        at += 8 * n_states
        links = np.frombuffer(data, "<i4", 2 * n_arcs, at).reshape(-1, 2)
        weights = np.frombuffer(data, "<i8", n_arcs, at + 8 * n_arcs).tolist()
        flat = list(zip(map(words.__getitem__, links[:, 0].tolist()), links[:, 1].tolist(), weights))
        arcs, at = [], 0
        for size in sizes:
            arcs.append(tuple(flat[at : at + size]))
            at += size
        return cls(arcs, ends)


def union(parts: Iterable[Transducer], least: int = 0) -> Transducer:
    """All phrases of ``parts`` with the sums of their counts, those of ``least`` or more."""
    totals: dict[Phrase, int] = {}
    known = totals.get
    for part in parts:
        todo: list[tuple[int, Phrase, int]] = [(len(part.arcs) - 1, (), 0)]
        while todo:
            state, words, weight = todo.pop()
            if part.ends[state] >= 0:
                totals[words] = known(words, 0) + weight + part.ends[state]
            for word, target, more in part.arcs[state]:
                phrase = (*words, word)
                if target == LEAF:
                    totals[phrase] = known(phrase, 0) + weight + more
                else:
                    todo.append((target, phrase, weight + more))
    return Transducer.build(sorted((p, c) for p, c in totals.items() if c >= least))


def compose(one: Transducer, two: Transducer) -> Iterator[tuple[Phrase, int, int]]:
    """The phrases both accept, in rising order, with the count in each."""
    todo: list[tuple[int, int, Phrase, int, int]] = [(len(one.arcs) - 1, len(two.arcs) - 1, (), 0, 0)]
    while todo:
        a, b, words, x, y = todo.pop()
        if one.ends[a] >= 0 and two.ends[b] >= 0:
            yield words, x + one.ends[a], y + two.ends[b]
        fewer, more, swapped = one.arcs[a], two.arcs[b], False
        if len(fewer) > len(more):
            fewer, more, swapped = more, fewer, True
        found = {arc[0]: arc for arc in fewer}
        for arc in reversed(more):
            other = found.get(arc[0])
            if other is not None:
                p, q = (arc, other) if swapped else (other, arc)
                todo.append((p[1], q[1], (*words, arc[0]), x + p[2], y + q[2]))

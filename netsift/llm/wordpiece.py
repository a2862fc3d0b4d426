"""Token counts by a linear longest-match automaton.

The vocabulary is a trie of two roots, one for pieces that start a word and one for
pieces that go on with it. Every node has a failure link: where to go on when the next
byte has no edge, and the number of pieces that are thereby settled. Both are found once,
breadth first, so a word is counted in time linear in its length and no piece is built.

The automaton runs over the distinct new words of a batch in step: one numpy pass moves
every word by one edge or one link. Counts of words are remembered in bounded memory
(speed only).

Cases: null or empty texts have no words and no tokens; a word that the vocabulary cannot
cover counts as one token and as unknown; a null id stays null; repeated rows are each
counted; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from netsift.llm.common import groups_of, read, rows_of, utf8, words
from netsift.llm.packing import vocabulary

REMEMBERED = 500_000
_FEW = 24

_loaded: dict[str, Automaton] = {}


class Automaton:
    """Greedy longest-match counts for a vocabulary of starting and continuing pieces (bytes)."""

    def __init__(self, starting: Iterable[bytes], continuing: Iterable[bytes]):
        edges: dict[int, int] = {}  # node * 256 + byte -> node
        ends = [False, False]
        parents = [(-1, 0), (-1, 0)]
        for root, pieces in ((0, starting), (1, continuing)):
            for piece in pieces:
                node = root
                for byte in piece:
                    key = node * 256 + byte
                    if key not in edges:
                        edges[key] = len(ends)
                        parents.append((node, byte))
                        ends.append(False)
                    node = edges[key]
                if piece:
                    ends[node] = True
        self.edges = edges
        n = len(ends)
        self.link, self.settled = [-1] * n, [0] * n
        depth_first = sorted(range(2, n), key=self._depths(parents).__getitem__)
        for node in depth_first:
            parent, byte = parents[node]
            if ends[node]:
                self.link[node], self.settled[node] = 1, 1
                continue
            at, pops = self.link[parent], self.settled[parent]
            while at >= 0 and (at * 256 + byte) not in edges:
                pops += self.settled[at]
                at = self.link[at]
            if at >= 0:
                self.link[node], self.settled[node] = edges[at * 256 + byte], pops
        self.keys = np.array(sorted(edges), np.int64)
        self.targets = np.array([edges[k] for k in self.keys.tolist()], np.int64)
        self.links, self.pops = np.array(self.link, np.int64), np.array(self.settled, np.int64)

    @staticmethod
    def _depths(parents: list[tuple[int, int]]) -> list[int]:
        depth = [0] * len(parents)
        for node in range(2, len(parents)):  # parents come before their children
            depth[node] = depth[parents[node][0]] + 1
        return depth

    def count_one(self, word: bytes) -> int:
        """Pieces of one word, or -1 if it cannot be covered."""
        at = pops = 0
        for byte in word:
            while (to := self.edges.get(at * 256 + byte, -1)) < 0:
                pops += self.settled[at]
                at = self.link[at]
                if at < 0:
                    return -1
            at = to
        while at != 1:
            pops += self.settled[at]
            at = self.link[at]
            if at < 0:
                return -1
        return pops

    def count(self, batch: list[bytes]) -> np.ndarray:
        """Pieces of each (not empty) word, or -1; all words move in step."""
        out = np.zeros(len(batch), np.int64)
        text = np.frombuffer(b"".join(batch), np.uint8).astype(np.int64)
        ends = np.cumsum([len(w) for w in batch])
        word, place, stop = np.arange(len(batch)), ends - np.array([len(w) for w in batch]), ends
        at = np.zeros(len(batch), np.int64)
        while len(word) > _FEW:
            more = place < stop
            key = at * 256 + np.where(more, text[np.minimum(place, len(text) - 1)], 0)
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            moves = more & (self.keys[found] == key)
            np.add.at(out, word[~moves], self.pops[at[~moves]])
            at = np.where(moves, self.targets[found], self.links[at])
            place = place + moves
            lost = at < 0
            out[word[lost]] = -1
            going = ~lost & ((place < stop) | (at != 1))
            word, place, stop, at = word[going], place[going], stop[going], at[going]
        for i in word.tolist():  # the last few, perhaps very long, one by one
            out[i] = self.count_one(batch[i])
        return out


def byte_level_pieces(path: str) -> tuple[list[bytes], list[bytes]]:
    """Starting and continuing pieces from a byte-level vocabulary file.

    Entries with a leading space start a word, those without white space go on with one;
    single bytes may do both, so that every word is covered.
    """
    # the rule by which byte-level vocabularies write bytes: printable ones as they are, the rest from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    with open(path, encoding="utf-8") as file:
        entries = json.load(file)["model"]["vocab"]
    single = [bytes([b]) for b in range(256)]
    starting, continuing = set(single), set(single)
    for entry in entries:
        piece = bytes(of[c] for c in entry)
        if piece[:1] == b" " and len(piece.strip()) == len(piece) - 1 and len(piece) > 1:
            starting.add(piece[1:])
        elif not any(b in b" \t\n\x0b\x0c\r" for b in piece):
            continuing.add(piece)
    return sorted(starting), sorted(continuing)


def automaton(path: str) -> Automaton:
    """One automaton per Python worker."""
    if path not in _loaded:
        _loaded[path] = Automaton(*byte_level_pieces(path))
    return _loaded[path]


def token_counts(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` for each row; ``path`` is a byte-level vocabulary file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, known = automaton(path), {}
        for group in groups_of(rows_of(batches, "id", "text"), 1 << 20):
            split = [words(t) for _, t in group]
            distinct = set().union(*split)
            new = list(distinct - known.keys())
            if len(known) + len(new) > REMEMBERED:
                known, new = {}, list(distinct)
            known.update(zip(new, machine.count([utf8(w) for w in new]).tolist() if new else ()))
            rows = []
            for (i, _), found in zip(group, split):
                counts = np.fromiter(map(known.__getitem__, found), np.int64, len(found))
                lost = int((counts < 0).sum())
                rows.append((i, len(found), int(counts.sum()) + 2 * lost, lost))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*rows)],
                                             names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    slim = docs.selectExpr(f"cast(`{id_column}` as long) id", f"cast(`{text}` as string) text")
    return slim.mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")


def op8_longest_match_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(read(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))

"""Benchmark decontamination: rare word-pair seeds, then Smith-Waterman alignment of words.

1. A seed is two words of an item, next to each other or with one between, that stand so
   in the passage too (either way in each). Any passage that reaches the score needed
   keeps seeds from at least ``least_kept`` places of the item, whatever was exchanged, put
   in or left out; that bound is exact.
2. Documents are turned into numbers of the items' words once, and a pass over these counts
   how often each seed occurs. An item can spare its commonest ``least_kept`` - 1 places:
   one of the others is kept in any passage looked for, so only these are searched.
3. Another pass joins passages to items by the rare seeds. Around each hit a window as wide
   as a passage with the gaps that the score allows is aligned with the item, unless it holds
   too few of the item's words or seeds to reach the threshold; both bounds are exact.
4. A document is contaminated by an item if the best local alignment reaches ``threshold``
   of the item's own score, and at least ``least`` matching words or the whole item.

Words are compared in lower case without punctuation around them. Test items are read in
blocks of a bounded number of characters; a block is what tasks get, however many items
there are, and documents are never shuffled. Counting and alignment use no memory that
grows with the corpus.

Cases: null or empty texts match nothing; items of under ``shortest`` words are never
found, as they are no passage; a null document id is reported as null; repeated rows are
each reported; of equal scores the first place counts; very long texts are searched whole,
one row at a time; empty tables give no rows; other columns of documents pass through the
filter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm.common import WORD, groups_of, read, rows_of, written

SHORTEST = 3
THRESHOLD = 0.5
LEAST_WORDS = 8
MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_CHARS = 16_000_000
REMEMBERED = 300_000


def normal(word: str) -> str:
    """Lower case, without what is no letter or digit at the ends; the word itself if nothing is left."""
    low = word.lower()
    start, end = 0, len(low)
    while start < end and not low[start].isalnum():
        start += 1
    while end > start and not low[end - 1].isalnum():
        end -= 1
    return low[start:end] or low


def needed(length: int, threshold: float, least: int) -> float:
    """The alignment score from which an item of ``length`` words is found: always more than one word's."""
    own = MATCH * length
    return max(threshold * own, min(own, MATCH * least), MATCH + 1)


def least_kept(score: float) -> int:
    """From how many places of an item any passage of at least this score keeps a seed.

    Of ``m`` matches the ``m - 1`` that have a next one hold a seed if nothing or a single
    penalty lies between; the others cost two or more, as much as a match brings.
    """
    return math.ceil(score / MATCH) - 1


class Ids(dict):
    """Word -> number of its normal form among the items' words, 0 for others; remembered (speed only)."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = self.vocabulary.get(normal(word), 0)
        return value

    def of(self, text: str | None) -> np.ndarray:
        found = WORD.findall(text) if text else []
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


class Block:
    """Test items as arrays of word numbers, with the seeds at each of their places."""

    def __init__(self, items: list[tuple[int, str]], shortest: int):
        self.items, self.words = [], []
        self.vocabulary: dict[str, int] = {}
        for item, text in items:
            found = WORD.findall(text)
            if len(found) >= max(2, shortest):
                number = [self.vocabulary.setdefault(normal(w), len(self.vocabulary) + 1) for w in found]
                self.items.append(item)
                self.words.append(np.array(number, np.int64))
        self.size = len(self.vocabulary) + 1
        self.kind = np.uint16 if self.size <= 1 << 16 else np.uint32
        self.seeds = [self.pairs(w) for w in self.words]

    def pairs(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of all pairs of the items' words at distance one and two, and the places of their first words."""
        keys, places = [], []
        for step in (1, 2):
            first, second = ids[:-step], ids[step:]
            at = np.flatnonzero((first > 0) & (second > 0))
            keys.append(first[at].astype(np.int64) * self.size + second[at])
            places.append(at)
        return np.concatenate(keys), np.concatenate(places)


def hits(keys: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the keys occur in the sorted array ``of``, and where there."""
    if not len(keys) or not len(of):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(of, keys), len(of) - 1)
    found = np.flatnonzero(of[place] == keys)
    return found, place[found]


def best_alignment(window: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word arrays, and where in ``window`` it ends (exclusive)."""
    above = np.zeros(len(item) + 1, np.int64)
    slope = -GAP * np.arange(len(item) + 1)
    best, end = 0, 0
    for i, word in enumerate(window.tolist()):
        row = np.maximum(above + GAP, 0)
        np.maximum(row[1:], above[:-1] + np.where(item == word, MATCH, MISMATCH), out=row[1:])
        # gaps along the row: a running maximum of what each cell offers, less the way from it
        above = np.maximum.accumulate(row + slope) - slope
        top = int(above.max())
        if top > best:
            best, end = top, i + 1
    return best, end


class Matcher:
    """Finds the items of a block in arrays of word numbers, by the seeds at the places given for each item."""

    def __init__(self, block: Block, places: list[np.ndarray], threshold: float, least: int):
        self.block, self.ids, self.memory = block, Ids(block.vocabulary), {}
        rows = []
        for item, ((keys, at), rare) in enumerate(zip(block.seeds, places)):
            chosen = np.flatnonzero(np.isin(at, rare))
            rows.append(np.stack([keys[chosen], np.full(len(chosen), item), at[chosen]]))
        table = np.concatenate(rows, 1) if rows else np.zeros((3, 0), np.int64)
        table = table[:, np.argsort(table[0], kind="stable")]
        self.keys, first = np.unique(table[0], return_index=True)
        self.first = np.append(first, table.shape[1])
        self.where = list(zip(table[1].tolist(), table[2].tolist()))
        self.own = [MATCH * len(w) for w in block.words]
        self.needed = [needed(len(w), threshold, least) for w in block.words]
        self.bags = [Counter(w.tolist()) for w in block.words]

    def align(self, item: int, window: np.ndarray) -> tuple[int, int, int] | None:
        """Score, start and end in the window, or None below what is needed."""
        words = self.block.words[item]
        bag, have = self.bags[item], Counter(window.tolist())
        if MATCH * sum(min(n, have[w]) for w, n in bag.items()) < self.needed[item]:
            return None
        keys, at = self.block.seeds[item]
        if len(np.unique(at[np.isin(keys, self.block.pairs(window)[0])])) < least_kept(self.needed[item]):
            return None
        key = (item, window.tobytes())
        if key not in self.memory:
            if len(self.memory) > 20_000:
                self.memory.clear()
            score, end = best_alignment(window, words)
            if score < self.needed[item]:
                self.memory[key] = None
            else:
                back, length = best_alignment(window[:end][::-1], words[::-1])
                self.memory[key] = (score, end - length, end)
        return self.memory[key]

    def find(self, ids: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(item id, share of the item's own score, first word, end word) of each item found, by item."""
        keys, places = self.block.pairs(ids)
        found, place = hits(keys, self.keys)
        spans: dict[int, set[tuple[int, int]]] = {}
        for p, k in zip(places[found].tolist(), place.tolist()):
            for item, offset in self.where[self.first[k] : self.first[k + 1]]:
                length = len(self.block.words[item])
                pad = int(self.own[item] - self.needed[item]) // -GAP
                spans.setdefault(item, set()).add((max(0, p - offset - pad), min(len(ids), p - offset + length + pad)))
        found = []
        for item, windows in spans.items():
            best, last = None, (-1, -1)
            for start, end in sorted(windows):
                if end <= last[1]:
                    continue
                last = (start, end)
                got = self.align(item, ids[start:end])
                if got and (best is None or got[0] > best[0]):
                    best = (got[0], start + got[1], start + got[2])
            if best:
                found.append((self.block.items[item], best[0] / self.own[item], best[1], best[2]))
        return sorted(found)


def blocks(items: DataFrame, id_column: str, text: str, shortest: int, chars: int) -> Iterator[Block]:
    """The items in blocks of at most ``chars`` characters (or one item)."""
    held, total = [], 0
    chosen = items.where(F.col(text).isNotNull()).select(F.col(id_column).cast("long"), F.col(text).cast("string"))
    for item, body in chosen.toLocalIterator():
        if held and total + len(body) > chars:
            yield Block(held, shortest)
            held, total = [], 0
        held.append((item, body))
        total += len(body)
    if held:
        yield Block(held, shortest)


def numbered(docs: DataFrame, block: Block) -> DataFrame:
    """``doc_id`` and ``ids``, the numbers of the words of ``text`` in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(block.vocabulary)
        for group in groups_of(rows_of(batches, "doc_id", "text"), 1 << 20):
            bodies = [ids.of(body).astype(block.kind).tobytes() for _, body in group]
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in group], pa.int64()), pa.array(bodies, pa.binary())], names=["doc_id", "ids"])

    return docs.mapInArrow(run, "doc_id long, ids binary")


def rarest(block: Block, ids: DataFrame, threshold: float, least: int) -> list[np.ndarray]:
    """The places of each item that are searched: all but the ``least_kept`` - 1 whose seeds are commonest in ``ids``."""
    known = np.unique(np.concatenate([keys for keys, _ in block.seeds]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(known), np.int64)
        for (body,) in rows_of(batches, "ids"):
            _, place = hits(block.pairs(np.frombuffer(body, block.kind))[0], known)
            np.add.at(seen, place, 1)
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[some])], names=["seed", "n"])

    counts = ids.select("ids").mapInArrow(run, "seed long, n long")
    total = np.zeros(len(known), np.int64)
    for row in counts.groupBy("seed").agg(F.sum("n").alias("n")).toLocalIterator():  # at most the seeds of a block
        total[row.seed] = row.n
    places = []
    for (keys, at), words in zip(block.seeds, block.words):
        n = np.bincount(at, total[np.searchsorted(known, keys)], len(words) - 1)
        spared = least_kept(needed(len(words), threshold, least)) - 1
        places.append(np.sort(np.argsort(n, kind="stable")[: len(n) - spared]))
    return places


def contaminated(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", shortest: int = SHORTEST, threshold: float = THRESHOLD, least: int = LEAST_WORDS,
    chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per document and item found in it: ids, ``score`` (share of the item), ``first_word``, ``end_word``."""
    schema = "doc_id long, item_id long, score double, first_word long, end_word long"
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = None
    for block in blocks(items, item_id, item_text, shortest, chars):
        if not block.items:
            continue
        ids = written(numbered(slim, block))
        places = rarest(block, ids, threshold, least)

        def run(batches: Iterator[pa.RecordBatch], block=block, places=places) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, places, threshold, least)
            for doc, body in rows_of(batches, "doc_id", "ids"):
                if found := matcher.find(np.frombuffer(body, block.kind)):
                    columns = [[doc] * len(found), *zip(*found)]
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                                     names=["doc_id", "item_id", "score", "first_word", "end_word"])

        part = ids.mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def clean(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    shortest: int = SHORTEST, threshold: float = THRESHOLD, least: int = LEAST_WORDS, chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` without the documents in which an item is found; rows are filtered where they are, nothing is joined."""
    slim = docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    out = docs
    for block in blocks(items, item_id, item_text, shortest, chars):
        if not block.items:
            continue
        places = rarest(block, numbered(slim, block), threshold, least)

        def run(batches: Iterator[pa.RecordBatch], block=block, places=places) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, places, threshold, least)
            for batch in batches:
                bodies = batch.column(batch.schema.get_field_index(text))
                yield batch.filter(pa.array([not matcher.find(matcher.ids.of(b.as_py())) for b in bodies], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out


def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))

"""Removal of long repeated substrings by maximal repeats of a distributed suffix array.

A byte goes if it lies in a string of ``length`` bytes that also starts in a document of
lesser id. Every such string of a document is found through an anchor: the position in it
whose 16 bytes have the least hash, the same wherever the string occurs.

1. Documents are written once as compressed blocks of bounded size.
2. Blocks send the hashes of their anchors to buckets; the answer tells which anchors
   several documents have. An anchor is sent once per block, however often it occurs.
3. What stands around a shared anchor (all strings it is the anchor of, under twice
   ``length`` bytes) goes to the bucket of the anchor, each distinct piece once per block
   with its least document. If an anchor has more than ``HOT`` documents, its strings go one
   by one to the bucket of the string instead, so no bucket gets all that surrounds it.
4. A bucket builds an enhanced suffix array of its distinct pieces, apart from those that are the
   only one of their anchor and so share no string with another, and takes the maximal
   repeats with all their occurrences from its common-prefix interval tree. In each, all but
   the pieces of the least document are repeats of a lesser one. It answers each block with
   the least document of the piece and the strings in it that a still lesser one has.
5. Blocks take out what is covered and report on each document.

Buckets grow in number with the blocks, so the size of one stays. Hash collisions of
anchors bring more to compare, never a wrong answer: pieces are compared by their bytes.

Cases: a null text counts as empty; a document with a null id neither loses nor takes
anything; documents of equal id take nothing from each other; repeated rows are each
reported; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm.common import groups_of, read, rows_of, utf8, written
from netsift.llm.suffixes import maximal_repeats, words8

LENGTH = 50
GRAM = 16
BLOCK_CHARS = 6_000_000
HOT = 20_000
STRETCH = 1 << 14
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_NOBODY = np.iinfo(np.int64).max


def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unzip(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


def _table(rows: list[tuple], **kinds) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds.values())], names=list(kinds))


_INT, _BIN = pa.int64(), pa.binary()


def blocks(docs: DataFrame, id_column: str, text: str, chars: int) -> DataFrame:
    """``block, docs, sizes, data``: ids (null: the greatest number), byte counts and bytes of the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for group in groups_of(rows_of(batches, "id", "text"), chars):
            bodies = [utf8(t or "") for _, t in group]
            ids = np.array([_NOBODY if i is None else i for i, _ in group], np.int64)
            sizes = np.array([len(b) for b in bodies], np.int64)
            yield _table([(number, ids.tobytes(), sizes.tobytes(), _zip(b"".join(bodies)))], block=_INT, docs=_BIN, sizes=_BIN, data=_BIN)
            number += 1

    slim = docs.selectExpr(f"cast(`{id_column}` as long) id", f"cast(`{text}` as string) text")
    return slim.mapInArrow(run, "block long, docs binary, sizes binary, data binary")


class Block:
    """A block's documents with the anchors of all their strings of ``length`` bytes."""

    def __init__(self, docs: bytes, sizes: bytes, data: bytes, length: int):
        self.docs, self.sizes = np.frombuffer(docs, np.int64), np.frombuffer(sizes, np.int64)
        self.data = _unzip(data, np.uint8)
        self.ends = np.cumsum(self.sizes)
        self.length = length

    def runs(self) -> None:
        """Runs of neighbouring strings with one anchor: ``first`` string, how ``many``, ``hash``, document ``owner``."""
        n = len(self.data) - self.length + 1
        empty = np.empty(0, np.int64)
        self.first, self.many, self.owner, self.hash = empty, empty, empty, empty.astype(np.uint64)
        if n < 1:
            return
        begins = np.unique(self.ends - self.sizes)
        firsts, hashes, last = [], [], None
        # stretches that the processor's cache holds
        for at in range(0, n, STRETCH):
            m = min(STRETCH, n - at)
            w = words8(self.data[at : at + m + self.length - 1])
            with np.errstate(over="ignore"):
                h = w[: len(w) - GRAM + 1] * _A + w[8 : len(w) - GRAM + 9] * _B
                h = (h ^ (h >> np.uint64(32))) * _A
                h ^= h >> np.uint64(29)
            least = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
            span, have = self.length - GRAM + 1, 1
            while have < span:
                step = min(have, span - have)
                least = np.minimum(least[:-step], least[step:])
                have += step
            anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
            new = np.append(anchor[0] + at != last, anchor[1:] != anchor[:-1])
            new[begins[slice(*np.searchsorted(begins, [at, at + m]))] - at] = True
            new = np.flatnonzero(new)
            firsts.append(new + at)
            hashes.append(h[anchor[new]])
            last = anchor[-1] + at
        first = np.concatenate(firsts)
        owner = np.searchsorted(self.ends, first, "right")
        many = np.minimum(np.append(first[1:], n), self.ends[owner] - self.length + 1) - first
        good = np.flatnonzero((many > 0) & (self.docs[owner] != _NOBODY))
        self.first, self.many, self.owner, self.hash = first[good], many[good], owner[good], np.concatenate(hashes)[good]

    def anchors(self, buckets: int):
        """Distinct anchors in order of (bucket, rest of the hash): where each bucket starts, rests, documents, and each run's anchor."""
        bucket, rest = self.hash % np.uint64(buckets), (self.hash // np.uint64(buckets)) & np.uint64(0xFFFFFFFF)
        key = bucket << np.uint64(32) | rest
        order = np.argsort(key, kind="stable")
        key, owner = key[order], self.owner[order]
        new = np.append(True, key[1:] != key[:-1])[: len(key)]
        number = np.cumsum(new) - 1
        where = np.empty(len(key), np.int64)
        where[order] = number
        key = key[new]
        # runs stand in order of documents, so those of one anchor do too
        docs = np.bincount(number[new | np.append(True, owner[1:] != owner[:-1])[: len(owner)]], minlength=len(key))
        starts = np.searchsorted(key, np.arange(buckets + 1).astype(np.uint64) << np.uint64(32))
        return starts, (key & np.uint64(0xFFFFFFFF)).astype(np.uint32), docs, where

    def pieces(self, shared: np.ndarray, hot: np.ndarray, buckets: int):
        """Distinct pieces around shared anchors, in order of buckets.

        Gives each bucket's start, the pieces, their least documents, a number that pieces of one
        anchor have in common (0 for single strings, which share nothing with another piece),
        and per run or single string (first string, how many, document, piece).
        """
        chosen = np.flatnonzero(shared)
        runs = [(f, m, o, int(h), False) for f, m, o, h, t in zip(
            self.first[chosen].tolist(), self.many[chosen].tolist(), self.owner[chosen].tolist(), self.hash[chosen].tolist(), hot[chosen].tolist(),
        ) if not t]
        for i in np.flatnonzero(shared & hot).tolist():
            for j in range(int(self.first[i]), int(self.first[i] + self.many[i])):
                runs.append((j, 1, int(self.owner[i]), 0, True))
        raw, known, docs, least, tags, places = self.data.tobytes(), {}, [], [], [], []
        ids = self.docs.tolist()
        for first, many, owner, h, single in runs:
            piece = raw[first : first + many + self.length - 1]
            key = (piece, single)
            number = known.setdefault(key, len(known))
            if number == len(docs):
                if single:
                    h = int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "big")
                tag = 0 if single else h & 0xFFFFFFFF or 1
                docs.append((h * 0x9E3779B97F4A7C15 >> 20) % (1 << 40) % buckets)
                least.append(ids[owner])
                tags.append(tag)
            elif ids[owner] < least[number]:
                least[number] = ids[owner]
            places.append((first, many, owner, number))
        bucket = np.array(docs, np.int64)
        order = np.argsort(bucket, kind="stable")
        turned = np.empty(len(order), np.int64)
        turned[order] = np.arange(len(order))
        names = [k[0] for k in known]
        places = np.array(places, np.int64).reshape(-1, 4)
        places[:, 3] = turned[places[:, 3]]
        starts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        return starts, [names[i] for i in order.tolist()], np.array(least, np.int64)[order], np.array(tags, np.uint32)[order], places


def _shared_anchors(cut: DataFrame, buckets: int, length: int) -> DataFrame:
    """``block, bucket, state`` for each block: 0, 1 (shared) or 2 (hot) per distinct anchor of that bucket."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, *columns in rows_of(batches, "block", "docs", "sizes", "data"):
            block = Block(*columns, length)
            block.runs()
            starts, rest, docs, _ = block.anchors(buckets)
            docs = np.minimum(docs, 65535).astype(np.uint16)
            yield _table([(b, number, _zip(rest[x:y].tobytes()), _zip(docs[x:y].tobytes()))
                          for b, (x, y) in enumerate(zip(starts.tolist(), starts[1:].tolist())) if y > x],
                         bucket=_INT, block=_INT, rest=_BIN, docs=_BIN)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(bucket, held):
            rests = [_unzip(r, np.uint32) for _, r, _ in held]
            n = np.concatenate([_unzip(d, np.uint16) for _, _, d in held])
            _, where = np.unique(np.concatenate(rests), return_inverse=True)
            total = np.bincount(where, n)
            state = (total > 1).astype(np.uint8) + (total > HOT)
            each = np.split(state[where], np.cumsum([len(r) for r in rests])[:-1])
            return _table([(number, bucket, _zip(s.tobytes())) for (number, _, _), s in zip(held, each)], block=_INT, bucket=_INT, state=_BIN)

        yield from _per_bucket(rows_of(batches, "bucket", "block", "rest", "docs"), done)

    sent = cut.mapInArrow(send, "bucket long, block long, rest binary, docs binary")
    placed = sent.repartition("bucket").sortWithinPartitions("bucket", "block")
    return placed.mapInArrow(answer, "block long, bucket long, state binary")


def _per_bucket(rows: Iterator[tuple], done) -> Iterator[pa.RecordBatch]:
    at, held = None, []
    for bucket, *row in rows:
        if bucket != at and held:
            yield done(at, held)
            held = []
        at = bucket
        held.append(row)
    if held:
        yield done(at, held)


def judged(pieces: list[bytes], docs: np.ndarray, length: int) -> np.ndarray:
    """For distinct pieces with their least documents: bit i is set if a lesser document has the string from byte i on."""
    masks = np.zeros(len(pieces), np.uint64)
    sizes = np.array([len(p) for p in pieces], np.int64)
    many = sizes - length + 1
    data = np.frombuffer(b"".join(pieces), np.uint8)
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(pieces)), many)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    starts = begin[owner] + offset
    for found, where in maximal_repeats(data, starts, (begin + sizes)[owner], begin[owner], length):
        who = owner[where]
        later = where[docs[who] > docs[who].min()]
        ones = np.uint64((1 << (found - length + 1)) - 1)
        np.bitwise_or.at(masks, owner[later], ones << offset[later].astype(np.uint64))
    return masks


def _compared_pieces(cut: DataFrame, shared: DataFrame, buckets: int, n_blocks: int, length: int) -> DataFrame:
    """``block, bucket, least, masks``: per piece of a block its least document anywhere, and the strings a lesser one has."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block, states, _ in _met(batches, length):
            _, _, _, where = block.anchors(buckets)
            state = np.concatenate(states) if states else np.empty(0, np.uint8)
            starts, pieces, docs, tags, _ = block.pieces(state[where] > 0, state[where] > 1, buckets)
            rows = []
            for b, (x, y) in enumerate(zip(starts.tolist(), starts[1:].tolist())):
                if y > x:
                    sizes = np.array([len(p) for p in pieces[x:y]], np.uint16)
                    rows.append((b, number, _zip(sizes.tobytes()), _zip(b"".join(pieces[x:y])), _zip(docs[x:y].tobytes()), tags[x:y].tobytes()))
            yield _table(rows, bucket=_INT, block=_INT, sizes=_BIN, data=_BIN, docs=_BIN, tags=_BIN)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(bucket, held):
            known: dict[bytes, int] = {}
            which, docs, groups = [], [], []
            for _, sizes, data, own, tags in held:
                raw, at, numbers = zstandard.ZstdDecompressor().decompress(data), 0, []
                columns = (_unzip(sizes, np.uint16), _unzip(own, np.int64), np.frombuffer(tags, np.uint32))
                for size, doc, tag in zip(*(c.tolist() for c in columns)):
                    number = known.setdefault(raw[at : at + size], len(known))
                    if number == len(docs):
                        docs.append(doc)
                        groups.append(tag)
                    elif doc < docs[number]:
                        docs[number] = doc
                    numbers.append(number)
                    at += size
                which.append(np.array(numbers, np.int64))
            least = np.array(docs, np.int64)
            _, where, often = np.unique(np.array(groups, np.uint32), return_inverse=True, return_counts=True)
            some = np.flatnonzero((often[where] > 1) & (np.array(groups) > 0))
            masks, pieces = np.zeros(len(known), np.uint64), list(known)
            if len(some):
                masks[some] = judged([pieces[i] for i in some.tolist()], least[some], length)
            return _table([(number, bucket, _zip(least[w].tobytes()), _zip(masks[w].tobytes())) for (number, *_), w in zip(held, which)],
                          block=_INT, bucket=_INT, least=_BIN, masks=_BIN)

        yield from _per_bucket(rows_of(batches, "bucket", "block", "sizes", "data", "docs", "tags"), done)

    sent = _meet(cut, n_blocks, shared).mapInArrow(send, "bucket long, block long, sizes binary, data binary, docs binary, tags binary")
    placed = sent.repartition("bucket").sortWithinPartitions("bucket", "block")
    return placed.mapInArrow(answer, "block long, bucket long, least binary, masks binary")


def _meet(cut: DataFrame, n_blocks: int, *answers: DataFrame) -> DataFrame:
    """Blocks behind the answers they got, one block after the other."""
    parts = cut.select("block", F.lit(9).alias("kind"), F.lit(0).cast("long").alias("bucket"), F.col("docs").alias("a"), F.col("sizes").alias("b"), F.col("data").alias("c"))
    for kind, got in enumerate(answers):
        rest = [F.col(c) for c in got.columns if c not in ("block", "bucket")]
        rest += [F.lit(None).cast("binary")] * (3 - len(rest))
        parts = parts.union(got.select("block", F.lit(kind), "bucket", *rest))
    return parts.repartition(max(1, n_blocks), "block").sortWithinPartitions("block", "kind", "bucket")


def _met(batches: Iterator[pa.RecordBatch], length: int):
    """(number, block with its runs, anchor states, piece answers) of each block."""
    states, pieces = [], []
    for number, kind, a, b, c in rows_of(batches, "block", "kind", "a", "b", "c"):
        if kind == 0:
            states.append(_unzip(a, np.uint8))
        elif kind == 1:
            pieces.append((_unzip(a, np.int64), _unzip(b, np.uint64)))
        else:
            block = Block(a, b, c, length)
            block.runs()
            yield number, block, states, pieces
            states, pieces = [], []


def removed(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH, chars: int = BLOCK_CHARS) -> DataFrame:
    """Per row: id, ``n_bytes``, the kept bytes, and the maximal removed runs as arrays of starts and ends."""
    if not GRAM <= length <= GRAM + 48:
        raise ValueError(f"length must be from {GRAM} to {GRAM + 48}")  # a piece's strings are the bits of one number
    cut = written(blocks(docs, id_column, text, chars))
    n_blocks = cut.count()
    buckets = max(8, n_blocks)
    shared = written(_shared_anchors(cut, buckets, length))
    answers = written(_compared_pieces(cut, shared, buckets, n_blocks, length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block, states, got in _met(batches, length):
            change = np.zeros(len(block.data) + 1, np.int64)
            if got:
                _, _, _, where = block.anchors(buckets)
                state = np.concatenate(states)
                *_, places = block.pieces(state[where] > 0, state[where] > 1, buckets)
                first, many, owner, piece = places.T
                least, masks = np.concatenate([g[0] for g in got])[piece], np.concatenate([g[1] for g in got])[piece]
                all_ = block.docs[owner] > least
                np.add.at(change, first[all_], 1)
                np.add.at(change, first[all_] + many[all_] - 1 + length, -1)
                part = ~all_ & (masks > 0)
                first, masks = first[part], masks[part]
                for i in range(int(many.max())):
                    at = first[(masks >> np.uint64(i) & np.uint64(1)).astype(bool)] + i
                    np.add.at(change, at, 1)
                    np.add.at(change, at + length, -1)
            gone = np.cumsum(change[:-1]) > 0
            rows, begin = [], 0
            for doc, end in zip(block.docs.tolist(), block.ends.tolist()):
                own = gone[begin:end]
                edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                rows.append((None if doc == _NOBODY else doc, end - begin, block.data[begin:end][~own].tobytes(), edges[::2].tolist(), edges[1::2].tolist()))
                begin = end
                if len(rows) == 2000:
                    yield _table(rows, **kinds)
                    rows = []
            yield _table(rows, **kinds)

    kinds = {"doc_id": _INT, "n_bytes": _INT, "kept": _BIN, "starts": pa.list_(_INT), "ends": pa.list_(_INT)}
    schema = "doc_id long, n_bytes long, kept binary, starts array<long>, ends array<long>"
    return _meet(cut, n_blocks, shared, answers).mapInArrow(run, schema)


def op2_repeated_substrings(spark: SparkSession, folder: str) -> DataFrame:
    done = removed(read(spark, folder, "documents"))
    return done.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )

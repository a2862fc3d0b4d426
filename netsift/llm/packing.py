"""Cost-balanced packing of tokenised documents into training sequences.

A document's ids (and one end id) are cut into pieces. Full pieces fill a sequence
each. The tails are packed by cost: the cost of a piece is linear plus quadratic in
its length, as attention within a document is; tails go, most costly first, to the
sequence of lowest cost that has room. A tail that fits nowhere whole is cut over the
sequences with most room, so each sequence of a window is full.

Work is per input partition, in windows of a bounded number of ids, without a shuffle:
memory does not depend on the data, and a partition computed again after a lost
executor gives the same rows. What is left of a window goes on to the next one; the
rest at the end of a partition is cut into sequences whose lengths are powers of two,
which need no padding.

Cases: a null text counts as empty and gives its end id alone; a null id stays null;
repeated rows are packed as often as they occur; an empty table gives no rows. Other
columns of the input are not read.
"""

from __future__ import annotations

import base64
import heapq
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from netsift.llm.common import groups_of, read, rows_of

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"
)
ARROW = pa.schema([(n, pa.float64() if n == "cost" else pa.int64()) for n in
                   ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "cost")])

# The characters with the Unicode property White_Space.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SPACES = re.compile(f"[{_SPACE}]")
# A space behind white space that is not the last of its run: the vocabulary's own split then
# does not start a piece there. Before any other space it does.
_INNER_SPACE = re.compile(f"[{_SPACE}] (?![^{_SPACE}])")
# Words of which no library disagrees about what is a letter: ASCII and Latin.
_PLAIN = re.compile("[!-~\u00a1-\u024f]+")
CACHED_UNITS = 800_000
CACHED_LENGTH = 100

_loaded: dict[tuple[str, str | None], Encoder] = {}


class Encoder:
    """Ids of texts. What stands between spaces is encoded once and remembered (speed only, same ids).

    ``ranks`` names the same vocabulary as a rank file; with it new plain words are encoded by
    a faster library, to the same ids.
    """

    def __init__(self, path: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}  # ids of a unit with the space before it, 32 bits each
        self.older: dict[str, bytes] = {}
        self.fast = None
        if ranks is not None:
            import tiktoken
            from public_tokenizers import PATTERN

            with open(ranks, "rb") as file:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        # a byte-level vocabulary writes each byte of a token as one character
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.n_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.n_bytes[i] = len(token)

    def plain(self, text: str) -> np.ndarray:
        # the same ids as encode(), without the offsets
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def learn(self, units: list[str]) -> None:
        """Encodes new units. Those that start and end with a word are encoded in one text, where they stay apart."""
        joined = []
        for unit in units:
            if unit in self.older:
                self.known[unit] = self.older[unit]
            elif unit and not _SPACES.match(unit) and not _SPACES.match(unit, len(unit) - 1):
                joined.append(unit)
            else:
                self.known[unit] = self.plain(f" {unit}").tobytes()
        if self.fast is not None:
            plain = [u for u in joined if _PLAIN.fullmatch(u)]
            self._take(plain, lambda text: np.array(self.fast.encode_ordinary(text), np.uint32))
            joined = [u for u in joined if u not in self.known]
        self._take(joined, self.plain)

    def _take(self, joined: list[str], encode: Callable[[str], np.ndarray]) -> None:
        """Encodes units in one text and cuts the ids by the bytes they stand for."""
        if joined:
            ids = encode(" " + " ".join(joined))
            ends = np.cumsum(self.n_bytes[ids])
            cuts = np.searchsorted(ends, np.cumsum([len(u.encode()) + 1 for u in joined])) + 1
            packed, start = ids.tobytes(), 0
            for unit, end in zip(joined, (4 * cuts).tolist()):
                self.known[unit] = packed[start:end]
                start = end

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, 32 bits each."""
        # special tokens may span what we take for units, so texts with such are encoded as they are
        whole = [any(s in t for s in self.special) or _INNER_SPACE.search(t) is not None for t in texts]
        split = [[] if w else t.split(" ") for t, w in zip(texts, whole)]
        first = [u.pop(0) if u else "" for u in split]
        units = set().union(*split)
        new = units - self.known.keys()
        if len(self.known) + len(new) > CACHED_UNITS:
            self.known, self.older, new = {}, self.known, units
        self.learn(list(new))
        get = self.known.__getitem__
        out = []
        for text, w, head, rest in zip(texts, whole, first, split):
            out.append(b"".join([self.plain(text if w else head).tobytes(), *map(get, rest)]))
        for unit in new:
            if len(unit) > CACHED_LENGTH:
                self.known.pop(unit, None)
        return out


def encoder(path: str, ranks: str | None = None) -> Encoder:
    """One encoder per Python worker."""
    if (path, ranks) not in _loaded:
        _loaded[path, ranks] = Encoder(path, ranks)
    return _loaded[path, ranks]


def attention_cost(length: int, linear: float, quadratic: float) -> float:
    return linear * length + quadratic * length * length


def balance(lengths: list[int], sequences: int, size: int, linear: float, quadratic: float):
    """Deals pieces of ``lengths`` to ``sequences`` of ``size`` ids.

    Gives (placed, left): ``placed`` has for each sequence the list of (piece, start in
    the piece, length), ``left`` the (piece, start, length) that found no room.
    """
    placed: list[list[tuple[int, int, int]]] = [[] for _ in range(sequences)]
    room = [size] * sequences
    costs = [0.0] * sequences
    heap = [(0.0, i) for i in range(sequences)]
    whole: list[int] = []
    for piece in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n, full = lengths[piece], []
        while heap and room[heap[0][1]] < n:
            full.append(heapq.heappop(heap))
        if heap:
            at = heap[0][1]
            placed[at].append((piece, 0, n))
            room[at] -= n
            costs[at] += attention_cost(n, linear, quadratic)
            heapq.heapreplace(heap, (costs[at], at))
        else:
            whole.append(piece)
        for entry in full:
            if room[entry[1]]:
                heapq.heappush(heap, entry)
    # nothing has room for these whole: cut them over the sequences with most room
    free = sorted((i for i in range(sequences) if room[i]), key=lambda i: (-room[i], i))
    left = []
    for piece in whole:
        start, n = 0, lengths[piece]
        while n and free:
            at = free[0]
            take = min(n, room[at])
            placed[at].append((piece, start, take))
            room[at] -= take
            start, n = start + take, n - take
            if not room[at]:
                free.pop(0)
        if n:
            left.append((piece, start, n))
    return placed, left


def powers(n: int) -> list[int]:
    """The powers of two that add up to ``n``, largest first."""
    return [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1]


class _Window:
    def __init__(self, size: int, linear: float, quadratic: float, first: int):
        self.size, self.linear, self.quadratic = size, linear, quadratic
        self.next = first
        self.pieces: list[tuple] = []  # (doc, its ids in all, start, ids)
        self.total = 0
        self.out: list[tuple] = []

    def place(self, parts: list[tuple]) -> None:
        at = 0
        for doc, tokens, start, ids in parts:
            self.out.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), tokens, self.next, at,
                             attention_cost(len(ids), self.linear, self.quadratic)))
            at += len(ids)
        self.next += 1

    def add(self, doc, ids: np.ndarray) -> None:
        n = len(ids)
        for start in range(0, n - n % self.size, self.size):
            self.place([(doc, n, start, ids[start : start + self.size])])
        if n % self.size:
            self.pieces.append((doc, n, n - n % self.size, ids[n - n % self.size :].copy()))
            self.total += n % self.size

    def pack(self) -> None:
        pieces = self.pieces
        placed, left = balance([len(p[3]) for p in pieces], self.total // self.size, self.size, self.linear, self.quadratic)
        cut = lambda i, a, n: (pieces[i][0], pieces[i][1], pieces[i][2] + a, pieces[i][3][a : a + n])
        for parts in placed:
            self.place([cut(*p) for p in parts])
        self.pieces = [cut(*p) for p in left]
        self.total = sum(n for _, _, n in left)

    def finish(self) -> None:
        self.pack()
        for size in powers(self.total):
            parts = []
            while size:
                doc, tokens, start, ids = self.pieces.pop()
                parts.append((doc, tokens, start, ids[:size]))
                if len(ids) > size:
                    self.pieces.append((doc, tokens, start + size, ids[size:]))
                size -= min(size, len(ids))
            self.place(parts)

    def rows(self) -> pa.RecordBatch:
        out, self.out = self.out, []
        return pa.RecordBatch.from_pylist([dict(zip(ARROW.names, r)) for r in out], schema=ARROW)


def pack(
    docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 0, linear: float = 1.0,
    quadratic: float = 1 / 1024, window: int = 1 << 20, id_column: str = "doc_id", text_column: str = "text",
    ranks: str | None = None,
) -> DataFrame:
    """One row per piece: its document, place in the document, checksum, sequence and place there.

    ``tokenizer`` is the path of a vocabulary file on every executor (``ranks`` of the same one
    as ranks, if there is one), ``window`` the number of ids of tails packed together. ``sequence_id`` holds the partition in its upper bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, ranks)
        end = np.array([end_id], np.uint32).tobytes()
        state = _Window(size, linear, quadratic, TaskContext.get().partitionId() << 33)
        for group in groups_of(rows_of(batches, "doc", "text"), 1 << 20):
            for (doc, _), ids in zip(group, encode.many([text or "" for _, text in group])):
                state.add(doc, np.frombuffer(ids + end, np.uint32))
                if state.total >= window:
                    state.pack()
            if len(state.out) >= 10_000:
                yield state.rows()
        state.finish()
        yield state.rows()

    needed = docs.selectExpr(f"cast(`{id_column}` as long) doc", f"cast(`{text_column}` as string) text")
    return needed.mapInArrow(run, SCHEMA)


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_cost_balanced_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), ranks=vocabulary("byte_bpe_50k.tiktoken"))

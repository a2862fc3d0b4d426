"""Adaptive context-mixing range coder for token ids.

Each id is predicted three times: by how often ids come in the block (order 0), by the id that
last followed the id before (order 1), and by the one that last followed the two ids before
(order 2). Order 0 is a distribution over the block's ids. Orders 1 and 2 predict one id each,
with a confidence that grows with hits; how often predictions of two such confidences were right
so far is their share in the mix. An id takes one step of a range coder with 64-bit bounds and
32-bit output: its part of the range is its order 0 part times the rest of the shares, before
which stands the share of each order that predicts it.

Order 0 is sent ahead, as the ids of the block and how often each comes. What they and their
cumulative sums say is exact: the order 0 parts of a block are scaled to ``1 << FREQ_BITS``, which
no block passes, so that every id that comes keeps a part, and the id at a place of the range is looked up.

A block is cut into up to ``LANES`` runs of ids that are coded side by side with one model, so
that each step is a few numpy calls over all lanes. A block starts from a fresh model and carries
checksums of its bytes and of its ids: it can be read alone. All figures are integers.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"CMI2"
BLOCK_IDS = 1 << 20
LANES = 4096
LEAST_LANE = 256
ID_BITS = 20
FREQ_BITS = 20  # order 0 parts of a block, in all
SHARE_BITS = 8  # steps of the share of order 0 in the mix
LEAST = 4  # share that order 0 keeps
SLOT_BITS = 16, 18  # predictions of orders 1 and 2 in a block
AGES = 1 << 14  # predictions after which those of a state count half
_HEAD = struct.Struct("<4sIIII")
_SUMS = struct.Struct("<II")

_U = np.uint64
_WORD, _LOW, _FIRST, _BITS = _U(32), _U(0xFFFFFFFF), _U(1 << 32), _U(FREQ_BITS + SHARE_BITS)
_A1, _A2 = np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
_SHIFTS = [np.uint32(32 - b) for b in SLOT_BITS]
_STATES = 128  # two confidences of three bits, and whether both orders name one id
_sure = np.arange(_STATES)
_one, _two, _same = _sure & 7, _sure >> 3 & 7, _sure >> 6
_FRESH = np.stack([8 - np.maximum(_one, _two), _one * (1 - _same) // 2, (1 - _same) * _two // 2, _same * np.maximum(_one, _two)], 1)
# confidence behind a miss and a hit, by the one before
_SURER = np.array([[max(1, s >> 1), min(7, s + 1)] for s in range(8)], np.int32).ravel()


class _Model:
    """What the lanes of a block have learned. ``ids`` are those that come, ``counts`` how often."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, lanes: int):
        ends = (np.cumsum(counts) << FREQ_BITS) // max(1, int(counts.sum()))
        sizes = np.diff(ends, prepend=0)
        # ids are known by their rank here
        self.ranks_at = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
        self.sizes, self.starts = sizes.astype(np.int32), (ends - sizes).astype(np.int32)
        self.hashed = (ids.astype(np.uint32) + np.uint32(1)) * _A1
        # a predicted rank, three bits of confidence; where nothing was seen, the commonest
        self.known = [np.full(1 << b, int(counts.argmax()) << 3, np.int32) for b in SLOT_BITS]
        self.one = self.two = np.zeros(lanes, np.uint32)
        # by state, how often neither, order 1, order 2 or both were right
        self.found = _FRESH.copy()
        self.steps = 0
        self.weigh()

    def weigh(self) -> None:
        """Shares of the orders, by state."""
        tried = self.found.sum(1)
        self.found[tried >= AGES] >>= 1
        _, one, two, both = self.found.T
        two = two + both
        right = one + two
        taken = np.minimum((right << SHARE_BITS) // (self.found.sum(1) + 1), (1 << SHARE_BITS) - LEAST)
        first = (taken << FREQ_BITS) * one // np.maximum(right, 1)
        self.shares = [q.astype(np.int32) for q in ((1 << SHARE_BITS) - taken, first, (taken << FREQ_BITS) - first)]

    def predict(self, k: int) -> None:
        """Starts an id in each of the first ``k`` lanes."""
        one = self.one[:k]
        mixed = self.two[:k] * _A2
        mixed += one
        mixed ^= mixed >> np.uint32(15)
        mixed *= _A2
        self.slots = [(one >> _SHIFTS[0]).astype(np.int64), (mixed >> _SHIFTS[1]).astype(np.int64)]
        self.came = c1, c2 = [t.take(s, mode="clip") for t, s in zip(self.known, self.slots)]
        self.named = p1, p2 = c1 >> 3, c2 >> 3
        self.sure = s1, s2 = c1 & 7, c2 & 7
        state = (p1 == p2).view(np.int8) * np.int64(8)
        state += s2
        state <<= 3
        state += s1
        self.state = state
        self.q = [q.take(state, mode="clip") for q in self.shares]

    def find(self, value: np.ndarray) -> np.ndarray:
        """The ranks in whose parts of the mixed distribution ``value`` lies."""
        q0, q1, q2 = self.q
        p1, p2 = self.named
        later = p2 < p1
        past1 = self.starts.take(p1, mode="clip")
        past1 *= q0
        past1 += q2 * later
        np.subtract(value, past1, out=past1)
        past2 = self.starts.take(p2, mode="clip")
        past2 *= q0
        past2 += q1 * (p1 < p2)
        np.subtract(value, past2, out=past2)
        # what lies in the share of a prediction is brought to the start of its order 0 part
        value = value - np.minimum(np.maximum(past1, 0, out=past1), q1, out=past1)
        value -= np.minimum(np.maximum(past2, 0, out=past2), q2, out=past2)
        return self.ranks_at.take((value / q0).astype(np.int64), mode="clip")  # quotients of doubles are exact here

    def close(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the ranks' parts; the model learns them."""
        q0, q1, q2 = self.q
        p1, p2 = self.named
        hit1, hit2 = rank == p1, rank == p2
        start = self.starts.take(rank, mode="clip")
        start *= q0
        start += q1 * (p1 < rank)
        start += q2 * (p2 < rank)
        size = self.sizes.take(rank, mode="clip")
        size *= q0
        size += q1 * hit1
        size += q2 * hit2
        for known, at, named, sure, hit in zip(self.known, self.slots, self.named, self.sure, (hit1, hit2)):
            # an unsure prediction that was wrong gives way
            now = named - rank
            now *= sure > 1
            now += rank
            now <<= 3
            sure <<= 1
            sure += hit
            now += _SURER.take(sure, mode="clip")
            known[at] = now  # where lanes share a slot, the last one counts
        state = self.state
        state <<= 1
        state += hit2
        state <<= 1
        state += hit1
        self.found += np.bincount(state, minlength=4 * _STATES).reshape(-1, 4)
        self.steps += 1
        if self.steps < 16 or self.steps % 4 == 0:
            self.weigh()
        self.two = self.one
        self.one = self.hashed.take(rank, mode="clip")
        return start.astype(_U), size.astype(_U)


def _lanes(n: int) -> tuple[int, int]:
    """Lanes of a block of ``n`` ids and their length; only the last may be shorter."""
    length = max(LEAST_LANE, -(-n // LANES))
    return -(-n // length), length


def _planes(numbers: np.ndarray) -> bytes:
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def encode_block(ids: np.ndarray) -> bytes:
    """The bytes of a block of ids."""
    ids = np.asarray(ids, np.uint32)
    if len(ids) > 1 << FREQ_BITS:
        raise ValueError(f"a block has at most {1 << FREQ_BITS} ids")
    if int(ids.max(initial=0)) >> ID_BITS:
        raise ValueError(f"ids are below 2 ** {ID_BITS}")
    n, (lanes, length) = len(ids), _lanes(len(ids))
    counts = np.bincount(ids, minlength=1)
    listed = np.flatnonzero(counts)
    words, filled = np.zeros((lanes, 2 + length), _U), np.zeros(lanes, np.int64)
    if n:
        rank = np.zeros(len(counts), np.int64)
        rank[listed] = np.arange(len(listed))
        ranks = np.zeros(lanes * length, np.int32)
        ranks[:n] = rank[ids]
        ranks = np.ascontiguousarray(ranks.reshape(lanes, length).T)
        model = _Model(listed, counts[listed], lanes)
        low, room = np.zeros(lanes, _U), np.full(lanes, 2**64 - 1, _U)
        # a word for what comes before the first, so that carries always have a place
        place, flat = np.arange(lanes) * words.shape[1], words.ravel()
        last = n - (lanes - 1) * length
        for t in range(length if lanes > 1 else last):
            k = lanes - (t >= last)
            model.predict(k)
            start, size = model.close(ranks[t, :k])
            unit = room[:k] >> _BITS
            start *= unit
            before = low[:k]
            now = before + start
            over = np.flatnonzero(now < before)
            if len(over):
                flat[place[over]] += _U(1)
            size *= unit
            low[:k], room[:k] = now, size
            full = np.flatnonzero(size < _FIRST)
            if len(full):
                place[full] += 1
                moved = now[full]
                flat[place[full]] = moved >> _WORD
                low[full] = moved << _WORD
                room[full] = size[full] << _WORD
        end = low + _LOW
        flat[place[end < low]] += _U(1)
        place += 1
        flat[place] = end >> _WORD
        filled = place - np.arange(lanes) * words.shape[1]
        for at in range(words.shape[1] - 1, 0, -1):
            words[:, at - 1] += words[:, at] >> _WORD
    out = words[:, 1:].astype("<u4")
    table = zlib.compress(b"".join(map(_planes, (np.diff(listed, prepend=0), counts[listed], filled))), 6)
    body = table + out[np.arange(out.shape[1]) < filled[:, None]].tobytes()
    head = _HEAD.pack(MAGIC, n, len(listed), len(table), len(body))
    return head + _SUMS.pack(zlib.crc32(body, zlib.crc32(head)), zlib.crc32(ids.astype("<u4").tobytes())) + body


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """The bytes of each block of ids."""
    return [encode_block(ids) for ids in blocks]


HEAD_BYTES = _HEAD.size + _SUMS.size


def block_size(head: bytes) -> int:
    """Bytes of the block that starts with ``head`` (``HEAD_BYTES`` of it)."""
    magic, _, _, _, size = _HEAD.unpack(head[: _HEAD.size])
    if magic != MAGIC:
        raise ValueError("no block of ids starts here")
    return HEAD_BYTES + size


def decode_block(data: bytes) -> np.ndarray:
    """The ids of a block; raises ValueError where a checksum is wrong."""
    magic, n, n_listed, n_table, n_body = _HEAD.unpack(data[: _HEAD.size])
    body_sum, ids_sum = _SUMS.unpack(data[_HEAD.size : HEAD_BYTES])
    body = data[HEAD_BYTES : HEAD_BYTES + n_body]
    if magic != MAGIC or len(body) != n_body or zlib.crc32(body, zlib.crc32(data[: _HEAD.size])) != body_sum:
        raise ValueError("damaged block of ids")
    lanes, length = _lanes(n)
    table = np.frombuffer(zlib.decompress(body[:n_table]), np.uint8)
    listed, counts = _numbers(table[: 4 * n_listed]).cumsum(), _numbers(table[4 * n_listed : 8 * n_listed])
    filled = _numbers(table[8 * n_listed :])
    ranks = np.zeros((length, lanes), np.int32)
    if n:
        # zeros behind the words of a lane
        words = np.zeros((lanes, int(filled.max()) + 3), _U)
        words[np.arange(words.shape[1]) < filled[:, None]] = np.frombuffer(body, "<u4", offset=n_table) if n_table % 4 == 0 else np.frombuffer(body[n_table:], "<u4")
        flat, place = words.ravel(), np.arange(lanes) * words.shape[1] + 2
        left, room = (words[:, 0] << _WORD) | words[:, 1], np.full(lanes, 2**64 - 1, _U)
        model = _Model(listed, counts, lanes)
        last = n - (lanes - 1) * length
        for t in range(length if lanes > 1 else last):
            k = lanes - (t >= last)
            model.predict(k)
            unit = room[:k] >> _BITS
            value = np.minimum(left[:k] // unit, _U((1 << FREQ_BITS + SHARE_BITS) - 1))
            ranks[t, :k] = rank = model.find(value.astype(np.int32))
            start, size = model.close(rank)
            start *= unit
            left[:k] -= start
            size *= unit
            room[:k] = size
            full = np.flatnonzero(size < _FIRST)
            if len(full):
                at = place[full]
                left[full] = (left[full] << _WORD) | flat.take(at, mode="clip")
                room[full] = size[full] << _WORD
                place[full] = at + 1
    got = listed[ranks.T.ravel()[:n]].astype(np.uint32)
    if zlib.crc32(got.astype("<u4").tobytes()) != ids_sum:
        raise ValueError("ids of a block do not match their checksum")
    return got


def decode(blocks: list[bytes]) -> list[np.ndarray]:
    """The ids of each block."""
    return [decode_block(data) for data in blocks]

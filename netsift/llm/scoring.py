"""Language-model scores of documents: context mixing, refined by each document itself.

1. Documents are tokenised once into blocks of a bounded size: the block's distinct words,
   and the documents as numbers of them. All later steps read the blocks.
2. Each block sends its distinct words and heads (see ``mixing``), with how often they occur in
   training documents, to buckets by hash. A bucket adds up: there each word and head of the
   corpus is once, however many blocks have it. A frequent word costs one entry per block.
3. The model: buckets send the keys of their coded bytes, each once with its count, to ranges of
   the key space. A range adds them up and answers each bucket with the counts of all bit nodes
   on its keys' paths. There is no table of fixed size: contexts do not share slots, and what
   is learned grows with the input. Nothing of it passes through the driver or a broadcast.
4. Gate weights: each bucket works out gradient and curvature of its training occurrences,
   Spark adds them up, the driver takes a Newton step on 16 times 5 numbers. So the model does not
   depend on how rows fall to tasks (but for the last digits, by the order of additions).
5. Buckets answer blocks with total and cost per word and head. A token's probability is the
   model's, mixed with how often the document itself had the word so far; the share of that
   grows with the document.

Messages hold at least one word or key each, and each word of a block or key of a bucket is in one:
their number is at most linear in the input, and far smaller as long as a bucket takes many words of a block.

Cases: a null or empty text is the end token alone; rows with a null id are training rows
(held out is false); repeated rows are each scored; with no training tokens all predictions
are even; an empty table gives no rows; other columns are not read. A block ends with the text
that fills it: a very long text is a block of its own, held by one task at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm import mixing
from netsift.llm.common import groups_of, read, rows_of, utf8, written
from netsift.llm.languages import fold

BLOCK_CHARS = 6_000_000
# Words and heads of blocks, one entry per block, that a bucket gets on average.
BUCKET_ENTRIES = 1_000_000
# What a worker gets and gives at once, or a message that is larger.
BATCH_BYTES = 1 << 22
STEPS = 2
CACHE_SHARE, CACHE_HALF = 0.3, 300.0
_BLOCK = "block long, docs binary, words binary, tokens binary, sizes binary, training binary, n_docs long, n_training long, n_words long"


def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unzip(data: bytes, dtype=None):
    raw = zstandard.ZstdDecompressor().decompress(data)
    return raw if dtype is None else np.frombuffer(raw, dtype)


def blocks(docs: DataFrame, id_column: str, text: str, held_out: Column, chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents as blocks: ids, distinct words, word numbers of all documents, tokens per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for group in groups_of(rows_of(batches, "id", "text", "held_out"), chars):
            known: dict[bytes, int] = {mixing.END: 0}
            tokens, sizes = [], []
            for _, body, _ in group:
                # bytes.lower and bytes.split know A-Z and the six white-space bytes only, as wanted here
                found = utf8(body or "").lower().split()
                ids = np.fromiter((known.setdefault(w, len(known)) for w in found), np.uint32, len(found))
                tokens += [ids, np.zeros(1, np.uint32)]
                sizes.append(len(found) + 1)
            training = np.array([not h for _, _, h in group])
            sizes = np.array(sizes, np.int64)
            # a null id is kept as a number that is marked in a second array
            ids = [np.array([i or 0 for i, _, _ in group], np.int64), np.array([i is None for i, _, _ in group])]
            yield pa.RecordBatch.from_pylist([{
                "block": number, "docs": ids[0].tobytes() + ids[1].tobytes(), "words": _zip(b" ".join(known)),
                "tokens": _zip(np.concatenate(tokens).tobytes()), "sizes": sizes.tobytes(), "training": training.tobytes(),
                "n_docs": len(group), "n_training": int(sizes[training].sum()), "n_words": len(known),
            }], schema=pa.schema([("block", pa.int64()), *((n, pa.binary()) for n in ("docs", "words", "tokens", "sizes", "training")),
                                  ("n_docs", pa.int64()), ("n_training", pa.int64()), ("n_words", pa.int64())]))
            number += 1

    slim = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("string").alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    return slim.mapInArrow(run, _BLOCK)


class Block:
    def __init__(self, docs, words, tokens, sizes, training):
        self.sizes, self.training = np.frombuffer(sizes, np.int64), np.frombuffer(training, bool)
        n = len(self.sizes)
        self.docs, self.null = np.frombuffer(docs[: 8 * n], np.int64), np.frombuffer(docs[8 * n :], bool)
        self.words, self.tokens = _unzip(words).split(b" "), _unzip(tokens, np.uint32).astype(np.int64)
        self.owner = np.repeat(np.arange(n), self.sizes)

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))

    def counts(self) -> np.ndarray:
        """Training count of each word."""
        return np.bincount(self.tokens[self.training[self.owner]], minlength=len(self.words))

    def heads(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct heads: last two bytes of the word before and first two of the word, as a number. Their training
        counts, and which one each token has."""
        ends = np.fromiter((int.from_bytes((b"  " + w)[-2:], "big") for w in self.words), np.uint32, len(self.words))
        starts = np.fromiter((int.from_bytes((w + b" ")[:2], "big") for w in self.words), np.uint32, len(self.words))
        before = np.concatenate([np.zeros(1, np.uint32), ends[self.tokens[:-1]]])
        before[np.cumsum(self.sizes) - self.sizes] = 0x2020
        heads, where = np.unique(before << np.uint32(16) | starts[self.tokens], return_inverse=True)
        return heads, np.bincount(where, self.training[self.owner], len(heads)).astype(np.int64), where


def _split(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by (bucket, hash), and where each bucket starts in it; buckets are ranges of hashes."""
    order = np.argsort(hashes, kind="stable")
    return order, _starts(hashes[order], buckets)


def _starts(ordered: np.ndarray, buckets: int) -> np.ndarray:
    """Where each of ``buckets`` (a power of two) equal ranges of 64-bit numbers starts among ordered ones."""
    bounds = np.arange(buckets, dtype=np.uint64) << np.uint64(65 - buckets.bit_length())
    return np.append(np.searchsorted(ordered, bounds), len(ordered))


def _spread(heads: np.ndarray) -> np.ndarray:
    """Heads as 64-bit hashes, one to one."""
    with np.errstate(over="ignore"):
        mixed = (heads.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


_UNITS = "bucket long, block long, words binary, counts binary, heads binary, head_counts binary, v long, n long"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}
    named = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[k]) for c, (_, k) in zip(zip(*rows), named)],
                                      names=[name for name, _ in named])


def _batches(rows: Iterator[tuple], schema: str, size: int = 256) -> Iterator[pa.RecordBatch]:
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += sum(len(part) for v in row for part in (v if isinstance(v, list) else [v]) if isinstance(part, bytes))
        if len(held) >= size or total > BATCH_BYTES:
            yield _batch(held, schema)
            held, total = [], 0
    if held:
        yield _batch(held, schema)


def _units(cut: DataFrame, buckets: int) -> DataFrame:
    """Per bucket its distinct words and heads with training counts (``block`` null), ``v`` and ``n`` of its words;
    per bucket and block which of them the block's are, in the order of ``_split``."""
    message = "bucket long, block long, hashes binary, counts binary, words binary, heads binary, head_counts binary"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for number, *columns in rows_of(batches, "block", "docs", "words", "tokens", "sizes", "training"):
                block = Block(*columns)
                counts, hashes = block.counts(), block.hashes()
                order, starts = _split(hashes, buckets)
                heads, head_counts, _ = block.heads()
                head_order, head_starts = _split(_spread(heads), buckets)
                for b in range(buckets):
                    o, h = order[starts[b] : starts[b + 1]], head_order[head_starts[b] : head_starts[b + 1]]
                    if len(o) or len(h):
                        yield (b, number, hashes[o].tobytes(), _zip(counts[o].tobytes()), _zip(b" ".join([block.words[i] for i in o])),
                               _zip(heads[h].tobytes()), _zip(head_counts[h].tobytes()))

        return _batches(rows(), message)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(ids, counts):
            total, first, where = np.unique(np.concatenate(ids), return_index=True, return_inverse=True)
            n = np.bincount(where, np.concatenate(counts), len(total)).astype(np.int64)
            return total, first, n, np.split(where.astype(np.uint32), np.cumsum([len(i) for i in ids])[:-1])

        def done(bucket, held):
            _, first, n, places = summed([np.frombuffer(m[1], np.uint64) for m in held], [_unzip(m[2], np.int64) for m in held])
            words = b" ".join(w for m in held if (w := _unzip(m[3]))).split(b" ") if len(first) else []
            heads, _, head_n, head_places = summed([_unzip(m[4], np.uint32) for m in held], [_unzip(m[5], np.int64) for m in held])
            yield (bucket, None, _zip(b" ".join([words[i] for i in first])), _zip(n.tobytes()), _zip(heads.tobytes()),
                   _zip(head_n.tobytes()), int((n > 0).sum()), int(n.sum()))
            for m, place, head_place in zip(held, places, head_places):
                yield bucket, m[0], _zip(place.tobytes()), None, _zip(head_place.tobytes()), None, 0, 0

        return _batches(_grouped(batches, done, message), _UNITS)

    sent = cut.mapInArrow(send, message).repartition(buckets, "bucket").sortWithinPartitions("bucket", "block")
    return sent.mapInArrow(gather, _UNITS)


def _grouped(batches: Iterator[pa.RecordBatch], done, schema: str):
    """``done(first column, other columns of all its rows)`` for rows that come ordered by the first column."""
    at, held = None, []
    for first, *others in rows_of(batches, *[c.split()[0] for c in schema.split(", ")]):
        if first != at and held:
            yield from done(at, held)
            held = []
        at = first
        held.append(others)
    if held:
        yield from done(at, held)


def _of(row) -> mixing.Units:
    """The units of a bucket from its columns words, counts, heads, head_counts."""
    words, counts, heads, head_counts = (_unzip(c) for c in row)
    return mixing.Units(np.frombuffer(heads, np.uint32), np.frombuffer(head_counts, np.int64),
                        words.split(b" ") if words else [], np.frombuffer(counts, np.int64))


_TABLES = [f"{name}{k}" for k in range(mixing.CONTEXTS) for name in ("nodes", "places")]


def _learned(units: DataFrame, buckets: int) -> DataFrame:
    """Per bucket its units and, per context, the counts of the bit nodes of its keys and which key each coded byte has.

    The counts stay as the ranges sent them, one part per range."""
    asked = "span long, context long, bucket long, ids binary, counts binary"
    answered = "bucket long, context long, span long, nodes binary"
    schema = "bucket long, words binary, counts binary, heads binary, head_counts binary, " + ", ".join(
        f"{c} array<binary>" if c.startswith("nodes") else f"{c} binary" for c in _TABLES)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for bucket, *columns in rows_of(batches, "bucket", "words", "counts", "heads", "head_counts"):
                for k, (keys, counts, _) in enumerate(_of(columns).keys()):
                    starts = _starts(keys, buckets)
                    for span in range(buckets):
                        part = slice(starts[span], starts[span + 1])
                        if part.start < part.stop:
                            yield span, k, bucket, keys[part].tobytes(), _zip(counts[part].tobytes())

        return _batches(rows(), asked)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(span, held):
            for k in range(mixing.CONTEXTS):
                some = [m for m in held if m[0] == k]
                if not some:
                    continue
                found = [np.frombuffer(m[2], np.uint64) for m in some]
                keys, where = mixing.distinct(np.concatenate(found))
                nodes = mixing.node_sums(keys, np.bincount(where, np.concatenate([_unzip(m[3], np.int64) for m in some]), len(keys)).astype(np.int64))
                for m, place in zip(some, np.split(where, np.cumsum([len(f) for f in found])[:-1])):
                    # columns of equal depth side by side compress well
                    yield m[1], k, span, _zip(np.ascontiguousarray(nodes[place].T).tobytes())

        return _batches(_grouped(batches, done, asked), answered)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(bucket, held):
            nodes = [[] for _ in range(mixing.CONTEXTS)]
            for context, _, data, *columns in held:
                if context < mixing.CONTEXTS:
                    nodes[context].append(data)
                    continue
                tables = []
                for k, (_, _, where) in enumerate(_of(columns).keys()):
                    tables += [nodes[k], _zip(where.tobytes())]
                yield (bucket, *columns, *tables)

        return _batches(_grouped(batches, done, both), schema)

    both = answered + ", words binary, counts binary, heads binary, head_counts binary"
    sums = units.mapInArrow(ask, asked).repartition(buckets, "span").sortWithinPartitions("span", "context", "bucket").mapInArrow(answer, answered)
    own = units.select("bucket", F.lit(mixing.CONTEXTS).cast("long").alias("context"), F.lit(0).cast("long").alias("span"), "words", "counts", "heads", "head_counts")
    placed = sums.unionByName(own, allowMissingColumns=True).repartition(buckets, "bucket")
    return placed.sortWithinPartitions("bucket", "context", "span").mapInArrow(join, schema)


def _predictor(tables: list, head_bytes: int, without: int) -> mixing.Predictor:
    none = np.zeros((0, 9), np.int64)
    nodes = (chain([none], (_unzip(part, np.int64).reshape(9, -1).T for part in t)) for t in tables[::2])
    return mixing.Predictor(nodes, [_unzip(t, np.uint32) for t in tables[1::2]], head_bytes, without)


def _weights(learned: DataFrame, steps: int) -> np.ndarray:
    """Gate weights after that many Newton steps over all training occurrences."""
    weights = mixing.first_weights()
    width = mixing.CONTEXTS * (1 + mixing.CONTEXTS)

    def slopes(batches: Iterator[pa.RecordBatch], weights) -> Iterator[pa.RecordBatch]:
        for words, counts, heads, head_counts, *tables in rows_of(batches, "words", "counts", "heads", "head_counts", *_TABLES):
            units = _of((words, counts, heads, head_counts))
            found = mixing.gradients(units.often, _predictor(tables, units.head_bytes, 1), weights)
            yield pa.RecordBatch.from_arrays([pa.array(range(mixing.GATES), pa.int64()), pa.array(found.tolist(), pa.list_(pa.float64()))], names=["gate", "g"])

    for _ in range(steps):
        found = learned.mapInArrow(lambda batches, w=weights: slopes(batches, w), "gate long, g array<double>")
        sums = found.groupBy("gate").agg(*[F.sum(F.col("g")[i]).alias(f"g{i}") for i in range(width)])
        summed = np.zeros((mixing.GATES, width))
        for row in sums.collect():  # a row per gate, 16 at most
            summed[row[0]] = row[1:]
        weights = mixing.step(weights, summed)
    return weights


def _costs(learned: DataFrame, weights: np.ndarray) -> DataFrame:
    """Per bucket: training counts and costs of its words, costs of its heads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for bucket, words, counts, heads, head_counts, *tables in rows_of(batches, "bucket", "words", "counts", "heads", "head_counts", *_TABLES):
                units = _of((words, counts, heads, head_counts))
                found = mixing.costs(units.owner, sum(units.sizes), _predictor(tables, units.head_bytes, 0), weights)
                yield bucket, None, counts, found[units.sizes[0] :].tobytes(), found[: units.sizes[0]].tobytes()

        return _batches(rows(), _COSTS)

    return learned.mapInArrow(run, _COSTS)


_COSTS = "bucket long, block long, counts binary, costs binary, head_costs binary"


def _answers(units: DataFrame, costs: DataFrame, buckets: int) -> DataFrame:
    """Per block and bucket: counts and costs of the block's words, costs of its heads, in the order of ``_split``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held = None
            for bucket, block, counts, own, heads in rows_of(batches, "bucket", "block", "counts", "costs", "head_costs"):
                if block is None:  # first of its bucket
                    held = _unzip(counts, np.int64), np.frombuffer(own, np.float64), np.frombuffer(heads, np.float64)
                    continue
                place, head_place = _unzip(own, np.uint32), _unzip(heads, np.uint32)
                yield bucket, block, _zip(held[0][place].tobytes()), held[1][place].tobytes(), held[2][head_place].tobytes()

        return _batches(rows(), _COSTS)

    places = units.where("block is not null").select("bucket", "block", F.lit(None).cast("binary").alias("counts"),
                                                     F.col("words").alias("costs"), F.col("heads").alias("head_costs"))
    placed = costs.unionByName(places).repartition(buckets, "bucket").sortWithinPartitions("bucket", F.col("block").asc_nulls_first())
    return placed.mapInArrow(run, _COSTS)


def _repeats(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """For each token how often its document had the word before it, and its place in the document."""
    key = block.owner * len(block.words) + block.tokens
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    rank = np.empty(len(key), np.int64)
    rank[order] = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
    return rank, np.arange(len(key)) - np.repeat(np.cumsum(block.sizes) - block.sizes, block.sizes)


def score(
    docs: DataFrame, held_out: Column, id_column: str = "doc_id", text: str = "text",
    block_chars: int = BLOCK_CHARS, bucket_entries: int = BUCKET_ENTRIES, steps: int = STEPS,
) -> DataFrame:
    """Per row: id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``bits_per_byte``."""
    with _short_batches(docs.sparkSession):
        return written(_scored(docs, held_out, id_column, text, block_chars, bucket_entries, steps))


@contextmanager
def _short_batches(spark: SparkSession) -> Iterator[None]:
    """Meanwhile workers get rows of ``BATCH_BYTES`` at once, or one; else all of a task's messages, a copy on each side."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(name, None)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)


def _scored(docs: DataFrame, held_out: Column, id_column: str, text: str, block_chars: int, bucket_entries: int, steps: int) -> DataFrame:
    cut = written(blocks(docs, id_column, text, held_out, block_chars))
    n_blocks, entries = cut.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    buckets = 1 << max(4, (2 * entries // bucket_entries).bit_length())  # about as many heads as words
    units = written(_units(cut, buckets))
    v, n = units.agg(F.coalesce(F.sum("v"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    learned = written(_learned(units.where("block is null"), buckets))
    costs = _costs(learned, _weights(learned, steps))
    answers = _answers(units, costs, buckets).select("block", F.lit(0).alias("kind"), "bucket", F.col("counts").alias("docs"), F.col("costs").alias("words"), F.col("head_costs").alias("tokens"))
    asked = cut.select("block", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("bucket"), "docs", "words", "tokens", "sizes", "training")
    placed = asked.unionByName(answers, allowMissingColumns=True).repartition(max(1, n_blocks), "block")
    placed = placed.sortWithinPartitions("block", "kind", "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for kind, *columns in rows_of(batches, "kind", "docs", "words", "tokens", "sizes", "training"):
            if kind == 0:
                held.append((_unzip(columns[0], np.int64), np.frombuffer(columns[1]), np.frombuffer(columns[2])))
                continue
            block = Block(*columns)
            heads, _, where = block.heads()
            count, rest, head_cost = np.empty(len(block.words), np.int64), np.empty(len(block.words)), np.empty(len(heads))
            order = _split(block.hashes(), buckets)[0]
            count[order], rest[order], head_cost[_split(_spread(heads), buckets)[0]] = (np.concatenate(c) for c in zip(*held))
            held = []
            own = head_cost[where] + rest[block.tokens]
            before, place = _repeats(block)
            share = CACHE_SHARE * place / (place + CACHE_HALF)
            mixed = np.logaddexp(own + np.log1p(-share), np.log(np.maximum(share * before / np.maximum(place, 1), 1e-300)))
            each = lambda values: np.bincount(block.owner, values, len(block.sizes))
            c = count[block.tokens]
            base = each(np.log10((count + 1) / (n + 1 * (v + 1)))[block.tokens])
            total = each(mixed) / np.log(10)
            lengths = each(np.fromiter(map(len, block.words), np.int64, len(block.words))[block.tokens] + 1)
            yield pa.RecordBatch.from_arrays([
                pa.array(block.docs, mask=block.null), pa.array(~block.training), pa.array(block.sizes),
                pa.array(each((c > 0).astype(float)).astype(np.int64)), pa.array(np.full(len(base), n, np.int64)),
                pa.array(base), pa.array(total), pa.array(-total * np.log2(10) / lengths),
            ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    return placed.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                  "base_score double, score double, bits_per_byte double")


def op6_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return score(read(spark, folder, "documents"), fold("doc_id", 7) == 2)

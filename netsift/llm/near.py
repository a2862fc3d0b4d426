"""Near-duplicate documents: DartMinHash bands, verified pairs, connected components.

Documents are multisets of five-word shingles; two are linked if their weighted Jaccard
similarity is ``threshold`` or more, and a class is what links connect.

1. One pass over the text gives each document a hash of its words, its number of shingles
   and its band keys. Documents of equal words are one from here on, the one of least id.
2. A bucket holds the documents that share a band key. Only keys that several documents have
   are kept. In the first bands all documents of a bucket are compared with its least one,
   the leader; links make components. From then on only buckets of several components
   count, each set of documents once, however many bands show it.
3. Those are compared across components, every pair, inside tasks: a bucket is dealt to
   blocks of a bounded number of documents and of shingles, and a cell of two blocks gets
   the texts of both. It counts the shingles that its documents have in common for all pairs
   at once and gives only links that join components, fewer than it has documents. So no
   link that the buckets can show is missed, and no row is made per pair.
4. Each pair is judged on the texts. Members of one leader are dealt to parts of a
   bounded size, and each part streams through a task behind the leader's text.

A text is sent to a cell for each block of its bucket: once, unless the bucket holds more
than ``BLOCK`` documents. Larger ones cost their square over that, spread over the cells.

With 40 bands of 7 rows a pair of similarity 0.8 shares a bucket with probability 0.9999,
one of 0.9 with all but 1e-11, one of 0.3 with 0.01.

Cases: documents without a word (null, empty) and those with a null id are classes of
their own; texts of under five words are near only to equal ones; repeated ids count as
one document, which is linked with what any of its texts is linked with; an empty table
gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm import darts
from netsift.llm.common import groups_of, read, rows_of, utf8, words, written
from netsift.llm.components import components

SHINGLE = 5
BANDS, ROWS = 40, 7
FIRST = 8
THRESHOLD = 0.8
# Members verified against one leader in one part.
PART = 256
# Documents and shingles of a block of a bucket.
BLOCK, BLOCK_SHINGLES = 512, 400_000
# Shingles of up to so many documents of a cell are counted by pairs, others by a product of matrices.
FEW = 8
WIDE = 2048
# Bits of the table that tells most texts that no other shares a bucket with before texts are shuffled.
SIEVE = 1 << 24
_SIGNED = pa.schema([("id", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64()), ("n", pa.int64()), ("bands", pa.list_(pa.int64()))])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _digest(split: list[str]) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(utf8(" ".join(split)))
    return _signed(whole >> 64), _signed(whole & ((1 << 64) - 1))


def sign(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """``id``, 128 bits of hash of the words, number of shingles, and the band keys of documents with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = darts.WordHashes()
        for group in groups_of(rows_of(batches, "id", "text"), 1 << 19):
            split = [(i, w) for i, w in ((i, words(t)) for i, t in group) if w]
            if not split:
                continue
            bags = [darts.shingles(w, hashes, size) for _, w in split]
            keys = darts.band_keys(darts.signatures(bags, bands * rows), bands)
            whole = [_digest(w) for _, w in split]
            yield pa.RecordBatch.from_arrays([
                pa.array([i for i, _ in split], pa.int64()),
                pa.array([x for x, _ in whole], pa.int64()),
                pa.array([x for _, x in whole], pa.int64()),
                pa.array([int(b[1].sum()) for b in bags], pa.int64()),
                pa.array(list(keys), pa.list_(pa.int64())),
            ], schema=_SIGNED)

    return docs.mapInArrow(run, "id long, w1 long, w2 long, n long, bands array<long>")


def _sieved(rows: DataFrame, column: str, asked: DataFrame, wanted: str) -> DataFrame:
    """``rows`` whose ``column`` may be among ``wanted`` of ``asked``: all that are and few others, without a shuffle.

    Values are hashed to ``SIEVE`` bits, in a table of at most a 64th as many rows, so what is broadcast does not grow.
    """
    def placed(df: DataFrame, name: str) -> DataFrame:
        place = F.pmod(F.xxhash64(name), F.lit(SIEVE))
        return df.select("*", F.shiftright(place, 6).alias("_slot"), F.pmod(place, F.lit(64)).cast("int").alias("_bit"))

    masks = placed(asked, wanted).groupBy("_slot").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_mask"))
    met = placed(rows, column).join(F.broadcast(masks), "_slot")
    return met.where(F.getbit("_mask", "_bit") == 1).select(rows.columns)


def _texts(slim: DataFrame, asked: DataFrame, torn: DataFrame) -> DataFrame:
    """``id, text`` of the nodes ``asked`` (``id, first, w1, w2``); ids of several texts (``torn``) are told apart by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(rows_of(batches, "doc", "text"), 1 << 19):
            whole = [_digest(words(t)) for _, t in group]
            yield pa.RecordBatch.from_arrays([
                pa.array([x for x, _ in whole], pa.int64()), pa.array([x for _, x in whole], pa.int64()),
                pa.array([t for _, t in group], pa.string()),
            ], names=["w1", "w2", "text"])

    rows = _sieved(slim.withColumnRenamed("id", "doc"), "doc", asked, "first")
    plain = asked.join(torn.select(F.col("doc").alias("first")), "first", "left_anti").select("id", F.col("first").alias("doc"))
    plain = rows.join(plain, "doc").select("id", "text")
    several = rows.join(torn.select("doc"), "doc", "left_semi").mapInArrow(run, "w1 long, w2 long, text string")
    several = several.join(asked.join(torn.select(F.col("doc").alias("first")), "first", "left_semi"), ["w1", "w2"]).select("id", "text")
    return plain.union(several).dropDuplicates(["id"])


def _compared(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The pairs (leader ``a``, member ``b``) with the similarity ``s`` of their texts."""
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("n"))
    dealt = pairs.join(parts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("n")).cast("int").alias("part"), F.col("b").alias("id"))
    leaders = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("part"), F.col("a").alias("id"))
    asked = dealt.select("*", F.lit(1).alias("role")).union(leaders.select("*", F.lit(0).alias("role")))
    met = asked.join(texts, "id").select("a", "part", "role", "id", "text")
    placed = met.repartition("a", "part").sortWithinPartitions("a", "part", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, leader = darts.WordHashes(), None
        for group in groups_of(rows_of(batches, "a", "role", "id", "text"), 1 << 21, 3):
            found = []
            for a, role, i, text in group:
                bag = darts.shingles(words(text), hashes, size)
                if role == 0:
                    leader = bag
                else:
                    found.append((a, i, darts.similarity(leader, bag)))
            kinds = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], kinds[k]) for k in range(3)], names=["a", "b", "s"])

    return placed.mapInArrow(run, "a long, b long, s double")


def _led(buckets: DataFrame) -> DataFrame:
    """``buckets`` (``key, id``) of several members, with the least id as ``a``."""
    many = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("_c"), F.min("id").alias("a")).where("_c > 1")
    return buckets.join(many, "key").drop("_c")


def _cells(met: DataFrame, roots: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """``key, x, y, part, id, root``: the members of blocks ``x`` and ``y`` of each bucket of several roots."""
    members = met.join(roots, "id", "left").join(sizes, "id").select("key", "id", F.coalesce("root", "id").alias("root"), "n")
    seen = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("c"), F.sum("n").alias("n_all"), F.min("root").alias("r1"), F.max("root").alias("r2"),
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.bit_xor("id").alias("x1"), F.bit_xor(F.xxhash64("id")).alias("x2"),
    )
    # least, greatest and xor tell sets of up to three members; larger ones have 64 bits of hash besides
    seen = seen.where("r1 <> r2").dropDuplicates(["c", "lo", "hi", "x1", "x2"])
    blocks = F.greatest(F.ceil(F.col("c") / block), F.ceil(F.col("n_all") / BLOCK_SHINGLES)).cast("int")
    dealt = members.drop("n").join(seen.select("key", blocks.alias("blocks")), "key")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select("key", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "part", "id", "root")


def common(bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """How many shingles each two of the multisets have in common, as a square table."""
    c = len(bags)
    hashes = np.concatenate([np.repeat(h, n) for h, n in bags])
    at = np.concatenate([np.repeat(np.cumsum(n) - n, n) for _, n in bags])
    sizes = np.array([n.sum() for _, n in bags])
    turn = np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes) - at
    again = np.flatnonzero(turn)
    with np.errstate(over="ignore"):  # a shingle's second, third, ... occurrence counts as an element of its own
        hashes[again] = darts.mixed(hashes[again] + darts.mixed(turn[again].astype(np.uint64)))
    _, where, often = np.unique(hashes, return_inverse=True, return_counts=True)
    order = np.argsort(where, kind="stable")
    owner = np.repeat(np.arange(c), sizes)[order]
    begin = np.cumsum(often) - often
    both = np.zeros(c * c, np.int64)
    for k in range(2, FEW + 1):
        held = owner[begin[often == k][:, None] + np.arange(k)]
        for i in range(k):
            for j in range(i):
                np.add.at(both, held[:, j] * c + held[:, i], 1)
    both = both.reshape(c, c)
    both += both.T
    heavy = np.flatnonzero(often > FEW)
    for a in range(0, len(heavy), WIDE):
        some = heavy[a : a + WIDE]
        has = np.zeros((c, len(some)), np.float32)
        column = np.repeat(np.arange(len(some)), often[some])
        first = np.cumsum(often[some]) - often[some]
        has[owner[np.repeat(begin[some] - first, often[some]) + np.arange(len(column))], column] = 1
        both += (has @ has.T).astype(np.int64)
    return both


def joined(bags: list[tuple[np.ndarray, np.ndarray]], roots: list[int], parts: list[int], threshold: float) -> list[tuple[int, int]]:
    """Pairs of ``roots`` that links between the multisets join, fewer than there are roots.

    Multisets of one part are compared with those of the other; if there is only one part, with each other.
    """
    up: dict[int, int] = {}

    def top(root: int) -> int:
        while (higher := up.get(root, root)) != root:
            up[root] = root = up.get(higher, higher)
        return root

    sizes, side, root = np.array([n.sum() for _, n in bags]), np.array(parts), np.array(roots)
    maybe = np.triu(root[:, None] != root, 1) & (np.minimum(sizes[:, None], sizes) >= threshold * np.maximum(sizes[:, None], sizes) - 1e-9)
    if side.min() != side.max():
        maybe &= side[:, None] != side
    first, second = np.nonzero(maybe)
    if not len(first):
        return []
    if len(bags) > FEW:
        both = common(bags)[first, second]
        near = both / (sizes[first] + sizes[second] - both) >= threshold
    else:
        near = np.array([darts.similarity(bags[i], bags[j]) >= threshold for i, j in zip(first.tolist(), second.tolist())])
    links = []
    for i, j in zip(first[near].tolist(), second[near].tolist()):
        a, b = top(roots[i]), top(roots[j])
        if a != b:
            up[max(a, b)] = min(a, b)
            links.append((a, b))
    return links


def _joined(cells: DataFrame, texts: DataFrame, size: int, threshold: float) -> DataFrame:
    """Links (``a, b``) between roots that pairs of texts in one cell show."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = darts.WordHashes()
        rows = rows_of(batches, "key", "x", "y", "part", "root", "text")
        for _, cell in itertools.groupby(rows, lambda r: r[:3]):
            bags, roots, parts = [], [], []
            for *_, part, root, text in cell:
                bags.append(darts.shingles(words(text), hashes, size))
                roots.append(root)
                parts.append(part)
            if links := joined(bags, roots, parts, threshold):
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in range(2)], names=["a", "b"])

    placed = cells.join(texts, "id").repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
    return placed.mapInArrow(run, "a long, b long")


def near_classes(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SHINGLE, bands: int = BANDS,
    rows: int = ROWS, threshold: float = THRESHOLD, block: int = BLOCK,
) -> DataFrame:
    """``id, class_id`` for each document with an id; ``class_id`` is the least id of the class."""
    slim = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).cast("string").alias("text")).where("id is not null")
    signed = written(sign(slim, size, bands, rows))
    # a node per text, numbered as written: below, ``id`` is the node
    one = signed.groupBy("w1", "w2").agg(F.min("id").alias("first"), F.min("n").alias("n"), F.min("bands").alias("bands"))
    one = written(one.withColumn("id", F.monotonically_increasing_id()))
    sizes = one.select("id", "n")
    held = written(signed.select(F.col("id").alias("doc"), "w1", "w2").join(one.select("w1", "w2", "id"), ["w1", "w2"]).select("doc", "id").distinct())
    # the texts of a repeated id are links without a check
    torn = written(held.groupBy("doc").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select("doc", "a"))
    known = written(held.join(torn, "doc").where("a <> id").select("a", F.col("id").alias("b")).distinct())
    keyed = one.select("id", F.posexplode("bands").alias("band", "key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("key")
    met = written(keyed.join(shared, "key").select("key", F.col("band").cast("byte").alias("band"), "id"))
    asked = one.drop("bands", "n").join(met.select("id").distinct(), "id", "left_semi")
    texts = written(_texts(slim, written(asked), torn))
    buckets = _led(met.where(F.col("band") < FIRST).select("key", "id"))
    pairs = written(buckets.where("a <> id").select("a", F.col("id").alias("b")).distinct())
    scored = _compared(pairs, texts, size).where(F.col("s") >= threshold).select("a", "b")
    roots = written(components(known.union(written(scored))))
    higher = components(written(_joined(_cells(met, roots, sizes, block), texts, size, threshold)))
    rooted = held.join(roots, "id", "left").select("doc", F.coalesce("root", "id").alias("low"))
    rooted = rooted.join(higher.withColumnRenamed("id", "low"), "low", "left").select("doc", F.coalesce("root", "low").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc").alias("class_id"), F.max("doc").alias("_last")).where("class_id <> _last")
    moved = rooted.join(least, "root").where("doc <> class_id").select(F.col("doc").alias("id"), "class_id").distinct()
    return slim.select("id").distinct().join(moved, "id", "left").select("id", F.coalesce("class_id", "id").alias("class_id"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that are near a document of lesser id; null ids stay."""
    gone = near_classes(docs, id_column, text).where("id <> class_id").select(F.col("id").alias("_gone"))
    return docs.join(gone, F.col(id_column).cast("long") == F.col("_gone"), "left_anti")


def op9_dart_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_classes(read(spark, folder, "documents")).select(F.col("id").alias("doc_id"), "class_id")

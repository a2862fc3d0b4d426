"""Token ids of documents in files of their own format, written and read as a Spark data source.

``write_ids`` encodes texts with a vocabulary, appends an end id to each and writes them in
ascending order of the document's id. Rows are dealt to tasks by ranges of ids, so a task's
files hold a stretch of that order. ``read_ids`` gives the ids of each document back, and how
many ids stand before it in all files.

A file is a row of stripes; a stripe holds whole documents with ``STRIPE_IDS`` ids or a little
more, as a checksummed index (ids and lengths of its documents) and blocks of the range coder in
``idcoder``. Tasks write files of names that no other attempt uses; the manifest, written once all
tasks are done, names the files that count, so a lost executor leaves nothing behind that
is read. It has one entry per file of up to ``FILE_IDS`` ids. A task holds a stripe at a time, and
texts of ``GROUP_BYTES`` or one longer text.

Cases: a null text counts as empty and gives its end id alone; rows with a null id come first;
rows of equal id stand in an order given by their texts, repeated rows are each written; an
empty table gives files without documents; other columns are not read. A very long text makes a stripe of
its own, in as many blocks as it needs.
"""

from __future__ import annotations

import itertools
import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from netsift.llm import idcoder
from netsift.llm.common import read, shared_folder

FORMAT = "token_ids"
MAGIC = b"CMIF0002"
STRIPE_IDS = idcoder.BLOCK_IDS - idcoder.BLOCK_IDS // 16  # with most last documents no more than a block
FILE_IDS = 1 << 24
MANIFEST = "_manifest.json"
SCHEMA = "doc_id long, start long, ids binary"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
_STRIPE = struct.Struct("<4sIII")
CACHED_UNITS = 3 << 17
CACHED_LENGTH = 64
GROUP_BYTES = 1 << 22
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MARKS = ".,;:!?#$%*&()"

_loaded: dict[tuple[str, bool], Encoder] = {}


def _laid(pool: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of a pool, told by their numbers, in a row; and where each ends there."""
    starts, ends = np.cumsum(sizes) - sizes, np.cumsum(sizes[which])
    out = np.empty(int(ends[-1]) if len(ends) else 0, pool.dtype)
    for at in range(0, len(which), 1 << 16):
        some = which[at : at + (1 << 16)]
        n = sizes[some]
        begin, end = int(ends[at] - n[0]), int(ends[at + len(some) - 1])
        places = np.repeat(starts[some] - (ends[at : at + len(some)] - n), n)
        places += np.arange(begin, end)
        out[begin:end] = pool[places]
    return out, ends


class Encoder:
    """Ids of texts, as bytes (32 bits each, little-endian).

    ``drops_spaces`` says that the vocabulary drops white space, so that what stands between
    spaces and line breaks can be encoded alone; the distinct units of some texts are encoded once and
    remembered. Units of Latin letters with plain marks behind them are parted there, so that a
    word in capitals or before a comma is no new one. Whether the vocabulary parts them too, and
    what it makes of each letter, is asked of its own normalizer and pre-tokenizer.
    """

    def __init__(self, path: str, drops_spaces: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.drops_spaces = drops_spaces
        self.letters = self._letters() if drops_spaces else {}
        self.alphabet, self.table = "".join(self.letters), str.maketrans(self.letters)
        self.marks = MARKS if self.letters else ""
        lower = pc.utf8_lower(pa.array(self.letters, pa.string())).to_pylist()
        self.folds = all(self.letters.get(c) == made for c, made in zip(lower, self.letters.values()))
        # what was encoded, the ids of all of it in a row, how many each has, and in which turn it came last
        self.known = pa.array([], pa.string())
        self.ids, self.sizes, self.used, self.turn = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64), 0

    def _cut(self, text: str) -> list[str]:
        """The pieces that the model gets of a text."""
        t = self.tokenizer
        text = t.normalizer.normalize_str(text) if t.normalizer else text
        return [piece for piece, _ in t.pre_tokenizer.pre_tokenize_str(text)] if t.pre_tokenizer else [text]

    def _letters(self) -> dict[str, str]:
        """What each Latin letter is in a piece; empty if runs of them or of marks are not one piece each."""
        letters = [c for c in map(chr, range(0x41, 0x180)) if c.isalpha() and c != "\u0130"]
        made = dict(zip(letters, self._cut(" ".join(letters))))
        runs = ["".join(letters), "".join(reversed(letters)), *(c + "x" + c + "X" for c in letters)]
        marks = ["", MARKS, MARKS[::-1], *MARKS, *map("".join, itertools.product(MARKS, repeat=2))]
        pairs = [*((r, m) for r in runs for m in marks[:3]), *((r, m) for r in ("", "aZ") for m in marks)]
        parts = [x for r, m in pairs for x in ("".join(map(made.get, r)), m) if x] if len(made) == len(letters) else []
        whole = self._cut(" ".join(letters)) == [*made.values()] and self._cut(" ".join(r + m for r, m in pairs)) == parts
        added = self.tokenizer.get_added_tokens_decoder().values()
        return made if whole and not any({*t.content} <= {*MARKS, *made} for t in added) else {}

    def plain(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def piece(self, piece: str) -> list[int]:
        return [token.id for token in self.model.tokenize(piece.translate(self.table))] if piece else []

    def forget(self) -> None:
        """Drops long units, and all but the half used last where too many are known."""
        keep = pc.less_equal(pc.utf8_length(self.known), CACHED_LENGTH).to_numpy(zero_copy_only=False)
        if len(keep) > CACHED_UNITS:
            keep &= self.used > np.sort(self.used)[-(CACHED_UNITS // 2) - 1]
        kept = np.flatnonzero(keep)
        self.ids, _ = _laid(self.ids, self.sizes, kept)
        self.known, self.sizes, self.used = self.known.take(pa.array(kept)), self.sizes[kept], self.used[kept]

    def places(self, pieces: pa.Array, odd: pa.Array) -> np.ndarray:
        """The numbers, among what is known, of distinct pieces and of other units."""
        strings = pa.concat_arrays([pieces, odd])
        self.known = self.known.cast(strings.type)
        found = pc.index_in(strings, value_set=self.known)
        places = pc.fill_null(found, 0).to_numpy().astype(np.int64)
        new = np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False))
        ids, sizes = [], np.zeros(len(new), np.int64)
        add = strings.take(pa.array(new))
        for k, (at, string) in enumerate(zip(new.tolist(), add.to_numpy(zero_copy_only=False).tolist())):
            some = self.piece(string) if at < len(pieces) else self.plain(string)
            ids += some
            sizes[k] = len(some)
        places[new] = len(self.known) + np.arange(len(new))
        self.known = pa.concat_arrays([self.known, add])
        self.ids, self.sizes = np.concatenate([self.ids, np.array(ids, "<u4")]), np.concatenate([self.sizes, sizes])
        self.used, self.turn = np.concatenate([self.used, np.zeros(len(new), np.int64)]), self.turn + 1
        self.used[places] = self.turn
        return places

    def units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct units in a row, and how many are each unit's."""
        short = pc.less_equal(pc.utf8_length(units), CACHED_LENGTH)
        letters = pc.utf8_rtrim(units, self.marks)
        simple = pc.and_(pc.equal(pc.utf8_ltrim(letters, self.alphabet), ""), short)
        letters, marks = letters.filter(simple), pc.utf8_ltrim(units.filter(simple), self.alphabet)
        coded = pa.concat_arrays([pc.utf8_lower(letters) if self.folds else letters, marks]).dictionary_encode()
        odd = units.filter(pc.invert(simple))
        places = self.places(coded.dictionary, odd)
        # each unit is two stretches of the known ids, the second of which may be none
        parts, simple = np.full((len(units), 2), len(self.sizes)), simple.to_numpy(zero_copy_only=False)
        parts[simple] = places[coded.indices.to_numpy()].reshape(2, -1).T
        parts[~simple, 0] = places[len(coded.dictionary) :]
        ids, ends = _laid(self.ids, np.append(self.sizes, 0), parts.ravel())
        if len(self.known) > CACHED_UNITS or not pc.all(short).as_py():
            self.forget()
        return ids, np.diff(ends[1::2], prepend=0)

    def many(self, texts: list[str] | pa.Array) -> list[bytes]:
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not self.drops_spaces:
            return [np.array(self.plain(t), "<u4").tobytes() for t in texts.to_pylist()]
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        ids, ends = _laid(*self.units(coded.dictionary), coded.indices.to_numpy())
        lasts = np.concatenate([[0], ends])[np.cumsum(split.value_lengths().to_numpy(), dtype=np.int64)]
        return [ids[a:z].tobytes() for a, z in itertools.pairwise([0, *lasts.tolist()])]


def encoder(path: str, drops_spaces: bool) -> Encoder:
    """One encoder per Python worker."""
    if (path, drops_spaces) not in _loaded:
        _loaded[path, drops_spaces] = Encoder(path, drops_spaces)
    return _loaded[path, drops_spaces]


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[int, int, str, int, int]]  # task, number in the task, name, documents, ids


@dataclass
class IdFile(InputPartition):
    name: str
    start: int


def stripe_bytes(docs: list[int | None], ids: list[bytes]) -> bytes:
    """One stripe: ``docs`` with the ``ids`` of each."""
    sizes = np.array([len(i) // 4 for i in ids], "<i8")
    numbers = np.array([0 if d is None else d for d in docs], "<i8")
    nulls = np.array([d is None for d in docs], np.uint8)
    index = zlib.compress(numbers.tobytes() + sizes.tobytes() + nulls.tobytes(), 1)
    flat = np.frombuffer(b"".join(ids), "<u4")
    # blocks of one size, as a short one takes as many steps
    blocks = np.array_split(flat, -(-len(flat) // idcoder.BLOCK_IDS)) if len(flat) else []
    return b"".join([_STRIPE.pack(b"CMIS", len(blocks), len(index), zlib.crc32(index)), index, *map(idcoder.encode_block, blocks)])


def _exactly(stream, size: int) -> bytes:
    data = stream.read(size)
    if len(data) != size:
        raise ValueError("file of ids ends early")
    return data


def stripes(stream) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """The documents of a file, stripe by stripe."""
    if _exactly(stream, len(MAGIC)) != MAGIC:
        raise ValueError("not a file of ids")
    while head := stream.read(_STRIPE.size):
        if len(head) != _STRIPE.size:
            raise ValueError("file of ids ends early")
        magic, n_blocks, n_index, checksum = _STRIPE.unpack(head)
        index = _exactly(stream, n_index)
        if magic != b"CMIS" or zlib.crc32(index) != checksum:
            raise ValueError("damaged index of a stripe")
        index = zlib.decompress(index)
        n = len(index) // 17
        numbers, sizes = np.frombuffer(index, "<i8", 2 * n).reshape(2, n)
        nulls = np.frombuffer(index, np.uint8, n, 16 * n)
        found = []
        for _ in range(n_blocks):
            head = _exactly(stream, idcoder.HEAD_BYTES)
            found.append(idcoder.decode_block(head + _exactly(stream, idcoder.block_size(head) - idcoder.HEAD_BYTES)))
        data = memoryview(np.concatenate(found).astype("<u4").tobytes() if found else b"")
        ends = (4 * np.cumsum(sizes)).tolist()
        docs = [None if null else d for d, null in zip(numbers.tolist(), nulls.tolist())]
        yield docs, [data[a:b] for a, b in zip([0, *ends], ends)]


def _manifest(path: str) -> list[dict] | None:
    """The files that count, or None where nothing was written yet."""
    files, folder = fs.FileSystem.from_uri(path)
    name = f"{folder}/{MANIFEST}"
    if files.get_file_info(name).type == fs.FileType.NotFound:
        return None
    with files.open_input_stream(name) as stream:
        return json.loads(stream.read())["files"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], pa.Array]]:
    """Rows of ``doc_id, text`` in groups that end with the row that brings their texts to ``GROUP_BYTES``."""
    for batch in batches:
        docs, texts = (batch.column(batch.schema.get_field_index(n)) for n in ("doc_id", "text"))
        texts = pc.fill_null(texts, "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        at = 0
        while at < len(texts):
            before = int(ends[at - 1]) if at else 0
            n = int(np.searchsorted(ends, before + GROUP_BYTES)) + 1 - at
            yield docs.slice(at, n).to_pylist(), texts.slice(at, n)
            at += n


class IdWriter(DataSourceArrowWriter):
    """Takes rows of ``doc_id, text``; encodes and writes them in one worker."""

    def __init__(self, path: str, tokenizer: str, end_id: int, drops_spaces: bool):
        self.path, self.tokenizer, self.end_id, self.drops_spaces = path, tokenizer, end_id, drops_spaces

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, folder = fs.FileSystem.from_uri(self.path)
        files.create_dir(folder, recursive=True)
        task = TaskContext.get().partitionId()
        done: list[tuple[int, int, str, int, int]] = []
        stream, name, docs, n_ids = None, "", 0, 0
        pending: tuple[list, list, int] = ([], [], 0)

        def flush(last: bool) -> None:
            nonlocal stream, name, docs, n_ids, pending
            ids_of, bodies, total = pending
            if ids_of:
                if stream is None:
                    name = f"part-{task:08d}-{len(done):04d}-{uuid.uuid4().hex}.ids"
                    stream, docs, n_ids = files.open_output_stream(f"{folder}/{name}"), 0, 0
                    stream.write(MAGIC)
                stream.write(stripe_bytes(ids_of, bodies))
                docs, n_ids, pending = docs + len(ids_of), n_ids + total, ([], [], 0)
                pa.default_memory_pool().release_unused()  # else a worker keeps what its largest groups took
            if stream is not None and (last or n_ids >= FILE_IDS):
                stream.close()
                done.append((task, len(done), name, docs, n_ids))
                stream = None

        encode, end = encoder(self.tokenizer, self.drops_spaces), np.array([self.end_id], "<u4").tobytes()
        for group, texts in _groups(iterator):
            for doc, ids in zip(group, encode.many(texts)):
                pending[0].append(doc)
                pending[1].append(ids + end)
                pending = (pending[0], pending[1], pending[2] + len(ids) // 4 + 1)
                if pending[2] >= STRIPE_IDS:
                    flush(False)
        flush(True)
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        files, folder = fs.FileSystem.from_uri(self.path)
        files.create_dir(folder, recursive=True)
        rows = sorted(itertools.chain.from_iterable(m.files for m in messages if m is not None))
        starts = itertools.accumulate([0, *[r[4] for r in rows]])
        table = [{"file": r[2], "docs": r[3], "ids": r[4], "start": s} for r, s in zip(rows, starts)]
        old = _manifest(self.path)
        with files.open_output_stream(f"{folder}/{MANIFEST}") as out:
            out.write(json.dumps({"files": table}).encode())
        for row in old or []:
            files.delete_file(f"{folder}/{row['file']}")

    def abort(self, messages: list[Written | None]) -> None:
        files, folder = fs.FileSystem.from_uri(self.path)
        for row in itertools.chain.from_iterable(m.files for m in messages if m is not None):
            files.delete_file(f"{folder}/{row[2]}")


class IdReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[IdFile]:
        table = _manifest(self.path)
        if table is None:
            raise ValueError(f"no id files in {self.path}")
        return [IdFile(r["file"], r["start"]) for r in table] or [IdFile("", 0)]

    def read(self, partition: IdFile) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        files, folder = fs.FileSystem.from_uri(self.path)
        start = partition.start
        with files.open_input_stream(f"{folder}/{partition.name}") as stream:
            for docs, ids in stripes(stream):
                starts = start + np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])])
                start = int(starts[-1])
                # a bounded number of bytes a batch, which a longer document alone may pass
                at = 0
                while at < len(docs):
                    end = max(at + 1, int(np.searchsorted(starts, starts[at] + STRIPE_IDS, "right")) - 1)
                    yield pa.RecordBatch.from_arrays([pa.array(docs[at:end], pa.int64()), pa.array(starts[at:end]), pa.array(ids[at:end], pa.binary())], schema=_ARROW)
                    at = end


class IdFiles(DataSource):
    """Spark data source for folders of id files."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> IdReader:
        return IdReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> IdWriter:
        if not overwrite and _manifest(self.options["path"]) is not None:
            raise ValueError(f"{self.options['path']} holds ids already; write with mode 'overwrite'")
        o = self.options
        return IdWriter(o["path"], o["tokenizer"], int(o["endid"]), o["dropsspaces"] == "true")


def write_ids(
    docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, drops_spaces: bool = False,
    id_column: str = "doc_id", text_column: str = "text", mode: str = "append",
) -> None:
    """Writes the ids of ``docs`` in ascending order of the document's id to files in the folder ``path``.

    ``tokenizer`` is the path of a vocabulary file on every executor. ``append`` needs a folder
    without ids, as a later stretch of ids could belong before them; ``overwrite`` replaces them.
    """
    docs.sparkSession.dataSource.register(IdFiles)
    slim = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    # the hash deals rows of equal id over tasks too
    keyed = slim.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
    rows = keyed.sortWithinPartitions("doc_id", "tie", "text").drop("tie")
    options = {"tokenizer": tokenizer, "endid": str(end_id), "dropsspaces": str(drops_spaces).lower()}
    # else a worker gets ten thousand texts at once, of any length
    conf = docs.sparkSession.conf
    old = conf.get(BATCH_BYTES, None)
    conf.set(BATCH_BYTES, str(GROUP_BYTES))
    try:
        rows.write.format(FORMAT).options(**options).mode(mode).save(path)
    finally:
        conf.unset(BATCH_BYTES) if old is None else conf.set(BATCH_BYTES, old)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of the files in ``path``; ``ids`` has 32 bits each, little-endian."""
    spark.dataSource.register(IdFiles)
    return spark.read.format(FORMAT).load(path)


def op12_mixed_id_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = shared_folder(spark)
    write_ids(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), path, drops_spaces=True)
    return read_ids(spark, path).selectExpr("doc_id", "start", "cast(octet_length(ids) div 4 as long) n_tokens", "crc32(ids) ids_crc32")

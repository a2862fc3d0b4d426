import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

from netsift.llm import idcoder, tokenfiles
from netsift.llm.tokenfiles import Encoder, op12_mixed_id_files, read_ids, write_ids

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(VOCABULARY)


def ids_of(text, end=2):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, end]


def packed(ids):
    return np.array(ids, "<u4").tobytes()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2**20 - 1)), max_size=600), min_size=1, max_size=4))
def test_any_ids_come_back(blocks):
    blocks = [np.array(b, np.uint32) for b in blocks]
    for made, ids in zip(idcoder.decode(idcoder.encode(blocks)), blocks):
        assert made.tolist() == ids.tolist()


def test_blocks_stand_alone_and_shrink():
    rng = np.random.default_rng(3)
    ids = rng.zipf(1.3, 60_000).clip(max=49_000).astype(np.uint32)
    repeated = np.tile(rng.integers(0, 40_000, 100, dtype=np.uint32), 300)
    together = idcoder.encode([ids, repeated, ids[:5]])
    assert [idcoder.encode([b])[0] for b in (ids, repeated, ids[:5])] == together
    assert len(together[0]) < 2 * len(ids) and len(together[1]) < len(repeated) / 4
    assert idcoder.decode(together[1:2])[0].tolist() == repeated.tolist()


@pytest.mark.parametrize("at", [30, 200, -1])
def test_damage_is_found(at):
    data = bytearray(idcoder.encode([np.arange(5000, dtype=np.uint32) % 700])[0])
    data[at] ^= 1
    with pytest.raises(ValueError):
        idcoder.decode([bytes(data)])
    with pytest.raises(ValueError):
        idcoder.decode([bytes(data[:100])])
    with pytest.raises(ValueError):
        idcoder.encode([np.array([1 << 20], np.uint32)])


def test_units_as_whole_texts():
    rng = random.Random(8)
    pieces = ["Don't", "ΣΑΣ", "é", "é", "́", "漢字", "12a", "<|startoftext|>", "<|endoftext|>", "<|", "|>", " ", "  ", "\n", "\t", " ", " ", "\r\n", "🙂", "...", "İ", "x" * 90]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(30))) for _ in range(500)]
    encode = Encoder(VOCABULARY, drops_spaces=True)
    for texts in (texts, texts[::-1]):
        assert encode.many(texts) == [packed(ids_of(t)[:-1]) for t in texts]


def test_many_units_over_the_bound(monkeypatch):
    monkeypatch.setattr(tokenfiles, "CACHED_UNITS", 5)
    encode = Encoder(VOCABULARY, drops_spaces=True)
    for k in range(6):
        texts = [f"word{k + i} again same{i}" for i in range(4)]
        assert encode.many(texts) == [packed(ids_of(t)[:-1]) for t in texts]


def test_words_in_other_dress_are_not_new():
    words = [a + b for a in ("tree", "über", "ça", "sol") for b in ("s", "ing", "ê", "ßen", "")]
    texts = [" ".join(dress(w) for w in words) for dress in (str, str.title, str.upper, "{}, ".format, "{}.".format, "{}!?".format)]
    texts += ["Don't, DON'T. a1, (b) ,c ... A.B \u0130i, x\u0301. \u017f! \u00aa?", "J\u030c, j\u030c <|endoftext|>. <|>", "y" * 90 + "."]
    encode = Encoder(VOCABULARY, drops_spaces=True)
    encode.many(texts[:6])
    assert len(encode.known) < 2 * len(words)
    assert encode.many(texts) == [packed(ids_of(t)[:-1]) for t in texts]


def test_cased_vocabulary(tmp_path):
    vocabulary = {c: i for i, c in enumerate("abAB.,")} | {"ab": 6, "AB": 7}
    made = Tokenizer(models.BPE(vocabulary, [("a", "b"), ("A", "B")]))
    made.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    made.save(str(tmp_path / "cased.json"))
    texts = ["ab AB, aB. ab", "ABAB.. a"]
    want = [packed(made.encode(t, add_special_tokens=False).ids) for t in texts]
    assert Encoder(str(tmp_path / "cased.json"), drops_spaces=True).many(texts) == want


def test_an_id_takes_one_step(monkeypatch):
    steps, close = [], idcoder._Model.close
    monkeypatch.setattr(idcoder._Model, "close", lambda self, *of: steps.append(1) or close(self, *of))
    ids = np.random.default_rng(1).zipf(1.3, 30_000).clip(max=49_000).astype(np.uint32)
    made = idcoder.encode([ids])
    assert len(steps) <= 256
    assert idcoder.decode(made)[0].tolist() == ids.tolist() and len(steps) <= 512


@pytest.mark.parametrize("kinds", [1, 2, 3, 50, 40_000])
def test_carries_and_long_lanes(kinds, monkeypatch):
    monkeypatch.setattr(idcoder, "LANES", 3)
    rng = np.random.default_rng(kinds)
    ids = np.concatenate([rng.integers(0, kinds, 4000), np.full(3000, kinds - 1), rng.integers(0, kinds, 999)]).astype(np.uint32)
    made = idcoder.encode([ids])
    assert idcoder.decode(made)[0].tolist() == ids.tolist()
    for at in range(idcoder.HEAD_BYTES):
        broken = bytearray(made[0])
        broken[at] ^= 4
        with pytest.raises(ValueError):
            idcoder.decode([bytes(broken)])


def expected(rows):
    """(doc_id, start, n, crc) per row; rows of equal id share the starts they may have."""
    out, start = [], 0
    for i, text in rows:
        ids = ids_of(text)
        out.append((i, start, len(ids), zlib.crc32(packed(ids))))
        start += len(ids)
    return out


def test_odd_rows(spark, odd, odd_rows, none, tmp_path):
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    got = op12_mixed_id_files(spark, str(tmp_path)).orderBy("start").collect()
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i))
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    want = sorted(((i, len(ids_of(t)), zlib.crc32(packed(ids_of(t)))) for i, t, *_ in odd_rows), key=repr)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == want
    write_ids(none, VOCABULARY, str(tmp_path / "none"))
    assert read_ids(spark, str(tmp_path / "none")).count() == 0


def test_ids_and_starts_over_many_files(spark, tmp_path, monkeypatch):
    rows = [(i, f"text number {i} of many " * (i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(5)
    path = str(tmp_path / "ids")
    write_ids(df, VOCABULARY, path, end_id=7)
    got = read_ids(spark, path).orderBy("doc_id").collect()
    flat = [ids_of(t, 7) for _, t in rows]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == flat
    assert [r.start for r in got] == np.cumsum([0, *map(len, flat)])[:-1].tolist()


def test_folder_is_replaced_only_if_told(spark, tmp_path):
    df = spark.createDataFrame([(1, "one"), (2, "two words")], "doc_id long, text string")
    path = str(tmp_path / "ids")
    write_ids(df, VOCABULARY, path)
    (tmp_path / "ids" / "part-left-behind.ids").write_bytes(b"no part of a manifest")
    with pytest.raises(Exception, match="holds ids already"):
        write_ids(df, VOCABULARY, path)
    write_ids(df.where("doc_id = 2"), VOCABULARY, path, mode="overwrite")
    assert [r.doc_id for r in read_ids(spark, path).collect()] == [2]


def test_stripes_of_small_files(tmp_path, monkeypatch):
    monkeypatch.setattr(idcoder, "BLOCK_IDS", 50)
    docs, ids = [None, 5, 5, 9], [packed(range(130)), b"", packed([1]), packed(range(1000, 1900))]
    data = tokenfiles.MAGIC + tokenfiles.stripe_bytes(docs, ids) + tokenfiles.stripe_bytes([12], [packed([3])])
    (tmp_path / "x").write_bytes(data)
    with open(tmp_path / "x", "rb") as stream:
        got = list(tokenfiles.stripes(stream))
    assert [(d, [bytes(i) for i in b]) for d, b in got] == [(docs, ids), ([12], [packed([3])])]
    (tmp_path / "x").write_bytes(data[:-1])
    with open(tmp_path / "x", "rb") as stream, pytest.raises(ValueError):
        list(tokenfiles.stripes(stream))


@pytest.mark.parametrize("was", [None, "123456789"])
def test_batch_size_is_put_back(spark, tmp_path, was):
    spark.conf.unset(tokenfiles.BATCH_BYTES) if was is None else spark.conf.set(tokenfiles.BATCH_BYTES, was)
    try:
        write_ids(spark.createDataFrame([(1, "one")], "doc_id long, text string"), VOCABULARY, str(tmp_path / "ids"))
        assert spark.conf.get(tokenfiles.BATCH_BYTES, None) == was
    finally:
        spark.conf.unset(tokenfiles.BATCH_BYTES)


def test_groups_of_texts_are_bounded(monkeypatch):
    monkeypatch.setattr(tokenfiles, "GROUP_BYTES", 10)
    texts = ["abc", None, "é" * 5, "", "x" * 40, "y", ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": [None, *range(6)], "text": texts})
    got = [(d, t.to_pylist()) for d, t in tokenfiles._groups([batch, batch.slice(5), batch.slice(0, 0)])]
    assert got == [([None, 0, 1], ["abc", "", "é" * 5]), ([2, 3], ["", "x" * 40]), ([4, 5], ["y", ""]), ([4, 5], ["y", ""])]

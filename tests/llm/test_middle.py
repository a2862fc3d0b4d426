import hashlib
import random
import re

import pytest

from netsift.llm import middle
from netsift.llm.middle import fill_in_middle, op13_displacement_middle, restore


def by_hand(doc_id, text, rate=100, spm=50):
    text = text or ""
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text, text
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    pieces = ["a", "é", "漢字", "🙂", "\n", "\n\n", "<", "P>", "<P", ">", "<S", "<X>", " word ", "\r\n"]
    made = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(40)))) for i in range(400)]
    made += [(i, f"one\n{mark}\ntwo\n") for i, mark in enumerate(("<P>", "<S>", "<M>", "<Q>"), 400)]
    return made + [(500, None), (501, ""), (None, "a\nb\nc"), (None, None), (502, "\n"), (503, "no break"), (504, "x\n" * 30), (504, "x\n" * 30)]


def test_every_row_as_by_hand(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert rows(restore(fill_in_middle(df))) == sorted((by_hand(*t) for t in texts), key=repr)


def test_rate_and_order(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = restore(fill_in_middle(df, rate=40, spm=0))
    assert rows(got) == sorted((by_hand(*t, rate=40, spm=0) for t in texts), key=repr)


def test_small_windows_and_chunks(texts, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(middle, "WINDOW", 7)
    monkeypatch.setattr(middle, "CHUNK_BYTES", 50)
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in texts], schema=pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))
    for chunk in middle._chunks(iter([batch]), "text"):
        data, bounds = middle._strings(chunk.column("text"))
        draw = middle.np.arange(len(bounds) - 1) * 7919
        _, low, high = middle.cut_points(data, bounds, draw, draw // 3)
        form = draw % 3
        form[middle.np.isin(range(len(form)), middle.np.searchsorted(bounds, middle._find_marks(data, b"PSM"), "right") - 1)] = 0
        out, out_bounds = middle.scatter(data, bounds, low, high, form, b"PSM")
        back, back_bounds = middle.gather(out, out_bounds, form, b"PSM")
        assert back.tobytes() == data.tobytes() and back_bounds.tolist() == bounds.tolist()


def test_odd_rows(spark, odd, odd_rows, none):
    got = restore(fill_in_middle(odd))
    assert rows(got) == sorted((by_hand(r[0], r[1]) for r in odd_rows), key=repr)
    assert fill_in_middle(none).count() == 0


def test_query_digests(spark, odd, odd_rows, tmp_path):
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = [(*r[:5], sha(r[5]), sha(r[6])) for r in (by_hand(r[0], r[1]) for r in odd_rows)]
    assert rows(op13_displacement_middle(spark, str(tmp_path))) == sorted(expected, key=repr)


def test_marks_are_checked(spark, odd):
    with pytest.raises(ValueError):
        fill_in_middle(odd, marks=("<P>", "<P>", "<M>"))

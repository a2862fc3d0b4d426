import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from netsift.llm import phrases
from netsift.llm.phrases import collocations
from netsift.llm.transducers import Transducer, compose, union

WORD = st.sampled_from([b"a", b"b", b"ab", b"\xc3\xa9"])
COUNTED = st.dictionaries(st.lists(WORD, min_size=1, max_size=4).map(tuple), st.integers(0, 50), max_size=25)


@settings(max_examples=150, deadline=None)
@given(COUNTED, COUNTED)
def test_transducers(one, two):
    a, b = Transducer.build(sorted(one.items())), Transducer.build(sorted(two.items()))
    assert list(a.paths()) == sorted(one.items())
    assert list(Transducer.unpack(a.pack()).paths()) == sorted(one.items())
    both = Counter(one)
    both.update(two)
    assert dict(union([a, b]).paths()) == {p: both[p] for p in one | two}
    assert dict(union([a, b], 30).paths()) == {p: c for p, c in both.items() if c >= 30}
    assert list(compose(a, b)) == sorted((p, one[p], two[p]) for p in one.keys() & two.keys())
    for phrase, count, before in a.prefixes():
        assert count == one[phrase] and list(before) == [one.get(phrase[:k]) for k in range(1, len(phrase))]


def test_equal_endings_are_shared():
    phrases = [((first, b"of", b"the", b"house"), 5 + i) for i, first in enumerate(sorted([b"in", b"out", b"roof", b"top"]))]
    assert len(Transducer.build(phrases).arcs) == 5
    with pytest.raises(ValueError):
        Transducer.build(phrases[::-1])


def brute(rows, least, top=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 6):
                f[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        rows = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * c >= 100 * a and inside(p, q) for q, c in candidates.items()):
                continue
            score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -score) for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def sample(seed, n=150):
    rng = random.Random(seed)
    words = ["the", "of", "The", "New", "york", "é", "漢字", "a\x00b", "#"]
    breaks = [" ", " ", "  ", "\t", " ", ". ", "\n", " ,", "\x0b"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words[: rng.choice([3, 9])]) + rng.choice(breaks) for _ in range(rng.randrange(60)))
        rows.append((rng.choice(["en", "en", "de", None, ""]), text))
    return rows + [("en", "new york city hall " * 40), ("en", None), (None, ""), ("fr", " .. \t"), ("de", "of the " * 500)]


def got(spark, rows, **more):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    return sorted(map(tuple, collocations(df, **more).collect()))


def test_as_brute_force(spark):
    rows = sample(1)
    assert got(spark, rows, least=5) == brute(rows, 5)
    assert got(spark, rows, least=40, top=3) == brute(rows, 40, 3)


def test_split_ranges_and_many_shards(spark, monkeypatch):
    rows = sample(2)
    monkeypatch.setattr(phrases.shards, "__defaults__", (300,))
    assert got(spark, rows, least=4, hot=3) == brute(rows, 4)


def test_products_past_64_bits(spark):
    from netsift.llm.transducers import Transducer as T

    big = 4_000_000_000
    part = T.build([((b"a", b"b"), big), ((b"a", b"c"), 2**62)])
    assert dict(union([T.unpack(part.pack())]).paths()) == {(b"a", b"b"): big, (b"a", b"c"): 2**62}
    exact = "cast({} as decimal(19,0)) * cast({} as decimal(19,0)) * cast(1000 as decimal(4,0)) div (cast({} as decimal(19,0)) * cast({} as decimal(19,0)))"
    a, n, left, right = big + 7, 9_000_000_000_000_001, 5_000_000_011, 6_000_000_007
    assert spark.sql("select " + exact.format(a, n, left, right)).first()[0] == 1000 * a * n // (left * right)


def test_odd_rows(spark, odd, odd_rows, none):
    rows = [(r[2], r[1]) for r in odd_rows]
    assert sorted(map(tuple, collocations(odd, least=30).collect())) == brute(rows, 30)
    assert collocations(none).count() == 0
    assert collocations(odd, least=10**9).count() == 0

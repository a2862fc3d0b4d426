"""Each operator against a plain computation, on rows with nulls, empty and long texts, ties and repeats."""

import collections
import hashlib
import random
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from netsift.llm import darts, decontaminate, languages, lines, mixing, near, packing, quality, scoring, substrings, suffixes
from netsift.llm import wordpiece, wrappers
from netsift.llm.common import words
from netsift.llm.extract import extract, infer, main_text
from tests.llm.conftest import prose

SPLIT = re.compile("[^\x20\x09-\x0D]+")


def listed(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# ---- language mixtures ----

def test_languages(odd, odd_rows, none):
    done = languages.predict(odd, F.lit(True))
    got = done.collect()
    assert len(got) == len(odd_rows)
    by_text = {(r[0], r[1]): r for r in odd_rows}
    assert {r.id for r in got if r.lang_pred == "und"} >= {100, 101, 102, 105}
    assert all(0 <= r.score <= 1 and (r.score == 0) == (r.lang_pred == "und") for r in got)
    assert {r.lang_pred for r in got} <= {"en", "de", "fr", "und"} and by_text
    assert next(r for r in got if r.id == 108).lang_pred == "fr"
    assert none.count() == 0 and languages.predict(none, F.lit(True)).count() == 0
    assert {r.lang_pred for r in languages.predict(odd, F.lit(False)).collect()} == {"und"}


def test_mixture_finds_both_languages():
    rng = np.random.default_rng(0)
    one, two = (" ".join("".join(rng.choice(list(abc), 5)) for _ in range(4000)) for abc in ("abcde", "vwxyz"))
    counts = np.stack([np.bincount(languages.trigrams(t), minlength=languages.BUCKETS) for t in (one, two)], 1)
    model = languages.Mixtures(["one", "two"], counts, 3.0, 30)
    mixed = model.of(one[:3000] + " " + two[:1000])
    assert abs(mixed["one"] - 0.75) < 0.03 and set(model.of(two[500:900])) == {"two"}


# ---- repeated substrings ----

def plain_removed(docs, length):
    first = {}
    bodies = [(i, (t or "").encode()) for i, t in docs]
    for i, b in sorted((x for x in bodies if x[0] is not None), key=lambda x: x[0]):
        for k in range(len(b) - length + 1):
            first.setdefault(b[k : k + length], i)
    out = []
    for i, b in bodies:
        gone = np.zeros(len(b) + 1, int)
        if i is not None:
            for k in range(len(b) - length + 1):
                if first[b[k : k + length]] < i:
                    gone[k : k + length] = 1
        gone = gone[: len(b)]
        runs = int((np.diff(np.concatenate([[0], gone, [0]])) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[gone == 0].tobytes()
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot, chars", [(20_000, 6_000_000), (1, 4_000)])
def test_repeated_substrings(spark, odd, odd_rows, none, monkeypatch, hot, chars):
    monkeypatch.setattr(substrings, "HOT", hot)
    done = substrings.removed(odd, chars=chars)
    got = listed(done, "doc_id", "n_bytes", F.col("n_bytes") - F.length("kept"), F.size("starts"), F.sha2("kept", 256))
    assert got == plain_removed([r[:2] for r in odd_rows], 50)
    assert substrings.removed(none).count() == 0


def test_maximal_repeats_are_all_and_maximal():
    rng = random.Random(5)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(4, 30))) for _ in range(12)]
    least = 3
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    begins = ends - [len(t) for t in texts]
    at = [(b, e, p) for b, e in zip(begins, ends) for p in range(b, e - least + 1)]
    firsts, stops, starts = (np.array(x) for x in zip(*at))
    got = {(n, tuple(sorted(starts[w].tolist()))) for n, w in suffixes.maximal_repeats(data, starts, stops, firsts, least)}
    want = {}
    for b, e in zip(begins, ends):
        for p in range(b, e):
            for q in range(p + least, e + 1):
                want.setdefault(data[p:q].tobytes(), []).append((p, p == b, q == e))
    maximal = set()
    for s, places in want.items():
        left = {("edge", p) if edge else int(data[p - 1]) for p, edge, _ in places}
        right = {("edge", p) if edge else int(data[p + len(s)]) for p, _, edge in places}
        if len(places) > 1 and len(left) > 1 and len(right) > 1:
            maximal.add((len(s), tuple(sorted(p for p, _, _ in places))))
    assert got == maximal


# ---- line dedup ----

def edit_within_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if abs(len(a) - len(b)) != 1:
        return False
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def test_line_dedup_against_all_pairs(spark):
    rng = random.Random(3)
    base = [[rng.choice("abcdefgh") for _ in range(rng.randint(3, 20))] for _ in range(40)]
    rows = []
    for doc in range(60):
        out = []
        for _ in range(rng.randint(1, 6)):
            w = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 2])):
                p = rng.randrange(len(w))
                if rng.random() < 0.4:
                    w[p] = rng.choice("xyz")
                elif rng.random() < 0.5:
                    del w[p]
                else:
                    w.insert(p, rng.choice("xyz"))
            out.append("  ".join(w) if rng.random() < 0.2 else " ".join(w))
        rows.append((doc, "\n".join(out)))
    flat = [((d, i), SPLIT.findall(x), x) for d, t in rows for i, x in enumerate(t.split("\n"))]
    long = [(k, w) for k, w, _ in flat if len(w) >= 5]
    gone = {k for k, w in long if any(o < k and edit_within_one(w, v) for o, v in long)}
    want = {d: [x for (e, i), _, x in flat if e == d and (e, i) not in gone] for d, _ in rows}
    got = lines.deduped_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert gone and {r.doc_id: r._kept_lines for r in got} == want


def test_variants_of_lines_are_made_twice_and_summed_by_hash(spark, tmp_path):
    """Most work of near copies: once for the earliest line of each variant, once to meet it; no sort before the sums."""
    path = str(tmp_path / "lines.parquet")
    rows = [(r, 0, 3, [str(w) for w in words]) for r, words in enumerate(([1, 2, 3, 4, 5, 6], [1, 9, 3, 4, 5, 6], [1, 3, 4, 5, 6], [7, 7, 7, 7, 7, 7]))]
    spark.createDataFrame(rows, "rank long, low int, high int, words array<string>").write.parquet(path)
    found = lines._partners(spark.read.parquet(path))
    assert sorted(map(tuple, found.collect())) == [(1, 0), (2, 0)]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 2 and "SortAggregate" not in plan


def test_line_dedup_odd_rows(odd, odd_rows, none):
    done = lines.without_copied_lines(odd)
    assert done.columns == odd.columns and lines.without_copied_lines(none).count() == 0
    rows = collections.defaultdict(list)
    for r in done.collect():
        rows[r.doc_id].append(r)
    assert rows[100][0].text is None and rows[101][0].text == "" and len(rows[None]) == 2
    assert 107 not in rows  # the text of document 7, whose line came first
    assert all(r.text is None or r.n_chars == len(r.text) for rs in rows.values() for r in rs if r.text)
    assert len(rows[7]) == 3 and rows[104][0].text == "x" * 150_000


def test_short_equal_lines_are_copies_too(spark):
    rows = [(1, "Share this\none two three four five six\n\n漢字のとても長い行です"), (2, "Share  this\n\nmenu\nShare that"),
            (3, "own\n漢字のとても長い行です\nmenu\n\none two three four five 6\nown")]
    got = {r.doc_id: r.text for r in lines.without_copied_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "\nmenu\nShare that", 3: "own\n"}


# ---- decontamination ----

def test_decontamination(spark, odd, none):
    item = prose(500, 40)
    edited = item.split()
    edited[5] = edited[17] = edited[30] = "changed"
    del edited[22]
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, prose(501, 25)), (5, prose(501, 25))], "item_id long, text string")
    rows = [(200, prose(600, 80) + " " + item.upper() + ". " + prose(601, 80)), (201, prose(602, 50) + " " + " ".join(edited)), (202, prose(501, 25)),
            (203, item[: len(item) // 4] + " " + prose(603, 300)), (None, item)]
    more = odd.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(more, items).collect()}
    assert set(got) == {(200, 1), (201, 1), (202, 4), (202, 5), (None, 1)}
    assert got[200, 1].score == 1 and (got[200, 1].first_word, got[200, 1].end_word) == (80, 120)
    assert 0.6 < got[201, 1].score < 1
    small_blocks = decontaminate.contaminated(more, items, chars=10)
    assert {(r.doc_id, r.item_id) for r in small_blocks.collect()} == set(got)
    clean = decontaminate.clean(more, items)
    assert clean.columns == more.columns and clean.count() == more.count() - 4
    assert decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.contaminated(odd, items.where("false")).count() == 0 and decontaminate.clean(odd, items.where("false")).count() == odd.count()


def test_edited_copies_are_found_without_their_original(spark):
    rng = random.Random(9)
    items, rows = [(i, " ".join(f"{w}{rng.randrange(9)}" for w in prose(700 + i, 20).split())) for i in range(30)], []
    for i, body in items:
        w = body.split()
        for k in rng.sample(range(20), 5) if i else (4, 9, 14):
            w[k] = "changed" if i % 2 else f"put in {w[k]}"
        # some n-grams of the item occur more often than those that the copy keeps
        rows += [(i, f"before it {' '.join(w)} and behind it"), (100 + i, " ".join(body.split()[:4])), (200 + i, " ".join(body.split()[:3]))]
    block = decontaminate.Block(items, 3)
    ids = decontaminate.Ids(block.vocabulary)
    want = {(d, i) for d, body in rows for i, w in enumerate(block.words) if decontaminate.best_alignment(ids.of(body), w)[0] >= 20}
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and len(want) >= 25


def test_all_alignments_at_the_threshold_are_found(spark):
    """Against aligning every document with every item: edits of every kind, few words in all, passages at the bound."""
    rng = random.Random(31)
    names = [f"w{k}" for k in range(40)]
    items = [(i, " ".join(rng.choice(names) for _ in range(rng.choice([3, 5, 8, 12, 16, 17, 24, 30])))) for i in range(40)]
    rows = []
    for i, body in items:
        w = body.split()
        third = [("new" if k % 3 == 2 else x) for k, x in enumerate(w)]
        spread = [x for pair in w for x in (pair, "new")]
        thin = [x for k, x in enumerate(w) if k % 3 != 1]
        for k, edited in enumerate([w, third, spread, thin, w[: len(w) // 2], w[len(w) // 2 :]]):
            around = [rng.choice(names) for _ in range(rng.randrange(6))]
            rows.append((10 * i + k, " ".join([*around, *edited, *around])))
        for k in range(4):
            edited = [x for x in w for x in rng.choice([[x], [x], [x], ["new"], [], [x, rng.choice(names)]])]
            rows.append((10 * i + 6 + k, " ".join(edited)))
    rows += [(1000 + k, " ".join(rng.choice(names) for _ in range(60))) for k in range(30)]
    block = decontaminate.Block(items, 3)
    ids = decontaminate.Ids(block.vocabulary)
    for threshold, least in ((0.5, 8), (0.5, 2), (0.8, 8)):
        want = {}
        for d, body in rows:
            for i, w in enumerate(block.words):
                score = decontaminate.best_alignment(ids.of(body), w)[0]
                if score >= decontaminate.needed(len(w), threshold, least):
                    want[d, i] = score / (2 * len(w))
        docs, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
        got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs, table, threshold=threshold, least=least).collect()}
        assert got == want and len(want) > 40
        dirty = {d for d, _ in want}
        assert {r.doc_id for r in decontaminate.clean(docs, table, threshold=threshold, least=least).collect()} == {d for d, _ in rows} - dirty


def test_items_spare_their_commonest_seeds(spark):
    assert decontaminate.least_kept(20) == 9 and decontaminate.least_kept(15) == 7 and decontaminate.least_kept(3) == 1
    body = " ".join(f"w{k}" for k in range(20))
    common = [(k, "w0 w1 w2 w3 w4 w5") for k in range(3, 9)]
    docs = spark.createDataFrame([(1, body), *common], "doc_id long, text string")
    block = decontaminate.Block([(1, body)], 3)
    places = decontaminate.rarest(block, decontaminate.numbered(docs, block), 0.5, 8)[0].tolist()
    # 19 places hold seeds, 8 may be left out: the five common ones are among these
    assert len(places) == 11 and not set(places) & {0, 1, 2, 3, 4}
    assert {r.doc_id for r in decontaminate.contaminated(docs, spark.createDataFrame([(1, body)], "item_id long, text string")).collect()} == {1}


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a, b = rng.integers(1, 5, 14), rng.integers(1, 5, 9)
        h = np.zeros((15, 10), int)
        for i in range(1, 15):
            for j in range(1, 10):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        assert decontaminate.best_alignment(a, b)[0] == h.max()


# ---- quality ----

def plain_counts(t):
    w = SPLIT.findall(t or "")
    windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
    often = collections.Counter(windows)
    covered = {i for k, x in enumerate(windows) if often[x] > 1 for i in range(k, k + 8)}
    real = [x for x in (t or "").split("\n") if SPLIT.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(real) - len(set(real)), len(covered)


def test_quality_counts_and_rules(odd, odd_rows, none):
    got = quality.judge(odd)
    assert listed(got, "doc_id", *quality.COUNTS) == sorted(((r[0], *plain_counts(r[1])) for r in odd_rows), key=repr)
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[106].base_failed and rows[100].base_failed and not rows[105].kept
    assert all(not r.kept for r in rows.values() if r.base_failed) and rows[5].kept and rows[20].kept
    assert quality.judge(none).count() == 0


def test_robust_distances_ignore_a_mass_of_outliers(spark):
    from netsift.llm.outliers import robust_distances

    rng = np.random.default_rng(1)
    good = rng.multivariate_normal([0, 0], [[1, 0.8], [0.8, 1]], 800)
    bad = rng.multivariate_normal([6, -6], [[0.1, 0], [0, 0.1]], 160)
    df = spark.createDataFrame([("g", float(x), float(y), i < 800) for i, (x, y) in enumerate([*good, *bad])], "_g string, x double, y double, good boolean")
    got = robust_distances(df, ["x", "y"], [0.01, 0.01]).groupBy("good").agg(F.min("_d2"), F.max("_d2"), F.avg("_d2")).collect()
    by = {r.good: r for r in got}
    assert by[False][1] > 50 and 1.5 < by[True][3] < 2.6


# ---- scores ----

def test_scores(odd, odd_rows, none):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = scoring.score(odd, held).collect()
    tokens = [(r[0], (r[1] or "").encode().lower().split() + [mixing.END]) for r in odd_rows]
    train = [t for i, t in tokens if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    counts = collections.Counter(w for t in train for w in t)
    n, v = sum(counts.values()), len(counts)
    want = sorted(((i, len(t), sum(w in counts for w in t), n, round(sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in t), 5)) for i, t in tokens), key=repr)
    assert sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got), key=repr) == want
    assert all(r.score < 0 for r in got) and scoring.score(none, held).count() == 0


def test_scores_do_not_depend_on_partitions_or_blocks(odd):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    one = scoring.score(odd.coalesce(1), held).collect()
    four = scoring.score(odd.repartition(4), held, block_chars=500, bucket_entries=100).collect()
    pairs = zip(*[sorted((str(r.doc_id), r.n_tokens, r.score) for r in rows) for rows in (one, four)])
    assert len(one) == len(four) and all(a[:2] == b[:2] and abs(a[2] / b[2] - 1) < 1e-5 for a, b in pairs)


def plain_model(tokens_of, steps):
    """The method with dictionaries: node counts of every bit, Newton steps over single bits, score per document."""
    def coded(tokens):
        for before, word in zip([b"  ", *(b"  " + t for t in tokens)], tokens):
            head, closed = before[-2:] + (word + b" ")[:2], word + b" "
            for part, s in ((0, head), (1, closed)):
                for at in range(2, len(s)):
                    last = b"" + s[2:at] if part == 0 else s[max(at - 3, 0) : at]
                    contexts = [(part, k, c) for k, c in enumerate((s[at - 1 : at], s[max(at - 2, 0) : at], s[max(at - 4, 0) : at], s[:at], last))]
                    for bit in range(8):
                        node = (1 << bit) | (s[at] >> (8 - bit))
                        yield part, [(*c, node) for c in contexts], s[at] >> (7 - bit) & 1

    def seen(row, less):
        part, contexts, bit = row
        both = [[counts[c + (v,)] - less * (v == bit) for v in (0, 1)] for c in contexts]
        x = np.array([np.log((b[bit] + 0.4) / (b[1 - bit] + 0.4)) for b in both])
        whole = sum(both[3])
        return x, (whole > 0) + (whole > 3) + (whole > 60) + 4 * (sum(both[2]) > 0) + 8 * part

    counts = collections.Counter(c + (bit,) for tokens, train in tokens_of if train for _, cs, bit in coded(tokens) for c in cs)
    weights = mixing.first_weights()
    for _ in range(steps):
        slope, curve = -mixing.RIDGE * (weights - mixing.first_weights()), np.tile(np.eye(5) * mixing.RIDGE, (16, 1, 1))
        for row in (r for tokens, train in tokens_of if train for r in coded(tokens)):
            x, g = seen(row, 1)
            q = 1 / (1 + np.exp(np.clip(x @ weights[g], -15, 15)))
            slope[g] += q * x
            curve[g] += max(q * (1 - q), 1e-4) * np.outer(x, x)
        weights = weights + np.linalg.solve(curve, slope[..., None])[..., 0]
    for tokens, _ in tokens_of:
        total = 0.0
        parts = [sum(-np.logaddexp(0, -np.clip(x @ weights[g], -15, 15)) for x, g in (seen(r, 0) for r in coded(tokens[: i + 1]))) for i in range(len(tokens))]
        for i, (whole, before) in enumerate(zip(parts, [0, *parts])):
            share = scoring.CACHE_SHARE * i / (i + scoring.CACHE_HALF)
            total += np.log(np.exp(whole - before) * (1 - share) + share * tokens[:i].count(tokens[i]) / max(i, 1))
        yield total / np.log(10)


def test_scores_against_dictionaries(spark):
    texts = [prose(i, 12) for i in range(12)] + ["", prose(3, 12), "a bc a bc\u00e9 A"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = sorted(scoring.score(docs, F.col("doc_id") % 4 == 2, block_chars=200, bucket_entries=20).collect())
    tokens = [((t.encode().lower().split()) + [mixing.END], i % 4 != 2) for i, t in enumerate(texts)]
    want = list(plain_model(tokens, scoring.STEPS))
    assert np.allclose([r.score for r in got], want, rtol=1e-4)


def test_keys_of_large_buckets_take_little_memory():
    """A worker's share of memory holds a bucket of ordinary size; the keys do not depend on the slices they are made in."""
    words = [b"%x" % (i * 0x9E3779B97F4A7C15 % (1 << 40)) for i in range(60000)] + [b"long" * 5000]
    units = mixing.Units(np.arange(1000, dtype=np.uint32), np.ones(1000, np.int64), words, np.ones(len(words), np.int64))
    tracemalloc.start()
    try:
        found = [(key[:5].copy(), len(key), count.sum(), where[-1]) for key, count, where in units.keys()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 130 * len(units.owner)
    for k, (key, n, total, last) in enumerate(found):
        all_keys = np.concatenate([mixing._keys(*text, part)[k] for part, text in enumerate(units.texts)])
        want, where = np.unique(all_keys, return_inverse=True)
        assert (want[:5] == key).all() and (len(want), len(all_keys), where[-1]) == (n, total, last)


def test_counts_are_taken_part_by_part():
    """A range's counts are predicted from as they came: the whole table of a context is never unpacked at once."""
    rng = np.random.default_rng(1)
    nodes = [np.sort(rng.integers(0, 90, (160_000, 9)))[:, ::-1] for _ in range(mixing.CONTEXTS)]
    where = [rng.integers(0, 160_000, 5000).astype(np.uint32) for _ in range(mixing.CONTEXTS)]
    tables = []
    for some, places in zip(nodes, where):
        tables += [[scoring._zip(np.ascontiguousarray(part.T).tobytes()) for part in np.split(some, 16)], scoring._zip(places.tobytes())]
    tracemalloc.start()
    try:
        parted = scoring._predictor(tables, 1000, 1)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 160_000 * (8 * 4 * (mixing.CONTEXTS + 1) + 32)  # what is predicted, one context twice, and the gates
    whole = mixing.Predictor(nodes, where, 1000, 1)
    for (_, x, gate), (_, y, same) in zip(parted.batches(np.arange(5000)), whole.batches(np.arange(5000))):
        assert (x == y).all() and (gate == same).all()


def test_workers_get_short_batches_while_scoring(spark, odd, monkeypatch):
    name, seen, plain = "spark.sql.execution.arrow.maxBytesPerBatch", [], scoring.written
    before = spark.conf.get(name, None)
    monkeypatch.setattr(scoring, "written", lambda df: seen.append(spark.conf.get(name)) or plain(df))
    scoring.score(odd, F.lit(False))
    assert len(seen) == 4 and set(seen) == {str(scoring.BATCH_BYTES)} and spark.conf.get(name, None) == before


def test_model_is_a_distribution():
    """The probabilities of all next bytes add up to one, whatever was learned."""
    vocabulary = [w.encode() for w in sorted(set(prose(1, 400).split()))]
    # words of two bytes code one byte more after them; every one of its values is asked for
    asked = [b"th" + bytes([b]) for b in range(256) if b not in b" "]
    known = mixing.Units(np.zeros(0, np.uint32), np.zeros(0, np.int64), [*vocabulary, *asked], np.array([1] * len(vocabulary) + [0] * len(asked)))
    learned = list(known.keys())
    nodes = [mixing.node_sums(key, count) for key, count, _ in learned]
    predictor = mixing.Predictor(nodes, [where for _, _, where in learned], 0, 0)
    weights = mixing.step(mixing.first_weights(), mixing.gradients(known.often, mixing.Predictor(nodes, predictor.where, 0, 1), mixing.first_weights()))
    first = np.flatnonzero(np.append(True, np.diff(known.owner) > 0) & (known.owner >= len(vocabulary)))
    cost = mixing.costs(known.owner, len(vocabulary) + len(asked), predictor, weights)
    closing = mixing.costs(known.owner[first + 1], len(vocabulary) + len(asked), mixing.Predictor(nodes, [w[first + 1] for w in predictor.where], 0, 0), weights)
    total = np.exp((cost - closing)[len(vocabulary) :]).sum()
    space = mixing.Units(np.zeros(0, np.uint32), np.zeros(0, np.int64), [*vocabulary, *asked, b"th"], np.array([1] * len(vocabulary) + [0] * (len(asked) + 1)))
    learned = list(space.keys())
    last = mixing.costs(space.owner, sum(space.sizes), mixing.Predictor([mixing.node_sums(k, c) for k, c, _ in learned], [w for _, _, w in learned], 0, 0), weights)[-1]
    assert abs(total + np.exp(last) - 1) < 1e-4


# ---- packing ----

def test_packing(odd, odd_rows, none):
    path = packing.vocabulary("byte_bpe_50k.json")
    rows = packing.pack(odd, path, window=5000, ranks=packing.vocabulary("byte_bpe_50k.tiktoken")).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    want = collections.Counter((i, zlib.crc32(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes())) for i, t, *_ in odd_rows)
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024 and (at == 1024 or at & (at - 1) == 0)
    single = {(r.doc_id, r.ids_crc32) for r in rows if r.length == r.doc_tokens}
    assert single <= set(want) and sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    assert packing.pack(none, path).count() == 0


@pytest.mark.parametrize("text", [
    "  a b\x1cc  d\n\n e 　f\x85g  ", "<|endoftext|>  x  <|endoftext|>", "it's  'll \t\tfoo123,bar   ", "\x1c\x1d a\x1f", "   ", "a\r\n\r\n  b", "",
    " ", "x \n", "é à   ü", "a  b  ", "foo\n bar  \n", prose(9, 200),
])
def test_encoder_gives_the_tokenizers_ids(text):
    encoder = packing.encoder(packing.vocabulary("byte_bpe_50k.json"), packing.vocabulary("byte_bpe_50k.tiktoken"))
    assert np.frombuffer(encoder.many([text])[0], np.uint32).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_balance_takes_the_lowest_cost_with_room():
    placed, left = packing.balance([9, 7, 5, 4, 4, 3], 3, 10, 1.0, 0.1)
    assert not left or sum(n for _, _, n in left) == 32 - 30
    assert all(sum(n for _, _, n in s) == 10 for s in placed)
    assert [s[0] for s in placed] == [(0, 0, 9), (1, 0, 7), (2, 0, 5)] and placed[2][1] == (3, 0, 4)


# ---- token counts ----

def greedy(word, starting, continuing):
    n = i = 0
    while i < len(word):
        for j in range(len(word), i, -1):
            if word[i:j] in (continuing if i else starting):
                n, i = n + 1, j
                break
        else:
            return -1
    return n


def test_automaton_counts_like_greedy_matching():
    rng = random.Random(8)
    for _ in range(30):
        starting, continuing = ({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 4))) for _ in range(6)} for _ in range(2))
        machine = wordpiece.Automaton(starting, continuing)
        batch = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 12))) for _ in range(200)]
        want = [greedy(w, starting, continuing) for w in batch]
        assert machine.count(batch).tolist() == want and [machine.count_one(w) for w in batch] == want


def test_token_counts(odd, odd_rows, none):
    path = packing.vocabulary("byte_bpe_50k.json")
    starting, continuing = map(set, wordpiece.byte_level_pieces(path))
    got = listed(wordpiece.token_counts(odd.where("doc_id <> 104 or doc_id is null"), path), "doc_id", "n_words", "n_tokens", "n_unknown")
    known = {}
    want = []
    for i, t, *_ in odd_rows:
        if i != 104:
            found = [w.encode() for w in words(t)]
            want.append((i, len(found), sum(known.setdefault(w, None) or known.__setitem__(w, greedy(w, starting, continuing)) or known[w] for w in found), 0))
    assert got == sorted(want, key=repr) and wordpiece.token_counts(none, path).count() == 0
    assert wordpiece.token_counts(odd, path).where("doc_id = 104").first().n_words == 1


def test_runs_of_anchors_over_stretches(monkeypatch):
    rng = random.Random(21)
    texts = ["".join(rng.choice("ab") for _ in range(rng.choice([0, 3, 49, 50, 51, 300]))) * rng.choice([1, 5]) for _ in range(40)]
    ids = [rng.choice([substrings._NOBODY, 1, 2, 3]) for _ in texts]
    packed = (np.array(ids, np.int64).tobytes(), np.array([len(t) for t in texts], np.int64).tobytes(), substrings._zip("".join(texts).encode()))
    got = []
    for stretch in (7, 64, 1 << 14):
        monkeypatch.setattr(substrings, "STRETCH", stretch)
        block = substrings.Block(*packed, 50)
        block.runs()
        starts, rest, docs, where = block.anchors(3)
        got.append([x.tolist() for x in (block.first, block.many, block.owner, block.hash, starts, rest, docs, where)])
    assert got[0] == got[1] == got[2]
    # every string of a document with an id is in one run of its document, and each anchor counts its documents
    at = np.repeat(block.first, block.many) + np.concatenate([np.arange(m) for m in block.many])
    begins = np.cumsum([0, *map(len, texts)])
    assert at.tolist() == [b + i for b, t, d in zip(begins, texts, ids) if d != substrings._NOBODY for i in range(len(t) - 49)]
    assert docs.tolist() == [len(set(block.owner[where == i].tolist())) for i in range(len(docs))]
    # equal strings have equal anchors
    of = {}
    raw = "".join(texts)
    for first, many, h in zip(block.first.tolist(), block.many.tolist(), block.hash.tolist()):
        assert all(of.setdefault(raw[i : i + 50], h) == h for i in range(first, first + many))


# ---- near-duplicates ----

def bag(text):
    w = words(text)
    n = min(5, len(w))
    return collections.Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w else collections.Counter()


def test_near_classes_against_all_pairs(spark):
    rng = random.Random(4)
    texts = []
    for g in range(12):
        base = prose(g, rng.randint(30, 120)).split()
        for _ in range(rng.randint(1, 12)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = "edit"
            texts.append(" ".join(w))
    rng.shuffle(texts)
    bags = [bag(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in range(len(texts)):
        for j in range(i):
            if sum((bags[i] & bags[j]).values()) >= 0.8 * sum((bags[i] | bags[j]).values()):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: find(i) for i in range(len(texts))}
    assert {r.id: r.class_id for r in near.near_classes(df).collect()} == want
    # few rows a band put strangers into one bucket: the splits lose nothing
    assert {r.id: r.class_id for r in near.near_classes(df, bands=60, rows=1).collect()} == want


def test_near_cells_against_all_pairs(spark):
    rng = random.Random(11)
    base = prose(77, 90).split()
    texts = ["same " * 70, "same " * 60, *(" ".join(x if rng.random() > 0.03 else "edit" + str(rng.randrange(9)) for x in base) for _ in range(60))]
    bags = [bag(t) for t in texts]
    hashes = darts.WordHashes()
    hashed = [darts.shingles(words(t), hashes, 5) for t in texts]
    both = near.common(hashed)
    want = [[sum((a & b).values()) for b in bags] for a in bags]
    assert all(both[i, j] == want[i][j] for i in range(len(texts)) for j in range(len(texts)) if i != j)
    roots = list(range(len(texts)))
    for a, b in near.joined(hashed, roots, [0] * len(texts), 0.8):
        roots = [min(a, b) if r == max(a, b) else r for r in roots]
    classes = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if darts.similarity(hashed[i], hashed[j]) >= 0.8:
                classes = [classes[j] if c == classes[i] else c for c in classes]
    alike = lambda xs: [[a == b for b in xs] for a in xs]
    assert alike(roots) == alike(classes) and 2 < len(set(roots)) < len(roots)
    # a group many times the size of a block: each text is in one cell per block, and no link is lost
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.class_id for r in near.near_classes(df, bands=60, rows=1, block=7).collect()}
    assert alike([got[i] for i in range(len(texts))]) == alike(classes)


def test_near_buckets_make_no_row_per_pair(spark):
    met = spark.createDataFrame([(k, 0, i) for k in (1, 2) for i in range(1000)] + [(3, 0, 1), (3, 0, 2)], "key long, band byte, id long")
    roots = spark.createDataFrame([(1, 1), (2, 1)], "id long, root long")
    sizes = spark.createDataFrame([(i, 50) for i in range(1000)], "id long, n long")
    cells = near._cells(met, roots, sizes, 512).collect()
    # the set is taken once; bucket 3 has one root; two blocks, so three cells
    assert len(cells) == 2000 and {(r.x, r.y) for r in cells} == {(0, 0), (0, 1), (1, 1)} and len({r.key for r in cells}) == 1


def test_near_texts_are_sieved_before_they_are_shuffled(spark):
    rows = spark.range(100_000).selectExpr("id * 7 - 1000 doc", "cast(id as string) text")
    asked = spark.range(0, 100_000, 10).selectExpr("id * 7 - 1000 first")
    got = {r.doc for r in near._sieved(rows, "doc", asked, "first").select("doc").collect()}
    want = {i * 7 - 1000 for i in range(0, 100_000, 10)}
    assert want <= got and len(got) < 1.1 * len(want)
    assert near._sieved(rows, "doc", asked.where("false"), "first").count() == 0


def test_near_odd_rows(odd, none):
    got = {r.id: r.class_id for r in near.near_classes(odd).collect()}
    assert got[107] == 7 and got[100] == 100 and got[101] == 101 and got[102] == 102 and None not in got
    kept = near.one_of_each(odd)
    assert kept.columns == odd.columns and kept.where("doc_id is null").count() == 2 and kept.where("doc_id = 107").count() == 0
    assert kept.where("doc_id = 7").count() == 3 and near.near_classes(none).count() == 0


def test_darts_estimate_weighted_similarity():
    rng = np.random.default_rng(6)
    keys = np.sort(rng.integers(0, 1 << 62, 300).astype(np.uint64))
    a, b = (keys, rng.integers(1, 9, 300)), (keys[40:], rng.integers(1, 9, 260))
    signature = darts.signatures([a, b], 4096)
    assert abs((signature[0] == signature[1]).mean() - darts.similarity(a, b)) < 0.03


# ---- pages ----

PAGE = """<!DOCTYPE html><html><head><title>x</title><script>var t="</p>";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a>m</a></ul></nav><div class="cookie-notice">We use cookies</div><div id="content"><article class="post">
<h1>T &amp; x&nbsp;y</h1><p>One <b>two</b><br>three<p>Four <form><input></form><div class="ad">buy</div><ul><li>a<li>b</ul>
<table><tr><td>c<td>d</table><aside>no</aside><p>Five &lt;x&gt; 5 < 6 and a<b</p></article><section class="comments"><p>hey
</section></div><footer>f</footer></body></html>"""


def test_main_text():
    assert main_text(PAGE, None) == "T & x y\nOne two three\nFour\na\nb\nc\nd\nFive <x> 5 < 6 and a"
    for text in ("<p", "<", "a < b", '<a href="', "<!--", "<script>", "</p></div>", "<p>" * 500, '<a ' + '"' * 3001, "&#1114112; &bogus; &am"):
        assert isinstance(main_text(text, None), str)


def test_wrapper_joins_optional_and_repeated_parts():
    forms = [wrappers.elements(wrappers.read_page(p)[0]) for p in (
        "<div><h1>a</h1><p>b<p>c</div>", "<div><h1>a</h1><h2>s</h2><p>b</div>", "<div><p>b</div>",
    )]
    whole = forms[0]
    for f in forms[1:]:
        whole = wrappers.aligned(whole, f)
    assert wrappers.written_out(whole) == "(div (h1 #)? (h2 #)? (p #)+)"
    assert wrappers.read_back(wrappers.written_out(whole)) == whole


def test_the_wrapper_tells_the_kinds_of_root(spark):
    """What the wrapper of a host shows decides where a page's text is looked for."""
    page = "<div id='content'><p>one</p><main><p>two</p></main></div>"
    assert [main_text(page, r) for r in ("article,main", "main", "-", None)] == ["two", "two", "one\ntwo", "two"]
    rows = [(1, "http://a.b/1", page), (2, "http://a.b/2", "<article>x</article>"), (3, "http://c.d/", "<p>plain</p>"), (4, "http://e.f/", "<main>y</main>")]
    roots = {r.host: r.root.split(" ")[0] for r in infer(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert roots == {"a.b": "article,main", "c.d": "-", "e.f": "main"}


def test_extract_odd_pages(spark):
    plain = "<div class='top'>menu menu</div><div class='x'><p>{} long enough to be the most of it</p></div>"
    rows = [(1, "http://a.b/1", PAGE), (2, "http://a.b/2", None), (3, None, ""), (None, "no url", "<p>t"), (1, "http://a.b/1", PAGE)]
    rows += [(10 + i, f"https://c.d/{i}", plain.format(prose(i, 30))) for i in range(5)]
    df = spark.createDataFrame([(*r, "t", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = extract(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert by[2] == "" and by[3] == "" and by[None] == "t" and by[1].startswith("T & x y\nOne")
    assert by[12] == prose(2, 30) + " long enough to be the most of it"
    assert extract(df.where("false")).count() == 0


def test_every_text_of_a_repeated_id_links(spark):
    x = prose(910, 60).split()
    y = prose(911, 60).split()
    near_x, near_y = [*x[:-1], "other"], [*y[:-1], "other"]
    rows = [(1, " ".join(x)), (1, " ".join(y)), (2, " ".join(near_y)), (3, " ".join(near_x)), (4, prose(912, 60)), (1, "  ".join(x)), (5, " ".join(y))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 5):
        got = {r.id: r.class_id for r in near.near_classes(df.repartition(parts)).collect()}
        assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 1}
    # an id of larger number than one that it is linked with through its second text only
    rows = [(9, " ".join(x)), (9, " ".join(y)), (2, " ".join(near_y)), (30, " ".join(near_x))]
    got = {r.id: r.class_id for r in near.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {9: 2, 2: 2, 30: 2}

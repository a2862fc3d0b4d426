"""Phrase collocations by weighted acyclic automata.

Phrases of up to five words are counted per language within pieces of text; a phrase scores by how
much more often it stands than its two parts would by chance, at its weakest cut.

1. Tasks cut texts into pieces and words once and keep them as shards of bounded size: sorted
   words and, per language, the numbers of the words in order.
2. Counts of single words are summed over shards; each shard gets back those of its words that
   are frequent. A phrase is frequent only if all its words are.
3. Each shard sorts its pairs of frequent words and builds count transducers from them
   (``transducers``), one per prefix range: a group of first words. Phrases whose first word
   stands more than ``HOT`` times go over several ranges by their second word.
4. A range's transducers are united and their weights summed; what stays below ``least`` goes.
   Composing the sum with what a shard sent gives the pairs that the shard has to go on with.
5. The same once more for phrases of three to five words all of whose pairs are frequent.
6. In the united transducer of a range, each phrase meets the counts of its first parts on its
   path. Its last parts go to their own ranges, where a transducer of all that is asked for
   is composed with the counts. Parts of one word are joined with the counts of words.

No count is dropped before it is known in full: only frequent phrases can be candidates or parts
of such. Ranges are ``RANGES``, or more so that they hold some ``HOT`` occurrences each.

Cases: a null text counts as empty, a null language is ``und``; texts without words give
nothing; repeated rows count as often as they occur; very long texts make a shard of their own;
an empty table gives no rows; other columns are not read. Equal scores are ranked by count, then by
the bytes of the phrase.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netsift.llm.common import groups_of, read, rows_of, utf8, written
from netsift.llm.transducers import Transducer, compose, union
from netsift.operators.skew import join_lookup

SHARD_CHARS = 16_000_000
HOT = 1 << 20
RANGES = 256
_SPREAD = 0x9E3779B1
LONGEST = 5
# What ends a piece becomes a line break, the tab a space, A to Z lower case.
_TABLE = bytes.maketrans(
    b".,;:!?\x0a\x0b\x0c\x0d\x09" + bytes(range(65, 91)), b"\n" * 10 + b" " + bytes(range(97, 123))
)
_COUNTS = "lang string, part int, shard long, hot array<struct<word:binary,total:long>>, counts binary"
_ARROW = {
    "lang": pa.string(), "part": pa.int32(), "shard": pa.int64(),
    "hot": pa.list_(pa.struct([("word", pa.binary()), ("total", pa.int64())])), "counts": pa.binary(),
}


def _table(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds.values())], names=list(kinds))


def _batches(rows: Iterator[tuple], kinds: dict[str, pa.DataType], size: int = 2000) -> Iterator[pa.RecordBatch]:
    while some := list(itertools.islice(rows, size)):
        yield _table(some, kinds)


def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def shards(docs: DataFrame, text: str, lang: str, chars: int = SHARD_CHARS) -> DataFrame:
    """``shard, lang, n, words, numbers``: sorted words, and the text as their numbers with -1 between pieces."""
    kinds = {"shard": pa.int64(), "lang": pa.string(), "n": pa.int64(), "words": pa.binary(), "numbers": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for group in groups_of(rows_of(batches, "lang", "text"), chars):
            by_lang = defaultdict(list)
            for lang, text in group:
                if text:
                    by_lang["und" if lang is None else lang].append(utf8(text))
            out = []
            for lang, texts in by_lang.items():
                seen = defaultdict(itertools.count().__next__)
                seen[b""], seen[b"\n"]
                tokens = b"\n".join(texts).translate(_TABLE).replace(b"\n", b" \n ").split(b" ")
                ids = np.fromiter(map(seen.__getitem__, tokens), np.int32, len(tokens))
                ids = ids[ids > 0]
                words = list(seen)[2:]
                if not words:
                    continue
                order = sorted(range(len(words)), key=words.__getitem__)
                place = np.full(len(words) + 2, -1, np.int32)
                place[np.array(order) + 2] = np.arange(len(words))
                numbers = place[ids]
                out.append((number, lang, int((numbers >= 0).sum()), _zip(b"\n".join([words[i] for i in order])), _zip(numbers.tobytes())))
            yield _table(out, kinds)
            number += 1

    slim = docs.selectExpr(f"cast(`{lang}` as string) lang", f"cast(`{text}` as string) text")
    return slim.mapInArrow(run, "shard long, lang string, n long, words binary, numbers binary")


def _single_words(kept: DataFrame) -> DataFrame:
    """``shard, lang, word, c``."""
    kinds = {"shard": pa.int64(), "lang": pa.string(), "word": pa.binary(), "c": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, lang, words, numbers in rows_of(batches, "shard", "lang", "words", "numbers"):
            words, numbers = _unzip(words).split(b"\n"), np.frombuffer(_unzip(numbers), np.int32)
            counts = np.bincount(numbers[numbers >= 0], minlength=len(words))
            for at in range(0, len(words), 50_000):
                some = words[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(some), pa.int64()), pa.array([lang] * len(some)), pa.array(some, pa.binary()), pa.array(counts[at : at + 50_000])],
                    names=list(kinds),
                )

    return kept.mapInArrow(run, "shard long, lang string, word binary, c long")


class _Ranges:
    """Which prefix range a phrase belongs to: by its first word, by its second too if the first is hot."""

    def __init__(self, ranges: int, hot: int):
        self.ranges, self.hot = ranges, hot

    def part(self, first: bytes, second: bytes, total: int) -> int:
        piece = zlib.crc32(second) % -(-total // self.hot) if total > self.hot else 0
        return (zlib.crc32(first) + piece * _SPREAD) % self.ranges

    def column(self, first: str, second: str, total: str) -> Column:
        """The same as a column."""
        pieces = F.ceil(F.col(total) / self.hot)
        piece = F.when(F.col(total) > self.hot, F.pmod(F.crc32(second), pieces)).otherwise(F.lit(0))
        return F.pmod(F.crc32(first) + piece * _SPREAD, F.lit(self.ranges)).cast("int")

    def messages(self, shard: int, lang: str, runs: Iterator[tuple], totals: dict[bytes, int]) -> Iterator[tuple]:
        """Transducers of sorted runs of phrases, one per prefix range. ``totals`` has the counts of hot words at least."""
        parts = defaultdict(list)
        for stem, words, counts in runs:
            total = totals.get(stem[0], 0)
            if len(stem) > 1 or total <= self.hot:
                parts[self.part(stem[0], stem[1] if len(stem) > 1 else b"", total)].append((stem, words, counts))
                continue
            pieces = defaultdict(list)
            for word, count in zip(words, counts):
                pieces[self.part(stem[0], word, total)].append((word, count))
            for part, piece in pieces.items():
                parts[part].append((stem, *map(list, zip(*piece))))
        for part, some in parts.items():
            hot = [{"word": w, "total": totals[w]} for w in {stem[0] for stem, *_ in some} if totals.get(w, 0) > self.hot]
            yield lang, part, shard, hot, Transducer.build_runs(some).pack()


def _pairs(kept: DataFrame, known: DataFrame, ranges: _Ranges) -> DataFrame:
    """Transducers of the pairs of frequent words of each shard."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for shard, lang, words, numbers, frequent in rows_of(batches, "shard", "lang", "words", "numbers", "known"):
            words, numbers = _unzip(words).split(b"\n"), np.frombuffer(_unzip(numbers), np.int32)
            totals = {w["word"]: w["total"] for w in frequent}
            good = np.array([w in totals for w in words] + [False])
            a, b = numbers[:-1].astype(np.int64), numbers[1:]
            both = good[a] & good[b]
            codes, counts = np.unique(a[both] * len(words) + b[both], return_counts=True)
            one, two = np.divmod(codes, len(words))
            starts = np.flatnonzero(np.diff(one, prepend=-1)).tolist()
            firsts, seconds, counts = one[starts].tolist(), [words[j] for j in two.tolist()], counts.tolist()
            runs = (((words[i],), seconds[a:z], counts[a:z]) for i, a, z in zip(firsts, starts, [*starts[1:], len(counts)]))
            yield from ranges.messages(shard, lang, runs, totals)

    joined = kept.join(known, ["shard", "lang"])
    return joined.mapInArrow(lambda batches: _batches(rows(batches), _ARROW), _COUNTS)


def _longer(kept: DataFrame, replies: DataFrame, longest: int, ranges: _Ranges) -> DataFrame:
    """Transducers of the phrases of three words and more all of whose pairs are frequent."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for shard, lang, words, numbers, pairs in rows_of(batches, "shard", "lang", "words", "numbers", "pairs"):
            words, numbers = _unzip(words).split(b"\n"), np.frombuffer(_unzip(numbers), np.int32).astype(np.int64)
            place = {w: i for i, w in enumerate(words)}
            totals, codes = {}, []
            for reply in pairs:
                totals.update((w["word"], w["total"]) for w in reply["hot"])
                codes += [place[a] * len(words) + place[b] for (a, b), _ in Transducer.unpack(reply["counts"]).paths()]
            codes = np.sort(np.array(codes, np.int64))
            inside = (numbers[:-1] >= 0) & (numbers[1:] >= 0)
            pair = np.where(inside, numbers[:-1] * len(words) + numbers[1:], -1)
            at = np.minimum(np.searchsorted(codes, pair), len(codes) - 1)
            frequent = codes[at] == pair
            # phrases are numbered in the order of their words, one word more at a time
            start = np.flatnonzero(frequent)
            number, phrases, counted = at[start], [divmod(int(c), len(words)) for c in codes], []
            for length in range(3, longest + 1):
                follows = start + length - 2
                ok = follows < len(frequent)
                ok[ok] = frequent[follows[ok]]
                start, number = start[ok], number[ok]
                found, number, counts = np.unique(number * len(words) + numbers[start + length - 1], return_inverse=True, return_counts=True)
                phrases = [(*phrases[c // len(words)], c % len(words)) for c in found.tolist()]
                counted += zip(phrases, counts.tolist())
            counted.sort()
            by_stem = ((stem, list(zip(*run))) for stem, run in itertools.groupby(counted, key=lambda pc: pc[0][:-1]))
            runs = ((tuple([words[i] for i in stem]), [words[p[-1]] for p in some], counts) for stem, (some, counts) in by_stem)
            yield from ranges.messages(shard, lang, runs, totals)

    joined = kept.join(replies, ["shard", "lang"])
    return joined.mapInArrow(lambda batches: _batches(rows(batches), _ARROW), _COUNTS)


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    """Rows dealt by prefix range, those of a range together."""
    return rows.repartition("lang", "part").sortWithinPartitions("lang", "part", *order)


def _by_range(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    return itertools.groupby(rows_of(batches, "lang", "part", *names), key=lambda r: r[:2])


def _united(messages: DataFrame, least: int, replies: bool) -> DataFrame:
    """Sums over shards (a null ``shard``), and, if asked for, what of it each shard has."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (lang, part), group in _by_range(batches, "shard", "hot", "counts"):
            sent = [row[2:] for row in group]
            total = union((Transducer.unpack(counts) for *_, counts in sent), least)
            if not total.arcs[-1]:
                continue
            yield lang, part, None, [], total.pack()
            for shard, hot, counts in sent if replies else ():
                left = [(phrase, count) for phrase, count, _ in compose(Transducer.unpack(counts), total)]
                if left:
                    yield lang, part, shard, hot, Transducer.build(left).pack()

    return _dealt(messages).mapInArrow(lambda batches: _batches(rows(batches), _ARROW, 50), _COUNTS)


def _cuts(totals: DataFrame) -> DataFrame:
    """Each frequent phrase at each cut, with the counts of first parts of two words and more (``l``)."""
    kinds = {"lang": pa.string(), "phrase": pa.binary(), "a": pa.int64(), "k": pa.int32(), "l": pa.int64(), "head": pa.binary(), "first": pa.binary(), "second": pa.binary(), "rest": pa.binary()}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (lang, _), group in _by_range(batches, "counts"):
            for phrase, count, before in union(Transducer.unpack(counts) for *_, counts in group).prefixes():
                text = b" ".join(phrase)
                for k in range(1, len(phrase)):
                    second = phrase[k + 1] if len(phrase) > k + 1 else None
                    yield lang, text, count, k, before[k - 1], phrase[0], phrase[k], second, b" ".join(phrase[k:])

    schema = "lang string, phrase binary, a long, k int, l long, head binary, first binary, second binary, rest binary"
    return _dealt(totals.select("lang", "part", "counts")).mapInArrow(lambda b: _batches(rows(b), kinds), schema)


def _answered(questions: DataFrame, totals: DataFrame) -> DataFrame:
    """``questions`` with ``r``, the count of the rest, looked up in the range it belongs to."""
    kinds = {"lang": pa.string(), "phrase": pa.binary(), "a": pa.int64(), "k": pa.int32(), "l": pa.int64(), "rest": pa.binary(), "r": pa.int64()}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (lang, _), group in _by_range(batches, "kind", "counts", "phrase", "a", "k", "l", "rest"):
            known, asked = [], []
            for _, _, kind, counts, *question in group:
                if kind == 0:
                    known.append(Transducer.unpack(counts))
                else:
                    asked.append(question)
            wanted = Transducer.build(sorted((tuple(rest.split(b" ")), 0) for rest in {q[-1] for q in asked}))
            answers = {b" ".join(p): c for p, _, c in compose(wanted, union(known))}
            for phrase, a, k, cut_l, rest in asked:
                yield lang, phrase, a, k, cut_l, rest, answers[rest]

    counts = totals.select("lang", "part", F.lit(0).alias("kind"), "counts")
    everything = questions.withColumn("kind", F.lit(1)).unionByName(counts, allowMissingColumns=True)
    schema = "lang string, phrase binary, a long, k int, l long, rest binary, r long"
    return _dealt(everything, "kind").mapInArrow(lambda b: _batches(rows(b), kinds), schema)


def collocations(
    docs: DataFrame, least: int = 100, top: int = 2000, longest: int = LONGEST, hot: int = HOT, ranges: int = RANGES,
    text_column: str = "text", lang_column: str = "lang",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of 2 to ``longest`` words.

    Candidates stand ``least`` times or more. One that lies in a longer candidate that stands as often is left out.
    """
    if least < 1 or longest < 2:
        raise ValueError("phrases stand once at least and have two words at least")
    kept = written(shards(docs, text_column, lang_column))
    total = F.sum("c").over(Window.partitionBy("lang", "word"))
    counted = written(_single_words(kept).withColumn("total", total).where(F.col("total") >= least))
    words = counted.groupBy("lang", "word").agg(F.first("total").alias("total"))
    known = counted.groupBy("shard", "lang").agg(F.collect_list(F.struct("word", "total")).alias("known"))
    # ranges grow in number with the words, so that the size of one stays
    dealt = _Ranges(max(ranges, (kept.agg(F.sum("n")).first()[0] or 0) // hot), hot)
    pairs = written(_united(_pairs(kept, known, dealt), least, replies=True))
    replies = pairs.where("shard is not null").groupBy("shard", "lang").agg(F.collect_list(F.struct("hot", "counts")).alias("pairs"))
    longer = _united(_longer(kept, replies, longest, dealt), least, replies=False)
    totals = written(pairs.where("shard is null").unionByName(longer))
    cuts = join_lookup(_cuts(totals), words.select("lang", F.col("word").alias("head"), F.col("total").alias("f_head")), ["lang", "head"])
    cuts = join_lookup(cuts, words.select("lang", F.col("word").alias("first"), F.col("total").alias("f_first")), ["lang", "first"])
    cuts = written(cuts.withColumn("l", F.coalesce("l", "f_head")).withColumn("part", dealt.column("first", "second", "f_first")))
    single = cuts.where("second is null").select("lang", "phrase", "a", "k", "l", "rest", F.col("f_first").alias("r"))
    questions = cuts.where("second is not null").select("lang", "part", "phrase", "a", "k", "l", "rest")
    parts = written(_answered(questions, totals).unionByName(single))
    # A longer candidate that stands as often as a part has a candidate of one word more than the part between them.
    same = parts.where("k = 1 and r = a and instr(rest, ' ') > 0").selectExpr("lang", "rest phrase").unionByName(
        parts.where("instr(rest, ' ') = 0 and k > 1 and l = a").selectExpr("lang", "substring(phrase, 1, length(phrase) - length(rest) - 1) phrase")
    )
    n = kept.groupBy("lang").agg(F.sum("n").alias("n"))
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    scored = parts.join(n, "lang").withColumn("over", whole("a") * whole("n") * F.lit(1000).cast("decimal(4,0)")).withColumn("under", whole("l") * whole("r"))
    scored = scored.withColumn("score", F.expr("`over` div `under`"))
    weakest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
    left = weakest.join(same.distinct(), ["lang", "phrase"], "left_anti").select("lang", F.col("phrase").cast("string").alias("phrase"), "cut.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(read(spark, folder, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), cut AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM cut GROUP BY lang
), grams AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM cut, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE len(w) >= size)
), f AS (
  SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, size, phrase, a, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS x, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, size)) AS k FROM f WHERE size >= 2)
), scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, c.x, c.y, p.a AS l, q.a AS r, t.n,
    1000::HUGEINT * c.a * t.n // (p.a::HUGEINT * q.a) AS score
  FROM cuts c JOIN f p ON p.lang = c.lang AND p.phrase = c.x JOIN f q ON q.lang = c.lang AND q.phrase = c.y JOIN totals t ON t.lang = c.lang
), dropped AS (
  SELECT DISTINCT s.lang, s.phrase FROM f s JOIN f b ON b.lang = s.lang AND b.size > s.size AND b.a = s.a
    AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ') WHERE s.size >= 2
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM scored
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
  FROM best b WHERE nth = 1 AND NOT EXISTS (SELECT 1 FROM dropped d WHERE d.lang = b.lang AND d.phrase = b.phrase)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

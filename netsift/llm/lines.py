"""Line dedup by a deletion-neighbourhood join.

A line counts as a copy if a line earlier in the corpus (by document id, then position)
differs from it by at most one word put in, taken out or exchanged; every copy is
removed, the earliest stays. Lines of under ``min_words`` words are copies only of equal
lines, and with ``short=False`` are left alone; lines without words
always stay. White space between words does not count. What is earlier is judged on the input, so the
answer does not depend on any order of work.

1. Equal lines meet by their hash; each distinct line goes on once, with its earliest place.
2. Two lines within the bound share their first or their last ``a`` words, ``a`` being
   about half their length. Distinct lines that share neither with another line have no
   partner and need no variants. This loses no pair.
3. The others emit each variant with one word of the half that is not shared left out, as
   a hashed key, and themselves.
   Lines of a length that share a variant at one position differ by that one word; a line
   that is itself the variant of another differs by one word too. So the earliest line per
   (variant, position) and per variant is all a member needs: no pairs are built, and a
   key shared by any number of lines is summed up map side.
4. Each line found to be a copy is compared word by word with its earlier partner.

DataFrame operations only. A document's text is shuffled to take out the copies, and to
give the lines in question their words if these lines are more than ``MAX_SENT``.

Cases: a null text has no lines and stays null; documents with a null id stay as they
are; repeated ids count as one document if the texts are equal, and otherwise lines at the
same place keep or go together; an empty table gives an empty one; other columns pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from netsift.functions.staging import once
from netsift.llm.common import read, written
from netsift.llm.quality import SPACE_PATTERN
from netsift.operators.skew import is_small

MIN_WORDS = 5
# Lines in question that are sent to every task rather than met by a shuffle.
MAX_SENT = 1_000_000


def _words(line: Column) -> Column:
    return F.array_remove(F.split(line, SPACE_PATTERN), "")


def _half(n: Column) -> Column:
    """About half of ``n`` words, never more; the same for most neighbouring lengths."""
    return F.when(n < 16, 2 * F.floor(n / 4)).otherwise(8 * F.floor(n / 16)).cast("int")


def _ends(hashes: Column, a: Column) -> list[Column]:
    first = F.xxhash64(F.lit(1), a, F.slice(hashes, F.lit(1), a))
    return [first, F.xxhash64(F.lit(2), a, F.slice(hashes, F.size(hashes) - a + 1, a))]


def _distinct_lines(docs: DataFrame, least: int) -> DataFrame:
    """Distinct lines: ``h1, h2`` (hash of the words), ``place`` (earliest id and position), ``n``, ``ends``.

    ``ends`` holds the first and last words, as long as suits a partner of the same length or
    longer, and if that differs, as long as suits a shorter one.
    """
    lines = docs.select("_id", F.posexplode(F.split("_text", "\n")).alias("pos", "line"))
    lines = once(lines, hashes=F.transform(_words(F.col("line")), lambda w: F.xxhash64(w))).drop("line")
    lines = lines.where(F.size("hashes") >= least)
    n, h = F.size("hashes"), F.col("hashes")
    ends = _ends(h, _half(n))
    ends = F.when(_half(n) == _half(n - 1), F.array(*ends)).otherwise(F.array(*ends, *_ends(h, _half(n - 1))))
    keyed = lines.select("_id", "pos", n.alias("n"), F.xxhash64(h).alias("h1"), F.xxhash64(F.lit(7), h).alias("h2"), ends.alias("ends"))
    return keyed.groupBy("h1", "h2").agg(
        F.min(F.struct("_id", "pos")).alias("place"), F.first("n").alias("n"), F.first("ends").alias("ends")
    )


def _in_question(distinct: DataFrame) -> DataFrame:
    """``place`` of lines that share an end with another line, and the range ``low``..``high`` of words that may differ."""
    n = F.col("n")
    ends = distinct.select("place", "n", F.posexplode("ends").alias("e", "end"))
    a = F.when(F.col("e") < 2, _half(n)).otherwise(_half(n - 1))
    head = F.col("e") % 2 == 0
    ends = ends.select("place", "end", F.when(head, a).otherwise(0).alias("low"), F.when(head, n).otherwise(n - a).alias("high"))
    shared = ends.groupBy("end").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select("end")
    met = ends.join(shared, "end", "left_semi")
    return met.groupBy("place._id", "place.pos").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def _with_words(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``lines`` with their ``words``, from the documents, and ``rank``, a number in the order of places.

    Unlike places, ranks are compared and added up by hash, without sorting."""
    lines = written(lines.orderBy("_id", "pos").withColumn("rank", F.monotonically_increasing_id()))
    wanted = lines.groupBy("_id").agg(F.collect_list(F.struct("pos", "low", "high", "rank")).alias("wanted"))
    if is_small(lines, MAX_SENT):  # about 50 bytes a line
        wanted = F.broadcast(wanted)
    met = docs.select("_id", "_text").join(wanted, "_id").select("_id", F.split("_text", "\n").alias("lines"), F.explode("wanted").alias("w"))
    met = met.select(F.struct("_id", "w.pos").alias("place"), "w.rank", "w.low", "w.high", _words(F.get("lines", F.col("w.pos"))).alias("words"))
    return met.where(F.col("words").isNotNull()).dropDuplicates(["place"])


def _without(words: Column, i: Column) -> Column:
    """``words`` without the one at ``i``; with ``i`` = -1 all of them."""
    rest = F.slice(words, i + 2, F.greatest(F.size(words) - i - 1, F.lit(0)))
    return F.when(i < 0, words).otherwise(F.concat(F.slice(words, F.lit(1), F.greatest(i, F.lit(0))), rest))


def _partners(lines: DataFrame) -> DataFrame:
    """``rank`` of each line with that of an earlier line that shares a variant, ``partner``."""
    places = F.concat(F.array(F.lit(-1)), F.sequence(F.col("low"), F.col("high") - 1))
    # a variant is made of the hashes of its words: a line has about as many variants as words
    hashed = once(lines.select("rank", "low", "high", "words"), hashes=F.transform("words", lambda w: F.xxhash64(w)))
    numbered = hashed.select("rank", "hashes", F.explode(places).alias("i"))
    variant = _without(F.col("hashes"), F.col("i"))
    # made twice, for the sums and for the join with them: on disk they would be larger than the lines by far
    keys = numbered.select("rank", "i", F.xxhash64(variant).alias("k1"), F.xxhash64(F.lit(7), variant).alias("k2"))
    at = keys.groupBy("k1", "k2", "i").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n"))
    own = F.col("i") == -1
    # a row per position by now, however many lines share the key
    key = Window.partitionBy("k1", "k2")
    both = at.select(
        "k1", "k2", "i", "first", F.min(F.when(own, F.col("first"))).over(key).alias("whole"),
        F.min(F.when(~own, F.col("first"))).over(key).alias("longer"), F.sum("n").over(key).alias("_n"),
    ).where("_n > 1")
    # most keys are of one line only and gone by now
    best = both.select("k1", "k2", "i", F.when(own, F.col("longer")).otherwise(F.least("first", "whole")).alias("partner"))
    found = keys.join(best, ["k1", "k2", "i"]).where(F.col("partner") < F.col("rank"))
    return found.groupBy("rank").agg(F.min("partner").alias("partner"))


def _copies(lines: DataFrame) -> DataFrame:
    """Places of lines whose partner is within one word, by comparison of the words."""
    found = _partners(lines)
    other = lines.select(F.col("rank").alias("partner"), F.col("words").alias("theirs"))
    met = found.join(lines, "rank").join(other, "partner")
    exchanged = F.size(F.filter(F.zip_with("words", "theirs", lambda a, b: ~a.eqNullSafe(b)), lambda x: x)) <= 1
    # a line that is its partner with one word left out is checked by trying the words; they are few and the lines too
    drop_one = lambda a, b: F.exists(F.sequence(F.lit(0), F.size(a) - 1), lambda i: _without(F.col(a), i) == F.col(b))
    within = (
        F.when(F.size("words") == F.size("theirs"), exchanged)
        .when(F.size("words") == F.size("theirs") + 1, drop_one("words", "theirs"))
        .when(F.size("words") + 1 == F.size("theirs"), drop_one("theirs", "words"))
        .otherwise(F.lit(False))
    )
    return met.where(within).select("place")


def deduped_lines(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, short: bool = False
) -> DataFrame:
    """``docs`` plus ``_kept_lines``, the lines that stay, and ``_n_lines``, how many there were.

    Both are null where the text is.
    """
    slim = docs.select(F.col(id_column).alias("_id"), F.col(text).cast("string").alias("_text"))
    known = slim.where(F.col("_id").isNotNull())
    least = 1 if short else min_words
    distinct = written(_distinct_lines(known, least))
    lines = written(_with_words(known, _in_question(distinct.where(F.col("n") >= min_words))))
    copies = _copies(lines)
    stay = distinct.select("place").join(copies, "place", "left_anti")
    stay = stay.groupBy(F.col("place._id").alias("_id")).agg(F.collect_list("place.pos").alias("_stay"))
    packed = docs.select(F.struct("*").alias("_row"), F.col(id_column).alias("_id"))
    joined = packed.join(stay, "_id", "left")
    stays = F.coalesce(F.col("_stay"), F.array().cast("array<int>"))
    split = once(joined.select("_row", "_id", stays.alias("_stay")), _lines=F.split(F.col(f"_row.{text}").cast("string"), "\n"))
    # a marker per place that stays is sorted in before its line
    entry = lambda i, m, line: F.struct(i.alias("i"), F.lit(m).alias("m"), line.alias("line"))
    both = F.concat(F.transform("_lines", lambda line, i: entry(i, 1, line)),
                    F.transform("_stay", lambda p: entry(p, 0, F.lit(""))))
    split = once(split.select("_row", "_id", F.size("_lines").alias("_n_lines"), both.alias("_both")), _sorted=F.array_sort("_both"))
    marked = lambda k: F.coalesce(F.get(F.col("_sorted"), k - 1)["m"] == 0, F.lit(False))
    kept = F.filter(
        "_sorted",
        lambda e, k: (e["m"] == 1) & (F.col("_id").isNull() | marked(k) | (F.size(_words(e["line"])) < least)),
    )
    lines = F.transform(kept, lambda e: e["line"])
    return once(split.select("_row", "_id", "_n_lines", "_sorted"), _kept_lines=lines).select("_row.*", "_kept_lines", "_n_lines")


def without_copied_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with copied lines of any length taken out of the text; documents that lose all their words go.

    ``length`` names a column that holds the length of the text, if there is one.
    """
    done = deduped_lines(docs, id_column, text, short=True)
    joined = F.array_join("_kept_lines", "\n")
    emptied = (F.size("_kept_lines") < F.col("_n_lines")) & (F.trim(F.translate(joined, "\t\n\x0b\x0c\r", " ")) == "")
    done = done.where(~F.coalesce(emptied, F.lit(False)))
    out = []
    for c in docs.columns:
        if c == text:
            out.append(joined.alias(c))
        elif c == length:
            out.append(F.length(joined).cast(docs.schema[c].dataType).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return done.select(*out)


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: lines, lines removed, and the MD5 of what stays."""
    done = deduped_lines(read(spark, folder, "documents"), short=True)
    return done.select(
        "doc_id", F.col("_n_lines").cast("long").alias("n_lines"),
        (F.col("_n_lines") - F.size("_kept_lines")).cast("long").alias("n_removed"),
        F.md5(F.array_join("_kept_lines", "\n")).alias("kept_md5"),
    )


OP3_SQL = """
WITH l AS (
  SELECT doc_id, i - 1 AS pos, string_split(text, chr(10))[i] AS line,
         list_filter(string_split_regex(string_split(text, chr(10))[i], '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(i)
), d AS (
  SELECT words, min(struct_pack(d := doc_id, p := pos)) AS place FROM l WHERE len(words) >= 5 GROUP BY words
), v AS (
  SELECT place, len(words) AS n, j, list_concat(words[1:j-1], words[j+1:]) AS v
  FROM d, unnest(range(1, len(words) + 1)) AS t(j)
), copies AS (
  SELECT a.place FROM v a JOIN v b ON a.n = b.n AND a.j = b.j AND a.v = b.v WHERE b.place < a.place
  UNION SELECT a.place FROM v a JOIN d b ON a.v = b.words WHERE b.place < a.place
  UNION SELECT b.place FROM v a JOIN d b ON a.v = b.words WHERE a.place < b.place
), stay AS (
  SELECT place.d AS doc_id, place.p AS pos FROM d WHERE place NOT IN (SELECT place FROM copies)
  UNION ALL SELECT place.d, place.p FROM (
    SELECT min(struct_pack(d := doc_id, p := pos)) AS place FROM l WHERE len(words) BETWEEN 1 AND 4 GROUP BY words)
), flagged AS (
  SELECT l.doc_id, l.pos, l.line, len(l.words) = 0 OR s.pos IS NOT NULL AS keep
  FROM l LEFT JOIN stay s ON s.doc_id = l.doc_id AND s.pos = l.pos
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT keep) AS n_removed,
       md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keep), '')) AS kept_md5
FROM flagged GROUP BY doc_id
"""

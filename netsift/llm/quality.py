"""Quality rules: counts per document, two fixed rules, and robust multivariate outliers.

DataFrame operations only. Counts come from one pass over the text; they are written to
the shared folder as a table of numbers (without the text), from which the robust
estimates per language and source are made (see ``outliers``). A document is rejected if
it fails a fixed rule or lies, among the documents of its language and source, further
from the robust centre than ``alpha`` of a normal sample would.

Groups of under ``least`` documents are judged with the small groups of their language,
those still smaller with all of such; if even that is smaller, only the fixed rules hold.

Cases: a null text has no words (and so fails); null language or source form groups of
their own; a null or repeated id is judged like any other; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.functions.staging import once
from netsift.llm.common import read, written
from netsift.llm.outliers import chi2_quantile, robust_distances

# The space and the characters from tab to carriage return; the counted symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SPACE_PATTERN = "[\\x20\\x09-\\x0D]+"
WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
DIMENSIONS = ["x_words", "x_word_length", "x_symbols", "x_dup_lines", "x_repeats", "x_upper"]
# Least standard deviation of each: what differs by a few of these is no outlier, however alike the rest is.
FLOOR = [0.5, 0.1, 0.04, 0.2, 0.15, 0.05]


def _without(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "")


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus the counts of each text, without the text."""
    names = [c for c in docs.columns if c != text]
    df = docs.select(*names, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda line: F.length(_without(line, SPACES)) > 0)
    df = once(
        df,
        _hashes=F.transform(F.array_remove(F.split("_text", SPACE_PATTERN), ""), lambda w: F.xxhash64(w)),
        _lines=lines,
        word_chars=F.length(_without(F.col("_text"), SPACES)).cast("long"),
        n_symbols=(F.length("_text") - F.length(_without(F.col("_text"), SYMBOLS))).cast("long"),
        _upper=F.length(F.regexp_replace("_text", "[^\\p{Lu}]+", "")),
    )
    n = F.size("_hashes")
    starts = F.when(n >= WINDOW, F.sequence(F.lit(1), n - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    df = once(
        df.select(*names, "word_chars", "n_symbols", "_upper", "_hashes", n.cast("long").alias("n_words"),
                  F.size("_lines").cast("long").alias("n_lines"),
                  (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines")),
        _windows=F.transform(starts, lambda i: F.xxhash64(F.slice("_hashes", i, WINDOW))),
    ).drop("_hashes")
    # only texts with an equal pair of windows sort them; equal windows are then neighbours
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.array_sort(F.transform("_windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    df = once(df, _sorted=F.when(repeats, placed)).drop("_windows")
    beside = lambda s, k: F.coalesce(F.get(F.col("_sorted"), k)["w"] == s["w"], F.lit(False))
    twice = F.filter("_sorted", lambda s, k: beside(s, k - 1) | beside(s, k + 1))
    at = F.array_sort(F.transform(twice, lambda s: s["i"]))
    covered = F.aggregate(
        at, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda acc, i: F.struct((i + WINDOW).alias("end"), (acc["n"] + F.least(F.lit(WINDOW), i + WINDOW - acc["end"])).alias("n")),
        lambda acc: acc["n"],
    )
    return df.select(*names, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                     F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
                     "n_lines", F.col("_upper").cast("long").alias("n_upper"))


def _vector(df: DataFrame) -> DataFrame:
    """The transformed statistics: logarithms of sizes, roots of shares."""
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return df.select(
        "*",
        F.log1p(F.col("n_words").cast("double")).alias("x_words"),
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))).alias("x_word_length"),
        share("n_symbols", "word_chars").alias("x_symbols"),
        share("n_dup_lines", "n_lines").alias("x_dup_lines"),
        share("n_repeat_words", "n_words").alias("x_repeats"),
        share("n_upper", "word_chars").alias("x_upper"),
    )


def _grouped(df: DataFrame, lang: str, source: str, least: int) -> DataFrame:
    """Adds ``_g``, the group that judges the document, or null."""
    key = lambda *c: F.to_json(F.struct(*c))
    own, language = key(F.col(lang).alias("l"), F.col(source).alias("s")), key(F.col(lang).alias("l"))
    df = df.withColumn("_own", own).withColumn("_language", language)
    sizes = df.groupBy("_own", "_language").agg(F.count(F.lit(1)).alias("_n"))
    small = sizes.where(F.col("_n") < least)
    by_language = small.groupBy("_language").agg(F.sum("_n").alias("_nl"))
    rest = by_language.where(F.col("_nl") < least).agg(F.coalesce(F.sum("_nl"), F.lit(0)).alias("_nr"))
    chosen = sizes.join(by_language, "_language", "left").crossJoin(F.broadcast(rest))  # one row
    group = (
        F.when(F.col("_n") >= least, F.col("_own")).when(F.col("_nl") >= least, F.col("_language"))
        .when(F.col("_nr") >= least, F.lit("{}"))
    )
    return df.join(chosen.select("_own", group.alias("_g")), "_own").drop("_own", "_language")


def judge(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
    alpha: float = 1e-6, floor: list[float] = FLOOR, least: int = 40, min_words: int = 20, max_repeat_percent: int = 30,
) -> DataFrame:
    """One row per document: id, counts, ``base_failed``, ``distance2`` (null: not judged) and ``kept``."""
    slim = docs.select(F.col(id_column).alias("_id"), F.col(lang).cast("string").alias("_lang"),
                       F.col(source).cast("string").alias("_source"), F.col(text).alias("text"))
    stats = written(_vector(counted(slim)))
    grouped = written(_grouped(stats, "_lang", "_source", least))
    judged = robust_distances(grouped.where(F.col("_g").isNotNull()), DIMENSIONS, floor)
    rest = grouped.where(F.col("_g").isNull()).withColumn("_d2", F.lit(None).cast("double"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    cut = chi2_quantile(1 - alpha, len(DIMENSIONS))
    return judged.unionByName(rest).select(
        F.col("_id").alias(id_column), *COUNTS, failed.alias("base_failed"), F.col("_d2").alias("distance2"),
        (~failed & (F.coalesce(F.col("_d2"), F.lit(0.0)) <= cut)).alias("kept"),
    )


def op5_robust_quality(spark: SparkSession, folder: str) -> DataFrame:
    return judge(read(spark, folder, "documents"))

"""Language mixtures of documents, by expectation-maximisation over n-gram likelihoods.

Training counts hashed byte trigrams per language over all labelled training documents
(partial sums per task, added up per language and bucket by Spark). A document is then a
mixture of languages: EM estimates the proportions that best explain its trigrams. The
set of languages is chosen by penalised likelihood: from the best single language on, the
language that adds most likelihood joins as long as it adds more than ``penalty`` times
the logarithm of the number of trigrams, a proportion being one free parameter more.

The table that tasks get has ``buckets`` numbers per language.

Cases: a text that is null or has no letter is ``und`` with score 0; null labels are not
learned from, nor are texts without a letter; with nothing learned all is ``und``; a null
id stays null and counts as a training id only in training; repeated rows are each
predicted; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.llm.common import groups_of, read, rows_of, utf8

BUCKETS = 1 << 16
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
# ASCII letters and bytes beyond ASCII stay; all else is a space.
_KEPT = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint32)


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the byte trigrams that hold a letter, of the text in lower case."""
    if not text or not _LETTER.search(text):
        return np.empty(0, np.int64)
    b = _KEPT[np.frombuffer(b" " + utf8(text.lower()) + b" ", np.uint8)]
    key = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
    key = key[(b[1:-1] != 32) | ((b[:-2] != 32) & (b[2:] != 32))]
    return ((key * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


def learn(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """``lang, bucket, n``: trigram counts over all ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for group in groups_of(rows_of(batches, "lang", "text"), 1 << 20):
            by: dict[str, list[np.ndarray]] = {}
            for name, body in group:
                by.setdefault(name, []).append(trigrams(body))
            for name, found in by.items():
                counts = np.bincount(np.concatenate(found), minlength=BUCKETS)
                totals[name] = totals[name] + counts if name in totals else counts
        for name, counts in totals.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), pa.array(some), pa.array(counts[some])],
                                             names=["lang", "bucket", "n"])

    slim = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")).where("lang is not null")
    counted = slim.mapInArrow(run, "lang string, bucket long, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Mixtures:
    """The likelihoods of a learned table, and what they say of texts."""

    def __init__(self, names: list[str], counts: np.ndarray, penalty: float, rounds: int, smoothing: float = 0.5):
        self.names, self.penalty, self.rounds = names, penalty, rounds
        total = counts.sum(0, keepdims=True)
        self.table = ((counts + smoothing) / (total + smoothing * len(counts))).astype(np.float64)

    def fit(self, p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions of the languages in the columns of ``p``, and the log-likelihood."""
        share = np.full(p.shape[1], 1 / p.shape[1])
        if len(share) > 1:
            for _ in range(self.rounds):
                new = share * (p.T @ (n / (p @ share))) / n.sum()
                if np.abs(new - share).max() < 1e-3:
                    share = new
                    break
                share = new
        return share, float(n @ np.log(p @ share))

    def of(self, text: str | None) -> dict[str, float]:
        """Proportion per chosen language; empty if the text has no letter."""
        found = trigrams(text)
        if not len(found) or not self.names:
            return {}
        bucket, n = np.unique(found, return_counts=True)
        p, n = self.table[bucket], n.astype(np.float64)
        single = n @ np.log(p)
        chosen = [int(single.argmax())]
        share, best = np.ones(1), float(single[chosen[0]])
        if p.shape[1] > 1:
            # languages that even the full mixture gives next to nothing cannot pay for themselves
            rest = [i for i in np.flatnonzero(self.fit(p, n)[0] > 0.02).tolist() if i not in chosen]
            while rest:
                tried = [(self.fit(p[:, [*chosen, i]], n), i) for i in rest]
                (new, value), i = max(tried, key=lambda x: (x[0][1], -x[1]))
                if value - best <= self.penalty * np.log(n.sum()):
                    break
                chosen, share, best = [*chosen, i], new, value
                rest.remove(i)
        return {self.names[i]: float(s) for i, s in zip(chosen, share)}


def predict(
    docs: DataFrame, train: Column, id_column: str = "doc_id", text: str = "text", lang: str = "lang",
    penalty: float = 3.0, rounds: int = 12,
) -> DataFrame:
    """Per row: id, ``lang_pred``, its proportion ``score``, and the whole mixture; learned where ``train`` holds."""
    counts = learn(docs.where(train), lang, text).toPandas()  # one number per language and bucket
    names = sorted(counts["lang"].unique())
    table = np.zeros((BUCKETS, len(names)), np.int64)
    for i, name in enumerate(names):
        own = counts[counts["lang"] == name]
        table[own["bucket"].to_numpy(), i] = own["n"].to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast((names, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Mixtures(*sent.value, penalty, rounds)
        for group in groups_of(rows_of(batches, "id", "text"), 1 << 20):
            mixes = [model.of(body) for _, body in group]
            tops = [max(m.items(), key=lambda x: (x[1], x[0])) if m else (UNKNOWN, 0.0) for m in mixes]
            yield pa.RecordBatch.from_arrays([
                pa.array([i for i, _ in group], pa.int64()), pa.array([t[0] for t in tops], pa.string()),
                pa.array([min(1.0, max(0.0, t[1])) for t in tops], pa.float64()),
                pa.array([list(m.items()) for m in mixes], pa.map_(pa.string(), pa.float64())),
            ], names=["id", "lang_pred", "score", "mixture"])

    slim = docs.selectExpr(f"cast(`{id_column}` as long) id", f"cast(`{text}` as string) text")
    return slim.mapInArrow(run, "id long, lang_pred string, score double, mixture map<string,double>")


def fold(id_column: str, modulus: int) -> Column:
    """The remainder of the checksum of an id's text."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus


def op1_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    done = predict(docs, F.coalesce(fold("doc_id", 4) != 2, F.lit(True)))
    held_out = F.coalesce(fold("id", 4) == 2, F.lit(False))
    return done.select(F.col("id").alias("doc_id"), held_out.alias("held_out"), "lang_pred", "score", "mixture")

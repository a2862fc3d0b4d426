"""The corpus pipeline: quality rules, line dedup, near-duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet
to the shared folder and read again as the next stage's docs, so a lost executor costs
at most one stage. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from netsift.llm.common import read, written
from netsift.llm.decontaminate import clean
from netsift.llm.lines import without_copied_lines
from netsift.llm.near import one_of_each
from netsift.llm.packing import pack, vocabulary
from netsift.llm.quality import judge


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and are no outliers among their language and source."""
    # rows that share an id stay or go together: they stay if one of them passes
    judged = judge(docs).where("kept").select("doc_id").distinct()
    return docs.join(judged, docs["doc_id"].eqNullSafe(judged["doc_id"]), "left_semi")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_copied_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, vocabulary("byte_bpe_50k.json"), ranks=vocabulary("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# The robust estimates and the tokenizer are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs

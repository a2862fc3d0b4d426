"""Batch ingestion: read, parse, set rejects aside, enrich, write."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from netsift.operators.enrichment import apply_enrichment
from netsift.operators.progress import staged, write_metrics
from netsift.operators.tables import drop_batch, fold_log, read_log, write_batch
from netsift.sources.base import APPEND, Source, get_source, rejects


class RejectedRows(Exception):
    """Raised after the write when rows were set aside and ``strict`` was asked for."""


@dataclass(frozen=True)
class Report:
    parsed: int
    rejected: int
    batch_id: int


def rejects_path(path: str) -> str:
    return path.rstrip("/") + "__rejects"


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The rows set aside for the table at ``path``; ``batch`` tells by which write."""
    return read_log(spark, rejects_path(path))


def documents_of(source: Source, parsed: DataFrame, **options) -> DataFrame:
    """Documents of one batch; writes to the same key are merged where one pass does it.

    Documents that may span ``part`` rows are left for the fold at read time.
    """
    documents = source.shape(parsed, **options)
    if source.mode == APPEND or "part" in source.key or "_order" not in documents.columns:
        return documents
    return fold_log(documents, source)


def _counted(counts: Observation) -> dict[str, int]:
    try:
        return counts.get
    except Py4JJavaError:
        # Spark found the input empty while it ran and left the counting out with the rest of the plan
        return {"parsed": 0, "rejected": 0}


def write_parsed(
    source: Source, parsed: DataFrame, path: str, batch_id: int, *, enrichment: str | None = None,
    partitions: int | None = None, rows_per_file: int = 0, strict: bool = False, writer: str = "batch",
    carried: DataFrame | None = None, metrics: bool = False, **options,
) -> Report:
    """Write the documents of a parsed frame, then its rejects if there were any.

    ``carried`` are good rows of earlier micro-batches that belong to the same documents.

    Counts come from the write itself, so a clean input is parsed once. A batch that is
    written again by the same ``writer`` replaces its documents and its rejects. ``metrics``
    keeps counts per file besides (see ``operators.progress``), for which parsed rows are written once.
    """
    if metrics:
        parsed = staged(parsed)
    counts = Observation()
    watched = parsed.observe(
        counts, F.count(F.lit(1)).alias("parsed"), F.count_if(F.col("_error").isNotNull()).alias("rejected")
    )
    rows = watched if carried is None else watched.unionByName(carried, allowMissingColumns=True)
    documents = apply_enrichment(documents_of(source, rows, **options), enrichment)
    if source.mode != APPEND and "_order" not in documents.columns:
        documents = documents.withColumn("_order", F.lit(0))
    write_batch(documents, path, batch_id, partitions, rows_per_file, source.key, writer)
    seen = _counted(counts)
    if metrics:
        write_metrics(parsed, source.name, path, batch_id, writer)
    if not seen["rejected"]:
        drop_batch(parsed.sparkSession, rejects_path(path), batch_id, writer)
    else:
        write_batch(rejects(parsed), rejects_path(path), batch_id, writer=writer)
        if strict:
            raise RejectedRows(f"{seen['rejected']:,} rows were rejected, see {rejects_path(path)}")
    return Report(seen["parsed"], seen["rejected"], batch_id)


def ingest(
    spark: SparkSession, source: Source | str, input_path, path: str, *, batch_id: int | None = None, **options
) -> Report:
    """Read files of ``source`` and write them to the table at ``path``.

    Without ``batch_id`` each call is a batch of its own; with one, a further call with the
    same replaces it.
    """
    source = get_source(source)
    if batch_id is None:
        batch_id, options["writer"] = 0, f"ingest-{uuid.uuid4().hex}"
    asked = {k: v for k, v in options.items() if k != "writer"}
    parsed = source.parse(source.read(spark, input_path, **asked), **asked)
    return write_parsed(source, parsed, path, batch_id, **options)

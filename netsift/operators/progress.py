"""What batches have taken in: rows and rejects per file and batch, kept beside the table.

``<table>__metrics`` is a table of batches like the others: a batch that is written again replaces
its counts, so the sums are right after retries and for streams that were restarted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.operators.skew import shared_folder
from netsift.operators.tables import read_log, write_batch


def metrics_path(path: str) -> str:
    return path.rstrip("/") + "__metrics"


def staged(parsed: DataFrame) -> DataFrame:
    """``parsed`` written once to shared storage, for all that reads it: documents, rejects and counts."""
    folder = f"{shared_folder(parsed.sparkSession).rstrip('/')}/netsift-{uuid.uuid4().hex}"
    parsed.write.parquet(folder)
    return parsed.sparkSession.read.schema(parsed.schema).parquet(folder)


def write_metrics(parsed: DataFrame, source: str, path: str, batch_id: int, writer: str = "batch") -> None:
    """Counts of a batch per file; rows without a file count under null."""
    file = F.col("_file") if "_file" in parsed.columns else F.lit(None).cast("string")
    counts = parsed.groupBy(file.alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_error").isNotNull()).alias("rejected"))
    write_batch(counts.select(F.lit(source).alias("source"), "*"), metrics_path(path), batch_id, writer=writer)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """``batch, source, file, rows, rejected`` of all batches that count; ``batch`` is the place in the metrics' own line."""
    return read_log(spark, metrics_path(path)).select("batch", "source", "file", "rows", "rejected")


def landed(spark: SparkSession, path) -> DataFrame:
    """``file, bytes`` of the files at ``path``, by a listing; their content is not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listed.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))


def progress(spark: SparkSession, path: str, input_path) -> DataFrame:
    """``file, bytes, batch, rows, rejected, done`` of every landed file, once per batch that read it.

    A file is done when a batch has counted it; one in which no line was a record has no counts and stays undone.
    """
    files, metrics = landed(spark, input_path), read_metrics(spark, path).drop("source")
    both = files.join(metrics, "file", "left")
    return both.select(
        "file", "bytes", "batch", F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("rejected", F.lit(0)).alias("rejected"), F.col("batch").isNotNull().alias("done"))


def summary(progress_rows: DataFrame) -> DataFrame:
    """One row: files and bytes landed, files and bytes done, rows, rejects."""
    by_file = progress_rows.groupBy("file", "bytes").agg(
        F.bool_or("done").alias("done"), F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected"))
    done = F.col("done")
    sums = {"files": F.lit(1), "files_done": F.when(done, 1).otherwise(0), "bytes": F.col("bytes"),
            "bytes_done": F.when(done, F.col("bytes")).otherwise(0), "rows": F.col("rows"), "rejected": F.col("rejected")}
    return by_file.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in sums.items()])

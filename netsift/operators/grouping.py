"""Runs of consecutive lines and the order of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def run_numbers(rows: DataFrame, key: str) -> DataFrame:
    """Add ``_run``: the position of the first line of the run the row belongs to.

    A run is a stretch of consecutive rows of one file with the same ``key``. Runs are
    found inside each file split, which is all that is ever sorted. A table with one
    row per split then tells which splits open in the middle of a run, and where that
    run began.
    """
    inside = Window.partitionBy("_file", "_block").orderBy("_row")
    before = F.lag(key).over(inside)
    starts = F.when(before.isNull() | (before != F.col(key)), F.struct("_block", "_row"))
    marked = rows.withColumn("_start", starts)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("_run", F.last("_start", ignorenulls=True).over(upto)).drop("_start")
    splits = marked.groupBy("_file", "_block").agg(
        F.min("_run").alias("_head"),
        F.max("_run").alias("_tail"),
        F.min_by(key, "_row").alias("_first"),
        F.max_by(key, "_row").alias("_last"),
    )
    across = Window.partitionBy("_file").orderBy("_block")
    splits = splits.withColumn("_goes_on", F.coalesce(F.lag("_last").over(across) == F.col("_first"), F.lit(False)))
    anchor = F.when(~F.col("_goes_on") | (F.col("_head") != F.col("_tail")), F.col("_tail"))
    splits = splits.withColumn("_anchor", anchor)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    begun = F.last("_anchor", ignorenulls=True).over(earlier)
    opened = splits.withColumn("_begun", begun).where("_goes_on").select("_file", "_block", "_head", "_begun")
    joined = marked.join(opened, ["_file", "_block"], "left")
    continued = F.coalesce(F.col("_run") == F.col("_head"), F.lit(False))
    return joined.withColumn("_run", F.when(continued, F.col("_begun")).otherwise(F.col("_run"))).drop("_head", "_begun")


def with_order(documents: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` and ``_order``: which write wins, the same for all parts of a document.

    Files count in name order. Inside a file there is one document per key, or one per
    run, in the order of the runs.
    """
    start = F.lit(0).cast("bigint")
    run = [F.col(f"_run.{n}") if "_run" in documents.columns else start for n in ("_block", "_row")]
    order = F.struct(F.col("_file"), run[0].alias("_block"), run[1].alias("_row"))
    return documents.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields], order.alias("_order"))

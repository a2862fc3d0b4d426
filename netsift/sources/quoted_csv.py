"""CSV whose quoted fields may hold line breaks, read by many tasks per file.

The text reader cuts files into lines at any place. A line break belongs to a field if the
quotes before it in its file are odd in number. So each split counts its quotes, a running
sum over one row per split tells how each split begins, and running sums inside a split tell it for
every line. Lines that are a record of their own, nearly all, stay where they are; those of longer
records are gathered by the place where their record starts, which may be splits before.

Cases: blank lines are no records; a line break inside a field becomes ``\\n``; a quote that is
never closed makes one record of all that follows, as in any reader. A record of more
than MAX_RECORD_LINES lines is not put together: its first line stands for it, with ``_error``.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds what is gathered for one record; only a stray quote makes longer ones.
MAX_RECORD_LINES = 100_000
UNCLOSED = "quote not closed"


def raw_lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def first_lines(spark: SparkSession, path) -> dict[str, list[str]]:
    """First line of every file that has one, and the files that begin with it: one job, a row per file."""
    at = F.struct("_block", "_row")
    found = raw_lines(spark, path).groupBy("_file").agg(F.min_by("value", at).alias("line"))
    groups: dict[str, list[str]] = {}
    for row in found.sort("_file").collect():
        groups.setdefault(row.line.lower(), []).append(row["_file"])
    return groups


def records(lines: DataFrame, max_lines: int = MAX_RECORD_LINES) -> DataFrame:
    """``record, _file, _block, _row, _error`` from raw lines; the position is that of a record's first line."""
    odd = F.regexp_count("value", F.lit('"')) % 2
    inside = Window.partitionBy("_file", "_block").orderBy("_row")
    counted = lines.withColumn("_odd", odd).withColumn("_before", F.sum("_odd").over(inside) - F.col("_odd"))
    # How a split begins is not known yet: where records start is worked out for both cases.
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    starts = [F.last(F.when(F.col("_before") % 2 == k, F.col("_row")), ignorenulls=True).over(upto) for k in (0, 1)]
    counted = counted.withColumn("_start0", starts[0]).withColumn("_start1", starts[1])
    splits = counted.groupBy("_file", "_block").agg(
        F.sum("_odd").alias("_quotes"), F.max("_start0").alias("_last0"), F.max("_start1").alias("_last1"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2
    splits = splits.withColumn("_open", opened)
    last = F.when(F.col("_open") == 0, F.col("_last0")).otherwise(F.col("_last1"))
    splits = splits.withColumn("_from", F.when(last.isNotNull(), F.struct("_block", last.alias("_row"))))
    splits = splits.withColumn("_from", F.last("_from", ignorenulls=True).over(earlier)).select("_file", "_block", "_open", "_from")
    placed = counted.join(splits, ["_file", "_block"])
    own = F.when(F.col("_open") == 0, F.col("_start0")).otherwise(F.col("_start1"))
    start = F.when(own.isNotNull(), F.struct("_block", own.alias("_row"))).otherwise(F.col("_from"))
    placed = placed.withColumn("_start", start)
    alone = (F.col("_before") + F.col("_open")) % 2 + F.col("_odd") == 0
    none = F.lit(None).cast("string").alias("_error")
    single = placed.where(alone).select(F.col("value").alias("record"), "_file", "_block", "_row", none)
    parts = placed.where(~alone).select("_file", "_start", "_block", "_row", "value")
    sizes = parts.groupBy("_file", "_start").agg(F.count("_row").alias("_n")).where(F.col("_n") > max_lines)
    # at most lines / max_lines rows
    long = F.broadcast(sizes.select(F.col("_file").alias("_f"), F.col("_start").alias("_s")))
    same = (F.col("_file") == F.col("_f")) & (F.col("_start") == F.col("_s"))
    gathered = parts.join(long, same, "left_anti").groupBy("_file", "_start").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_row", "value"))).alias("_lines"))
    whole = gathered.select(F.array_join("_lines.value", "\n").alias("record"), "_file", "_start.*", none)
    first = parts.join(long, same, "left_semi").where(F.col("_start") == F.struct("_block", "_row"))
    cut = first.select(F.col("value").alias("record"), "_file", "_block", "_row", F.lit(UNCLOSED).alias("_error"))
    return single.unionByName(whole).unionByName(cut).where(F.col("record") != "")


def read_split(spark: SparkSession, path, max_lines: int = MAX_RECORD_LINES) -> list[DataFrame]:
    """One frame per distinct header (a line), all columns text, and ``_error``, ``_raw`` of records that were not put together."""
    frames = []
    for header, files in first_lines(spark, path).items():
        names = next(csv.reader([header]), [])
        found = records(raw_lines(spark, files), max_lines)
        heads = found.groupBy("_file").agg(F.min(F.struct("_block", "_row")).alias("_head"))
        # a row per file, as many as the driver lists anyway
        body = found.join(F.broadcast(heads), "_file").where(F.struct("_block", "_row") > F.col("_head"))
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
        whole = F.when(F.col("_error").isNull(), F.col("record"))
        fields = body.select(F.from_csv(whole, schema.simpleString()[7:-1].replace(":", " "), {"escape": '"'}).alias("_c"),
                             "_error", F.when(F.col("_error").isNotNull(), F.col("record")).alias("_raw"))
        frames.append(fields.select(*[F.col(f"_c.c{i}").alias(n) for i, n in enumerate(names)], "_error", "_raw"))
    return frames

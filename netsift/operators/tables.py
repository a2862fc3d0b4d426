"""Tables: create, append, write by key, read back, export, summarise.

A table is a log of numbered batches (see ``batches``). Writing a batch again replaces
just that batch, so retries are harmless; the current documents are an aggregate over
the log, and ``compact`` replaces the batches by what they amount to, in place.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netsift.functions.text import human_size
from netsift.operators.batches import Batches
from netsift.operators.merging import ORDER, last_rows, last_writes
from netsift.sources.base import APPEND, REPLACE, Source, get_source


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, path: str | None = None, enrichment: str | None = None
) -> bool:
    """Create a catalog table; False when it exists already."""
    from netsift.operators.enrichment import apply_enrichment

    if spark.catalog.tableExists(name):
        return False
    if enrichment is not None:
        schema = apply_enrichment(spark.createDataFrame([], schema), enrichment).schema
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    return True


def laid_out(documents: DataFrame, partitions: int | None, key: tuple[str, ...] = ()) -> DataFrame:
    """Write in ``partitions`` pieces; by key only where rows of one key are few."""
    if partitions is None:
        return documents
    return documents.repartition(partitions, *key) if key else documents.repartition(partitions)


def append(documents: DataFrame, table: str, partitions: int | None = None, rows_per_file: int = 0) -> None:
    """Add documents to a catalog table."""
    writer = laid_out(documents, partitions).write.mode("append").format("parquet")
    writer.option("maxRecordsPerFile", rows_per_file).saveAsTable(table)


def write_batch(
    documents: DataFrame, path: str, batch_id: int, partitions: int | None = None, rows_per_file: int = 0,
    key: tuple[str, ...] = (), writer: str = "batch",
) -> int:
    """Write a batch of ``writer``; gives its number in the table's one line of numbers."""
    laid = laid_out(documents, partitions, key)
    return Batches(documents.sparkSession, path).write(laid, writer, batch_id, rows_per_file)


def drop_batch(spark: SparkSession, path: str, batch_id: int, writer: str = "batch") -> None:
    """Take a batch of ``writer`` out, if there is one."""
    Batches(spark, path).drop(writer, batch_id)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All batches; ``batch`` tells which."""
    return Batches(spark, path).read()


def _ordered(log: DataFrame) -> DataFrame:
    return log.withColumn(ORDER, F.struct(F.col("batch").cast("bigint").alias("batch"), F.col(ORDER))).drop("batch")


def current(spark: SparkSession, path: str, source: Source | str) -> DataFrame:
    """The documents of a table as they stand after all batches."""
    source = get_source(source)
    log = read_log(spark, path)
    if source.mode == APPEND:
        return log.drop("batch")
    return fold_log(_ordered(log), source).drop(ORDER)


def fold_log(log: DataFrame, source: Source) -> DataFrame:
    """One document per key from rows ordered by ``_order``; keeps ``_order``."""
    key, maps = list(source.key), list(source.merge_maps)
    if source.mode == REPLACE:
        return last_rows(log, key)
    if "part" not in key:
        return last_writes(log, key, ORDER, maps)
    base = [k for k in key if k != "part"]
    heads = log.where(F.col("part") == 0)
    merged = last_writes(heads, base, ORDER, maps)
    return merged.unionByName(_continuations(log.where(F.col("part") > 0), heads, merged, base, maps))


def _continuations(further: DataFrame, heads: DataFrame, merged: DataFrame, base: list[str], maps: list[str]) -> DataFrame:
    """Continuation rows of hot documents that belong to the latest write of their list.

    There is one such row per HOT_ROWS list elements, so their keys are few enough to
    broadcast; the lists themselves are not.
    """
    hot = F.broadcast(further.select(*base).distinct())
    if not maps:
        latest = merged.join(hot, base, "left_semi").select(*base, ORDER)
        kept = further.join(F.broadcast(latest), [*base, ORDER], "left_semi")
        return last_rows(kept, [*base, "part"]).select(*merged.columns)
    name = maps[0]
    heads_of_hot = heads.join(hot, base, "left_semi")
    latest = heads_of_hot.select(*base, ORDER, F.explode(F.map_keys(name)).alias("_k"))
    latest = latest.groupBy(*base, "_k").agg(F.max(ORDER).alias(ORDER))
    entries = further.select(*base, "part", ORDER, F.explode(name).alias("_k", "_v"))
    kept = entries.join(F.broadcast(latest), [*base, "_k", ORDER], "left_semi")
    lists = kept.groupBy(*base, "part").agg(F.map_from_entries(F.collect_list(F.struct("_k", "_v"))).alias(name))
    facts = F.broadcast(merged.join(hot, base, "left_semi").drop("part", name))
    return lists.join(facts, base, "inner").select(*merged.columns)


def compact(spark: SparkSession, path: str, source: Source | str, partitions: int | None = None) -> None:
    """Replace the batches written so far by the current documents; readers and streams go on.

    The old batches' files stay for readers that hold them, until ``vacuum``.
    """
    source = get_source(source)
    batches = Batches(spark, path)
    if source.mode == APPEND:
        batches.replace(laid_out(batches.origins().drop("batch"), partitions))
        return
    # documents keep the order within its batch of their latest write
    folded = fold_log(_ordered(batches.read()), source).withColumn(ORDER, F.col(f"{ORDER}.{ORDER}"))
    batches.replace(laid_out(folded, partitions, source.key))


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the files of replaced batches; gives how many batches these were."""
    return Batches(spark, path).vacuum()


def export_json(documents: DataFrame, path: str) -> None:
    """Append the documents as JSON lines; nulls are left out."""
    documents.write.mode("append").json(path)


def import_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def with_snapshot_date(documents: DataFrame, day: str) -> DataFrame:
    """Add ``snapshot_date``, to be written with ``partitionBy('snapshot_date')``."""
    return documents.withColumn("snapshot_date", F.lit(day).cast("date"))


def write_dated(documents: DataFrame, path: str, day: str | None = None, partitions: int | None = None) -> None:
    """Write snapshots, one folder per ``snapshot_date``; those of the days that come in are replaced, others stay.

    ``day`` dates all documents; without it they hold their ``snapshot_date`` already (null: a
    folder of its own). Days are swapped when the job commits, so a failed write changes none.
    """
    dated = documents if day is None else with_snapshot_date(documents, day)
    writer = laid_out(dated, partitions).write.partitionBy("snapshot_date").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def read_dated(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The snapshots from day ``first`` to ``last``, both included; only the folders of these days are read."""
    docs = spark.read.parquet(path)
    day = F.col("snapshot_date")
    if first is not None:
        docs = docs.where(day >= F.lit(first).cast("date"))
    return docs if last is None else docs.where(day <= F.lit(last).cast("date"))


def table_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Documents, files and bytes per table read from files; hidden and empty tables are left out.

    Only file footers are read: no data column is asked for.
    """
    pieces = None
    for name, df in tables.items():
        if name.startswith("."):
            continue
        one = df.select(
            F.lit(name).alias("name"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")
        )
        per_file = one.groupBy("name", "f").agg(F.count(F.lit(1)).alias("n"), F.max("b").alias("b"))
        total = per_file.groupBy("name").agg(
            F.sum("n").alias("documents"), F.count(F.lit(1)).alias("files"), F.sum("b").alias("bytes")
        )
        pieces = total if pieces is None else pieces.unionByName(total)
    return pieces.where(F.col("documents") > 0).withColumn("size", human_size(F.col("bytes")))

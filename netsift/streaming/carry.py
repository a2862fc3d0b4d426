"""What a topic's micro-batches hand on to each other: open keys, end marks, transfer marks.

A file is never split over micro-batches, a topic always is. Two small tables below the
query's checkpoint, written anew by each micro-batch as ``<table>/<batch>``, carry on what a reader
of lines would remember:

``open``  the rows of keys that may go on: of all keys, or, grouped by run, of the run each topic
          ended with. A micro-batch joins the rows of the keys it touches to its own and so
          writes their documents whole; lists are united, earlier rows first.
``marks`` per topic, whether its end mark came (nothing behind it counts, in any later
          micro-batch) and where its transfer comment stands.

``parsed`` holds the parsed rows of a micro-batch while it is being written.

Micro-batch n reads what n - 1 left and replaces what an earlier attempt of n left, so one that
is run again gives the same. Rows keep their places over micro-batches: ``_block`` gets
the number of the micro-batch in front.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.operators.batches import remove_folder
from netsift.operators.grouping import run_numbers
from netsift.operators.skew import join_lookup
from netsift.sources.base import Source, good_rows
from netsift.sources.lines import SENTINEL, first_marks

BLOCK_BITS = 31
MARKS = "_file string, _end boolean, _axfr struct<_block: bigint, _row: bigint, value: boolean>"


def placed(lines: DataFrame, batch_id: int) -> DataFrame:
    """``lines`` with places that come after those of all earlier micro-batches."""
    legal = F.col("_block").between(0, (1 << BLOCK_BITS) - 1)
    block = F.when(legal, F.col("_block").cast("bigint") + (batch_id << BLOCK_BITS))
    return lines.withColumn("_block", block.otherwise(F.raise_error(F.lit(f"_block is not below 2 ** {BLOCK_BITS}"))))


def marks_after(lines: DataFrame, before: DataFrame, token: str | None) -> DataFrame:
    """The marks of each topic after ``lines``, which hold nothing of topics that had ended."""
    text = F.col("value")
    transfer = text.startswith(";") & text.contains("DiG") & text.contains("AXFR")
    marks = {"_at": (text == token if token is not None else F.lit(False), F.lit(True)), "_axfr": (transfer, F.lit(True))}
    found = first_marks(lines, marks).withColumn("_at", F.when(F.col("_at").isNotNull(), F.struct("_at._block", "_at._row")))
    counts = F.col("_at").isNull() | (F.struct("_axfr._block", "_axfr._row") < F.col("_at"))
    found = found.select("_file", F.col("_at").isNotNull().alias("_end"), F.when(counts, F.col("_axfr")).alias("_axfr"))
    both = before.unionByName(found).groupBy("_file").agg(F.bool_or("_end").alias("_end"), F.min("_axfr").alias("_axfr"))
    return both.where(F.col("_end") | F.col("_axfr").isNotNull())


class Carry:
    """The carried tables of one query. ``open_for``: a key without a new row in so many micro-batches is closed."""

    def __init__(self, source: Source, folder: str, group: str = "key", open_for: int | None = None, sentinel: str | None = SENTINEL):
        if source.open_key is None:
            raise ValueError(f"source {source.name!r} has no keys that could be open")
        self.source, self.folder, self.group, self.open_for, self.sentinel = source, folder.rstrip("/"), group, open_for, sentinel

    def _kept(self, spark: SparkSession, table: str, batch_id: int, schema) -> DataFrame:
        if batch_id <= 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.folder}/{table}/{batch_id - 1}")

    def _keep(self, df: DataFrame, table: str, batch_id: int) -> DataFrame:
        path = f"{self.folder}/{table}/{batch_id}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def parsed(self, lines: DataFrame, batch_id: int, **options) -> tuple[DataFrame, DataFrame]:
        """The parsed rows of a micro-batch, and the rows of earlier ones that its documents need."""
        spark = lines.sparkSession
        known = self._kept(spark, "marks", batch_id, MARKS)
        named = join_lookup(placed(lines, batch_id), known.withColumnRenamed("_axfr", "_axfr_before"), ["_file"])
        going_on = named.where(~F.coalesce("_end", F.lit(False))).drop("_end")
        marks = self._keep(marks_after(going_on, known, self.sentinel), "marks", batch_id)
        # written once: documents, open rows, touched keys and rejects all read it
        parsed = self._keep(self.source.parse(going_on, **options), "parsed", batch_id)
        rows = good_rows(parsed).drop("_raw", "_error", "_axfr", "_axfr_before")
        before = self._kept(spark, "open", batch_id, rows.schema)
        if self.group == "run":
            touched = rows.select("_file").distinct()
        else:
            touched = rows.select("_file", self.source.open_key).distinct()
        carried = join_lookup(before, touched, touched.columns, "left_semi")
        if "_axfr" in parsed.columns:
            carried = join_lookup(carried, marks.select("_file", "_axfr"), ["_file"])
        self._keep(self._open(before.unionByName(rows), batch_id), "open", batch_id)
        return parsed, carried

    def _open(self, rows: DataFrame, batch_id: int) -> DataFrame:
        columns, key = rows.columns, self.source.open_key
        if self.group == "run":
            runs = run_numbers(rows, key)
            last = runs.groupBy("_file").agg(F.max("_run").alias("_run"))
            rows = join_lookup(runs, last, ["_file", "_run"], "left_semi").select(*columns)
        elif self.open_for is not None:
            newest = rows.groupBy("_file", key).agg(F.max("_block").alias("_newest"))
            still = newest.where(F.shiftright("_newest", BLOCK_BITS) > batch_id - self.open_for).drop("_newest")
            rows = join_lookup(rows, still, ["_file", key], "left_semi")
        return self.source.open_rows(rows) if self.source.open_rows else rows

    def done(self, spark: SparkSession, batch_id: int) -> None:
        """Forgets what no attempt needs any more, once micro-batch ``batch_id`` is written."""
        for table in ("marks", "open"):
            remove_folder(spark, f"{self.folder}/{table}/{batch_id - 2}")
        remove_folder(spark, f"{self.folder}/parsed/{batch_id}")

"""What a table consists of: plain Parquet, partitioned by writer and batch.

    <path>/_writer=<name>/_batch=<n>/    the rows of a batch and one head row

A batch is written by dynamic partition overwrite: Spark puts its files aside and swaps the
partition when the job commits. A batch that is written again replaces itself, one that fails
leaves the old one, and other batches are not touched. The head row tells that the batch is
there, even with no rows; its ``_number`` says where it stands among the batches of
all writers. A new batch comes after all that are there; one that is written again keeps its
place. Batches that two writers begin at the same moment may share a number; then their names decide.

Compaction writes what batches amount to as a batch of its own, whose head row names the
ones it took in; these do not count from then on. A batch that is written again after that
is a new one and so the latest: its rows win by key, and in a table without keys they
replace those the compaction took from it. One compaction runs at a time. Head rows, one per
batch, are all that passes through the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

COMPACTED = "_compacted"
_OWN = ("_writer", "_batch", "_id", "_number", "_head", "_absorbed", "_origin")


def _files(spark: SparkSession, path: str) -> DataFrame | None:
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        # a first batch that has not been committed
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


class Batches:
    """The batches of a table as they are when this is made."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = _files(spark, self.path)
        heads = [] if self.files is None else self.files.where("_head").select("_writer", "_batch", "_id", "_number", "_absorbed").collect()
        gone = {i for h in heads for i in h["_absorbed"]}
        self.heads: list[Row] = heads
        self.live = [h for h in heads if h["_id"] not in gone]
        self.absorbed = [h for h in heads if h["_id"] in gone]

    def _number(self, writer: str, batch: int) -> int:
        own = [h["_number"] for h in self.live if (h["_writer"], h["_batch"]) == (writer, batch)]
        return own[0] if own else max((h["_number"] for h in self.heads), default=0) + 1

    def _put(self, rows: DataFrame, writer: str, batch: int, number: int, absorbed: Iterable[str], own: str, rows_per_file: int) -> None:
        ids = F.array(*[F.lit(i) for i in absorbed]).cast("array<string>")
        head = self.spark.range(1).select(F.lit(True).alias("_head"), ids.alias("_absorbed"))
        if "_origin" not in rows.columns:
            rows = rows.withColumn("_origin", F.lit(None).cast("string"))
        both = rows.withColumn("_head", F.lit(False)).unionByName(head, allowMissingColumns=True)
        named = both.withColumn("_id", F.lit(own)).withColumn("_number", F.lit(number).cast("bigint"))
        named = named.withColumn("_writer", F.lit(writer)).withColumn("_batch", F.lit(batch).cast("bigint"))
        out = named.write.partitionBy("_writer", "_batch").mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.option("maxRecordsPerFile", rows_per_file).parquet(self.path)

    def write(self, rows: DataFrame, writer: str, batch: int, rows_per_file: int = 0) -> int:
        """Writes a batch; gives its number."""
        number = self._number(writer, batch)
        self._put(rows, writer, batch, number, [], uuid.uuid4().hex, rows_per_file)
        return number

    def drop(self, writer: str, batch: int) -> None:
        """Takes a batch out, if it is there: what is left is a head row that takes itself in."""
        if any((h["_writer"], h["_batch"]) == (writer, batch) for h in self.live):
            own = uuid.uuid4().hex
            nothing = self.files.drop(*_OWN).limit(0)
            self._put(nothing, writer, batch, self._number(writer, batch), [own], own, 0)

    def read(self) -> DataFrame:
        """All rows that count, with the number of their batch as ``batch``."""
        if not self.live:
            raise ValueError(f"no table at {self.path}")
        return self._rows().drop(*_OWN)

    def _rows(self) -> DataFrame:
        rows = self.files.where(~F.col("_head") & ~_any_of(self.absorbed))
        again = [_label(h) for h in self.live if h["_writer"] != COMPACTED]
        if again and any(h["_writer"] == COMPACTED for h in self.live):
            rows = rows.where(~F.coalesce(F.col("_origin").isin(again), F.lit(False)))
        return rows.withColumn("batch", F.col("_number"))

    def origins(self) -> DataFrame:
        """As ``read``, and ``_origin``: the batch a row was first written in."""
        label = F.concat_ws(":", "_writer", F.col("_batch").cast("string"))
        return self._rows().withColumn("_origin", F.coalesce("_origin", label)).drop(*[c for c in _OWN if c != "_origin"])

    def replace(self, rows: DataFrame) -> None:
        """Puts ``rows`` in the place of all batches that count, under the greatest of their numbers."""
        number = max(h["_number"] for h in self.live)
        batch = max((h["_batch"] for h in self.heads if h["_writer"] == COMPACTED), default=0) + 1
        # files of batches taken in before may still lie there
        self._put(rows, COMPACTED, batch, number, [h["_id"] for h in self.heads], uuid.uuid4().hex, 0)

    def vacuum(self) -> int:
        """Deletes the files of batches that do not count any more; gives how many batches these were.

        Not while batches are being written or read.
        """
        for h in self.absorbed:
            remove_folder(self.spark, f"{self.path}/_writer={h['_writer']}/_batch={h['_batch']}")
        return len(self.absorbed)


def _folder(spark: SparkSession, path: str):
    """A path and its file system, for what Spark has no command for: a look whether it is there, deletion."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def remove_folder(spark: SparkSession, path: str) -> None:
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def _label(head: Row) -> str:
    return f"{head['_writer']}:{head['_batch']}"


def _any_of(heads: list[Row]) -> Column:
    """The rows of these batches, as a condition on partition columns only."""
    found = F.lit(False)
    for writer in {h["_writer"] for h in heads}:
        numbers = [h["_batch"] for h in heads if h["_writer"] == writer]
        found = found | ((F.col("_writer") == writer) & F.col("_batch").isin(numbers))
    return found

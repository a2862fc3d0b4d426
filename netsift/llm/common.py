"""Shared small parts of the training-data operators."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# A word is a run of anything but the space and the characters from tab to carriage return.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
WORD = re.compile(WORD_PATTERN)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


def utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster shares (``spark.checkpoint.dir``).

    Only a local session without that setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        import tempfile

        named = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(named)
    return f"{named.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` computed once, kept as Parquet in the shared folder and read back; this cuts lineage."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples, one batch in memory at a time."""
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        # short slices, so that long texts are not all turned into Python strings at once
        for at in range(0, batch.num_rows, 256):
            yield from zip(*[c.slice(at, 256).to_pylist() for c in columns])



def groups_of(rows: Iterator[tuple], chars: int, text: int = 1) -> Iterator[list[tuple]]:
    """Consecutive rows in lists that end with the row that brings their texts to ``chars`` characters."""
    group, total = [], 0
    for row in rows:
        group.append(row)
        total += len(row[text] or "") + 1
        if total >= chars:
            yield group
            group, total = [], 0
    if group:
        yield group

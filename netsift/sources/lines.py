"""Line input shared by every source.

A line frame has ``value`` (stripped text), ``_file`` and the position
``_block``, ``_row``: the byte offset of the file split and a number that grows
inside it. ``(_block, _row)`` orders the lines of one file even when many tasks
read it. Each split holds a bounded number of bytes, so ``(_file, _block)`` is a
grouping no hot key can swell.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netsift.functions.text import strip

SENTINEL = "~eof"
POSITION = ["_file", "_block", "_row"]
# Marks kept as a literal table up to this many files; beyond it they are joined per split.
MAX_LOCAL_MARKS = 20_000


def _with_position(df: DataFrame) -> DataFrame:
    return df.select(
        strip(F.col("value")).alias("value"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def read_lines(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """Lines of a file or of the files directly inside a directory."""
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    return _with_position(reader.text(path))


def watch_lines(spark: SparkSession, directory: str, pattern: str | None = None, files_per_trigger: int | None = None,
                bytes_per_trigger: int | None = None):
    """The same lines as a stream of files landing in ``directory``."""
    reader = spark.readStream
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.text(directory).select(
        strip(F.col("value")).alias("value"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def number_rows(batch: DataFrame) -> DataFrame:
    """Give the lines of a micro-batch their row numbers."""
    return batch.withColumn("_row", F.monotonically_increasing_id())


def file_name(df: DataFrame) -> Column:
    """Name of the file as it is on disk: paths come with ``%20`` for a blank and the like."""
    return F.url_decode(F.replace(F.element_at(F.split(df["_file"], "/"), -1), F.lit("+"), F.lit("%2B")))


def label_by_path(df: DataFrame, labels: Mapping[str, str], out: str, path: str = "_file") -> DataFrame:
    """Add column ``out``: the label of the first pattern that is found in the path, null if none is.

    For inputs that are told apart by where they lie only, as registries by their folder.
    """
    label = F.lit(None).cast("string")
    for pattern, name in reversed(labels.items()):
        label = F.when(F.col(path).rlike(pattern), name).otherwise(label)
    return df.withColumn(out, label)


def position(*extra: Column) -> Column:
    return F.struct("_block", "_row", *extra)


def position_number() -> Column:
    """Block and row as one number in the same order: unlike a struct it can be a hash-aggregate buffer."""
    block = F.col("_block").cast("decimal(18,0)") * F.lit(Decimal(10**19))
    return (block + F.col("_row").cast("decimal(19,0)")).cast("decimal(38,0)")


def first_marks(lines: DataFrame, marks: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Per file with a mark, for each name ``struct(_block, _row, value)`` of the first line where ``condition`` holds.

    Lines are first counted down to one per split and value, by number, which a hash aggregate
    can do: the least of structs would sort every line that qualifies.
    """
    any_mark = F.lit(False)
    for condition, _ in marks.values():
        any_mark = any_mark | F.coalesce(condition, F.lit(False))
    names = list(marks)
    values = {f"_v{i}": F.when(c, v) for i, (c, v) in enumerate(marks.values())}
    flags = {f"_c{i}": F.coalesce(c, F.lit(False)) for i, (c, _) in enumerate(marks.values())}
    marked = lines.where(any_mark).select("_file", "_block", "_row", *[c.alias(n) for n, c in {**values, **flags}.items()])
    least = marked.groupBy("_file", "_block", *values, *flags).agg(F.min("_row").alias("_row"))
    firsts = [F.min(F.when(F.col(f"_c{i}"), position(F.col(f"_v{i}").alias("value")))).alias(n) for i, n in enumerate(names)]
    return least.groupBy("_file").agg(*firsts)


def mark_first(lines: DataFrame, marks: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Add per-file facts: for each name the ``value`` at the first line where ``condition`` holds.

    The fact is ``struct(_block, _row, value)``, null where no line qualifies. Only
    lines that qualify leave the scan, one row per file. If they fit
    MAX_LOCAL_MARKS they come back as a literal table, else ``_marks_by_split`` joins
    them on splits so that a huge file is not one join key.
    """
    found = first_marks(lines, marks)
    rows = found.limit(MAX_LOCAL_MARKS + 1).collect()
    if not rows:
        shape = {f.name: f.dataType for f in found.schema}
        return lines.select("*", *[F.lit(None).cast(shape[name]).alias(name) for name in marks])
    if len(rows) <= MAX_LOCAL_MARKS:
        local = lines.sparkSession.createDataFrame(rows, T.StructType(found.schema.fields))
        return lines.join(F.broadcast(local), "_file", "left")
    return _marks_by_split(lines, found, list(marks))


def _marks_by_split(lines: DataFrame, found: DataFrame, names: list[str]) -> DataFrame:
    splits = lines.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    facts = splits.join(found, "_file", "inner")
    return lines.join(facts, ["_file", "_block"], "left").select(lines["*"], *names)


def place_of(number: Column) -> tuple[Column, Column]:
    """Block and row of a ``position_number``."""
    unit = F.lit(Decimal(10**19))
    return F.floor(number / unit).cast("bigint"), (number % unit).cast("bigint")


def cut_at_sentinel(lines: DataFrame, token: str | None = SENTINEL) -> DataFrame:
    """Keep the lines before the first ``token`` line of each file."""
    if token is None:
        return lines
    marked = mark_first(lines, {"_end": (F.col("value") == token, F.lit(True))})
    return before_mark(marked, "_end").drop("_end")


def before_mark(marked: DataFrame, name: str) -> DataFrame:
    end = F.struct(F.col(f"{name}._block"), F.col(f"{name}._row"))
    return marked.where(F.col(name).isNull() | (position() < end))

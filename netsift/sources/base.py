"""What a source is, and the registry of sources."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netsift.functions.staging import once

APPEND, REPLACE, UPSERT = "append", "replace", "upsert"
BOOKKEEPING = ["_file", "_block", "_row", "_raw", "_error"]


@dataclass(frozen=True)
class Source:
    """One kind of input.

    ``read`` loads raw records, ``parse`` turns them into typed rows with
    ``_error`` (null when good) and ``_raw``, ``shape`` folds good rows into the
    documents of ``schema``. ``mode`` and ``key`` say how documents are written,
    ``merge_maps`` which map columns merge key by key on an upsert. ``open_key`` is the column
    whose lines make a document and may go on in a later micro-batch of a topic, ``open_rows``
    what of the good rows to remember for that (null: all).
    """

    name: str
    schema: T.StructType
    parse: Callable[..., DataFrame]
    read: Callable[..., DataFrame]
    shape: Callable[..., DataFrame]
    mode: str = APPEND
    key: tuple[str, ...] = ()
    merge_maps: tuple[str, ...] = ()
    streaming: bool = True
    open_key: str | None = None
    open_rows: Callable[[DataFrame], DataFrame] | None = None


_SOURCES: dict[str, Source] = {}


def register_source(source: Source) -> Source:
    if source.mode != APPEND and not source.key:
        raise ValueError(f"source {source.name!r} writes by key but names none")
    _SOURCES[source.name] = source
    return source


def get_source(source: str | Source) -> Source:
    if isinstance(source, Source):
        return source
    if source not in _SOURCES:
        raise ValueError(f"unknown source {source!r}; known: {', '.join(sorted(_SOURCES))}")
    return _SOURCES[source]


def source_names() -> list[str]:
    return sorted(_SOURCES)


def first_error(*checks: tuple[Column, str]) -> Column:
    """Message of the first check that fails; a null condition counts as failed."""
    chain = None
    for ok, message in checks:
        failed = ~F.coalesce(ok, F.lit(False))
        chain = F.when(failed, message) if chain is None else chain.when(failed, message)
    return chain


def parse_json(lines: DataFrame, schema: T.StructType | str, out: str = "_json") -> DataFrame:
    """Parse one JSON object per line into struct ``out``; null when malformed.

    The line is nested in an outer object with a closing field, so that text after
    the object, which the parser would ignore, counts as malformed. A field of another
    type than asked for is null and the others stay. Where the parser saw something odd, or
    further fields might follow the object, the line itself is parsed as the only element of an
    array to tell whether it is legal.
    """
    inner = schema if isinstance(schema, str) else f"struct<{','.join(f'`{f.name}`:{f.dataType.simpleString()}' for f in schema)}>"
    wrapped = F.concat(F.lit('{"r":'), F.col("value"), F.lit(',"ok":true}'))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowSingleQuotes": "false"}
    outer = F.from_json(wrapped, f"r {inner}, ok boolean, _corrupt string", options)
    staged = once(lines, _outer=outer)
    doubtful = F.col("_outer._corrupt").isNotNull() | F.col("value").rlike(r"\}\s*,")
    alone = F.try_parse_json(F.concat(F.lit("["), F.col("value"), F.lit("]"))).cast("array<variant>")
    good = F.when(doubtful, F.coalesce(F.size(alone) == 1, F.lit(False))).otherwise(F.col("_outer.ok"))
    return staged.withColumn(out, F.when(good, F.col("_outer.r"))).drop("_outer")


def further(fields: Column, known: Sequence[str]) -> Column:
    """The entries of a map that are not among the known fields; null if there are none."""
    rest = F.map_filter(fields, lambda k, _v: ~k.isin(*known))
    return F.when(F.size(rest) > 0, rest)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in order and cast; absent ones are null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("_error").isNull())


def rejects(parsed: DataFrame) -> DataFrame:
    """Rows set aside, with the reason."""
    file = F.col("_file") if "_file" in parsed.columns else F.lit(None).cast("string").alias("_file")
    return parsed.where(F.col("_error").isNotNull()).select("_error", "_raw", file)


def as_is(schema: T.StructType) -> Callable[..., DataFrame]:
    """Shape of sources whose good rows already are the documents."""

    def shape(parsed: DataFrame, **_) -> DataFrame:
        return typed(good_rows(parsed), schema)

    return shape


def line_reader(pattern: str | None = None) -> Callable[..., DataFrame]:
    from netsift.sources.lines import read_lines

    def read(spark: SparkSession, path, **_) -> DataFrame:
        return read_lines(spark, path, pattern)

    return read

"""Radio licence dumps: CSV with a header."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.functions import times
from netsift.functions.text import blank_to_null, to_integer
from netsift.sources.base import Source, as_is, register_source
from netsift.sources.quoted_csv import first_lines, read_split
from netsift.sources.schemas import LICENCE, LICENCE_COLUMNS, LICENCE_DATES, LICENCE_INTEGERS, LICENCE_NUMBERS


def read(spark: SparkSession, path, multiline: bool = True, split: bool = False, **_) -> DataFrame:
    """All columns as text. Each file is read by its own header; files with the same header are read together.

    A dump with line breaks in fields is one task per file, unless ``split`` is set (see ``quoted_csv``). Turn
    ``multiline`` off for dumps without such breaks: files can then be split as they are.
    """
    if split:
        frames = read_split(spark, path)
    else:
        reader = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
        frames = [reader.csv(files) for files in first_lines(spark, path).values()]
    frames = frames or [spark.read.option("header", True).csv(path)]
    lowered = [df.toDF(*[c.lower() for c in df.columns]) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), lowered)


def parse(rows: DataFrame, **_) -> DataFrame:
    """Convert dates and numbers; values that do not convert, blanks and ``NULL`` become null."""
    lowered = rows.toDF(*[c.lower() for c in rows.columns])
    aside = [F.col(n) if n in lowered.columns else F.lit(None).cast("string").alias(n) for n in ("_error", "_raw")]
    names = [n for n in lowered.columns if n not in ("_error", "_raw")]
    converted = []
    for name in names:
        c = F.col(f"`{name}`")
        if name in LICENCE_DATES:
            c = times.licence_date(c)
        elif name in LICENCE_INTEGERS:
            c = to_integer(c)
        elif name in LICENCE_NUMBERS:
            c = c.try_cast("double")
        else:
            c = blank_to_null(c, "NULL")
        converted.append(c.alias(name))
    others = [n for n in names if n not in LICENCE_COLUMNS]
    pairs = [x for n in others for x in (F.lit(n), blank_to_null(F.col(f"`{n}`"), "NULL"))]
    extra = F.map_filter(F.create_map(*pairs), lambda _k, v: v.isNotNull()) if pairs else F.lit(None)
    return lowered.select(
        *[c for c, n in zip(converted, names) if n in LICENCE_COLUMNS],
        extra.cast("map<string,string>").alias("_extra"),
        *aside,
    )


LICENCES = register_source(Source("licences", LICENCE, parse, read, as_is(LICENCE), streaming=False))

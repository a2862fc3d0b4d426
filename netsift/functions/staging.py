"""Columns that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once per row.

    Filters are normally rewritten to the inputs of the columns they test, which
    repeats costly expressions for every test. They do not pass an explode, here of
    an array with one struct.
    """
    packed = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_once")
    return df.select("*", packed).select(*[F.col(f"`{c}`") for c in df.columns], *[f"_once.`{n}`" for n in columns])

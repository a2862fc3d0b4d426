"""Keyed tables laid out in buckets: an upsert shuffles the incoming rows only.

A table is bucketed and sorted by its key. The join of an upsert finds the stored side in
place, whatever its size, and the result is written bucket by bucket as the next
generation of the table, so no stored row changes its bucket. A generation is complete
before it is named in the result; a failed write leaves the one before.

Cases: a key comes once per side (see ``merging.last_writes``); rows with a null key are
kept beside the others and match nothing; empty sides give the other one; columns that one
side lacks are null there.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.operators.merging import merged_column


def write_bucketed(rows: DataFrame, table: str, key: Sequence[str], buckets: int) -> str:
    """Write ``rows`` as a generation of ``table``, dealt to buckets; gives the generation's name."""
    return _put(rows.repartition(buckets, *key), table, key, buckets)


def _put(rows: DataFrame, table: str, key: Sequence[str], buckets: int) -> str:
    name = f"{table}_{uuid.uuid4().hex}"
    rows.write.format("parquet").bucketBy(buckets, *key).sortBy(*key).saveAsTable(name)
    return name


def merged_buckets(
    spark: SparkSession, generation: str, incoming: DataFrame, key: Sequence[str], buckets: int,
    maps: Sequence[str] = (), array_merge: str = "replace",
) -> DataFrame:
    """The rows of a generation with ``incoming`` merged in as ``merging.upsert`` does, each row in its bucket."""
    key = list(key)
    stored = spark.table(generation)
    names = [c for c in (*stored.columns, *incoming.columns) if c not in key]
    names = list(dict.fromkeys(names))
    kinds = {**{f.name: f.dataType for f in incoming.schema.fields}, **{f.name: f.dataType for f in stored.schema.fields}}
    old, new = _full(stored, key, names, kinds), _full(incoming, key, names, kinds).repartition(buckets, *key)
    met = old.alias("o").join(new.alias("n"), [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key], "full_outer")
    return met.select(
        *[F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in key],
        *[merged_column(c, c in maps, array_merge, kinds[c].typeName() == "array").alias(c) for c in names],
    )


def _full(rows: DataFrame, key: list[str], names: list[str], kinds: dict) -> DataFrame:
    return rows.select(*key, *[c if c in rows.columns else F.lit(None).cast(kinds[c]).alias(c) for c in names])


def upsert_bucketed(
    spark: SparkSession, table: str, generation: str, incoming: DataFrame, key: Sequence[str], buckets: int,
    maps: Sequence[str] = (), array_merge: str = "replace",
) -> str:
    """Write the next generation of ``table``; gives its name. The one before stays for its readers until dropped."""
    return _put(merged_buckets(spark, generation, incoming, key, buckets, maps, array_merge), table, key, buckets)

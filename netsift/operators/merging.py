"""Writes by key: replacement, and upserts that merge column by column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER = "_order"


def last_writes(df: DataFrame, key: Sequence[str], order: str = ORDER, maps: Sequence[str] = ()) -> DataFrame:
    """One row per key: each column's latest non-null value, a map merged entry by entry.

    Everything is an aggregate with map-side partial results, so a key written a
    billion times shuffles one row per task and map entry. ``order`` is kept as the
    latest.
    """
    key = list(key)
    plain = [c for c in df.columns if c not in (*key, *maps, order)]
    if not maps:
        latest = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in plain]
        return df.groupBy(*key).agg(*latest, F.max(order).alias(order)).select(*df.columns)
    if len(maps) > 1:
        raise ValueError("one map column can be merged")
    # First per key and map entry, then per key; each plain column travels with its order.
    entries = df.select(*key, order, *plain, F.explode_outer(maps[0]).alias("_k", "_v"))
    dated = [
        F.max_by(F.struct(F.col(c).alias("v"), F.col(order).alias("at")), F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
        for c in plain
    ]
    per_entry = entries.groupBy(*key, "_k").agg(*dated, F.max_by("_v", order).alias("_v"), F.max(order).alias(order))
    pair = F.when(F.col("_k").isNotNull(), F.struct("_k", "_v"))
    per_key = per_entry.groupBy(*key).agg(
        *[F.max_by(F.col(f"{c}.v"), F.col(f"{c}.at")).alias(c) for c in plain],
        F.collect_list(pair).alias("_pairs"),
        F.max(order).alias(order),
    )
    merged = F.when(F.size("_pairs") > 0, F.map_from_entries("_pairs"))
    return per_key.withColumn(maps[0], merged).select(*df.columns)


def last_rows(df: DataFrame, key: Sequence[str], order: str = ORDER) -> DataFrame:
    """One whole row per key, the latest."""
    others = [c for c in df.columns if c not in key]
    newest = F.max_by(F.struct(*[F.col(c) for c in others]), F.col(order)).alias("_row")
    return df.groupBy(*key).agg(newest).select(*key, "_row.*").select(*df.columns)


def replace_by_key(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Existing rows whose key does not come in, and all incoming rows."""
    kept = existing.join(incoming.select(*key).distinct(), list(key), "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def merged_column(column: str, is_map: bool, array_merge: str, is_array: bool) -> Column:
    """The merge of a column of ``o`` (stored) and ``n`` (incoming)."""
    old, new = F.col(f"o.{column}"), F.col(f"n.{column}")
    if is_map:
        both = F.map_zip_with(old, new, lambda _k, a, b: F.coalesce(b, a))
        return F.coalesce(both, new, old)
    if is_array and array_merge == "union":
        return F.coalesce(F.array_distinct(F.concat(old, new)), new, old)
    return F.coalesce(new, old)


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    maps: Sequence[str] = (),
    array_merge: str = "replace",
) -> DataFrame:
    """Insert incoming rows or merge them into the row with the same key.

    Present values replace, null keeps what was there, ``maps`` merge by map key.
    Arrays are replaced, or united with ``array_merge='union'``. Both sides must hold
    one row per key (see ``last_writes``), which also means no key can be hot here.
    """
    if array_merge not in ("replace", "union"):
        raise ValueError("array_merge is 'replace' or 'union'")
    key = list(key)
    existing = _drop_stale_parts(existing, incoming, key, maps)
    arrays = {f.name for f in incoming.schema.fields if f.dataType.typeName() == "array"}
    names = [c for c in incoming.columns if c not in key]
    old = existing.select(*existing.columns).alias("o")
    joined = old.join(incoming.alias("n"), [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in key], "full_outer")
    return joined.select(
        *[F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) for k in key],
        *[merged_column(c, c in maps, array_merge, c in arrays).alias(c) for c in names],
    ).select(*incoming.columns)


def _drop_stale_parts(existing: DataFrame, incoming: DataFrame, key: list[str], maps: Sequence[str]) -> DataFrame:
    """Take out what continuation rows hold of lists that come in anew.

    Hot documents span several ``part`` rows. A new document replaces its lists in
    all parts, also when it has fewer of them.
    """
    if "part" not in key:
        return existing
    base = [k for k in key if k != "part"]
    first, further = existing.where(F.col("part") == 0), existing.where(F.col("part") > 0)
    if not maps:
        return first.unionByName(further.join(incoming.select(*base).distinct(), base, "left_anti"))
    name = maps[0]
    fresh = incoming.select(*base, F.explode(F.map_keys(name)).alias("_k")).groupBy(*base)
    fresh = fresh.agg(F.collect_set("_k").alias("_fresh"))
    trimmed = further.join(fresh, base, "left")
    known = F.coalesce("_fresh", F.array().cast("array<string>"))
    left = trimmed.withColumn(name, F.map_filter(name, lambda k, _v: ~F.array_contains(known, k))).drop("_fresh")
    return first.unionByName(left.where(F.size(name) > 0))

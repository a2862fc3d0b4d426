"""Guards for hot keys and for broadcast sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A group above this many rows counts as hot. The number of hot keys is at most
# rows / HOT_ROWS, which is what bounds the tables of hot keys broadcast below.
HOT_ROWS = 1_000_000
# Rows a lookup side may have to be sent to every executor.
MAX_BROADCAST_ROWS = 2_000_000


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; stops counting there."""
    return df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


def hot_keys(df: DataFrame, keys: Sequence[str], weight: Column | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, and the count as ``_n``.

    ``weight`` is a column to count. Counting one that the other users of ``df`` also
    need keeps both plans equal, so that a shuffle inside ``df`` is shared.
    """
    counted = F.count(F.lit(1) if weight is None else weight)
    return df.groupBy(*keys).agg(counted.alias("_n")).where(F.col("_n") > hot_rows)


def fold_lists(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    element: Column,
    out: str,
    others: Sequence[Column] = (),
    hot_rows: int = HOT_ROWS,
    bucket: Column | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """One row per key with the list of its elements in ``order``, in parts of bounded size.

    A group of a weight above ``hot_rows`` continues in further rows, numbered by ``part``.
    Parts are cut in order: put together by number they give the list, at any size.
    ``bucket`` is coarser than the first column of ``order`` and rises with it, with at most
    ``hot_rows`` rows of the input in each; a part ends with the bucket in which the weight
    passes ``hot_rows``. ``weight`` of an element is 1, or what its size calls for. Groups
    within the bound cost a count. ``others`` are further aggregates.

    The broadcast tables have a row per hot key, which are at most total weight / hot_rows, and one
    per bucket of such a key.
    """
    weight = F.lit(1) if weight is None else weight
    bucket = F.floor(F.col(order[0]) / hot_rows) if bucket is None else bucket
    # A struct is never null, so no null filter is inferred for one side only, and all sides
    # need the order column: they then share one exchange and ``df`` runs once.
    weighed = df.groupBy(*keys).agg(F.sum(F.when(F.col(order[0]).isNotNull(), weight)).alias("_n"))
    hot = weighed.where(F.col("_n") > hot_rows).select(F.struct(*keys).alias("_hot"))
    rows = df.withColumn("_bucket", bucket)
    inside = rows.join(F.broadcast(hot), F.struct(*[rows[k] for k in keys]) == hot["_hot"], "left_semi")
    inside = inside.groupBy(*keys, "_bucket").agg(F.sum(weight).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    number = F.floor(F.coalesce(F.sum("_n").over(earlier), F.lit(0)) / hot_rows).cast("int")
    parts = inside.select(F.struct(*keys, "_bucket").alias("_at"), number.alias("part"))
    at = F.struct(*[rows[k] for k in keys], rows["_bucket"].alias("_bucket"))
    parted = rows.join(F.broadcast(parts), at == parts["_at"], "left").withColumn("part", F.coalesce("part", F.lit(0)))
    # Grouping by one struct keeps Spark from reusing a partitioning by the bare keys,
    # which would put all parts of a hot key back into one task.
    grouped = parted.groupBy(F.struct(*keys, "part").alias("_group")).agg(
        F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in order], element.alias("_e")))).alias("_list"), *others
    )
    others_names = [c for c in grouped.columns if c not in ("_group", "_list")]
    return grouped.select("_group.*", F.col("_list._e").alias(out), *others_names)


def salted_join(
    big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Shuffle join that spreads hot and null keys of ``big`` over many tasks.

    Rows of a hot key are dealt to ceil(n / hot_rows) salts and only that key's rows
    of ``small`` are repeated per salt. Both tables of hot keys and all repeats are
    bounded by rows / hot_rows. ``small`` holds few rows per key.
    """
    keys = list(keys)
    parts = F.ceil(F.col("_n") / hot_rows).cast("bigint")
    hot = F.broadcast(hot_keys(big, keys, hot_rows=hot_rows).select(*keys, parts.alias("_parts")))
    # by content, so that a task that runs again deals its rows as before
    number = F.xxhash64(*[big[c] for c in big.columns if not isinstance(big.schema[c].dataType, (T.MapType, T.VariantType))])
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    salt = F.when(no_key, F.pmod(number, F.lit(4096))).otherwise(F.coalesce(F.pmod(number, F.col("_parts")), F.lit(0)))
    dealt = big.join(hot, keys, "left").withColumn("_salt", salt.cast("bigint")).drop("_parts")
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    repeated = small.join(hot, keys, "left").withColumn("_salt", salts).drop("_parts")
    return dealt.join(repeated, [*keys, "_salt"], how).drop("_salt")


def join_lookup(
    big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left",
    hot_rows: int = HOT_ROWS, max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Broadcast ``small`` when its checked size allows, else join by shuffle with salt."""
    if is_small(small, max_rows):
        return big.join(F.broadcast(small), list(keys), how)
    return salted_join(big, small, keys, how, hot_rows)


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the cluster's shared checkpoint folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def shared_folder(spark) -> str:
    """The folder the cluster names; a temporary one only in local mode without a name."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    import tempfile

    return tempfile.mkdtemp(prefix="netsift-")

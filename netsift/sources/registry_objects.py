"""Registry database dumps: blank-line separated objects of ``attribute: value`` lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.functions.text import strip
from netsift.sources.base import Source, as_is, register_source
from netsift.sources.schemas import REGISTRY_OBJECT


def read(spark: SparkSession, path, partitions: int | None = None, pattern: str | None = None, crlf: bool = False, **_) -> DataFrame:
    """One row per object. A gzipped dump is one task, so ``partitions`` spreads its objects afterwards.

    Dumps with CR LF are split too; ``crlf`` reads large ones object by object instead of whole.
    """
    separator = "\r\n\r\n" if crlf else "\n\n"
    rows = spark.read.text(path, lineSep=separator, pathGlobFilter=pattern).select("value", F.col("_metadata.file_path").alias("_file"))
    objects = rows.select(F.explode(F.split("value", r"\r?\n[ \t]*\r?\n")).alias("value"), "_file").where(strip(F.col("value")) != "")
    return objects.repartition(partitions) if partitions else objects


def parse(objects: DataFrame, **_) -> DataFrame:
    """Attributes of each object as a map to the list of their values, in order.

    Lines that start with a blank or ``+`` continue the value before; ``%`` and ``#``
    lines are comments.
    """
    plain = F.regexp_replace("value", r"(?m)^[%#].*$", "")
    joined = F.regexp_replace(plain, r"\r?\n[ \t+]+(?=\S)", " ")
    pairs = F.transform(
        F.filter(F.split(F.replace(joined, F.lit("\r\n"), F.lit("\n")), "\n"), lambda x: strip(x) != ""),
        lambda x: F.struct(
            strip(F.lower(F.split_part(x, F.lit(":"), F.lit(1)))).alias("name"),
            strip(F.regexp_extract(x, r"\A[^:]*:(.*)\z", 1)).alias("value"),
            x.contains(":").alias("ok"),
        ),
    )
    staged = objects.select("_file", F.col("value").alias("_raw"), pairs.alias("_pairs")).where(F.size("_pairs") > 0)
    names = F.array_distinct(F.transform("_pairs", lambda p: p["name"]))
    grouped = F.transform(
        names,
        lambda n: F.struct(n, F.transform(F.filter("_pairs", lambda p: p["name"] == n), lambda p: p["value"])),
    )
    fine = F.forall("_pairs", lambda p: p["ok"])
    return staged.select(
        "_file", "_raw",
        F.when(~fine, "line without a colon").alias("_error"),
        F.get("_pairs", F.lit(0)).getField("name").alias("object_class"),
        F.get("_pairs", F.lit(0)).getField("value").alias("object_id"),
        F.map_from_entries(grouped).alias("attributes"),
    )


def changed_snapshots(published: DataFrame, stored: DataFrame, key: str = "registry", serial: str = "serial") -> DataFrame:
    """Published snapshots whose serial differs from the stored one or that are not stored."""
    old = stored.select(key, F.col(serial).alias("_old"))
    return published.join(old, key, "left").where(~F.col(serial).eqNullSafe(F.col("_old"))).drop("_old")


OBJECTS = register_source(
    Source("registry_objects", REGISTRY_OBJECT, parse, read, as_is(REGISTRY_OBJECT), streaming=False)
)

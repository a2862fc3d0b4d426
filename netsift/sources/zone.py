"""Zone files: lines ``name ttl class type data``, one document per domain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions import times
from netsift.functions.staging import once
from netsift.functions.text import digits_only, drop_dots, fields, zone_of_file
from netsift.operators.grouping import run_numbers, with_order
from netsift.operators.skew import HOT_ROWS, fold_lists
from netsift.sources.base import UPSERT, Source, first_error, good_rows, line_reader, register_source
from netsift.sources.lines import POSITION, SENTINEL, before_mark, file_name, mark_first
from netsift.sources.schemas import ZONE, ZONE_RECORD_TYPES


def _tidy(kind: Column, data: Column) -> Column:
    """Drop trailing dots where the record type has names."""
    words = F.split(data, " ")
    first = drop_dots(F.get(words, F.lit(0)))
    rest = F.array_join(F.slice(words, 2, 2147483647), " ")
    nsec = F.when(F.size(words) > 1, F.concat_ws(" ", first, rest)).otherwise(first)
    return (
        F.when(kind == "nsec", nsec)
        .when(kind == "soa", F.regexp_replace(data, r"\.+(?= |\z)", ""))
        .otherwise(drop_dots(data))
    )


def parse(lines: DataFrame, sentinel: str | None = SENTINEL, **_) -> DataFrame:
    """One row per record line: domain, zone, type, ttl, data, and where the transfer comment stands."""
    text = F.col("value")
    comment = text.startswith(";")
    transfer = comment & text.contains("DiG") & text.contains("AXFR")
    marks = {"_axfr": (transfer, F.lit(True))}
    if sentinel is not None:
        marks["_end"] = (text == sentinel, F.lit(True))
    marked = mark_first(lines, marks)
    if sentinel is not None:
        marked = before_mark(marked, "_end")
    if "_axfr_before" in lines.columns:
        marked = marked.withColumn("_axfr", F.coalesce("_axfr_before", "_axfr"))
    rows = once(marked.where((text != "") & ~comment), _parts=fields(text, 5))
    parts = F.col("_parts")
    split = rows.select(
        *POSITION,
        "_axfr",
        text.alias("_raw"),
        zone_of_file(file_name(rows)).alias("zone"),
        F.get(parts, F.lit(4)).alias("_data"),
        F.lower(drop_dots(F.get(parts, F.lit(0)))).alias("domain"),
        F.get(parts, F.lit(1)).alias("_ttl"),
        F.lower(F.get(parts, F.lit(2))).alias("_class"),
        F.lower(F.get(parts, F.lit(3))).alias("type"),
    )
    error = first_error(
        (F.col("_data").isNotNull(), "fewer than 5 fields"),
        (digits_only(F.col("_ttl")) & F.col("_ttl").try_cast("bigint").isNotNull(), "bad ttl"),
        (F.col("_class") == "in", "unsupported class"),
        (F.col("type").isin(*ZONE_RECORD_TYPES), "unsupported type"),
    )
    return split.withColumn("_error", error).select(
        *POSITION, "_axfr", "_raw", "_error", "zone", "domain", "type",
        F.col("_ttl").try_cast("bigint").alias("ttl"),
        _tidy(F.col("type"), F.col("_data")).alias("data"),
    )


def records(parsed: DataFrame) -> DataFrame:
    """Long form: one row per accepted record, in no need of grouping."""
    return good_rows(parsed).drop("_error", "_raw")


def shape(parsed: DataFrame, group: str = "key", seen=None, hot_rows: int = HOT_ROWS, **_) -> DataFrame:
    """Documents: one per domain, its records grouped by type in file order."""
    rows, keys = records(parsed), ["_file", "domain"]
    if group == "run":
        rows, keys = run_numbers(rows, "domain"), ["_file", "_run", "domain"]
    rows = rows.withColumn("_pos", F.struct("_block", "_row"))
    facts = [F.min("_pos").alias("_start"), F.first("zone").alias("zone"), F.first("_axfr").alias("_axfr")]
    lists = fold_lists(rows, [*keys, "type"], ["_pos"], F.struct("ttl", "data"), "_records", facts, hot_rows,
                       F.struct("_block", F.floor(F.col("_row") / hot_rows).alias("_row")), 1 + F.floor(F.length("data") / 256))
    domains = lists.groupBy(*keys, "part").agg(
        F.map_from_entries(F.collect_list(F.struct("type", "_records"))).alias("records"),
        F.min("_start").alias("_start"),
        F.first("zone").alias("zone"),
        F.first("_axfr").alias("_axfr"),
    )
    after = F.col("_start") > F.struct(F.col("_axfr._block"), F.col("_axfr._row"))
    source = F.when(F.col("_axfr").isNotNull() & after, "axfr").otherwise("czds")
    return with_order(domains.withColumn("source", source).withColumn("seen", times.as_instant(seen)), ZONE)


ZONES = register_source(
    Source("zone", ZONE, parse, line_reader(), shape, UPSERT, ("domain", "part"), ("records",), open_key="domain")
)

"""Reverse-DNS names: answer lines ``name PTR data``, and JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.functions import ip, times
from netsift.functions.staging import once
from netsift.functions.text import drop_dots, fields
from netsift.operators.grouping import run_numbers, with_order
from netsift.operators.skew import HOT_ROWS, fold_lists
from netsift.sources.base import UPSERT, Source, first_error, good_rows, line_reader, parse_json, register_source
from netsift.sources.lines import POSITION, SENTINEL, cut_at_sentinel, place_of, position_number
from netsift.sources.schemas import REVERSE_NAMES, REVERSE_STREAM


def parse_text(lines: DataFrame, sentinel: str | None = SENTINEL, **_) -> DataFrame:
    """One row per usable answer line: ip, record."""
    rows = once(cut_at_sentinel(lines, sentinel).where(F.col("value") != ""), _parts=fields(F.col("value"), 3))
    parts = F.col("_parts")
    split = rows.select(
        *POSITION,
        F.col("value").alias("_raw"),
        F.get(parts, F.lit(2)).isNotNull().alias("_enough"),
        drop_dots(F.get(parts, F.lit(0))).alias("_name"),
        F.get(parts, F.lit(1)).alias("_type"),
        drop_dots(F.get(parts, F.lit(2))).alias("record"),
    )
    wanted = (F.col("_type") == "PTR") & (F.col("record") != "") & (F.col("record") != F.col("_name"))
    addressed = once(split.where(~F.col("_enough") | wanted), ip=ip.from_reverse_name(F.col("_name")))
    error = first_error(
        (F.col("_enough"), "fewer than 3 fields"),
        (ip.is_ipv4(F.col("ip")), "not an IPv4 reverse name"),
    )
    return addressed.withColumn("_error", error).drop("_enough", "_name", "_type")


def distinct_names(parsed: DataFrame) -> DataFrame:
    """Long form: one row per file, address and name, with its first position.

    This aggregate combines before the shuffle, so a hot address costs no more than
    its distinct names.
    """
    good = good_rows(parsed)
    return good.groupBy("_file", "ip", "record").agg(F.min(position_number()).alias("_first"))


def shape_text(parsed: DataFrame, group: str = "key", seen=None, hot_rows: int = HOT_ROWS, **_) -> DataFrame:
    """Documents: one per address with its distinct names in order of appearance.

    ``group='key'`` gathers an address over the whole file; ``group='run'`` makes one
    document per run of consecutive lines, as line-by-line readers do.
    """
    if group == "run":
        good = run_numbers(good_rows(parsed), "ip")
        names = good.groupBy("_file", "_run", "ip", "record").agg(F.min(position_number()).alias("_first"))
        keys = ["_file", "_run", "ip"]
    else:
        names, keys = distinct_names(parsed), ["_file", "ip"]
    folded = fold_lists(names, keys, ["_first"], F.col("record"), "record", hot_rows=hot_rows, weight=1 + F.floor(F.length("record") / 256))
    return with_order(folded.withColumn("seen", times.as_instant(seen)), REVERSE_NAMES)


def parse_json_records(lines: DataFrame, **_) -> DataFrame:
    """JSON reverse-DNS records; names that only repeat the address are dropped."""
    rows = lines.where(F.col("value").startswith("{"))
    r = F.col("_json")
    known = [f.name for f in REVERSE_STREAM.fields]
    everything = F.from_json("value", "map<string,variant>")
    flat = parse_json(
        rows, "struct<ip:string,nameserver:string,record:string,record_type:string,ttl:string,seen:string>"
    ).select(
        *POSITION,
        F.col("value").alias("_raw"),
        r.isNotNull().alias("_parsed"),
        *[r[name].alias(name) for name in ("ip", "nameserver", "record", "record_type")],
        r.ttl.try_cast("int").alias("ttl"),
        r.seen.try_cast("timestamp_ntz").alias("seen"),
        (r.ttl.isNull() | r.ttl.try_cast("int").isNotNull()).alias("_ttl_ok"),
        F.when(r.isNotNull(), F.map_filter(everything, lambda k, _v: ~k.isin(known))).alias("_extra"),
    )
    own_name = F.col("record") == ip.to_reverse_name(F.col("ip"))
    error = first_error(
        (F.col("_parsed"), "malformed JSON"),
        (ip.is_address(F.col("ip")), "bad or missing ip"),
        (F.col("record").isNotNull(), "missing record"),
        (F.col("_ttl_ok"), "bad ttl"),
    )
    return flat.where(~F.coalesce(own_name, F.lit(False))).withColumn("_error", error).drop("_parsed", "_ttl_ok")


def shape_json(parsed: DataFrame, **_) -> DataFrame:
    good = good_rows(parsed).withColumn("_order", F.struct(*POSITION))
    return good.select(*[f.name for f in REVERSE_STREAM.fields], "_order")


def first_rows(rows: DataFrame) -> DataFrame:
    """Each name of an address once, at its first position."""
    first = rows.groupBy("_file", "ip", "record").agg(F.min(position_number()).alias("_at"))
    block, row = place_of(F.col("_at"))
    return first.select("_file", block.alias("_block"), row.alias("_row"), "ip", "record").select(*rows.columns)


REVERSE = register_source(
    Source("reverse_names", REVERSE_NAMES, parse_text, line_reader(), shape_text, UPSERT, ("ip", "part"),
           open_key="ip", open_rows=first_rows)
)
REVERSE_JSON = register_source(
    Source("reverse_stream", REVERSE_STREAM, parse_json_records, line_reader(), shape_json, UPSERT, ("ip",), ("_extra",))
)

"""Registry delegation files: ``|``-separated lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.functions import ip, times
from netsift.functions.staging import once
from netsift.functions.text import blank_to_null, digits_only
from netsift.sources.base import Source, as_is, first_error, line_reader, register_source
from netsift.sources.lines import POSITION
from netsift.sources.schemas import DELEGATION, DELEGATION_STATES

_FIELDS = "registry string, cc string, type string, start string, value string, date string, status string, extensions string"


def parse(lines: DataFrame, seen=None, **_) -> DataFrame:
    """One row per record line; comments, the version line and summary lines are skipped."""
    text = F.col("value")
    rows = once(lines.where((text != "") & ~text.startswith("#")), r=F.from_csv(F.lower(text), _FIELDS, {"sep": "|"}))
    r = F.col("r")
    header = r.registry.rlike(r"\A[0-9.]+\z")
    summary = (r.type != "*") & (r.start == "*")
    rows = rows.where(~F.coalesce(header, F.lit(False)) & ~F.coalesce(summary, F.lit(False)))
    staged = rows.select(
        *POSITION, text.alias("_raw"), "r.*",
        F.when(digits_only(r.value), r.value).try_cast("bigint").alias("_count"),
        F.when(r.type == "asn", F.when(digits_only(r.start), r.start).try_cast("bigint")).alias("_asn"),
    )
    staged = once(staged, _bits=F.when(F.col("type") == "ipv6", ip.bits(F.col("start"))))
    first, count = F.col("start"), F.col("_count")
    end = F.when(F.col("type") == "ipv4", ip.ipv4_block_end(first, count)).when(
        F.col("type") == "ipv6", ip.ipv6_block_end(F.col("_bits"), count.try_cast("int"))
    )
    day = F.when(F.col("date") != "00000000", F.col("date"))
    ended = once(staged, _end=end, _date=times.compact_date(day))
    error = first_error(
        (F.coalesce(F.length("cc") == 2, F.lit(True)), "bad country code"),
        (count.isNotNull(), "bad value"),
        (F.col("type").isin("asn", "ipv4", "ipv6"), "bad record type"),
        ((F.col("type") != "asn") | F.col("_asn").isNotNull(), "bad AS number"),
        ((F.col("type") == "asn") | F.col("_end").isNotNull(), "bad IP range"),
        (day.isNull() | F.col("_date").isNotNull(), "bad date"),
        (F.col("status").isin(*DELEGATION_STATES), "bad status"),
    )
    return ended.select(
        *POSITION, "_raw", error.alias("_error"), "registry", blank_to_null(F.col("cc")).alias("cc"),
        F.when(F.col("_asn").isNotNull(), F.struct(F.col("_asn").alias("start"), (F.col("_asn") + count - 1).alias("end"))).alias("asn"),
        F.when(F.col("_end").isNotNull(), F.struct(first.alias("start"), F.col("_end").alias("end"))).alias("ip"),
        F.col("_date").alias("date"), "status", blank_to_null(F.col("extensions")).alias("extensions"),
        times.as_instant(seen).alias("seen"),
    )


DELEGATIONS = register_source(Source("delegations", DELEGATION, parse, line_reader(), as_is(DELEGATION)))

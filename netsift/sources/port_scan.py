"""Port-scan records, one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.functions import ip, times
from netsift.functions.staging import once
from netsift.functions.text import blank_to_null, squeeze, strip
from netsift.sources.base import Source, as_is, first_error, line_reader, parse_json, register_source
from netsift.sources.lines import POSITION, SENTINEL, cut_at_sentinel
from netsift.sources.schemas import PORT_SCAN

_RECORD = (
    "struct<ip:string,port:string,proto:string,ttl:string,timestamp:string,rec_type:string,"
    "data:struct<service_name:string,banner:string>>"
)


def parse(lines: DataFrame, sentinel: str | None = SENTINEL, **_) -> DataFrame:
    rows = cut_at_sentinel(lines, sentinel).where(F.col("value").startswith("{"))
    r = F.col("_json")
    banner = r.rec_type == "banner"
    # once, or each filter on these columns works them out again
    flat = once(
        parse_json(rows, _RECORD).select(*POSITION, F.col("value").alias("_raw"), "_json"),
        _parsed=r.isNotNull(),
        ip=r.ip,
        port=r.port.try_cast("int"),
        proto=r.proto,
        service=F.when(banner, blank_to_null(r.data.service_name, "unknown")),
        banner=F.when(banner & (strip(r.data.banner) != ""), squeeze(r.data.banner)),
        ttl=r.ttl.try_cast("int"),
        seen=times.from_epoch(r.timestamp),
        _kind=r.rec_type.isNotNull(),
    ).drop("_json")
    error = first_error(
        (F.col("_parsed"), "malformed JSON"),
        (ip.is_address(F.col("ip")), "bad or missing ip"),
        (F.col("port").isNotNull(), "bad or missing port"),
        (F.col("proto").isNotNull(), "missing proto"),
        (F.col("ttl").isNotNull(), "bad or missing ttl"),
        (F.col("seen").isNotNull(), "bad or missing timestamp"),
        (F.col("_kind"), "missing rec_type"),
    )
    return flat.withColumn("_error", error).drop("_parsed", "_kind")


PORT_SCANS = register_source(Source("port_scan", PORT_SCAN, parse, line_reader(), as_is(PORT_SCAN)))

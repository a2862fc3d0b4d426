"""Web-probe records, one JSON object per line; unknown fields are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.functions import times
from netsift.sources.base import Source, as_is, first_error, line_reader, parse_json, register_source
from netsift.sources.lines import POSITION, SENTINEL, cut_at_sentinel
from netsift.sources.schemas import WEB_PROBE, WEB_PROBE_DROPPED

# Numbers arrive as numbers or as text, so they are read as text first.
_LISTS = ("a", "cname", "aaaa", "tech")
_NUMBERS = ("port", "words", "lines", "status_code", "content_length")


def _raw_type(field) -> str:
    kind = field.dataType.simpleString()
    return kind.replace("int", "string") if "int" in kind else kind


_RECORD = "struct<" + ",".join(f"`{f.name}`:{_raw_type(f)}" for f in WEB_PROBE.fields if f.name != "_extra") + ">"


def parse(lines: DataFrame, sentinel: str | None = SENTINEL, utc: bool = False, **_) -> DataFrame:
    rows = cut_at_sentinel(lines, sentinel).where(F.col("value") != "")
    r = F.col("_json")
    known = [f.name for f in WEB_PROBE.fields] + list(WEB_PROBE_DROPPED)
    everything = F.from_json("value", "map<string,variant>")
    codes = r.chain_status_codes
    lifted = {f.name: r[f.name] for f in WEB_PROBE.fields if f.name != "_extra"}
    lifted |= {name: r[name].try_cast("int") for name in _NUMBERS}
    # a list field may come as one value
    for name in _LISTS:
        single = F.try_variant_get(everything[name], "$", "string")
        lifted[name] = F.coalesce(r[name], F.when(single.isNotNull(), F.array(single)))
    lifted["timestamp"] = times.probe_time(r.timestamp, utc)
    lifted["chain_status_codes"] = F.transform(codes, lambda c: c.try_cast("int"))
    numbers_ok = F.lit(True)
    for name in _NUMBERS:
        numbers_ok = numbers_ok & (r[name].isNull() | r[name].try_cast("int").isNotNull())
    error = first_error(
        (r.isNotNull(), "malformed JSON"),
        (r.timestamp.isNotNull(), "missing timestamp"),
        (numbers_ok, "bad number"),
    )
    return parse_json(rows, _RECORD).select(
        *POSITION,
        F.col("value").alias("_raw"),
        error.alias("_error"),
        *[c.alias(name) for name, c in lifted.items()],
        F.when(r.isNotNull(), F.map_filter(everything, lambda k, _v: ~k.isin(known))).alias("_extra"),
    )


WEB_PROBES = register_source(Source("web_probe", WEB_PROBE, parse, line_reader(), as_is(WEB_PROBE)))

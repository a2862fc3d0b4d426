"""Mesh-radio messages, one JSON object per line, with payloads of any shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions import times
from netsift.functions.staging import once
from netsift.sources.base import Source, as_is, first_error, further, line_reader, parse_json, register_source
from netsift.sources.lines import POSITION, SENTINEL, cut_at_sentinel
from netsift.sources.schemas import MESH_MESSAGE, MESH_PAYLOAD, MESH_PAYLOAD_STORED

_DECODED = "struct<bitfield:bigint,payload:variant,portnum:string,requestId:bigint,wantResponse:boolean>"
_DECODED_NAMES = ("bitfield", "payload", "portnum", "requestId", "wantResponse")
_MESSAGE = (
    f"struct<channel:bigint,decoded:{_DECODED},`from`:bigint,hopLimit:bigint,hopStart:bigint,id:bigint,"
    "priority:string,rxRssi:bigint,rxSnr:double,rxTime:string,to:bigint,viaMqtt:boolean,wantAck:boolean>"
)


def _epoch(c: Column) -> Column:
    return times.from_epoch(c.try_cast("double"))


def _payload(p: Column, known: Column, is_object: Column) -> Column:
    """An object keeps its fields, with epoch times as instants; anything else becomes ``value``."""
    kept = [known[f.name].cast(f.dataType).alias(f.name)
            for f in MESH_PAYLOAD_STORED.fields if f.name not in ("time", "timestamp", "value", "raw")]
    stamps = [
        F.when(is_object, _epoch(F.try_variant_get(p, f"$.{n}", "double"))).alias(n) for n in ("time", "timestamp")
    ]
    return F.struct(*kept, *stamps, F.when(~is_object, p).alias("value"), p.alias("raw"))


def parse(lines: DataFrame, sentinel: str | None = SENTINEL, **_) -> DataFrame:
    rows = cut_at_sentinel(lines, sentinel).where(F.col("value").startswith("{"))
    r = F.col("_json")
    p = r.decoded.payload
    staged = once(parse_json(rows, _MESSAGE), _is_object=F.schema_of_variant(p).startswith("OBJECT"))
    known = F.when(F.col("_is_object"), F.try_variant_get(p, "$", MESH_PAYLOAD.simpleString()))
    staged = once(staged, _known=known)
    decoded = F.when(
        r.decoded.isNotNull(),
        F.struct(
            r.decoded.bitfield.alias("bitfield"),
            F.when(p.isNotNull(), F.array(_payload(p, F.col("_known"), F.col("_is_object")))).alias("payload"),
            r.decoded.portnum.alias("portnum"),
            r.decoded.requestId.alias("requestId"),
            r.decoded.wantResponse.alias("wantResponse"),
            further(F.from_json(F.get_json_object("value", "$.decoded"), "map<string,variant>"), _DECODED_NAMES).alias("_extra"),
        ),
    )
    names = [f.name for f in MESH_MESSAGE.fields]
    extra = further(F.when(r.isNotNull(), F.from_json("value", "map<string,variant>")), names)
    own = {"decoded": decoded, "rxTime": _epoch(r.rxTime), "_extra": extra}
    error = first_error(
        (r.isNotNull(), "malformed JSON"),
        (r.rxTime.isNull() | _epoch(r.rxTime).isNotNull(), "bad rxTime"),
    )
    return staged.select(
        *POSITION, F.col("value").alias("_raw"), error.alias("_error"),
        *[(own[n] if n in own else r[n]).alias(n) for n in names],
    )


MESH = register_source(Source("mesh_radio", MESH_MESSAGE, parse, line_reader(), as_is(MESH_MESSAGE)))

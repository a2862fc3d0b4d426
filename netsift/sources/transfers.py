"""Registry transfer documents: one JSON document per file with an array of transfers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.functions import ip, times
from netsift.functions.staging import once
from netsift.functions.text import digits_only
from netsift.sources.base import Source, as_is, first_error, further, parse_json, register_source
from netsift.sources.schemas import TRANSFER, TRANSFER_TYPES

_NETS = "struct<original_set:array<struct<start_address:string,end_address:string>>,transfer_set:array<struct<start_address:string,end_address:string>>>"
_ASNS = "struct<original_set:array<struct<start:string,end:string>>,transfer_set:array<struct<start:string,end:string>>>"
_ORG = "struct<name:string,country_code:string>"
_DOCUMENT = (
    "struct<transfers:array<struct<transfer_date:string,source_registration_date:string,"
    f"recipient_registration_date:string,ip4nets:{_NETS},ip6nets:{_NETS},asns:{_ASNS},type:string,"
    f"source_organization:{_ORG},recipient_organization:{_ORG},source_rir:string,recipient_rir:string>>>"
)
_SETS = ("original_set", "transfer_set")


def read(spark: SparkSession, path, **_) -> DataFrame:
    """Whole documents; a JSON document cannot be split, so each file is one row."""
    return spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("_file"))


def _rewrite(block: Column, edges: tuple[str, str], change) -> Column:
    """Apply ``change`` to both edges of every range in both sets of ``block``."""
    def ranges(name: str) -> Column:
        return F.transform(block[name], lambda x: F.struct(*[change(x[e]).alias(e) for e in edges])).alias(name)

    return F.when(block.isNotNull(), F.struct(*[ranges(name) for name in _SETS]))


def _all_fine(before: Column, after: Column, edges: tuple[str, str]) -> Column:
    """True unless a rewrite lost an edge that was there or an edge is missing."""
    fine = F.lit(True)
    for name in _SETS:
        lost = F.exists(after[name], lambda x: x[edges[0]].isNull() | x[edges[1]].isNull())
        fine = fine & ~F.coalesce(lost, F.lit(False))
    return fine | before.isNull()


def _as_number(c: Column) -> Column:
    return F.when(digits_only(c), c).try_cast("bigint")


def parse(documents: DataFrame, seen=None, utc: bool = False, **_) -> DataFrame:
    """One row per transfer; a document without transfers is set aside whole."""
    docs = parse_json(documents, _DOCUMENT)
    usable = F.col("_json.transfers").isNotNull()
    broken = docs.where(~F.coalesce(usable, F.lit(False))).select(
        "_file",
        F.col("value").alias("_raw"),
        F.when(F.col("_json").isNull(), "malformed JSON").otherwise("no transfers").alias("_error"),
    )
    everything = F.from_json("value", "struct<transfers:array<map<string,variant>>>")["transfers"]
    t = F.col("t")
    rows = once(
        docs.select("_file", F.explode(F.arrays_zip(F.col("_json.transfers").alias("t"), everything.alias("all"))).alias("z"))
        .select("_file", F.col("z.t").alias("t"), F.col("z.all").alias("_all")),
        _v4=_rewrite(t.ip4nets, ("start_address", "end_address"), ip.repaired),
        _v6=_rewrite(t.ip6nets, ("start_address", "end_address"), ip.repaired),
        _as=_rewrite(t.asns, ("start", "end"), _as_number),
    )
    error = first_error(
        (_all_fine(t.asns, F.col("_as"), ("start", "end")), "bad AS number"),
        (_all_fine(t.ip4nets, F.col("_v4"), ("start_address", "end_address")), "bad address"),
        (_all_fine(t.ip6nets, F.col("_v6"), ("start_address", "end_address")), "bad address"),
        (t.type.isin(*TRANSFER_TYPES), "bad transfer type"),
    )
    dates = ("transfer_date", "source_registration_date", "recipient_registration_date")
    parsed = rows.select(
        "_file", F.to_json("t").alias("_raw"), error.alias("_error"),
        *[times.transfer_date(t[name], utc).alias(name) for name in dates],
        F.col("_v4").alias("ip4nets"), F.col("_v6").alias("ip6nets"), F.col("_as").alias("asns"), t.type.alias("type"),
        *[t[name].alias(name) for name in ("source_organization", "recipient_organization", "source_rir", "recipient_rir")],
        times.as_instant(seen).alias("seen"), further(F.col("_all"), [f.name for f in TRANSFER.fields]).alias("_extra"),
    )
    return parsed.unionByName(broken, allowMissingColumns=True)


TRANSFERS = register_source(Source("transfers", TRANSFER, parse, read, as_is(TRANSFER), streaming=False))

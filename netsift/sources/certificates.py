"""Certificate-transparency messages: one document per bare domain name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.functions import times
from netsift.functions.text import bare_domain
from netsift.sources.base import UPSERT, Source, first_error, good_rows, line_reader, parse_json, register_source
from netsift.sources.lines import POSITION
from netsift.sources.schemas import CERTIFICATE_NAMES

_MESSAGE = (
    "struct<data:struct<leaf_cert:struct<all_domains:array<string>,fingerprint:string,"
    "issuer:struct<O:string>,subject:map<string,string>>>>"
)


def parse(lines: DataFrame, **_) -> DataFrame:
    """One row per message with its names (wildcards reduced, doubles gone)."""
    cert = F.col("_json.data.leaf_cert")
    staged = parse_json(lines.where(F.col("value") != ""), _MESSAGE).select(
        *POSITION,
        F.col("value").alias("_raw"),
        F.col("_json").isNotNull().alias("_parsed"),
        F.array_distinct(cert.all_domains).alias("_all"),
        cert.fingerprint.alias("fingerprint"),
        cert.issuer.O.alias("issuer"),
        F.map_filter(cert.subject, lambda _k, v: v.isNotNull()).alias("subject"),
    )
    covered = F.filter("_all", lambda d: ~(d.startswith("*.") & F.array_contains("_all", bare_domain(d))))
    error = first_error(
        (F.col("_parsed"), "malformed JSON"),
        (F.col("_all").isNotNull(), "missing all_domains"),
        (F.col("fingerprint").isNotNull(), "missing fingerprint"),
        (F.col("subject").isNotNull(), "missing subject"),
    )
    return (
        staged.withColumn("_names", F.transform(covered, bare_domain)).withColumn("_error", error).drop("_parsed", "_all")
    )


def shape(parsed: DataFrame, seen=None, **_) -> DataFrame:
    return good_rows(parsed).select(
        F.explode("_names").alias("domain"),
        "fingerprint",
        "issuer",
        "subject",
        times.as_instant(seen).alias("seen"),
        F.struct(*POSITION).alias("_order"),
    )


CERTIFICATES = register_source(
    Source("certificates", CERTIFICATE_NAMES, parse, line_reader(), shape, UPSERT, ("domain",), ("subject",))
)

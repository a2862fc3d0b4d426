"""Internet exchange points, one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.functions import ip
from netsift.sources.base import Source, as_is, first_error, line_reader, parse_json, register_source
from netsift.sources.lines import POSITION
from netsift.sources.schemas import EXCHANGE


def parse(lines: DataFrame, **_) -> DataFrame:
    rows = parse_json(lines.where(F.col("value") != ""), EXCHANGE.simpleString())
    error = first_error(
        (F.col("_json").isNotNull(), "malformed JSON"),
        (F.col("_json.name").isNotNull(), "missing name"),
    )
    return rows.select(*POSITION, F.col("value").alias("_raw"), error.alias("_error"), "_json.*")


def prefixes(exchanges: DataFrame) -> DataFrame:
    """One row per peering prefix: the exchange, the network text and its range."""
    both = F.concat(
        F.coalesce(F.col("prefixes.ipv4"), F.array().cast("array<string>")),
        F.coalesce(F.col("prefixes.ipv6"), F.array().cast("array<string>")),
    )
    rows = exchanges.select("ix_id", "name", "country", F.explode(both).alias("prefix"))
    return ip.with_network(rows, "prefix", "net")


EXCHANGES = register_source(Source("exchanges", EXCHANGE, parse, line_reader(), as_is(EXCHANGE)))

"""Named enrichments, applied to documents as they are written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.operators.lookup import range_lookup
from netsift.sources.schemas import GEO

_ENRICHMENTS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register_enrichment(name: str, enrich: Callable[[DataFrame], DataFrame]) -> None:
    _ENRICHMENTS[name] = enrich


def geoip_enrichment(
    ranges: DataFrame, address: str = "ip", start: str = "first", end: str = "last", out: str = "geoip"
) -> Callable[[DataFrame], DataFrame]:
    """A step to register: adds the place of ``address`` from a table of address ranges.

    ``ranges`` has the bounds and any of the GEO fields; others are null. A row without an
    address, or with one in no range, gets null.
    """
    have = set(ranges.columns)
    fields = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in GEO.fields]
    placed = ranges.select(start, end, *fields)

    def enrich(documents: DataFrame) -> DataFrame:
        return range_lookup(documents, address, placed, start, end, out)

    return enrich


def apply_enrichment(documents: DataFrame, name: str | None) -> DataFrame:
    if name is None:
        return documents
    if name not in _ENRICHMENTS:
        raise ValueError(f"enrichment {name!r} does not exist")
    return documents.transform(_ENRICHMENTS[name])

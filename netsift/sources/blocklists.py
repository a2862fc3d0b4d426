"""Address blocklists: one address or network per line, category in a header comment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.functions import ip, times
from netsift.functions.staging import once
from netsift.functions.text import blank_to_null, stem, strip
from netsift.sources.base import REPLACE, Source, first_error, good_rows, line_reader, register_source, typed
from netsift.sources.lines import POSITION, file_name, mark_first
from netsift.sources.schemas import BLOCKLIST, BLOCKLIST_HISTORY

_CATEGORY = r"(?i)\A#\s*Category\s*:\s*(.+)\z"


def parse(lines: DataFrame, **_) -> DataFrame:
    """One row per entry: network text, list name, list category."""
    # by endings, not by a regex: this is asked of every line
    wanted = F.lit(False)
    for ending in (".ipset", ".netset"):
        listed = F.col("_file").endswith(ending)
        for age in BLOCKLIST_HISTORY:
            listed = listed & ~F.col("_file").endswith(age + ending)
        wanted = wanted | listed
    kept = lines.where(wanted)
    text = F.col("value")
    header = text.startswith("#") & text.rlike(_CATEGORY)
    marked = mark_first(kept, {"_category": (header, strip(F.regexp_extract(text, _CATEGORY, 1)))})
    entries = marked.where((text != "") & ~text.startswith("#")).select(
        *POSITION,
        text.alias("_raw"),
        ip.cidr_text(text).alias("ip"),
        stem(file_name(marked)).alias("ipset"),
        blank_to_null(F.col("_category.value")).alias("category"),
    )
    staged = once(entries, _addr=ip.cidr_address(F.col("ip")), _len=ip.written_length(F.col("ip")))
    staged = once(staged, _bits=ip.bits(F.col("_addr")))
    legal = ip.is_network(F.col("_bits"), F.col("_len"))
    return staged.withColumn("_error", first_error((legal, "bad network"))).drop("_addr", "_bits", "_len")


def shape(parsed: DataFrame, seen=None, **_) -> DataFrame:
    """One row per network with the sets of lists and categories that hold it.

    Both sets are bounded by the number of lists, and partial sets combine before
    the shuffle, so a network on every list is no hot group.
    """
    nets = good_rows(parsed).groupBy("ip").agg(
        F.array_sort(F.collect_set("ipset")).alias("ipsets"),
        F.array_sort(F.collect_set("category")).alias("categories"),
    )
    return typed(nets.withColumn("seen", times.as_instant(seen)), BLOCKLIST)


BLOCKLISTS = register_source(
    Source("blocklists", BLOCKLIST, parse, line_reader("*.{ipset,netset}"), shape, REPLACE, ("ip",), streaming=False)
)

"""Query predicates over documents; each gives a boolean column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from netsift.functions import ip, times
from netsift.functions.text import has_word

# Longer values are not found by exact match.
EXACT_LIMIT = 256


def exact(c: Column, value: str | Column) -> Column:
    return (F.length(c) <= EXACT_LIMIT) & (c == value)


def has_terms(c: Column, words: Sequence[str], every: bool = False, lowered: bool = False) -> Column:
    """Full-text match on any of the words, or on all of them; ``lowered`` says that ``c`` is in lower case."""
    found = [has_word(c if lowered else F.lower(c), w) for w in words]
    return reduce(and_ if every else or_, found)


def in_range(bits: Column, first: str, last: str) -> Column:
    """Address bits between two addresses, both included."""
    low, high = ip.sort_key(ip.bits(F.lit(first))), ip.sort_key(ip.bits(F.lit(last)))
    return ip.sort_key(bits).between(low, high)


def in_network(bits: Column, cidr: str) -> Column:
    """Address bits inside one network of the same family; ``bits`` is a stored or staged column."""
    address, _, length = cidr.partition("/")
    whole = 128 if ":" in address else 32
    wide = int(length or whole) + (128 - whole)
    net = ip.network(ip.bits(F.lit(address)), F.lit(wide))
    own = ip.network(bits, F.lit(wide))
    same_family = ip.is_mapped_v4(bits) == F.lit(":" not in address)
    return same_family & (own["hi"] == net["hi"]) & (own["lo"] == net["lo"])


def in_period(c: Column, start, end) -> Column:
    """Instant at or after ``start`` and before ``end``; reaches the scan as a pushed filter."""
    return (c >= times.as_instant(start)) & (c < times.as_instant(end))


def any_record(records: Column, kind: str, test) -> Column:
    """True when ``test`` holds for any record of a type in a zone document."""
    return F.coalesce(F.exists(records[kind], test), F.lit(False))

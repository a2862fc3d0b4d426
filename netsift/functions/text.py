"""Text expressions: stripping, splitting, file names, sizes."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space in scan logs, one by one and as regex ranges.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_UNUSUAL = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Runs that are not a single blank already; clean text has no match and is left alone.
_UNTIDY_RUN = f"(?: [ {_UNUSUAL}]|[{_UNUSUAL}])[ {_UNUSUAL}]*"

# Words of printable ASCII with single blanks between: most text, told by one pass that never goes back.
_TIDY = r"\A[!-~]++(?: [!-~]++)*+\z"

# Size units, each 1024 times the one before.
SIZE_UNITS = ("bytes", "kb", "mb", "gb", "tb", "pb", "eb", "zb")


def strip(c: Column) -> Column:
    """Drop leading and trailing white space."""
    return F.trim(c, F.lit(WHITESPACE))


def _tidied(c: Column) -> Column:
    """Every run of white space as one blank; the regex sees only text that may hold an untidy run."""
    return F.when(c.rlike(_TIDY), c).otherwise(F.regexp_replace(c, _UNTIDY_RUN, " "))


def squeeze(c: Column) -> Column:
    """Collapse every run of white space to one blank."""
    return _tidied(strip(c))


def fields(c: Column, limit: int = -1) -> Column:
    """Split stripped text on runs of white space; with ``limit`` the last field is the rest, joined by single blanks.

    Splitting tidied text on one literal blank spares a regex compiled per row.
    """
    return F.split(_tidied(c), " ", limit)


def drop_dots(c: Column) -> Column:
    """Drop all trailing dots."""
    return F.rtrim(c, F.lit("."))


def digits_only(c: Column) -> Column:
    return c.rlike(r"\A[0-9]+\z")


def blank_to_null(c: Column, *markers: str) -> Column:
    """Null for the empty string and for each marker."""
    return F.when(~c.isin("", *markers), c)


def bare_domain(c: Column) -> Column:
    """Drop one leading ``*.``."""
    return F.when(c.startswith("*."), F.substring(c, 3, 2147483647)).otherwise(c)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def zone_of_file(name: Column) -> Column:
    """``com.eu.txt`` -> ``com.eu``; a name without an extension gives ''."""
    return F.regexp_extract(name, r"\A(.*)\.[^.]*\z", 1)


def stem(name: Column) -> Column:
    """File name without its last extension; a name without one stays whole."""
    return F.regexp_replace(name, r"(?<=.)\.[^.]*\z", "")


def to_integer(c: Column) -> Column:
    """Number text cut to its whole part; anything else is null."""
    return c.try_cast("double").try_cast("bigint")


def has_word(text: Column, word: str) -> Column:
    """True when lower-case ``text`` has ``word`` as a whole word.

    The plain search rules out most texts before the regex looks at word ends.
    """
    escaped = re.sub(r"([^\w])", r"\\\1", word.lower())
    edge = r"[\p{L}\p{N}]"
    return text.contains(word.lower()) & text.rlike(f"(?<!{edge}){escaped}(?!{edge})")


def human_size(n: Column) -> Column:
    """Byte count with a unit, one decimal: 1536 -> ``1.5kb``."""
    n = n.cast("double")
    steps = [n / float(1024**i) for i in range(len(SIZE_UNITS))]
    text = [F.format_string("%.1f" + unit, F.bround(v, 1)) for v, unit in zip(steps, SIZE_UNITS)]
    chain = F.when(F.abs(steps[0]) < 1024, text[0])
    for v, t in zip(steps[1:], text[1:]):
        chain = chain.when(F.abs(v) < 1024, t)
    return chain.otherwise(F.format_string("%.1fYB", F.bround(n / float(1024 ** len(SIZE_UNITS)), 1)))

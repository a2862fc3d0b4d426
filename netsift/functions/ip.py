"""IP address expressions for both families.

An address becomes two 64-bit words (``hi``, ``lo``) of its 128-bit form, v4
mapped to ``::ffff:a.b.c.d``, so one set of joins and ranges serves both. Words
are raw bits; ``sort_key`` flips the sign bits so that they compare unsigned.
No higher-order function is used, which keeps these inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions.staging import once

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_V4 = rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z"
_H = "[0-9a-fA-F]{1,4}"
_V6_FORMS = [f"(?:{_H}:){{7}}{_H}", f"::(?:{_H}(?::{_H}){{0,6}})?", f"{_H}(?::{_H}){{6}}::"]
_V6_FORMS += [f"{_H}(?::{_H}){{{i - 1}}}::(?:{_H}(?::{_H}){{0,{6 - i}}})?" for i in range(1, 7)]
_V6 = rf"\A(?:{'|'.join(_V6_FORMS)})\z"
V4_MAX = 4294967295
_V4_PREFIX = 281470681743360  # ::ffff:0:0 in the low word
_SIGN = -9223372036854775808


def _long(v: int) -> Column:
    return F.lit(v).cast("bigint")


def _shl(c: Column, n: Column) -> Column:
    return F.call_function("shiftleft", c, n)


def is_ipv4(c: Column) -> Column:
    """Four decimal octets, no leading zeros."""
    return c.rlike(_V4)


def _dotted(c: Column) -> Column:
    n = _long(0)
    for i in range(1, 5):
        octet = F.substring_index(F.substring_index(c, ".", i), ".", -1)
        n = n * 256 + octet.try_cast("bigint")
    return n


def ipv4_to_long(c: Column) -> Column:
    return F.when(is_ipv4(c), _dotted(c))


def long_to_ipv4(n: Column) -> Column:
    return F.concat_ws(".", *[(F.shiftright(n, s).bitwiseAND(_long(255))).cast("string") for s in (24, 16, 8, 0)])


def ipv4_block_end(start: Column, count: Column) -> Column:
    """Last address of ``count`` addresses from ``start``; null past 255.255.255.255."""
    last = ipv4_to_long(start) + count - 1
    return F.when(last.between(_long(0), _long(V4_MAX)), long_to_ipv4(last))


def is_ipv6(c: Column) -> Column:
    """Plain hextet spellings; the mixed form with a dotted tail is not taken."""
    return c.rlike(_V6)


def is_address(c: Column) -> Column:
    return is_ipv4(c) | is_ipv6(c)


def _padded_hex(side: Column) -> Column:
    """Hextets -> four digits each, no colons."""
    wide = F.regexp_replace(F.lower(side), "([0-9a-f]+)", "000$1")
    return F.regexp_replace(wide, r"0*([0-9a-f]{4})(?::|\z)", "$1")


def _hex32(c: Column) -> Column:
    right = _padded_hex(F.split_part(c, F.lit("::"), F.lit(2)))
    left = _padded_hex(F.split_part(c, F.lit("::"), F.lit(1)))
    return F.concat(F.rpad(left, 32 - F.length(right), "0"), right)


def _word(hex32: Column, start: int) -> Column:
    return F.conv(F.substring(hex32, start, 16), 16, -10).cast("bigint")


def bits(c: Column) -> Column:
    """Address text -> struct(hi, lo) of raw bits; null for anything that is not an address.

    Give it a plain column and store the result as a column: the tree is large.
    """
    h = _hex32(c)
    six = F.struct(_word(h, 1).alias("hi"), _word(h, 17).alias("lo"))
    four = F.struct(_long(0).alias("hi"), _dotted(c).bitwiseOR(_long(_V4_PREFIX)).alias("lo"))
    return F.when(is_ipv4(c), four).when(is_ipv6(c), six)


def sort_key(b: Column) -> Column:
    """Raw bits -> struct that sorts in address order."""
    return F.struct(
        b["hi"].bitwiseXOR(_long(_SIGN)).alias("hi"),
        b["lo"].bitwiseXOR(_long(_SIGN)).alias("lo"),
    )


def _mask_words(length: Column) -> tuple[Column, Column]:
    high = F.when(length >= 64, _long(-1)).when(length <= 0, _long(0)).otherwise(_shl(_long(-1), 64 - length))
    low = F.when(length >= 128, _long(-1)).when(length <= 64, _long(0)).otherwise(_shl(_long(-1), 128 - length))
    return high, low


def network(b: Column, length: Column) -> Column:
    """First address of the ``length``-bit prefix (0..128) that holds ``b``."""
    high, low = _mask_words(length)
    return F.struct(b["hi"].bitwiseAND(high).alias("hi"), b["lo"].bitwiseAND(low).alias("lo"))


def last_in_network(b: Column, length: Column) -> Column:
    high, low = _mask_words(length)
    return F.struct(
        b["hi"].bitwiseOR(F.bitwise_not(high)).alias("hi"),
        b["lo"].bitwiseOR(F.bitwise_not(low)).alias("lo"),
    )


def _compress(text: Column) -> Column:
    """Shorten the longest run of two or more zero groups, the leftmost on a tie.

    Longest runs are tried first; once a ``::`` stands, later patterns fail.
    """
    for run in range(8, 1, -1):
        pattern = rf"\A(?!.*::)(.*?)(?:\A|:)0(?::0){{{run - 1}}}(?::|\z)(.*)\z"
        text = F.regexp_replace(text, pattern, "$1::$2")
    return text


def ipv6_text(b: Column) -> Column:
    """Raw bits -> shortest lower-case v6 text."""
    digits = F.concat(F.lpad(F.hex(b["hi"]), 16, "0"), F.lpad(F.hex(b["lo"]), 16, "0"))
    groups = F.regexp_replace(F.lower(digits), r"(.{4})(?!\z)", "$1:")
    return _compress(F.regexp_replace(groups, r"(?<![0-9a-f])0{1,3}(?=[0-9a-f])", ""))


def is_mapped_v4(b: Column) -> Column:
    return (b["hi"] == 0) & (F.shiftright(b["lo"], 32) == 65535)


def to_text(b: Column) -> Column:
    """Raw bits -> text; addresses of the mapped range print as v4."""
    v4 = long_to_ipv4(b["lo"].bitwiseAND(_long(V4_MAX)))
    return F.when(is_mapped_v4(b), v4).otherwise(ipv6_text(b))


def prefix_length(cidr: Column) -> Column:
    """Length as written; a bare address counts as a whole-address prefix."""
    whole = F.when(cidr.contains(":"), 128).otherwise(32)
    written = F.split_part(cidr, F.lit("/"), F.lit(2))
    return F.when(~cidr.contains("/"), whole).when(
        written.rlike(r"\A[0-9]{1,3}\z") & (written.try_cast("int") <= whole), written.try_cast("int")
    )


def cidr_text(c: Column) -> Column:
    """Add the whole-address length to a bare address: /32, or /128 for v6."""
    return F.when(c.contains("/"), c).when(c.contains(":"), F.concat(c, F.lit("/128"))).otherwise(
        F.concat(c, F.lit("/32"))
    )


def cidr_address(c: Column) -> Column:
    return F.split_part(c, F.lit("/"), F.lit(1))


def mapped_length(cidr: Column) -> Column:
    """Prefix length in the 128-bit form: a v4 /24 has 120. Null when illegal."""
    return F.when(~cidr.contains(":"), prefix_length(cidr) + 96).otherwise(prefix_length(cidr))


def written_length(cidr: Column) -> Column:
    """``mapped_length`` for text with at most one slash, else null."""
    return F.when(F.size(F.split(cidr, "/")) <= 2, mapped_length(cidr))


def is_network(b: Column, length: Column) -> Column:
    """True for a legal prefix without host bits."""
    lo = network(b, length)
    return b.isNotNull() & length.isNotNull() & (lo["hi"] == b["hi"]) & (lo["lo"] == b["lo"])


def network_range(b: Column, length: Column, strict: bool = True) -> Column:
    """struct(lo, hi, len) of the prefix; null when illegal or, if ``strict``, host bits are set."""
    lo = network(b, length)
    ok = b.isNotNull() & length.isNotNull()
    if strict:
        ok = ok & (lo["hi"] == b["hi"]) & (lo["lo"] == b["lo"])
    return F.when(ok, F.struct(lo.alias("lo"), last_in_network(b, length).alias("hi"), length.alias("len")))


def with_network(df: DataFrame, cidr: str, out: str, strict: bool = True) -> DataFrame:
    """Add ``out`` = struct(lo, hi: raw bits, len) of a CIDR column; null when illegal."""
    staged = once(df, _addr=cidr_address(F.col(cidr)), _len=written_length(F.col(cidr)))
    staged = once(staged, _bits=bits(F.col("_addr")))
    ranged = once(staged, **{out: network_range(F.col("_bits"), F.col("_len"), strict)})
    return ranged.drop("_addr", "_bits", "_len")


def ipv6_block_end(b: Column, length: Column) -> Column:
    """Last address of a strict v6 network as text; null when illegal."""
    first = network(b, length)
    ok = length.between(0, 128) & (first["hi"] == b["hi"]) & (first["lo"] == b["lo"])
    return F.when(ok, ipv6_text(last_in_network(b, length)))


def plain_octets(c: Column) -> Column:
    """Drop leading zeros of dotted octets: ``094.031.064.000`` -> ``94.31.64.0``."""
    return F.regexp_replace(c, r"(?<![0-9])0+(?=[0-9])", "")


def repaired(c: Column) -> Column:
    """The address as is when legal, else with plain octets when that is legal, else null."""
    fixed = plain_octets(c)
    return F.when(is_address(c), c).when(is_ipv4(fixed), fixed)


def _reversed_labels(c: Column) -> Column:
    return F.array_join(F.reverse(F.split(c, r"\.")), ".")


def from_reverse_name(name: Column) -> Column:
    """``7.6.5.4.in-addr.arpa`` -> ``4.5.6.7``."""
    return _reversed_labels(F.replace(name, F.lit(".in-addr.arpa"), F.lit("")))


def to_reverse_name(ip: Column) -> Column:
    """``4.5.6.7`` -> ``7.6.5.4.in-addr.arpa``."""
    return F.concat(_reversed_labels(ip), F.lit(".in-addr.arpa"))

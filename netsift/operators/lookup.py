"""Lookups of addresses in tables of networks or ranges, as equi-joins."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netsift.functions import ip
from netsift.functions.staging import once
from netsift.operators.skew import HOT_ROWS, MAX_BROADCAST_ROWS, is_small, join_lookup, salted_join, settled

# Titles that say nothing about a service.
NOISE_TITLES = (
    "301 Moved Permanently", "400 Bad Request", "403 Access Denied", "403 Forbidden", "404 Not Found",
    "408 Request Timeout", "408 Timeout", "500 Internal Server Error", "Access Denied", "Application Server Error",
    "Bad Request", "Bad Request (400)", "Invalid URL", "Error", "ERROR: The request could not be satisfied",
    "Fastly error: unknown domain", "HTTP 400", "Request Timeout", "Server Error", "Service Unavailable",
    "Welcome to nginx!", "Welcome to nginx on Debian!",
)


_WORD = Decimal(2**64)


def is_noise(service: Column, banner: Column) -> Column:
    """A ``title`` banner that is on the noise list."""
    return F.coalesce((service == "title") & banner.isin(*NOISE_TITLES), F.lit(False))


def without_noise(scans: DataFrame) -> DataFrame:
    return scans.where(~is_noise(F.col("service"), F.col("banner")))


def distinct_addresses(df: DataFrame, address: str) -> DataFrame:
    """Each legal address once, with its bits: lookups then cost per address, not per row.

    A hot address is one row here, and the aggregate combines before the shuffle.
    """
    each = df.where(F.col(address).isNotNull()).groupBy(F.col(address).alias("_ip")).agg(F.count(F.lit(1)).alias("_n"))
    return once(each, _b=ip.bits(F.col("_ip"))).where(F.col("_b").isNotNull())


def network_matches(
    addresses: DataFrame, networks: DataFrame, cidr: str, max_rows: int = MAX_BROADCAST_ROWS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows (_ip, _len, network columns), one per network that holds the address.

    Each address is masked once per prefix length that occurs in its own family (162 in
    all at most) and meets the networks by equality; v4 addresses lie in v4 networks only.
    ``networks`` has one row per network.
    """
    nets = ip.with_network(networks, cidr, "_net", strict=False).where(F.col("_net").isNotNull())
    nets = nets.select(
        "*", F.col("_net.len").alias("_len"), F.col("_net.lo.hi").alias("_hi"), F.col("_net.lo.lo").alias("_lo"),
        ip.is_mapped_v4(F.col("_net.lo")).alias("_v4"),
    ).drop("_net")
    return _met(addresses, nets, max_rows, hot_rows)


def _met(addresses: DataFrame, nets: DataFrame, max_rows: int, hot_rows: int) -> DataFrame:
    """Addresses with each of the networks (_v4, _len, _hi, _lo, other columns) that hold them."""
    lengths = nets.agg(F.collect_set(F.struct("_v4", "_len"))).scalar()
    masked = addresses.withColumn("_v4", ip.is_mapped_v4(F.col("_b"))).withColumn("_lens", lengths)
    own = F.filter("_lens", lambda x: x["_v4"] == F.col("_v4"))
    masked = masked.withColumn("_len", F.explode(F.transform(own, lambda x: x["_len"])))
    masked = once(masked, _m=ip.network(F.col("_b"), F.col("_len")))
    keyed = masked.select("_ip", "_v4", "_len", F.col("_m.hi").alias("_hi"), F.col("_m.lo").alias("_lo"))
    return join_lookup(keyed, nets, ["_v4", "_len", "_hi", "_lo"], "inner", hot_rows, max_rows).drop("_v4", "_hi", "_lo")


def attach(
    df: DataFrame, address: str, results: DataFrame, how: str,
    max_rows: int = MAX_BROADCAST_ROWS, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join per-address results back to the rows.

    The results are computed once; if few, they are broadcast and the rows are never
    shuffled, else the join is salted.
    """
    kept = settled(results).withColumnRenamed("_ip", address)
    return join_lookup(df, kept, [address], how, hot_rows, max_rows)


def inside_networks(df: DataFrame, address: str, networks: DataFrame, cidr: str, negate: bool = False, **sizes) -> DataFrame:
    """Rows whose address lies in any of the networks, or with ``negate`` in none.

    A row without a legal address lies in none.
    """
    hits = network_matches(distinct_addresses(df, address), networks.select(cidr).distinct(), cidr, **sizes)
    return attach(df, address, hits.select("_ip").distinct(), "left_anti" if negate else "left_semi", **sizes)


def longest_match(df: DataFrame, address: str, networks: DataFrame, cidr: str, out: str = "network", **sizes) -> DataFrame:
    """Add ``out``: the columns of the longest network that holds the address, else null."""
    columns = F.struct(*[F.col(c) for c in networks.columns])
    hits = network_matches(distinct_addresses(df, address), networks, cidr, **sizes)
    best = hits.groupBy("_ip").agg(F.max_by(columns, "_len").alias(out))
    return attach(df, address, best, "left", **sizes)


def _bucket(b: Column) -> Column:
    """Coarse position of an address: the top 16 bits of v4, the top 20 of v6."""
    v4 = F.shiftright(b["lo"], 16).bitwiseAND(F.lit(65535).cast("bigint"))
    v6 = F.shiftrightunsigned(b["hi"], 44) + 65536
    return F.when(ip.is_mapped_v4(b), v4).otherwise(v6)


def _unsigned(word: Column) -> Column:
    """A 64-bit word as a decimal number from 0 to 2**64 - 1."""
    number = word.cast("decimal(20,0)")
    return F.when(word < 0, number + F.lit(_WORD)).otherwise(number)


def _signed(number: Column) -> Column:
    return F.when(number >= F.lit(Decimal(2**63)), number - F.lit(_WORD)).otherwise(number).cast("bigint")


def _aligned(first: Column, last: Column) -> Column:
    """The aligned blocks of powers of two that make up first..last, as array<struct(bits, start)>; none if first > last.

    On each level a block stands alone at the left end, at the right end, at both or at none.
    """
    def level(size: Column, k: Column) -> Column:
        # whole blocks of this size lie from left to right (not included)
        rest, over = first % size, (last + 1) % size
        left = F.when(rest == 0, first).otherwise(first - rest + size)
        right = last + 1 - over
        odd = lambda at: at % (size + size) != 0
        block = lambda at: F.struct(k.alias("bits"), at.cast("decimal(20,0)").alias("start"))
        both = F.array(F.when((left < right) & odd(left), block(left)), F.when((left < right) & odd(right), block(right - size)))
        return F.filter(both, lambda x: x.isNotNull())

    sizes = F.array(*[F.lit(Decimal(2**k)).cast("decimal(21,0)") for k in range(65)])
    levels = F.flatten(F.transform(sizes, level))
    return F.when(first <= last, levels).otherwise(F.array().cast("array<struct<bits:int,start:decimal(20,0)>>"))


def _blocks(ranges: DataFrame) -> DataFrame:
    """Each range once per prefix that it is made up of: ``_len``, ``_hi``, ``_lo``.

    A range has two blocks per prefix length at most, and one or two in all if it is a network or nearly so.
    """
    words = {f"_{w}{n}": _unsigned(F.col(f"_{side}.{n}")) for w, side in (("f", "from"), ("t", "to")) for n in ("hi", "lo")}
    staged = once(ranges, **words)
    f_hi, f_lo, t_hi, t_lo = (F.col(c) for c in ("_fhi", "_flo", "_thi", "_tlo"))
    top = F.lit(_WORD - 1)
    same = f_hi == t_hi
    # what lies in the first and the last upper word, and the upper words wholly inside
    whole_first, whole_last = ~same & (f_lo == 0), ~same & (t_lo == top)
    inside = _aligned(f_hi + F.when(whole_first, 0).otherwise(1), t_hi - F.when(whole_last, 0).otherwise(1))
    low = lambda hi, first, last: F.transform(
        _aligned(first, last), lambda x: F.struct((128 - x["bits"]).alias("len"), hi.alias("hi"), _signed(x["start"]).alias("lo")))
    nothing = F.array().cast("array<struct<len:int,hi:bigint,lo:bigint>>")
    pieces = F.flatten(F.array(
        F.when(whole_first, nothing).otherwise(low(F.col("_from.hi"), f_lo, F.when(same, t_lo).otherwise(top))),
        F.when(same | whole_last, nothing).otherwise(low(F.col("_to.hi"), F.lit(Decimal(0)), t_lo)),
        F.when(same, nothing).otherwise(F.transform(inside, lambda x: F.struct((64 - x["bits"]).alias("len"), _signed(x["start"]).alias("hi"), F.lit(0).cast("bigint").alias("lo")))),
    ))
    return staged.select(*ranges.columns, F.explode(pieces).alias("_b")).select(*ranges.columns, F.col("_b.len").alias("_len"), F.col("_b.hi").alias("_hi"), F.col("_b.lo").alias("_lo"))


def _overlap(bucketed: DataFrame) -> bool:
    """Whether ranges of the same bucket overlap."""
    earlier = Window.partitionBy("_bucket").orderBy("_low", "_high").rowsBetween(Window.unboundedPreceding, -1)
    return not bucketed.withColumn("_reach", F.max("_high").over(earlier)).where(F.col("_reach") >= F.col("_low")).isEmpty()


def range_lookup(
    df: DataFrame, address: str, ranges: DataFrame, start: str, end: str, out: str,
    max_rows: int = MAX_BROADCAST_ROWS, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``out``: the columns of the narrowest range that holds the address, else null.

    Ranges are inclusive and may nest, cross and repeat; of equally wide ones the first counts,
    of the same one the least as JSON. Few ranges without overlaps are placed in address
    buckets and broadcast straight to the rows, which are not shuffled. Others are cut
    into prefixes; of the ranges that share a prefix only the narrowest is kept, so each distinct
    address meets one range per prefix length in use, however many overlap.
    """
    columns = F.struct(*[F.col(c) for c in ranges.columns if c not in (start, end)])
    parsed = once(ranges.withColumn(out, columns), _from=ip.bits(F.col(start)), _to=ip.bits(F.col(end)))
    keys = once(parsed, _low=ip.sort_key(F.col("_from")), _high=ip.sort_key(F.col("_to")))
    same_family = ip.is_mapped_v4(F.col("_from")) == ip.is_mapped_v4(F.col("_to"))
    legal = keys.where(F.col("_from").isNotNull() & F.col("_to").isNotNull() & same_family & (F.col("_low") <= F.col("_high")))
    legal = legal.select(out, "_from", "_to", "_low", "_high")
    within = F.col("_key").between(F.col("_low"), F.col("_high"))
    if is_small(legal, max_rows):
        buckets = F.explode(F.sequence(_bucket(F.col("_from")), _bucket(F.col("_to"))))
        bucketed = legal.select(out, "_low", "_high", buckets.alias("_bucket"))
        if is_small(bucketed, max_rows) and not _overlap(bucketed):
            rows = once(df, _b=ip.bits(F.col(address)))
            rows = once(rows, _at=_bucket(F.col("_b")), _key=ip.sort_key(F.col("_b")))
            met = rows.join(F.broadcast(bucketed), (F.col("_at") == F.col("_bucket")) & within, "left")
            return met.select(*df.columns, out)
    blocks = _blocks(legal.withColumn("_wide", _width(F.col("_from"), F.col("_to"))))
    rank = F.struct("_wide.hi", "_wide.lo", "_low", F.to_json(out))
    kept = blocks.withColumn("_rank", rank).groupBy("_len", "_hi", "_lo").agg(
        F.min("_rank").alias("_rank"), F.min_by(out, "_rank").alias(out), F.first(ip.is_mapped_v4(F.col("_from"))).alias("_v4")
    )
    # counted, asked for its prefix lengths and joined: cut once
    met = _met(distinct_addresses(df, address).drop("_n"), settled(kept), max_rows, hot_rows)
    found = met.groupBy("_ip").agg(F.min_by(out, "_rank").alias(out))
    return attach(df, address, found, "left", max_rows, hot_rows)


def _width(first: Column, last: Column) -> Column:
    """How far ``last`` is from ``first``, as struct(hi, lo) of unsigned words."""
    low = _unsigned(last["lo"]) - _unsigned(first["lo"])
    borrow = F.when(low < 0, 1).otherwise(0)
    high = _unsigned(last["hi"]) - _unsigned(first["hi"]) - borrow
    return F.struct(high.cast("decimal(21,0)").alias("hi"), (low + borrow * F.lit(_WORD)).cast("decimal(21,0)").alias("lo"))

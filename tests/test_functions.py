"""Expressions against the Python standard library, on seeded random input."""

import datetime as dt
import ipaddress
import random

from pyspark.sql import functions as F

from netsift.functions import ip, text, times


def values(spark, items, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, v string")
    df = ip.with_network(df.withColumn("b", ip.bits(F.col("v"))), "v", "r")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def v6_spellings(rng, n):
    for _ in range(n):
        groups = [rng.choice([0, 0, 0, rng.randrange(65536), rng.randrange(16)]) for _ in range(8)]
        addr = ipaddress.IPv6Address(b"".join(g.to_bytes(2, "big") for g in groups))
        yield rng.choice([addr.compressed, addr.exploded, addr.compressed.upper(), ":".join(f"{g:x}" for g in groups)])


def test_v6_text_and_bits(spark):
    rng = random.Random(7)
    items = list(v6_spellings(rng, 600)) + ["::", "::1", "1::", "fe80::1:0:0:1", "1:2:3:4:5:6:7::"]
    b = F.col("b")
    for item, (hi, lo, shown) in zip(items, values(spark, items, b["hi"], b["lo"], ip.ipv6_text(b))):
        n = int(ipaddress.IPv6Address(item))
        assert ((hi % 2**64) << 64 | lo % 2**64) == n
        if not ipaddress.IPv6Address(item).ipv4_mapped:
            assert shown == ipaddress.IPv6Address(item).compressed


def test_illegal_addresses(spark):
    items = ["", "1.2.3", "1.2.3.256", "01.2.3.4", "1.2.3.4\n", "1:2:3:4:5:6:7", "1::2::3", ":::", "1:2:3:4:5:6:7:8::",
             "g::", "12345::", ":1:2:3:4:5:6:7", "1.2.3.4.5", "a.b.c.d", "1:2:3:4:5:6:7:8:9", "::1.2.3.256"]
    assert [r[0] for r in values(spark, items, F.col("b").isNull())] == [True] * len(items)
    assert values(spark, ["::ffff:102:304", "1.2.3.4"], ip.to_text(F.col("b"))) == [("1.2.3.4",)] * 2


def test_networks(spark):
    rng = random.Random(11)
    items = []
    for _ in range(300):
        if rng.random() < 0.5:
            a, n = ipaddress.IPv4Address(rng.randrange(2**32)), rng.randrange(33)
        else:
            a, n = ipaddress.IPv6Address(rng.randrange(2**128)), rng.randrange(129)
        items.append(f"{a}/{n}")
        items.append(str(ipaddress.ip_network(f"{a}/{n}", strict=False)))
    items += ["192.0.2.1", "2001:db8::1", "192.0.2.0/33", "192.0.2.0/x", "192.0.2.0/", "1.2.3.4/32/1"]
    r = F.col("r")
    got = values(spark, items, ip.to_text(r["lo"]), ip.to_text(r["hi"]), r["len"])
    for item, (lo, hi, length) in zip(items, got):
        try:
            net = ipaddress.ip_network(item, strict=True)
        except ValueError:
            assert lo is None and length is None, item
            continue
        assert ipaddress.ip_address(lo) == net[0] and ipaddress.ip_address(hi) == net[-1], item
        assert length == net.prefixlen + (96 if net.version == 4 else 0)


def test_sort_key_orders_addresses(spark):
    rng = random.Random(5)
    items = [str(ipaddress.IPv6Address(rng.randrange(2**128))) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in items], "v string")
    got = [r.v for r in df.orderBy(ip.sort_key(ip.bits(F.col("v")))).collect()]
    assert got == sorted(items, key=lambda a: int(ipaddress.ip_address(a)))


def test_blocks_and_reverse_names(spark):
    v = F.col("v")
    assert values(spark, ["76.15.132.0", "255.255.255.0"], ip.ipv4_block_end(v, F.lit(1024))) == [("76.15.135.255",), (None,)]
    assert values(spark, ["2001:db8::", "2001:db8::1"], ip.ipv6_block_end(F.col("b"), F.lit(32))) == [
        ("2001:db8:ffff:ffff:ffff:ffff:ffff:ffff",), (None,)]
    assert values(spark, ["7.6.5.4.in-addr.arpa"], ip.from_reverse_name(v)) == [("4.5.6.7",)]
    assert values(spark, ["4.5.6.7"], ip.to_reverse_name(v)) == [("7.6.5.4.in-addr.arpa",)]
    assert values(spark, ["094.031.064.000", "94.31.64.0", "2001:DB8::", "1.2.3.x", "000.0.0.300"], ip.repaired(v)) == [
        ("94.31.64.0",), ("94.31.64.0",), ("2001:DB8::",), (None,), (None,)]


def test_text(spark):
    v = F.col("v")
    odd = ["  a \t b  c \n", "", "x", "\x1c y "]
    assert [r[0] for r in values(spark, odd, text.strip(v))] == [s.strip() for s in odd]
    assert [r[0] for r in values(spark, odd, text.squeeze(v))] == [" ".join(s.split()) for s in odd]
    assert values(spark, ["a b  c \td", "a b"], text.fields(v, 3)) == [(["a", "b", "c d"],), (["a", "b"],)]
    words = text.has_word(F.lower("v"), "Cat")
    assert [r[0] for r in values(spark, ["a Cat.", "concat", "cats", "xcat cat", "cat"], words)] == [
        True, False, False, True, True]
    assert values(spark, ["a...", "."], text.drop_dots(v)) == [("a",), ("",)]
    assert values(spark, ["com.eu.txt", "zone"], text.zone_of_file(v), text.stem(v)) == [("com.eu", "com.eu"), ("", "zone")]
    assert values(spark, ["*.x.y", "*.*.z", "x"], text.bare_domain(v)) == [("x.y",), ("*.z",), ("x",)]
    assert values(spark, ["12.9", "-3.7", "x", "inf", "nan", "1e3"], text.to_integer(v)) == [
        (12,), (-3,), (None,), (None,), (None,), (1000,)]


def test_human_size(spark):
    def expected(n):
        for unit in text.SIZE_UNITS:
            if abs(n) < 1024.0:
                return f"{n:3.1f}{unit}"
            n /= 1024.0
        return f"{n:.1f}YB"

    items = [0, 1, 1023, 1024, 1280, 1792, 1536, 10**6, 123456789, 10**12, 10**15, 10**18, 2**62]
    got = values(spark, [str(n) for n in items], text.human_size(F.col("v").cast("bigint")))
    assert [r[0] for r in got] == [expected(n) for n in items]


def test_times(spark):
    v = F.col("v")
    rng = random.Random(3)
    secs = [0, 1705255468] + [rng.randrange(4 * 10**9) for _ in range(100)]
    got = values(spark, [str(s) for s in secs], times.iso(times.from_epoch(v)))
    assert [r[0] for r in got] == [dt.datetime.fromtimestamp(s, dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ") for s in secs]
    forms = ["2017-09-15 19:00:00.123+0300", "2017-09-15 19:00:00Z", "2017-09-15 19:00:00", "2017-09-15T19:00:00Z",
             "2017-09-15 19:00:00.5", "2017-13-15 19:00:00"]
    assert [r[0] for r in values(spark, forms, times.transfer_date(v))] == [
        "2017-09-15T19:00:00Z"] * 4 + forms[4:]
    assert values(spark, forms[:2], times.transfer_date(v, utc=True)) == [("2017-09-15T16:00:00Z",), ("2017-09-15T19:00:00Z",)]
    licence = ["01/02/2020 00:00:00", " 1/2/2020 3:4:5 ", "2020-01-02", "0000-00-00", "junk", "", "2020-02-30"]
    assert [r[0] for r in values(spark, licence, times.iso(times.licence_date(v)))] == [
        "2020-01-02T00:00:00Z", "2020-01-02T03:04:05Z", "2020-01-02T00:00:00Z", None, None, None, None]
    probe = ["2024-01-14T13:08:15.117348474-05:00", "2024-01-14T13:08:15-05:00", "2024-01-14T13:08:15Z"]
    assert [r[0] for r in values(spark, probe, times.probe_time(v))] == ["2024-01-14T13:08:15Z"] * 3
    assert [r[0] for r in values(spark, probe, times.probe_time(v, utc=True))] == [
        "2024-01-14T18:08:15Z"] * 2 + ["2024-01-14T13:08:15Z"]
    assert values(spark, ["20070502", "20070231", "2007"], times.iso(times.compact_date(v))) == [
        ("2007-05-02T00:00:00Z",), (None,), (None,)]
    assert values(spark, ["x"], times.iso(times.as_instant("2024-01-02T03:04:05Z"))) == [("2024-01-02T03:04:05Z",)]
    shown = values(spark, ["x"], times.iso(times.now_utc()))[0][0]
    assert abs(dt.datetime.fromisoformat(shown) - dt.datetime.now(dt.UTC)) < dt.timedelta(minutes=5)


def test_fields_of_tidy_and_untidy_text(spark):
    """Tidy text is told by one pattern; what it does not tell goes through the regex as before."""
    v = F.col("v")
    odd = ["a b  c", "a\tb c", "a b\x1cc d", "　a b", "a b c", "", " ", "a", "a b c d", "ä b c", " a", "x " * 50_000 + "y", "a b\n", None]
    plain = F.split(F.regexp_replace(v, text._UNTIDY_RUN, " "), " ", 3)
    for row in spark.createDataFrame([(o,) for o in odd], "v string").select("v", text.fields(v, 3).alias("a"), plain.alias("b")).collect():
        assert row.a == row.b, row.v
    tidy = [r[0] for r in values(spark, ["1.0.0.10.in-addr.arpa. PTR a.b.", "a  b", "ä", "a "], v.rlike(text._TIDY))]
    assert tidy == [True, False, False, False]

"""Merging, lookups, predicates, tables and streams; skew paths are forced with tiny limits."""

import ipaddress
import json
import random

import pytest
from pyspark.sql import functions as F

from netsift.functions import ip
from netsift.ingest import RejectedRows, ingest, read_rejects
from netsift.operators import lookup, merging, predicates, skew, tables
from netsift.operators.enrichment import apply_enrichment, register_enrichment
from netsift.sources import get_source, source_names
from netsift.streaming.watch import watch

TINY = {"max_rows": 0, "hot_rows": 5}


def pairs(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_last_writes_per_column(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", {"k": "1", "m": "1"}, 1), ("a", None, "y", {"k": "2"}, 2), ("b", 5, None, None, 1)],
        "key string, n int, s string, m map<string,string>, _order int")
    got = {r.key: r for r in merging.last_writes(df, ["key"], maps=["m"]).collect()}
    assert (got["a"].n, got["a"].s, got["a"].m, got["a"]._order) == (1, "y", {"k": "2", "m": "1"}, 2)
    assert (got["b"].n, got["b"].s, got["b"].m) == (5, None, None)
    whole = {r.key: r for r in merging.last_rows(df, ["key"]).collect()}
    assert whole["a"].n is None and whole["a"].m == {"k": "2"}


def test_upsert_and_replace(spark):
    schema = "key string, n int, l array<string>, m map<string,string>"
    old = spark.createDataFrame([("a", 1, ["x"], {"k": "1", "o": "1"}), ("b", 2, ["y"], None)], schema)
    new = spark.createDataFrame([("a", None, ["z", "x"], {"k": "2"}), ("c", 3, None, {"q": "1"})], schema)
    got = {r.key: tuple(r)[1:] for r in merging.upsert(old, new, ["key"], ["m"]).collect()}
    assert got == {"a": (1, ["z", "x"], {"k": "2", "o": "1"}), "b": (2, ["y"], None), "c": (3, None, {"q": "1"})}
    united = {r.key: r.l for r in merging.upsert(old, new, ["key"], ["m"], array_merge="union").collect()}
    assert united["a"] == ["x", "z"]
    again = merging.upsert(merging.upsert(old, new, ["key"], ["m"]), new, ["key"], ["m"])
    assert {r.key: tuple(r)[1:] for r in again.collect()} == got
    replaced = {r.key: r.n for r in merging.replace_by_key(old, new, ["key"]).collect()}
    assert replaced == {"a": None, "b": 2, "c": 3}


def test_upsert_drops_stale_parts(spark):
    schema = "ip string, record array<string>, part int"
    old = spark.createDataFrame([("a", ["1"], 0), ("a", ["2"], 1), ("b", ["3"], 0), ("b", ["4"], 1)], schema)
    new = spark.createDataFrame([("a", ["9"], 0)], schema)
    assert pairs(merging.upsert(old, new, ["ip", "part"])) == [("a", ["9"], 0), ("b", ["3"], 0), ("b", ["4"], 1)]
    schema = "domain string, records map<string,array<int>>, part int"
    old = spark.createDataFrame([("a", {"ns": [1], "a": [2]}, 0), ("a", {"ns": [3], "a": [4]}, 1)], schema)
    new = spark.createDataFrame([("a", {"ns": [9]}, 0)], schema)
    got = {r.part: r.records for r in merging.upsert(old, new, ["domain", "part"], ["records"]).collect()}
    assert got == {0: {"ns": [9], "a": [2]}, 1: {"a": [4]}}


def test_fold_lists_splits_hot_groups_and_keeps_all(spark):
    df = spark.range(100).select(F.when(F.col("id") < 80, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    rows = skew.fold_lists(df, ["k"], ["id"], F.col("id"), "ids", hot_rows=10).collect()
    assert sorted(x for r in rows for x in r.ids) == list(range(100))
    hot = [r for r in rows if r.k == "hot"]
    assert len(hot) > 1 and all(r.ids == sorted(r.ids) for r in rows) and len(rows) == len(hot) + 20
    assert [x for r in sorted(hot, key=lambda r: r.part) for x in r.ids] == list(range(80))
    assert all(len(r.ids) <= 20 for r in hot)
    heavy = skew.fold_lists(df, ["k"], ["id"], F.col("id"), "ids", hot_rows=10, weight=F.lit(10)).where("k = 'hot'")
    assert heavy.count() == 8


def test_fold_lists_runs_its_input_once(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "r"))
    rows = spark.read.parquet(str(tmp_path / "r"))
    df = rows.groupBy((F.col("id") % 7).alias("k"), "id").agg(F.min("id").alias("first"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # adaptive plans hide the reuse until they run
    try:
        folded = skew.fold_lists(df, ["k"], ["first"], F.col("id"), "ids")
        plan = folded._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    big = spark.range(300).select(F.when(F.col("id") < 200, 1).when(F.col("id") > 205, F.col("id") % 40).alias("k"), "id")
    small = spark.createDataFrame([(k, f"v{k}") for k in range(20)], "k int, v string")
    big = big.withColumn("k", F.col("k").cast("int"))
    assert pairs(skew.salted_join(big, small, ["k"], how, hot_rows=10)) == pairs(big.join(small, ["k"], how))


@pytest.fixture(scope="module")
def addresses(spark):
    rng = random.Random(2)
    items = [f"10.{rng.randrange(4)}.{rng.randrange(4)}.{rng.randrange(8)}" for _ in range(150)]
    items += ["200.1.2.3", "11.0.0.0", "2001:dc0::1", "3fff::", "3fff::1", "2a00::7"]
    items += [f"2001:db8::{rng.randrange(300):x}" for _ in range(50)] + ["10.0.0.1"] * 60 + [None, "x"] * 3
    return items, spark.createDataFrame(list(enumerate(items)), "i int, ip string").repartition(4)


NETS = ["10.0.0.0/16", "10.0.1.0/24", "10.0.1.3/32", "10.2.0.0/15", "2001:db8::/120", "2001:db8::17/128", "::/3"]


def inside(address, nets=NETS):
    try:
        a = ipaddress.ip_address(address)
    except ValueError:
        return []
    found = [n for n in map(ipaddress.ip_network, nets) if a.version == n.version and a in n]
    return [str(n) for n in sorted(found, key=lambda n: n.prefixlen)]


@pytest.mark.parametrize("sizes", [{}, TINY])
def test_network_lookups(spark, addresses, sizes):
    items, df = addresses
    nets = spark.createDataFrame([(n, n[::-1]) for n in NETS], "cidr string, note string")
    hits = {r.i for r in lookup.inside_networks(df, "ip", nets, "cidr", **sizes).collect()}
    assert hits == {i for i, a in enumerate(items) if inside(a, NETS)}
    misses = {r.i for r in lookup.inside_networks(df, "ip", nets, "cidr", negate=True, **sizes).collect()}
    assert misses == set(range(len(items))) - hits
    longest = {r.i: r.network for r in lookup.longest_match(df, "ip", nets, "cidr", **sizes).collect()}
    for i, a in enumerate(items):
        expected = inside(a, NETS)
        assert (longest[i].cidr if longest[i] else None) == (expected[-1] if expected else None)


@pytest.mark.parametrize("sizes", [{}, TINY])
def test_overlapping_ranges_give_the_narrowest_once(spark, sizes):
    rng = random.Random(4)
    at = ipaddress.ip_address
    spans = [("10.0.0.0", "10.255.255.255", "all"), ("10.0.0.0", "10.0.0.255", "net"), ("10.0.0.5", "10.0.0.5", "one"),
             ("0.0.0.0", "255.255.255.255", "v4"), ("::", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "everything"),
             ("2001:db8::", "2001:db8:0:1::", "over"), ("2001:db8::", "2001:db8::ffff:ffff:ffff:ffff", "word"),
             ("2001:db8:0:1::", "2001:db8:0:5:ffff:ffff:ffff:ffff", "words"), ("fe80::1", "fe80::1", "a"), ("fe80::1", "fe80::1", "b")]
    for i in range(60):
        a, b = sorted(rng.randrange(600) for _ in range(2))
        spans.append((str(at(0x0A000000 + a)), str(at(0x0A000000 + b)), f"r{i}"))
        a, b = sorted(rng.randrange(2**70) for _ in range(2))
        spans.append((str(at((0x20010DB8 << 96) + a)), str(at((0x20010DB8 << 96) + b)), f"s{i}"))
    items = [str(at(0x0A000000 + i)) for i in range(0, 700, 3)] + [str(at((0x20010DB8 << 96) + rng.randrange(2**70))) for _ in range(150)]
    items += ["2001:db8::", "2001:db8:0:1::", "2001:db8:0:5:ffff:ffff:ffff:ffff", "2001:db8:0:6::", "::1", "fe80::1", "9.9.9.9", None, "bad"]
    df = spark.createDataFrame(list(enumerate(items)), "i int, ip string").repartition(4)
    ranges = spark.createDataFrame(spans, "first string, last string, name string")
    rows = lookup.range_lookup(df, "ip", ranges, "first", "last", "geo", **sizes).collect()

    def expected(a):
        try:
            a = at(a)
        except ValueError:
            return None
        hits = [(int(at(z)) - int(at(f)), int(at(f)), n) for f, z, n in spans if at(f).version == a.version and at(f) <= a <= at(z)]
        return min(hits)[2] if hits else None

    assert len(rows) == len(items)
    assert {r.i: r.geo and r.geo.name for r in rows} == {i: expected(a) for i, a in enumerate(items)}


@pytest.mark.parametrize("sizes", [{}, TINY])
def test_range_lookup(spark, addresses, sizes):
    items, df = addresses
    spans = [("10.0.0.0", "10.0.1.255", "A"), ("10.1.2.3", "10.3.0.0", "B"), ("2001:db8::10", "2001:db8::80", "C"),
             ("bad", "10.9.9.9", "D"), ("10.8.0.0", "10.7.0.0", "E"), ("2001:dc0::", "3fff::", "F"), ("11.0.0.0", "255.0.0.0", "G")]
    ranges = spark.createDataFrame(spans, "first string, last string, name string")
    got = {r.i: r.geo and r.geo.name for r in lookup.range_lookup(df, "ip", ranges, "first", "last", "geo", **sizes).collect()}

    def expected(a):
        try:
            a = ipaddress.ip_address(a)
        except ValueError:
            return None
        for first, last, name in (x for x in spans if x[2] in "ABCFG"):
            low, high = ipaddress.ip_address(first), ipaddress.ip_address(last)
            if a.version == low.version and low <= a <= high:
                return name
        return None

    assert got == {i: expected(a) for i, a in enumerate(items)}


def test_noise(spark):
    df = spark.createDataFrame([("title", "Error"), ("title", "Shop"), ("http", "Error"), (None, None)], "service string, banner string")
    assert pairs(lookup.without_noise(df)) == sorted([("title", "Shop"), ("http", "Error"), (None, None)], key=str)


def test_predicates(spark):
    df = spark.createDataFrame([("The quick, brown FOX",), ("x" * 300,), ("brown",)], "t string")
    t = F.col("t")
    assert [r[0] for r in df.select(predicates.has_terms(t, ["fox", "cat"])).collect()] == [True, False, False]
    assert [r[0] for r in df.select(predicates.has_terms(t, ["Brown", "quick"], every=True)).collect()] == [True, False, False]
    assert [r[0] for r in df.select(predicates.exact(t, "x" * 300) | predicates.exact(t, "brown")).collect()] == [False, False, True]
    a = spark.createDataFrame([("10.0.0.7",), ("10.0.1.7",), ("2001:db8::5",), ("x",)], "ip string").withColumn("b", ip.bits(F.col("ip")))
    b = F.col("b")
    assert [r.ip for r in a.where(predicates.in_network(b, "10.0.0.0/24")).collect()] == ["10.0.0.7"]
    assert [r.ip for r in a.where(predicates.in_network(b, "2001:db8::/32")).collect()] == ["2001:db8::5"]
    assert [r.ip for r in a.where(predicates.in_range(b, "10.0.0.8", "10.0.1.7")).collect()] == ["10.0.1.7"]
    z = spark.createDataFrame([({"a": [(60, "192.0.2.1")]},), ({"ns": [(60, "n")]},)], "records map<string,array<struct<ttl:bigint,data:string>>>")
    got = [r[0] for r in z.select(predicates.any_record(F.col("records"), "a", lambda x: x["data"] == "192.0.2.1")).collect()]
    assert got == [True, False]


def test_catalog_tables(spark, tmp_path):
    schema = get_source("port_scan").schema
    register_enrichment("tagged", lambda df: df.withColumn("tag", F.lit("t")))
    assert tables.create_table(spark, "scans_t", schema) and not tables.create_table(spark, "scans_t", schema)
    df = spark.createDataFrame([("192.0.2.1", 22, "tcp", None, None, 1, None)], schema)
    tables.append(df, "scans_t", partitions=2, rows_per_file=10)
    tables.append(df, "scans_t")
    assert spark.read.table("scans_t").count() == 2
    assert apply_enrichment(df, "tagged").first().tag == "t"
    with pytest.raises(ValueError):
        apply_enrichment(df, "none such")
    out = str(tmp_path / "dump")
    tables.export_json(spark.read.table("scans_t"), out)
    tables.export_json(df, out)
    assert tables.import_json(spark, out, schema).distinct().collect() == df.collect()
    df.write.parquet(str(tmp_path / "p"))
    got = tables.table_summary({"p": spark.read.parquet(str(tmp_path / "p")), ".hidden": df}).collect()
    assert [(r.name, r.documents) for r in got] == [("p", 1)] and got[0].size.endswith("kb")
    assert tables.with_snapshot_date(df, "2024-01-02").first().snapshot_date.isoformat() == "2024-01-02"
    spark.sql("drop table scans_t")


def ptr(octet, name):
    return f"{octet}.0.0.10.in-addr.arpa. PTR {name}.\n"


def test_keyed_table_life(spark, tmp_path):
    first, second = tmp_path / "a", tmp_path / "b"
    first.mkdir(), second.mkdir()
    (first / "1.txt").write_text("".join(ptr(1, f"n{i}") for i in range(40)) + ptr(2, "x") + "bad\n")
    (second / "1.txt").write_text(ptr(1, "old"))
    (second / "2.txt").write_text(ptr(1, "fresh") + ptr(3, "y"))
    path = str(tmp_path / "t")
    report = ingest(spark, "reverse_names", str(first), path, batch_id=1, hot_rows=10)
    assert (report.parsed, report.rejected) == (42, 1)
    assert read_rejects(spark, path).first()._error == "fewer than 3 fields"
    rows = tables.current(spark, path, "reverse_names").collect()
    assert sorted(n for r in rows if r.ip == "10.0.0.1" for n in r.record) == sorted(f"n{i}" for i in range(40))
    assert len({r.part for r in rows}) > 1
    for _ in range(2):  # a batch written again replaces itself
        ingest(spark, "reverse_names", str(second), path, batch_id=2)
    expected = [("10.0.0.1", ["fresh"]), ("10.0.0.2", ["x"]), ("10.0.0.3", ["y"])]
    assert sorted((r.ip, r.record) for r in tables.current(spark, path, "reverse_names").collect()) == expected
    tables.compact(spark, path, "reverse_names")
    assert sorted((r.ip, r.record) for r in tables.current(spark, path, "reverse_names").collect()) == expected
    assert tables.vacuum(spark, path) == 2  # the batch that was written again had replaced itself
    assert sorted((r.ip, r.record) for r in tables.current(spark, path, "reverse_names").collect()) == expected
    with pytest.raises(RejectedRows):
        ingest(spark, "reverse_names", str(first), path, batch_id=3, strict=True)


def test_zone_table_merges_by_type(spark, tmp_path):
    first, second = tmp_path / "a", tmp_path / "b"
    first.mkdir(), second.mkdir()
    many = "".join(f"d.eu. 60 IN NS n{i}.eu.\n" for i in range(40))
    (first / "eu.txt").write_text(many + "d.eu. 60 IN A 192.0.2.1\n")
    (second / "eu.txt").write_text("; DiG AXFR\nd.eu. 60 IN NS only.eu.\n")
    path = str(tmp_path / "t")
    ingest(spark, "zone", str(first), path, batch_id=1, hot_rows=10)
    parts = tables.current(spark, path, "zone").collect()
    assert len(parts) > 1 and sum(len(r.records.get("ns", [])) for r in parts) == 40
    ingest(spark, "zone", str(second), path, batch_id=2)
    rows = tables.current(spark, path, "zone").collect()
    assert [(r.source, {k: [x.data for x in v] for k, v in r.records.items()}) for r in rows] == [
        ("axfr", {"ns": ["only.eu"], "a": ["192.0.2.1"]})]


def test_enriched_ingest_and_registry(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = {"ip": "192.0.2.7", "timestamp": "1", "port": 1, "proto": "tcp", "ttl": 1, "rec_type": "status"}
    (tmp_path / "in" / "a.json").write_text(json.dumps(line))
    register_enrichment("upper", lambda df: df.withColumn("proto", F.upper("proto")))
    ingest(spark, "port_scan", str(tmp_path / "in"), str(tmp_path / "t"), enrichment="upper", partitions=1)
    assert tables.current(spark, str(tmp_path / "t"), "port_scan").first().proto == "TCP"
    assert {"zone", "certificates", "licences"} <= set(source_names())
    with pytest.raises(ValueError):
        get_source("none such")


def test_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(6):
        (folder / f"{i}.txt").write_text("".join(ptr(j % 4, f"f{i}n{j}") for j in range(12)) + "~eof\n" + ptr(9, "late"))
    query = watch(spark, "reverse_names", str(folder), str(tmp_path / "t"), str(tmp_path / "chk"), finite=True,
                  files_per_trigger=2, group="run")
    query.awaitTermination(120)
    live = {(r.ip, tuple(r.record)) for r in tables.current(spark, str(tmp_path / "t"), "reverse_names").collect()}
    assert {ip for ip, _ in live} == {f"10.0.0.{i}" for i in range(4)} and all(len(r) == 1 for _, r in live)
    (folder / "9.txt").write_text(ptr(0, "newest"))
    watch(spark, "reverse_names", str(folder), str(tmp_path / "t"), str(tmp_path / "chk"), finite=True).awaitTermination(120)
    after = {r.ip: r.record for r in tables.current(spark, str(tmp_path / "t"), "reverse_names").collect()}
    assert after["10.0.0.0"] == ["newest"] and len(after) == 4


def _names_in(spark, path):
    return {r.ip: r.record for r in tables.current(spark, path, "reverse_names").collect()}


def _stream(spark, tmp_path, path, name, text):
    folder = tmp_path / name
    folder.mkdir(exist_ok=True)
    (folder / f"{len(list(folder.iterdir()))}.txt").write_text(text)
    watch(spark, "reverse_names", str(folder), path, str(tmp_path / f"{name}-checkpoint"), finite=True).awaitTermination()


def test_streams_ingests_and_compaction_share_one_line_of_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    source = tmp_path / "in.txt"
    source.write_text("1.0.0.10.in-addr.arpa. PTR old.example.\n2.0.0.10.in-addr.arpa. PTR two.example.\n")
    ingest(spark, "reverse_names", str(source), path)
    tables.compact(spark, path, "reverse_names")
    _stream(spark, tmp_path, path, "s1", "1.0.0.10.in-addr.arpa. PTR newer.example.\n")
    assert _names_in(spark, path) == {"10.0.0.1": ["newer.example"], "10.0.0.2": ["two.example"]}
    _stream(spark, tmp_path, path, "s2", "3.0.0.10.in-addr.arpa. PTR three.example.\n")
    _stream(spark, tmp_path, path, "s1", "2.0.0.10.in-addr.arpa. PTR again.example.\n")
    tables.compact(spark, path, "reverse_names")
    want = {"10.0.0.1": ["newer.example"], "10.0.0.2": ["again.example"], "10.0.0.3": ["three.example"]}
    assert _names_in(spark, path) == want
    tables.vacuum(spark, path)
    source.write_text("1.0.0.10.in-addr.arpa. PTR last.example.\n")
    ingest(spark, "reverse_names", str(source), path)
    assert _names_in(spark, path) == {**want, "10.0.0.1": ["last.example"]}


def test_a_batch_written_again_replaces_itself_and_its_rejects(spark, tmp_path):
    path, source = str(tmp_path / "t"), tmp_path / "in.txt"
    source.write_text("1.0.0.10.in-addr.arpa. PTR one.example.\nbroken\n")
    ingest(spark, "reverse_names", str(source), path, batch_id=7)
    assert read_rejects(spark, path).count() == 1
    source.write_text("1.0.0.10.in-addr.arpa. PTR mended.example.\n")
    ingest(spark, "reverse_names", str(source), path, batch_id=7)
    assert _names_in(spark, path) == {"10.0.0.1": ["mended.example"]}
    with pytest.raises(ValueError):
        read_rejects(spark, path)


def test_a_write_that_fails_leaves_the_batch_as_it_was(spark, tmp_path):
    from pyspark.sql import functions as F

    path = str(tmp_path / "t")
    tables.write_batch(spark.range(3), path, 1)
    with pytest.raises(Exception):
        tables.write_batch(spark.range(3).select(F.raise_error(F.lit("lost")).alias("id")), path, 1)
    assert sorted(r.id for r in tables.read_log(spark, path).collect()) == [0, 1, 2]


def test_a_retry_of_a_compacted_append_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2):
        tables.write_batch(spark.range(n), path, n)
    tables.compact(spark, path, "port_scan")
    tables.write_batch(spark.range(2), path, 2)
    assert tables.read_log(spark, path).count() == 3


def test_a_batch_written_again_after_a_compaction_wins(spark, tmp_path):
    path, source = str(tmp_path / "t"), tmp_path / "in.txt"
    for round_, name in enumerate(("one", "mended", "again")):
        source.write_text(ptr(1, name) + ptr(2 + round_, "kept"))
        assert ingest(spark, "reverse_names", str(source), path, batch_id=1).parsed == 2
        assert _names_in(spark, path)["10.0.0.1"] == [name]
        tables.compact(spark, path, "reverse_names")
        assert _names_in(spark, path)["10.0.0.1"] == [name]
        if round_ == 1:
            assert tables.vacuum(spark, path) == 2
    assert tables.vacuum(spark, path) == 2
    assert len(_names_in(spark, path)) == 4


def test_append_batches_written_again_after_compactions(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2, 3):
        tables.write_batch(spark.range(n), path, n)
    tables.compact(spark, path, "port_scan")
    tables.write_batch(spark.range(10, 15), path, 2)
    tables.write_batch(spark.range(0), path, 3)
    for _ in range(3):
        assert sorted(r.id for r in tables.read_log(spark, path).collect()) == [0, 10, 11, 12, 13, 14]
        tables.compact(spark, path, "port_scan")
    tables.vacuum(spark, path)
    assert tables.read_log(spark, path).count() == 6
    tables.drop_batch(spark, path, 2)  # it was taken in: nothing of it is left to drop
    assert tables.read_log(spark, path).count() == 6


def test_an_empty_batch_and_a_dropped_one(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_batch(spark.range(4), path, 1)
    tables.write_batch(spark.range(0), path, 1)
    assert tables.read_log(spark, path).count() == 0
    tables.write_batch(spark.range(2), path, 2)
    tables.drop_batch(spark, path, 2)
    assert tables.read_log(spark, path).columns == ["id", "batch"] and tables.read_log(spark, path).count() == 0
    with pytest.raises(ValueError):
        tables.read_log(spark, str(tmp_path / "none"))


def test_progress_counts_files_and_batches(spark, tmp_path):
    """Rows and rejects per file and batch; a batch that is written again replaces its counts; files not read yet show."""
    from netsift.ingest import ingest
    from netsift.operators import progress
    from netsift.sources.lines import label_by_path
    from netsift.streaming.watch import watch

    folder, path = tmp_path / "in put", str(tmp_path / "table")
    folder.mkdir()
    good, bad = '{"ip": "10.0.0.1", "port": 1, "proto": "tcp", "ttl": 1, "timestamp": "1700000000", "rec_type": "status", "data": {}}', '{"ip": 1'
    for name, lines in {"a": [good, good, bad], "b": [good], "c": [bad, bad]}.items():
        (folder / f"{name}.json").write_text("\n".join(lines) + "\n")
    ingest(spark, "port_scan", str(folder / "a.json"), path, batch_id=1, metrics=True)
    again = ingest(spark, "port_scan", [str(folder / "a.json"), str(folder / "b.json")], path, batch_id=1, metrics=True)
    assert (again.parsed, again.rejected) == (4, 1)
    rows = progress.progress(spark, path, str(folder))
    named = label_by_path(rows, {"/a[.]": "first", "[.]json$": "other"}, "label", "file")
    assert {(r.label, r.batch, r.rows, r.rejected, r.done) for r in named.collect()} == {
        ("first", 1, 3, 1, True), ("other", 1, 1, 0, True), ("other", None, 0, 0, False)}
    total = progress.summary(rows).first()
    assert (total.files, total.files_done, total.rows, total.rejected) == (3, 2, 4, 1) and total.bytes_done < total.bytes
    watch(spark, "port_scan", str(folder), path, str(tmp_path / "cp"), finite=True, pattern="c*", bytes_per_trigger=1, metrics=True).awaitTermination()
    got = {(r.file[-6:], r.batch, r.rows, r.rejected) for r in progress.progress(spark, path, str(folder)).collect()}
    assert got == {("a.json", 1, 3, 1), ("b.json", 1, 1, 0), ("c.json", 2, 2, 2)}

"""Each source on small samples that exercise every branch."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from netsift.functions import times
from netsift.operators.lookup import without_noise
from netsift.sources import get_source
from netsift.sources.base import good_rows, rejects
from netsift.sources.exchanges import prefixes
from netsift.sources.registry_objects import changed_snapshots

SEEN = "2024-05-06T07:08:09Z"


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def run(spark, name, path, **options):
    source = get_source(name)
    parsed = source.parse(source.read(spark, path, **options), seen=SEEN, **options)
    docs = source.shape(parsed, seen=SEEN, **options)
    return docs, [r._error for r in rejects(parsed).collect()]


def seen_text(column="seen"):
    return times.iso(F.col(column)).alias(column)


PORT_LINES = """{"ip":"192.0.2.7","timestamp":"1705255468","port":22,"proto":"tcp","ttl":52,"rec_type":"banner","data":{"service_name":"ssh","banner":"SSH-2.0-X  1.0"}}
{"ip":"192.0.2.8","timestamp":1705255468,"port":80,"proto":"tcp","ttl":52,"rec_type":"status","data":{"status":"open"}}
{"ip":"192.0.2.9","timestamp":"1705255468","port":80,"proto":"tcp","ttl":52,"rec_type":"banner","data":{"service_name":"unknown","banner":"   "}}

#comment
{broken
{"ip":"192.0.2.9","timestamp":"1705255468","port":80,"proto":"tcp","ttl":52,"rec_type":"x"} {}
{"ip":"192.0.2.9","timestamp":"1705255468","port":80,"proto":"tcp","ttl":52}
~eof
{"ip":"192.0.2.10","timestamp":"1705255468","port":81,"proto":"tcp","ttl":1,"rec_type":"status","data":{}}
"""


def test_port_scan(spark, tmp_path):
    docs, errors = run(spark, "port_scan", write(tmp_path / "in", "a.json", PORT_LINES))
    rows = [tuple(r) for r in docs.select("ip", "port", "service", "banner", seen_text()).orderBy("ip").collect()]
    when = "2024-01-14T18:04:28Z"
    assert rows == [("192.0.2.7", 22, "ssh", "SSH-2.0-X 1.0", when), ("192.0.2.8", 80, None, None, when),
                    ("192.0.2.9", 80, None, None, when)]
    assert sorted(errors) == ["malformed JSON", "malformed JSON", "missing rec_type"]


def test_web_probe(spark, tmp_path):
    lines = [
        {"timestamp": "2024-01-14T13:08:15.117348474-05:00", "port": "443", "url": "https://a.example", "a": ["192.0.2.1"],
         "hash": {"body_md5": "x"}, "status_code": 200, "chain_status_codes": [301, 200], "failed": False, "time": "5ms",
         "knowledgebase": {"p": 1}, "extra_field": {"k": [1, 2]}},
        {"timestamp": "2024-01-14T13:08:15-05:00", "port": 80, "tech": ["Nginx"]},
        {"port": 80},
        {"timestamp": "2024-01-14T13:08:15Z", "port": "x"},
    ]
    text = "\n".join(json.dumps(x) for x in lines) + "\nnot json\n~eof\n"
    docs, errors = run(spark, "web_probe", write(tmp_path / "in", "a.json", text))
    rows = docs.select("timestamp", "port", "hash.body_md5", "chain_status_codes", F.to_json("_extra").alias("x")).orderBy("port").collect()
    assert [tuple(r) for r in rows] == [
        ("2024-01-14T13:08:15Z", 80, None, None, "{}"),
        ("2024-01-14T13:08:15Z", 443, "x", [301, 200], '{"extra_field":{"k":[1,2]}}'),
    ]
    assert sorted(errors) == ["bad number", "malformed JSON", "missing timestamp"]
    source = get_source("web_probe")
    utc = source.parse(source.read(spark, str(tmp_path / "in")), utc=True).where("port = 443").first()
    assert utc.timestamp == "2024-01-14T18:08:15Z"


PTR_LINES = """0.6.229.47.in-addr.arpa. PTR 047-229-006-000.res.example.com.
0.6.229.47.in-addr.arpa. PTR second.example.com.
0.6.229.47.in-addr.arpa. PTR second.example.com.
1.6.229.47.in-addr.arpa. A 192.0.2.1
1.6.229.47.in-addr.arpa. PTR 1.6.229.47.in-addr.arpa.
2.6.229.47.in-addr.arpa. PTR
3.6.229.47.in-addr.arpa. PTR .
4.6.229.47.in-addr.arpa. PTR x.example.net.
8.b.d.0.1.0.0.2.ip6.arpa. PTR six.example.net.
0.6.229.47.in-addr.arpa. PTR third.example.com.
"""


@pytest.mark.parametrize("hot_rows", [1_000_000, 2])
def test_reverse_names(spark, tmp_path, hot_rows):
    path = write(tmp_path / "in", "a.txt", PTR_LINES)
    docs, errors = run(spark, "reverse_names", path, hot_rows=hot_rows)
    found = {}
    for r in docs.collect():
        found.setdefault(r.ip, []).extend(r.record)
        assert len(r.record) <= 3
    names = ["047-229-006-000.res.example.com", "second.example.com", "third.example.com"]
    if hot_rows == 2:
        assert sorted(found["47.229.6.0"]) == sorted(names)
    else:
        assert found["47.229.6.0"] == names
    assert found["47.229.6.4"] == ["x.example.net"] and len(found) == 2
    assert sorted(errors) == ["fewer than 3 fields", "not an IPv4 reverse name"]
    runs, _ = run(spark, "reverse_names", path, group="run")
    ordered = [(r.ip, r.record) for r in runs.orderBy("_order").collect()]
    assert ordered == [("47.229.6.0", names[:2]), ("47.229.6.4", ["x.example.net"]), ("47.229.6.0", names[2:])]


def test_reverse_stream(spark, tmp_path):
    lines = ['{"ip":"4.5.6.7","record":"7.6.5.4.in-addr.arpa","ttl":5}', '{"ip":"4.5.6.7","record":"a.example","ttl":5,"x":1}',
             '{"ip":"4.5.6.7","record":"b.example","nameserver":"192.0.2.1","seen":"2024-01-02T03:04:05Z"}', '{"record":"b"}', "x"]
    docs, errors = run(spark, "reverse_stream", write(tmp_path / "in", "a.json", "\n".join(lines)))
    rows = docs.orderBy("_order").select("record", "ttl", "nameserver", F.to_json("_extra").alias("e"), seen_text()).collect()
    assert [tuple(r) for r in rows] == [("a.example", 5, None, '{"x":1}', None),
                                        ("b.example", None, "192.0.2.1", "{}", "2024-01-02T03:04:05Z")]
    assert errors == ["bad or missing ip"]


ZONE_LINES = """a.com.eu. 3600 IN NS ns11.example.com.
A.com.eu. 3600 in ns ns12.example.com.
a.com.eu. 300 IN A 192.0.2.1
a.com.eu. x IN A 192.0.2.2
a.com.eu. 300 CH TXT hello
a.com.eu. 300 IN BOGUS hello
; <<>> DiG 9.18 <<>> AXFR com.eu
b.com.eu. 60 IN SOA ns.example.com. host.example.com. 1 2 3 4 5
b.com.eu. 60 IN NSEC c.com.eu. A RRSIG NSEC
short line
~eof
c.com.eu. 60 IN A 192.0.2.3
"""


@pytest.mark.parametrize("group", ["key", "run"])
def test_zone(spark, tmp_path, group):
    docs, errors = run(spark, "zone", write(tmp_path / "in", "com.eu.txt", ZONE_LINES), group=group)
    rows = {r.domain: r for r in docs.collect()}
    a, b = rows["a.com.eu"], rows["b.com.eu"]
    assert len(rows) == 2 and (a.zone, a.source, b.source) == ("com.eu", "czds", "axfr")
    assert {k: [tuple(x) for x in v] for k, v in a.records.items()} == {
        "ns": [(3600, "ns11.example.com"), (3600, "ns12.example.com")], "a": [(300, "192.0.2.1")]}
    assert {k: [tuple(x) for x in v] for k, v in b.records.items()} == {
        "soa": [(60, "ns.example.com host.example.com 1 2 3 4 5")], "nsec": [(60, "c.com.eu A RRSIG NSEC")]}
    assert sorted(errors) == ["bad ttl", "fewer than 5 fields", "unsupported class", "unsupported type"]


def test_certificates(spark, tmp_path):
    message = {"data": {"leaf_cert": {
        "all_domains": ["*.x.example", "x.example", "*.y.example", "y2.example", "y2.example", "*.*.z", "*.z"],
        "fingerprint": "AA", "issuer": {"O": "CA"}, "subject": {"CN": "x.example", "O": None}}}}
    text = json.dumps(message) + '\n{"message_type":"heartbeat"}\nbad\n'
    docs, errors = run(spark, "certificates", write(tmp_path / "in", "a.json", text))
    rows = docs.select("domain", "fingerprint", "issuer", "subject", seen_text()).collect()
    assert sorted(r.domain for r in rows) == ["x.example", "y.example", "y2.example", "z"]
    assert all(tuple(r)[1:] == ("AA", "CA", {"CN": "x.example"}, SEEN) for r in rows)
    assert sorted(errors) == ["malformed JSON", "missing all_domains"]


DELEGATION_LINES = """2.3|arin|1700000000|4|19840101|20240101|-0500
arin|*|ipv4|*|2|summary
# comment
arin|US|ipv4|76.15.132.0|1024|20070502|allocated|6c06
arin|US|ipv6|2001:DB8::|32|00000000|assigned|6c07
arin||asn|64512|10||reserved|
arin|USA|asn|1|1|20200101|assigned|x
arin|US|ipv6|2001:db8::1|32|20200101|assigned|x
arin|US|asn|4200000000|1|20200101|allocated
arin|US|ipv4|255.255.255.0|1024|20200101|allocated|x
arin|US|asn|1|x|20200101|allocated|x
arin|US|asn|1|1|20201301|allocated|x
arin|US|asn|1|1|20200101|lost|x
arin|US|asx|1|1|20200101|allocated|x
"""


def test_delegations(spark, tmp_path):
    docs, errors = run(spark, "delegations", write(tmp_path / "in", "arin.txt", DELEGATION_LINES))
    rows = docs.select("registry", "cc", "asn", "ip", seen_text("date"), "status", "extensions", seen_text()).collect()
    got = {tuple(r) for r in rows}
    assert got == {
        ("arin", "us", None, ("76.15.132.0", "76.15.135.255"), "2007-05-02T00:00:00Z", "allocated", "6c06", SEEN),
        ("arin", "us", None, ("2001:db8::", "2001:db8:ffff:ffff:ffff:ffff:ffff:ffff"), None, "assigned", "6c07", SEEN),
        ("arin", None, (64512, 64521), None, None, "reserved", None, SEEN),
        ("arin", "us", (4200000000, 4200000000), None, "2020-01-01T00:00:00Z", "allocated", None, SEEN),
    }
    assert sorted(errors) == ["bad IP range", "bad IP range", "bad country code", "bad date", "bad record type", "bad status",
                              "bad value"]


def test_transfers(spark, tmp_path):
    def transfer(**own):
        base = {"transfer_date": "2017-09-15 19:00:00Z", "type": "MERGER_ACQUISITION", "source_organization": {"name": "A"},
                "recipient_organization": {"name": "B", "country_code": "DE"}, "source_rir": "X", "recipient_rir": "Y"}
        return base | own

    def nets(a, b):
        return {"original_set": [{"start_address": a, "end_address": b}], "transfer_set": []}

    doc = {"transfers": [
        transfer(ip4nets=nets("094.031.064.000", "94.31.127.255")),
        transfer(asns={"original_set": [{"start": "198257", "end": 198257}]}),
        transfer(asns={"original_set": [{"start": "AS1", "end": 1}]}),
        transfer(ip4nets=nets("1.2.3.999", "1.2.3.4")),
        transfer(type="GIFT"),
        transfer(ip6nets=nets("2001:db8::", "2001:db8::ffff"), transfer_date="2017-09-15T19:00:00Z"),
    ]}
    path = write(tmp_path / "in", "a.json", json.dumps(doc, indent=1))
    write(tmp_path / "in", "b.json", '{"other": 1}')
    write(tmp_path / "in", "c.json", "nope")
    docs, errors = run(spark, "transfers", path)
    rows = docs.select("transfer_date", "ip4nets", "asns", "ip6nets", "recipient_organization.country_code", seen_text()).collect()
    assert {r.transfer_date for r in rows} == {"2017-09-15T19:00:00Z"} and len(rows) == 3
    assert [r.ip4nets.original_set for r in rows if r.ip4nets] == [[("94.31.64.0", "94.31.127.255")]]
    assert [(r.asns.original_set, r.asns.transfer_set) for r in rows if r.asns] == [([(198257, 198257)], None)]
    assert [r.ip6nets.original_set for r in rows if r.ip6nets] == [[("2001:db8::", "2001:db8::ffff")]]
    assert sorted(errors) == ["bad AS number", "bad address", "bad transfer type", "malformed JSON", "no transfers"]


def test_blocklists(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, "one.ipset", "# Category : attacks\n# Category : later\n192.0.2.1\n192.0.2.2\n")
    write(folder, "two.netset", "192.0.2.0/24\n192.0.2.1/32\n192.0.2.1/24\n#category: spam\n")
    write(folder, "three.ipset", "192.0.2.1\n2001:db8::1\n")
    write(folder, "one_7d.ipset", "192.0.2.99\n")
    path = write(folder, "readme.md", "192.0.2.98\n")
    docs, errors = run(spark, "blocklists", path)
    rows = {r.ip: (r.ipsets, r.categories) for r in docs.collect()}
    assert rows == {
        "192.0.2.1/32": (["one", "three", "two"], ["attacks", "spam"]), "192.0.2.2/32": (["one"], ["attacks"]),
        "192.0.2.0/24": (["two"], ["spam"]), "2001:db8::1/128": (["three"], []),
    }
    assert errors == ["bad network"]


def test_licences(spark, tmp_path):
    text = ('LICENSE_ID,Callsign,GRANT_DATE,loc_lat_deg,power_erp,lic_name,note\n'
            '12.9,K1,01/02/2020 00:00:00,x,1.5,"two\nlines",n\n7,NULL,2020-01-02,30,junk,"a ""q""",\n8,K3,0000-00-00,,,,NULL\n')
    docs, _ = run(spark, "licences", write(tmp_path / "in", "a.csv", text))
    cols = ["license_id", "callsign", seen_text("grant_date"), "loc_lat_deg", "power_erp", "lic_name", "_extra", "market_code"]
    day = "2020-01-02T00:00:00Z"
    assert [tuple(r) for r in docs.select(*cols).orderBy("callsign", "license_id").collect()] == [
        (7, None, day, 30, None, 'a "q"', {}, None), (12, "K1", day, None, 1.5, "two\nlines", {"note": "n"}, None),
        (8, "K3", None, None, None, None, {}, None)]


def test_mesh_radio(spark, tmp_path):
    lines = [
        {"from": 1, "rxTime": 1705255468, "decoded": {"portnum": "TEXT", "payload": "hi"}},
        {"from": 2, "decoded": {"payload": {"time": 1705255468, "altitude": 7, "deviceMetrics": {"voltage": 3.5}, "odd": True}}},
        {"from": 3, "decoded": {"payload": 42}},
        {"from": 4, "decoded": {"portnum": "X"}},
        {"from": 5},
    ]
    docs, errors = run(spark, "mesh_radio", write(tmp_path / "in", "a.json", "\n".join(map(json.dumps, lines)) + "\n{bad\nplain\n"))
    p = F.col("decoded.payload")[0]
    rows = docs.orderBy("from").select(
        seen_text("rxTime"), p["value"].cast("string"), times.iso(p["time"]), p["altitude"], p["deviceMetrics"]["voltage"],
        F.try_variant_get(p["raw"], "$.odd", "boolean"), F.size("decoded.payload"), F.col("decoded").isNull()).collect()
    assert [tuple(r)[:7] for r in rows] == [
        ("2024-01-14T18:04:28Z", "hi", None, None, None, None, 1),
        (None, None, "2024-01-14T18:04:28Z", 7, 3.5, True, 1),
        (None, "42", None, None, None, None, 1), (None, None, None, None, None, None, None),
        (None, None, None, None, None, None, None)]
    assert rows[4][7] and not rows[3][7] and errors == ["malformed JSON"]


def test_exchanges(spark, tmp_path):
    line = {"pch_id": 1848, "name": "EXAMPLE-IX", "country": "AO", "alternatenames": [], "sources": ["pch"], "ix_id": 10,
            "prefixes": {"ipv4": ["192.0.2.0/24"], "ipv6": ["2001:db8:9d0::/48"]}, "latitude": 1.5}
    docs, errors = run(spark, "exchanges", write(tmp_path / "in", "a.jsonl", json.dumps(line) + "\n{}\nx"))
    assert [(r.name, r.latitude, r.sources) for r in docs.collect()] == [("EXAMPLE-IX", 1.5, ["pch"])]
    assert sorted((r.prefix, r.net.len) for r in prefixes(docs).collect()) == [("192.0.2.0/24", 120), ("2001:db8:9d0::/48", 48)]
    assert sorted(errors) == ["malformed JSON", "missing name"]


def test_registry_objects(spark, tmp_path):
    text = ("% banner\n\nroute: 192.0.2.0/24\ndescr: one\n  and more\ndescr: two\norigin: AS1\n\n"
            "# note\nmntner: M-1\nsource: X\n\n\nbroken\n")
    (tmp_path / "in").mkdir()
    with gzip.open(tmp_path / "in" / "a.db.gz", "wt") as f:
        f.write(text)
    docs, errors = run(spark, "registry_objects", str(tmp_path / "in"), partitions=4)
    rows = {r.object_class: (r.object_id, r.attributes) for r in docs.collect()}
    assert rows["route"] == ("192.0.2.0/24", {"route": ["192.0.2.0/24"], "descr": ["one and more", "two"], "origin": ["AS1"]})
    assert rows["mntner"][1]["source"] == ["X"] and len(rows) == 2 and errors == ["line without a colon"]


def test_changed_snapshots(spark):
    new = spark.createDataFrame([("a", "2"), ("b", "1"), ("c", "1")], "registry string, serial string")
    old = spark.createDataFrame([("a", "1"), ("b", "1")], "registry string, serial string")
    assert sorted(r.registry for r in changed_snapshots(new, old).collect()) == ["a", "c"]


def test_marks_do_not_depend_on_the_local_limit(spark, tmp_path, monkeypatch):
    from netsift.sources import lines

    folder = tmp_path / "in"
    for i in range(4):
        write(folder, f"{i}.txt", "a\nb\n~eof\nc\n" if i % 2 else "a\nb\nc\n")
    expected = sorted(r.value for r in lines.cut_at_sentinel(lines.read_lines(spark, str(folder))).collect())
    monkeypatch.setattr(lines, "MAX_LOCAL_MARKS", 1)
    got = sorted(r.value for r in lines.cut_at_sentinel(lines.read_lines(spark, str(folder))).collect())
    assert got == expected == ["a"] * 4 + ["b"] * 4 + ["c"] * 2


def test_runs_cross_file_splits(spark, tmp_path):
    """Many splits per file give the same runs as one split."""
    ips = [f"{i // 40}.0.0.10.in-addr.arpa. PTR n{i % 7}.example." for i in range(400)]
    path = write(tmp_path / "in", "a.txt", "\n".join(ips + ips[:80]))
    whole = [(r.ip, r.record) for r in run(spark, "reverse_names", path, group="run")[0].orderBy("_order").collect()]
    key, old = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(key, "1000")
    try:
        docs = run(spark, "reverse_names", path, group="run")[0].orderBy("_order")
        split = [(r.ip, r.record) for r in docs.collect()]
    finally:
        spark.conf.set(key, old)
    assert split == whole and len(whole) == 12


# ---- fields survive, strict lines, odd files ----

def lines_of(spark, *values):
    from netsift.sources.lines import POSITION

    return spark.createDataFrame([(v, "f", 0, i) for i, v in enumerate(values)], ["value", *POSITION])


def test_text_after_the_object_is_malformed_and_a_mistyped_field_is_not(spark):
    from netsift.sources.base import parse_json

    good = '{"ip":"1.1.1.1","n":3,"deep":{"a":1}, "x":2}'
    rows = lines_of(spark, good, '{"ip":"1.1.1.1"},"junk":1', '{"ip":"1.1.1.1","n":"q"}', '{"ip":"1"} {"ip":"2"}', '{"ip":')
    got = [r._json for r in parse_json(rows, "struct<ip:string,n:int>").orderBy("_row").collect()]
    assert [g and (g.ip, g.n) for g in got] == [("1.1.1.1", 3), None, ("1.1.1.1", None), None, None]


def test_a_list_field_with_one_value_is_a_list(spark):
    from netsift.sources import web_probe

    line = '{"timestamp":"2024-01-01T00:00:00.1Z","url":"u","cname":"x","a":["1.1.1.1"],"other":5}'
    row = web_probe.parse(lines_of(spark, line), sentinel=None).first()
    assert row._error is None and row.cname == ["x"] and row.a == ["1.1.1.1"] and list(row._extra) == ["other"]


def test_unknown_fields_of_messages_and_transfers_are_kept(spark):
    from netsift.sources import mesh_radio, transfers

    line = '{"from":1,"fromId":"!a","decoded":{"portnum":"P","text":"hi","payload":"z"},"rxTime":10}'
    row = mesh_radio.parse(lines_of(spark, line), sentinel=None).first()
    assert row._error is None and list(row._extra) == ["fromId"] and list(row.decoded._extra) == ["text"]
    document = '{"transfers":[{"type":"RESOURCE_TRANSFER","remarks":"r"},{"type":"RESOURCE_TRANSFER"}]}'
    rows = transfers.parse(spark.createDataFrame([(document, "f")], "value string, _file string"), seen="2024-01-01T00:00:00Z").collect()
    assert [r._error for r in rows] == [None, None] and [r._extra and list(r._extra) for r in rows] == [["remarks"], None]


def test_stored_extras_stay_when_a_later_record_has_none(spark, tmp_path):
    from netsift.ingest import ingest
    from netsift.operators import tables

    path = str(tmp_path / "t")
    for n, line in enumerate(('{"ip":"1.1.1.1","record":"a","asn":7}', '{"ip":"1.1.1.1","record":"b"}', '{"ip":"1.1.1.1","record":"c","org":"o"}')):
        (tmp_path / "in.txt").write_text(line)
        ingest(spark, "reverse_stream", str(tmp_path / "in.txt"), path)
        row = tables.current(spark, path, "reverse_stream").first()
        assert "asn" in row._extra and row.record == "abc"[n]
    assert set(row._extra) == {"asn", "org"}


def test_crlf_registry_dump_is_split(spark, tmp_path):
    from netsift.sources import registry_objects

    (tmp_path / "d").write_bytes(b"person: A\r\nnic-hdl: a1\r\n\r\nperson: B\r\nnic-hdl: b1\r\n\r\n\r\nperson: C\r\n")
    for crlf in (False, True):
        rows = registry_objects.parse(registry_objects.read(spark, str(tmp_path / "d"), crlf=crlf)).collect()
        assert sorted(r.object_id for r in rows) == ["A", "B", "C"] and all(r._error is None for r in rows)


def test_zone_name_of_a_file_with_a_blank(spark, tmp_path):
    from netsift.sources import get_source

    (tmp_path / "my zone+x.eu.txt").write_text("a.my. 3600 in a 10.0.0.1\n")
    zone = get_source("zone")
    row = zone.shape(zone.parse(zone.read(spark, str(tmp_path)), sentinel=None)).first()
    assert row.zone == "my zone+x.eu"


def test_licence_files_with_other_headers(spark, tmp_path):
    from netsift.sources import licences

    (tmp_path / "a.csv").write_text("CALLSIGN,LIC_NAME\nW1,Ann\n")
    (tmp_path / "b.csv").write_text("lic_name,callsign,grant_date\nBob,W2,01/02/2020 00:00:00\n")
    rows = licences.parse(licences.read(spark, str(tmp_path))).collect()
    assert sorted((r.callsign, r.lic_name) for r in rows) == [("W1", "Ann"), ("W2", "Bob")]


def test_split_dumps_equal_the_multi_line_reader(spark, tmp_path):
    """Quoted line breaks, commas and quotes over many splits; two files, one with another header."""
    from netsift.sources import licences, quoted_csv

    row = lambda i: f'{i},"name {i}{chr(10) * (i % 3)}, ""q{i}"" {"x" * (i % 90)}",{i}.5\n' + "\n" * (i % 17 == 0)
    for name, header, rows in (("a", "LICENSE_ID,lic_name,power_erp", range(1, 900)), ("b", "license_id,Lic_Name,more", range(900, 1200))):
        write(tmp_path / "in", f"{name}.csv", header + "\n" + "".join(row(i) for i in rows) + '7777,"a\n\n\nlong\none",1')
    write(tmp_path / "in", "empty.csv", "")
    path, size = str(tmp_path / "in"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = licences.read(spark, path)
    columns = sorted(want.columns)
    expected = sorted(map(str, want.select(columns).collect()))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        assert quoted_csv.raw_lines(spark, path).select("_file", "_block").distinct().count() > 40
        got = licences.read(spark, path, split=True)
        assert sorted(map(str, got.where("_error is null").select(columns).collect())) == expected and len(expected) == 1201
        assert got.where("_error is not null").count() == 0
        short = quoted_csv.records(quoted_csv.raw_lines(spark, path), max_lines=4).where("_error is not null").collect()
        assert sorted(r.record for r in short) == ['7777,"a'] * 2 and {r["_error"] for r in short} == {quoted_csv.UNCLOSED}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_lists_are_told_by_their_endings(spark):
    """No regex is asked of every line, and the same files are read."""
    names = ["a.netset", "a.ipset", "a_30d.netset", "a_1d.ipset", "readme.md", "a.ipset.txt", "_30d.netset", "x30d.netset", "a_730d.ipset", "netset"]
    lines = spark.createDataFrame([("10.0.0.1", f"/f/{n}", 0, i) for i, n in enumerate(names)], "value string, _file string, _block long, _row long")
    parsed = get_source("blocklists").parse(lines)
    assert sorted(r._file for r in parsed.collect()) == ["/f/a.ipset", "/f/a.netset", "/f/x30d.netset"]
    assert "RLIKE(_file" not in parsed._jdf.queryExecution().optimizedPlan().toString()


def test_noise_is_told_from_columns_that_are_there(spark):
    """The filter asks the columns made by the parse; it does not make the banner again."""
    lines = spark.createDataFrame([("{}", "/f", 0, 0)], "value string, _file string, _block long, _row long")
    source = get_source("port_scan")
    plan = without_noise(source.shape(source.parse(lines, sentinel=None)))._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line and "Welcome to nginx!" in line]
    assert filters and not any("regexp_replace" in f for f in filters)

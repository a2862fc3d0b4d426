import pytest
from pyspark.sql import functions as F

from netsift.ingest import write_parsed
from netsift.operators import tables
from netsift.sources import reverse_names, web_probe, zone
from netsift.streaming.carry import MARKS, Carry, marks_after
from netsift.streaming.watch import watch_frame

LINE = "value string, _file string, _block bigint, _row bigint"


def answer(octet, name):
    return f"{octet}.0.0.10.in-addr.arpa. PTR {name}."


def frame(spark, lines, first=0, topic="/t/one.txt"):
    rows = [(v, topic, 0, first + i) if isinstance(v, str) else (v[0], v[1], 0, first + i) for i, v in enumerate(lines)]
    return spark.createDataFrame(rows, LINE).coalesce(1)


def through(spark, tmp_path, source, batches, tries=1, **options):
    """The table after micro-batches of lines; each is tried ``tries`` times."""
    path = str(tmp_path / "t")
    kept = {k: options[k] for k in ("group", "open_for", "sentinel") if k in options}
    more = {k: v for k, v in options.items() if k != "open_for"}
    for n, lines in enumerate(batches):
        for _ in range(tries):
            carry = Carry(source, str(tmp_path / "carried"), **kept)
            frame(spark, lines).write.mode("overwrite").parquet(str(tmp_path / "lines"))
            parsed, carried = carry.parsed(spark.read.schema(LINE).parquet(str(tmp_path / "lines")), n, **more)
            write_parsed(source, parsed, path, n, writer="topic", carried=carried, **more)
        carry.done(spark, n)
    return tables.current(spark, path, source)


def names(df):
    return {r.ip: r.record for r in df.collect()}


def test_names_over_micro_batches_as_in_one(spark, tmp_path):
    batches = [
        [answer(1, "a"), answer(2, "x"), answer(1, "b"), "broken"],
        [answer(1, "c"), answer(1, "a"), answer(3, "z")],
        [],
        [answer(2, "y"), answer(3, "z"), answer(1, "d")],
    ]
    got = names(through(spark, tmp_path, reverse_names.REVERSE, batches))
    assert got == {"10.0.0.1": ["a", "b", "c", "d"], "10.0.0.2": ["x", "y"], "10.0.0.3": ["z"]}
    whole = reverse_names.parse_text(frame(spark, [v for b in batches for v in b]))
    assert names(reverse_names.shape_text(whole)) == got


def test_runs_go_on_only_where_a_topic_ended(spark, tmp_path):
    other = "/t/two.txt"
    batches = [
        [answer(1, "a"), answer(1, "b"), (answer(7, "p"), other)],
        [answer(1, "c"), answer(2, "x"), answer(2, "y")],
        [(answer(7, "q"), other), answer(2, "z"), answer(1, "new")],
    ]
    got = names(through(spark, tmp_path, reverse_names.REVERSE, batches, group="run"))
    # the run of 10.0.0.1 had ended: its last document holds the last run, as an upsert of runs does
    assert got == {"10.0.0.1": ["new"], "10.0.0.2": ["x", "y", "z"], "10.0.0.7": ["p", "q"]}


def test_hot_lists_in_parts(spark, tmp_path):
    batches = [[answer(1, f"n{b}-{i}") for i in range(25)] for b in range(2)]
    rows = through(spark, tmp_path, reverse_names.REVERSE, batches, tries=2, hot_rows=10).collect()
    parts = [n for r in sorted(rows, key=lambda r: r.part) for n in r.record]
    assert parts == [f"n{b}-{i}" for b in range(2) for i in range(25)] and len(rows) > 3


def test_keys_are_closed_after_a_while(spark, tmp_path):
    batches = [[answer(1, "a"), answer(2, "x")], [answer(2, "y")], [answer(3, "z")], [answer(1, "b"), answer(2, "w")]]
    got = names(through(spark, tmp_path, reverse_names.REVERSE, batches, open_for=2))
    assert got == {"10.0.0.1": ["b"], "10.0.0.2": ["x", "y", "w"], "10.0.0.3": ["z"]}


def test_an_end_mark_ends_its_topic_for_good(spark, tmp_path):
    batches = [[answer(1, "a"), "~eof", answer(2, "never")], [answer(1, "never"), (answer(5, "other"), "/t/two.txt")], [answer(4, "never")]]
    assert names(through(spark, tmp_path, reverse_names.REVERSE, batches)) == {"10.0.0.1": ["a"], "10.0.0.5": ["other"]}


def test_zones_over_micro_batches_as_in_one(spark, tmp_path):
    batches = [
        ["a.eu. 60 IN NS one.eu.", "b.eu. 60 IN A 192.0.2.1"],
        ["; <<>> DiG 9 <<>> AXFR eu", "c.eu. 60 IN NS one.eu.", "a.eu. 60 IN NS two.eu."],
        ["d.eu. 60 IN NS one.eu.", "b.eu. 60 IN A 192.0.2.2", "~eof", "; AXFR"],
        ["e.eu. 60 IN NS never.eu."],
    ]
    show = lambda df: {r.domain: (r.source, {k: [x.data for x in v] for k, v in r.records.items()}) for r in df.collect()}
    got = show(through(spark, tmp_path, zone.ZONES, batches))
    assert got == {
        "a.eu": ("czds", {"ns": ["one.eu", "two.eu"]}), "b.eu": ("czds", {"a": ["192.0.2.1", "192.0.2.2"]}),
        "c.eu": ("axfr", {"ns": ["one.eu"]}), "d.eu": ("axfr", {"ns": ["one.eu"]}),
    }
    assert show(zone.shape(zone.parse(frame(spark, [v for b in batches for v in b])))) == got


def test_a_transfer_behind_the_end_does_not_count(spark, tmp_path):
    batches = [["a.eu. 60 IN NS one.eu.", "~eof", "; DiG AXFR"]]
    assert [(r.domain, r.source) for r in through(spark, tmp_path, zone.ZONES, batches).collect()] == [("a.eu", "czds")]


def test_stream_carries_over_a_restart(spark, tmp_path):
    path = str(tmp_path / "t")
    for name, lines in (("0", [answer(1, "a")]), ("1", [answer(1, "b")]), ("2", [answer(1, "a"), answer(2, "x")])):
        frame(spark, lines).write.parquet(str(tmp_path / "in" / name))
        topic = spark.readStream.schema(LINE).parquet(str(tmp_path / "in" / "*"))
        watch_frame("reverse_names", topic, path, str(tmp_path / "c"), finite=True, carry=True).awaitTermination()
    assert names(tables.current(spark, path, "reverse_names")) == {"10.0.0.1": ["a", "b"], "10.0.0.2": ["x"]}
    assert sorted(p.name for p in (tmp_path / "c" / "carried" / "open").iterdir()) == ["1", "2"]


def test_what_cannot_be_carried(spark, tmp_path):
    with pytest.raises(ValueError):
        Carry(web_probe.WEB_PROBES, str(tmp_path))
    carry = Carry(reverse_names.REVERSE, str(tmp_path / "c"))
    far = frame(spark, [answer(1, "a")]).withColumn("_block", F.lit(1 << 31))
    with pytest.raises(Exception, match="not below"):
        carry.parsed(far, 0)[0].collect()


@pytest.mark.parametrize("source", [reverse_names.REVERSE, zone.ZONES])
def test_a_micro_batch_is_parsed_once(spark, tmp_path, source):
    """Documents, open rows and rejects read the parsed rows as they were written, not the lines again."""
    frame(spark, [answer(1, "a"), "x"]).write.parquet(str(tmp_path / "lines"))
    carry = Carry(source, str(tmp_path / "carried"))
    parsed, _ = carry.parsed(spark.read.schema(LINE).parquet(str(tmp_path / "lines")), 0)
    assert all("/carried/parsed/0/" in f for f in parsed.inputFiles())
    carry.done(spark, 0)
    assert not (tmp_path / "carried" / "parsed" / "0").exists()


def test_marks_and_open_rows_sort_no_lines(spark):
    """Both count down by hash; only what is left, a row per split and mark, is sorted."""
    lines = frame(spark, [answer(1, "a"), "; DiG AXFR", "~eof"])
    none = spark.createDataFrame([], MARKS)
    plans = [marks_after(lines, none, "~eof"), reverse_names.first_rows(lines.selectExpr("_file", "_block", "_row", "value ip", "value record"))]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        bottom = [line for line in plan.splitlines() if "Aggregate(" in line][-1]
        assert "HashAggregate" in bottom, plan

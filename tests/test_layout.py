"""Dated snapshots and bucketed keyed tables."""

import contextlib
import io
import uuid

from pyspark.sql import functions as F

from netsift.operators import keyed, merging, tables


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_a_day_is_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    rows = lambda values: spark.createDataFrame([(v,) for v in values], "v int")
    tables.write_dated(rows([1, 2]), path, "2024-05-01")
    tables.write_dated(rows([3]), path, "2024-05-02")
    both = spark.createDataFrame([(7, "2024-05-03"), (8, "2024-05-02"), (9, None)], "v int, d string")
    tables.write_dated(both.select("v", F.col("d").cast("date").alias("snapshot_date")), path)
    read = lambda *days: sorted((r.v, str(r.snapshot_date)) for r in tables.read_dated(spark, path, *days).collect())
    assert read() == [(1, "2024-05-01"), (2, "2024-05-01"), (7, "2024-05-03"), (8, "2024-05-02"), (9, "None")]
    assert read("2024-05-02") == [(7, "2024-05-03"), (8, "2024-05-02")]
    assert read("2024-05-01", "2024-05-01") == [(1, "2024-05-01"), (2, "2024-05-01")]
    # a day that gets no rows is left as it is
    tables.write_dated(rows([]), path, "2024-05-01")
    assert len(read()) == 5


def test_only_the_days_asked_for_are_read(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    for day in ("2024-05-01", "2024-05-02", "2024-05-03"):
        tables.write_dated(spark.range(5), path, day)
    period = tables.read_dated(spark, path, "2024-05-02", "2024-05-02")
    plan = plan_of(period)
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "2024-05-02" in plan
    assert {f.split("snapshot_date=")[1][:10] for f in [r.f for r in period.select(F.col("_metadata.file_path").alias("f")).collect()]} == {"2024-05-02"}


OLD = "id int, name string, tags array<string>, extra map<string,int>"
OLD_ROWS = [(1, "a", ["x"], {"p": 1}), (2, "b", None, None), (3, None, ["y"], {"q": 2}), (None, "lost", None, None)]
NEW_ROWS = [(1, None, ["z"], {"q": 5}), (3, "c", None, None), (4, "d", ["w"], {"p": 3}), (None, "other", None, None)]


def test_bucketed_upserts_equal_plain_ones(spark):
    old, new = spark.createDataFrame(OLD_ROWS, OLD), spark.createDataFrame(NEW_ROWS, OLD)
    name = f"layout_{uuid.uuid4().hex}"
    for merge in ("replace", "union"):
        first = keyed.write_bucketed(old, name, ["id"], 4)
        second = keyed.upsert_bucketed(spark, name, first, new, ["id"], 4, maps=["extra"], array_merge=merge)
        got = spark.table(second)
        want = merging.upsert(old.where("id is not null"), new.where("id is not null"), ["id"], ["extra"], merge)
        listed = lambda df: sorted(map(repr, df.collect()))
        assert listed(got.where("id is not null")) == listed(want)
        assert sorted(r.name for r in got.where("id is null").collect()) == ["lost", "other"]
        # a further generation, by way of an empty batch, is the same
        third = keyed.upsert_bucketed(spark, name, second, new.limit(0), ["id"], 4, maps=["extra"], array_merge=merge)
        assert listed(spark.table(third)) == listed(got)
        assert spark.table(first).count() == 4
        for t in (first, second, third):
            spark.sql(f"drop table {t}")


def test_the_stored_side_is_not_shuffled(spark):
    name = f"layout_{uuid.uuid4().hex}"
    stored = spark.range(2000).select(F.col("id").alias("key"), F.lit("s").alias("a"))
    first = keyed.write_bucketed(stored, name, ["key"], 8)
    told = spark.range(1000, 3000).select(F.col("id").alias("key"), F.lit("t").alias("b"))
    merged = keyed.merged_buckets(spark, first, told, ["key"], 8)
    plan = plan_of(merged)
    assert plan.count("\nExchange") + plan.count(") Exchange\n") == 1 and "REPARTITION_BY_NUM" in plan and "Bucketed: true" in plan
    second = keyed.upsert_bucketed(spark, name, first, told, ["key"], 8)
    # each bucket is written by one task, so it is one file
    assert len(spark.table(second).inputFiles()) == 8
    counts = spark.table(second).agg(F.count("*"), F.count("a"), F.count("b")).first()
    assert tuple(counts) == (3000, 2000, 2000)
    for t in (first, second):
        spark.sql(f"drop table {t}")

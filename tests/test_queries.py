"""Every registered query against its SQL on the smallest tables."""

import pytest

from netsift.plans import queries
from netsift.plans.oracle import ORACLE
from netsift.plans.queries import QUERIES
from tests.check import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    pytest.importorskip("duckdb")
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    assert compare(spark, db, name, FOLDER) is None


def test_progress_feed_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """No folder is one task's, and a stream that needs several batches is one row of the result."""
    monkeypatch.setattr(queries, "scratch", lambda _: str(tmp_path / "s"))
    whole = queries.watch

    def small(*args, bytes_per_trigger, **options):
        return whole(*args, bytes_per_trigger=1, **options)

    monkeypatch.setattr(queries, "watch", small)
    found = {r.registry: r for r in queries.ingest_progress(spark, FOLDER).collect()}
    files = [len(list((tmp_path / "s" / "in" / f"part={n}").glob("part-*"))) for n in range(3)]
    assert min(files) > 1
    assert {n: (r.batch, r.done) for n, r in found.items()} == {"north": (1, True), "south": (1, True), "east": (2, True)}


def test_a_day_written_again_is_read_from_its_folder(spark, tmp_path, monkeypatch):
    """The feed is parsed for the first write only."""
    monkeypatch.setattr(queries, "scratch", lambda _: str(tmp_path / "s"))
    written, write = [], queries.tables.write_dated

    def watched(documents, path, *args, **options):
        written.append(documents.inputFiles())
        write(documents, path, *args, **options)

    monkeypatch.setattr(queries.tables, "write_dated", watched)
    queries.dated_snapshots(spark, FOLDER).collect()
    assert all("events.parquet" in f for f in written[0])
    assert written[1] and all("/snapshot_date=" in f for f in written[1])

"""The pipeline's stages and the registered queries."""

import json

import corpus_pipeline
from netsift.llm.queries import ORACLE, QUERIES
from tests.check import normal

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark, odd, tmp_path):
    spark.createDataFrame([(1, "nothing like it at all in here, one hopes so")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, counts = odd, [odd.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == odd.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        counts.append(docs.count())
    ids = [r.doc_id for r in docs.collect()]
    assert 106 not in ids and 100 not in ids and 107 not in ids and 5 in ids and counts == sorted(counts, reverse=True)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() >= len(ids)


def test_run_on_tables(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 50
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), FOLDER).count() == 0


def test_queries_match_their_sql(spark):
    import duckdb

    db = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "labels", "conversations", "embeddings"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    for name, sql in ORACLE.items():
        df = QUERIES[name](spark, FOLDER)
        got = sorted(json.dumps([normal(r[c]) for c in sorted(df.columns)]) for r in df.collect())
        result = db.execute(sql)
        names = [d[0] for d in result.description]
        want = sorted(json.dumps([normal(r[names.index(c)]) for c in sorted(names)]) for r in result.fetchall())
        assert got == want, name

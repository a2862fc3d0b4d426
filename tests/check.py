"""Compare queries with their SQL: python tests/check.py [folder] [query ...]"""

import datetime
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(folder):
    import duckdb

    from netsift.plans.queries import TABLES

    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def normal(v):
    if isinstance(v, float):
        return "null" if math.isnan(v) else round(v, 6)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def compare(spark, db, name, folder):
    """None when equal, else a short account of the difference."""
    from netsift.plans.oracle import ORACLE
    from netsift.plans.queries import QUERIES

    df = QUERIES[name](spark, folder)
    got = [tuple(normal(r[c]) for c in sorted(df.columns)) for r in df.collect()]
    result = db.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    order = [names.index(c) for c in sorted(names)]
    want = [tuple(normal(r[i]) for i in order) for r in result.fetchall()]
    if sorted(got, key=repr) == sorted(want, key=repr):
        return None if got else "no rows"
    extra, missing = set(got) - set(want), set(want) - set(got)
    return f"{len(got)} / {len(want)} rows; extra {sorted(extra, key=repr)[:2]}; missing {sorted(missing, key=repr)[:2]}"


def main():
    from pyspark.sql import SparkSession

    from netsift.plans.queries import QUERIES

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    db = duck(folder)
    for name in sys.argv[2:] or list(QUERIES):
        start = time.time()
        try:
            outcome = compare(spark, db, name, folder)
        except Exception as e:  # noqa: BLE001
            outcome = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{'ok  ' if outcome is None else 'FAIL'} {name} {time.time() - start:.1f}s {outcome or ''}"[:900], flush=True)


if __name__ == "__main__":
    main()

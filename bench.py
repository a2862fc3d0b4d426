"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores. Every query runs whole, its result goes to a no-op sink.
Each runs once to warm up the JVM and then once for the time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from netsift.plans.queries import QUERIES  # noqa: E402

HEADLINE = (
    "port_services", "port_scan_parse", "web_probe_parse", "ptr_documents", "ptr_runs", "ptr_stream_upsert",
    "zone_documents", "certificate_domains", "delegation_blocks", "transfer_rows", "blocklist_documents",
    "mesh_payloads", "geo_enrichment", "listed_events", "longest_network", "text_match", "upsert_merge",
    "ingested_services", "streamed_certificates",
)


def run(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        run(spark, name, folder)
    times = {name: round(run(spark, name, folder), 3) for name in names}
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()

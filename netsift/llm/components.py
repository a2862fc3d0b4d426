"""Connected components of a table of links, by stars around least neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netsift.llm.common import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: larger neighbours move to the least of a node's neighbourhood; small star: the rest do."""
    if large:
        around = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select("b", "a"))
    else:
        around = edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("w"))
    least = around.groupBy("v").agg(F.min("w").alias("m")).select("v", F.least("m", "v").alias("m"))
    # a hub's neighbours are one skewed key of an equality join; none is collected in a group
    met = around.join(least, "v")
    moved = met.where(F.col("w") > F.col("v")) if large else met.where(F.col("w") != F.col("m"))
    out = moved.select(F.col("w").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.union(least.select(F.col("v").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``id, root`` for each id in ``links`` (columns ``a, b``); ``root`` is the least id linked to it.

    Alternates large and small stars until nothing moves; the number of rounds grows with
    the logarithm of the longest path. Each round is written to the shared folder.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        edges = written(_stars(_stars(edges, True), False))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).union(roots)

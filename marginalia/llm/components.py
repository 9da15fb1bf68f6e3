"""Connected components of a table of links, by repeated joins and written tables.

Large-star and small-star steps in turn: each node hangs its larger neighbours, then its smaller
ones and itself, on the smallest node it sees. The links end as stars around the smallest node
of each component, after a number of rounds that grows with the logarithm of the diameter. Only
two numbers come to the driver each round. A hub's links are split by AQE as skewed join keys,
and minima are combined before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, scratch

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a``, ``b``, in either order).

    ``component`` is the smallest node reachable. Self-links and repeated links are harmless;
    null ends are an error of the input. Nodes without links do not appear.
    """
    spark = links.sparkSession

    def settle(df: DataFrame, old: str | None) -> tuple[str, DataFrame, tuple]:
        path = scratch(spark, "links")
        df.distinct().write.parquet(path)
        back = spark.read.schema(df.schema).parquet(path)
        mark = back.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if old:
            drop_path(spark, old)
        return path, back, tuple(mark)

    path, edges, mark = settle(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), None
    )
    for _ in range(MAX_ROUNDS):
        before = mark
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(lowest, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        path, edges, _ = settle(large, path)
        # Each node's smaller neighbours and itself hang on the smallest of them.
        lowest = edges.groupBy("a").agg(F.min("b").alias("m"))
        small = edges.join(lowest, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        path, edges, mark = settle(small.unionByName(lowest.select("a", F.col("m").alias("b"))), path)
        if mark == before:
            break
    else:
        raise RuntimeError("the links did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )

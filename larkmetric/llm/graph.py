"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkmetric.llm.store import stored


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` of every node of ``links`` (``a``, ``b``); the root is the component's smallest node.

    Large-star and small-star steps take turns until nothing moves, about
    log(n) rounds. Each round's links are written to the shared folder. Only a
    count and a checksum reach the driver.
    """
    now = stored(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == before:
            break
        before = mark
        if not mark[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")).select(F.col("a").alias("of"), "m")
        large = both.join(low, F.col("a") == F.col("of")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        # Every link now points down: a's smallest neighbour is its root so far.
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), "m")
        small = large.join(low, F.col("a") == F.col("of")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        small = small.unionByName(low.select(F.col("of").alias("a"), F.col("m").alias("b"))).distinct()
        now = stored(small, "links")
    found = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    roots = found.select(F.col("root").alias("node"), "root").distinct()
    return found.unionByName(roots)

"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step of Kiveris et al., "Connected Components in MapReduce and Beyond" (2014).

    ``edges`` has ``u > v``.  Minima are combined before the shuffle, so a hub is one row.
    """
    around = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = around.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select("v", "m").where("v <> m").toDF("u", "v").unionAll(
            least.select("u", F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of an edge ``u, v``.

    The smallest nodes themselves have no row, nor do nodes without edges.
    """
    now = stored(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges")

    def mark(df: DataFrame) -> tuple:
        # The edge set counts as unchanged if its size and two sums of hashes are.
        h = [F.sum(F.xxhash64("u", "v", F.lit(k)).cast("decimal(38,0)")) for k in (1, 2)]
        return tuple(df.agg(F.count("*"), *h).first())

    seen = mark(now)
    while seen[0]:
        now = stored(_star(_star(now, True), False), "edges")
        after = mark(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))

"""Connected components of links between 64-bit nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import HOT_KEYS, HOT_ROWS, materialize, spread_join


def hot_of(counted: DataFrame, key: str) -> list[int]:
    """Keys that many rows share, from a table with their number ``n``."""
    return [r[0] for r in counted.where(F.col("n") > HOT_ROWS).orderBy(F.desc("n"), key).limit(HOT_KEYS).select(key).collect()]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges, root being the smallest node of its component.

    Large-star and small-star rounds; the neighbours of a hub, which the
    centre of a large component becomes, meet it in many tasks.
    """
    edges = materialize(edges.select("u", "v"), "links")
    mark = None

    def met(pairs: DataFrame, least: Column, label: str) -> DataFrame:
        """``pairs`` with the smallest neighbour m of their u."""
        low = materialize(pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), label)
        return spread_join(pairs, low.select("u", least.alias("m")), ["u"], hot_of(low, "u"), F.col("v"))

    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = met(both, F.least("u", "m"), "links-large").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = materialize(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "links-small", edges)
        stars = met(small, F.col("m"), "links-low")
        stars = stars.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(stars.select("u", F.col("m").alias("v")))
        edges = materialize(stars.where("u <> v").distinct(), "links", small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))

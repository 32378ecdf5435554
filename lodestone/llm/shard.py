"""Sharding by histogram sort, under the law ``bytes``.

A row's key is a hash of its text, so equal texts have equal keys and share a
shard. Splitters between the shards are found as in histogram sort: candidate
boundaries are probed, the exact bytes below each are counted over all
partitions, and the intervals that hold a splitter are probed again, finer,
until every splitter is within ``TOLERANCE`` of its target. Only then rows are
exchanged, once.

Groups of equal texts that are large for a shard (over ``HEAVY`` of its even
share; there are fewer than shards / HEAVY of them) are placed before, largest
first, on the emptiest shard, and the splitters fill up the others.

Defined results: a null text counts as empty (size 1); ties of the key stay
together; a group that alone exceeds the even share still stays whole, and the
other shards share the rest evenly; repeated rows each get a slot; an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import count_at_or_below, documents, fresh, materialize, text_or_empty

SHARDS = 16
TOLERANCE = 0.001
HEAVY = 0.01
#: Probes for each splitter and round.
PROBES = 48
#: Rows numbered together when slots are given out.
ROWS_PER_BIN = 200_000
LOW, HIGH = -(1 << 63), (1 << 63) - 1


@dataclass
class Plan:
    """Where keys go: placed heavy keys, and splitters for all others."""

    shards: int
    splitters: list[int]
    heavy: dict[int, int]
    rows: int
    rounds: int

    def shard(self, spark: SparkSession, rows: DataFrame, key: str, name: str = "shard") -> DataFrame:
        """``rows`` with the shard of their key as the column ``name``."""
        light = count_at_or_below(self.splitters, F.col(key))
        if not self.heavy:
            return rows.withColumn(name, light.cast("int"))
        heavy, to = fresh([*rows.columns, name], "heavy_key", "heavy_to")
        placed = spark.createDataFrame(list(self.heavy.items()), f"{heavy} long, {to} int")
        joined = rows.join(F.broadcast(placed), rows[key] == placed[heavy], "left")  # under shards / HEAVY rows
        return joined.withColumn(name, F.coalesce(to, light).cast("int")).drop(heavy, to)


def text_key(name: str = "text") -> Column:
    return F.xxhash64(text_or_empty(name))


def size_rows(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), text_key().alias("key"))


def _place(groups: list[tuple[int, int]], shards: int, total: int) -> tuple[dict[int, int], list[float]]:
    """Heavy groups largest first on the emptiest shard; what each shard then takes of the rest."""
    load, placed = [0] * shards, {}
    for key, size in sorted(groups, key=lambda g: (-g[1], g[0])):
        at = min(range(shards), key=lambda s: (load[s], s))
        placed[key], load[at] = at, load[at] + size
    rest, order = total - sum(load), sorted(load)
    for n in range(shards, 0, -1):  # the n least loaded shards are filled to one level
        level = (rest + sum(order[:n])) / n
        if level >= order[n - 1]:
            break
    return placed, [max(0.0, level - x) for x in load]


def plan_shards(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> Plan:
    """Splitters for rows of (key, size), by rounds of exact histograms."""
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    even = max(total / shards, 1.0)
    groups = rows.groupBy("key").agg(F.sum("size").alias("size")).where(F.col("size") > even * HEAVY).collect()
    heavy, wanted = _place([(g["key"], g["size"]) for g in groups], shards, total)
    light = rows.where(~F.col("key").isin(list(heavy))) if heavy else rows
    goals, below = [], 0.0
    for want in wanted[:-1]:
        below += want
        goals.append(below)
    low, high = [(LOW, 0)] * len(goals), [(HIGH, total)] * len(goals)
    found: list[int | None] = [None] * len(goals)
    rounds = 0
    while any(x is None for x in found):
        probes = sorted({low[i][0] + (high[i][0] - low[i][0]) * k // (PROBES + 1) for i, x in enumerate(found) if x is None for k in range(1, PROBES + 1)})
        bins = light.groupBy(count_at_or_below(probes, F.col("key")).alias("bin")).agg(F.sum("size").alias("size")).collect()
        counted, below = dict(map(tuple, bins)), 0
        at = []
        for b, probe in enumerate(probes):  # bytes of keys under each probe
            below += counted.get(b, 0)
            at.append((probe, below))
        for i, goal in enumerate(goals):
            if found[i] is None:
                low[i] = max([low[i], *(x for x in at if x[1] <= goal)], key=lambda x: (x[1], x[0]))
                high[i] = min([high[i], *(x for x in at if x[1] > goal)], key=lambda x: (x[1], x[0]))
                near = min((low[i], high[i]), key=lambda x: abs(x[1] - goal))
                if abs(near[1] - goal) <= tolerance * even or high[i][0] - low[i][0] <= 1:
                    found[i] = near[0]
        rounds += 1
    return Plan(shards, sorted(found), heavy, n_rows, rounds)


def shard_rows(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    rows = materialize(size_rows(docs), "shard-sizes")
    plan = plan_shards(rows, shards)
    placed = plan.shard(docs.sparkSession, rows, "key")
    bins = max(16, -(-plan.rows // (shards * ROWS_PER_BIN)))
    placed = placed.withColumn("bin", F.pmod(F.xxhash64("doc_id", "key"), F.lit(bins)).cast("int"))
    # One exchange: a bin of a shard is numbered on its own and shifted by the counts of the bins before it (shards x bins rows).
    counts = placed.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    here = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("doc_id", "key", "size"))
    numbered = placed.withColumn("__here", here).join(F.broadcast(starts), ["shard", "bin"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("__here") - 1).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> str:
    """Write ``docs`` with all columns into a folder for each shard, one exchange of the texts; the name of the folders' column.

    That is ``shard``, with underscores if ``docs`` has such a column.
    """
    rows = materialize(size_rows(docs), "shard-sizes")
    plan = plan_shards(rows, shards)
    key, name = fresh(docs.columns, "key_of_text", "shard")
    placed = plan.shard(docs.sparkSession, docs.withColumn(key, text_key()), key, name).drop(key)
    bins = max(1, -(-plan.rows // (shards * ROWS_PER_BIN)))
    placed.repartition(shards * bins, name, F.pmod(F.xxhash64("doc_id"), F.lit(bins))).write.partitionBy(name).parquet(path)
    return name


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_rows(documents(spark, sf_dir))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

"""Streaming counters over a folder of event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Parts of a counter's table that lie beside each other until they become one.
PARTS = 24


def read_stream(spark: SparkSession, path: str, schema: StructType, files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def popularity(events: DataFrame, delay: str = "1 hour", width: str = "1 hour") -> DataFrame:
    """Counts and sums a window and event type; with append or update output, state is dropped behind the watermark."""
    windowed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).groupBy(F.window("ts", width), "event_type")
    return windowed.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def _whole(spark: SparkSession, folder: str, name: str) -> dict[int, str]:
    """Tables ``name``-number below the folder that were written whole, by number."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}-*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    paths = [str(f.getPath().getParent().toString()) for f in found]
    return {int(p.rsplit("-", 1)[1]): p for p in paths}


def newest(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Each window's latest row and its ``batch``: of the last base, and of the parts after it."""
    bases, parts = _whole(spark, folder, "base"), _whole(spark, folder, "part")
    last = max(bases, default=-1)
    paths = [bases[n] for n in bases if n == last] + [parts[n] for n in sorted(parts) if n > last]
    if not paths:
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(0).cast("long"))
    order = Window.partitionBy("start", "event_type").orderBy(F.desc("batch"))
    return spark.read.parquet(*paths).withColumn("__rn", F.row_number().over(order)).where("__rn = 1").drop("__rn")


def compact(spark: SparkSession, folder: str, number: int, schema: StructType) -> None:
    """The parts up to ``number`` and the base before them become a base; what the base before the last one covered is deleted.

    A base counts once it is whole, and its parts stay until the next one, so
    a repeated batch or a reader at work finds all it needs.
    """
    bases = _whole(spark, folder, "base")
    if number not in bases:
        newest(spark, folder, schema).write.mode("overwrite").parquet(f"{folder}/base-{number}")
    before = max((n for n in bases if n < number), default=None)
    if before is None:
        return
    covered = [p for n, p in bases.items() if n < before] + [p for n, p in _whole(spark, folder, "part").items() if n <= before]
    for path in map(spark._jvm.org.apache.hadoop.fs.Path, covered):
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run_to_table(counted: DataFrame, folder: str) -> DataFrame:
    """Run a counter over all files there are; its newest rows, kept in ``folder``.

    Update mode: a batch writes only the windows that it changed, into a part
    of its own, which a repeated batch replaces. Every ``PARTS`` batches the
    parts become one base, so a reader ranks that and few parts however long
    the stream runs, and never meets a half-written table.
    """
    spark, table, schema = counted.sparkSession, f"{folder}/table", counted.schema

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{table}/part-{number}")
        if (number + 1) % PARTS == 0:
            compact(batch.sparkSession, table, number, schema)

    run = counted.writeStream.outputMode("update").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(keep).start()
    run.awaitTermination()
    return newest(spark, table, schema).drop("batch")

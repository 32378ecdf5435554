"""Helpers shared by the training-data operators.

Whitespace is the set ``[\\x20\\x09-\\x0D]`` everywhere in this subpackage.
Tables that cut lineage are written as Parquet into the folder that
``spark.checkpoint.dir`` names, which all executors share.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


#: A key of more rows than this is dealt to ``SALTS`` tasks by :func:`spread_join`; at most ``HOT_KEYS`` keys, the most frequent ones.
HOT_ROWS = 500
HOT_KEYS = 10_000
SALTS = 64


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a folder of its own only where none is set and all tasks run in this process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lodestone-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/") + "/lodestone"


def materialize(df: DataFrame, label: str, *done_with: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that later steps don't recompute it.

    Tables of earlier calls in ``done_with``, which nothing needs from here on, are deleted.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    for old in done_with:
        discard(old)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a materialised table."""
    spark = df.sparkSession
    base = scratch_dir(spark)
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.toString().split(":", 1)[-1].lstrip("/").startswith(base.split(":", 1)[-1].lstrip("/")):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores as it takes to differ from all ``columns``."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def hot_keys(rows: DataFrame, key: str) -> list[int]:
    """Keys (long) of more than ``HOT_ROWS`` rows, the ``HOT_KEYS`` most frequent at most."""
    n = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > HOT_ROWS)
    return [r[0] for r in n.orderBy(F.desc("n_rows"), key).limit(HOT_KEYS).collect()]


def spread_join(many: DataFrame, one: DataFrame, on: list[str], hot: list[int], by: Column, how: str = "inner") -> DataFrame:
    """``many`` joined to ``one``, which has few rows a key; rows of ``many`` with a hot ``on[0]`` are dealt to ``SALTS`` tasks by ``by``."""
    if not hot:
        return many.join(one, on, how)
    [salt] = fresh([*many.columns, *one.columns], "salt")
    is_hot = F.col(on[0]).isin(hot)
    dealt = many.withColumn(salt, F.when(is_hot, F.pmod(F.xxhash64(by), F.lit(SALTS))).otherwise(F.lit(0)).cast("int"))
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(one.withColumn(salt, F.explode(every)), [*on, salt], how).drop(salt)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def word_count(name: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(name), F.lit(WORD)), F.lit(0)).cast("long")


def long_array(values: Iterable[int]) -> Column:
    """A constant ``array<bigint>``; one literal after constant folding, however many values."""
    values = [str(int(v)) for v in values]
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(values)), ",").cast("array<bigint>")


def count_at_or_below(bounds: list[int], x: Column) -> Column:
    """How many of the ascending ``bounds`` are <= ``x``, by binary search inside the plan (null: 0)."""
    if not bounds:
        return F.lit(0).cast("int")
    table, n = long_array(bounds), len(bounds)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when((at + step <= n) & (F.get(table, at + step - 1) <= x), at + step).otherwise(at),
    )


def number_rows(df: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """Gapless positions from 0 in a global order, without a single-task window.

    Rows are range-partitioned and written once; each partition is numbered
    on its own and shifted by the exact counts of the partitions before it
    (one row a partition, so the broadcast side is bounded).
    """
    part, n, start = fresh([*df.columns, name], "part", "part_rows", "part_start")
    laid = materialize(df.repartitionByRange(*order).select("*", F.spark_partition_id().alias(part)), label)
    counts = laid.groupBy(part).agg(F.count(F.lit(1)).alias(n))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start))
    here = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    return laid.join(F.broadcast(starts), part).withColumn(name, (F.col(start) + here - 1).cast("long")).drop(part, start)


def text_blocks(batch, column: str, limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of an Arrow batch that hold about ``limit`` bytes of text, one row at least."""
    from itertools import accumulate

    sizes = batch.column(column).nbytes / max(1, batch.num_rows)
    if sizes * batch.num_rows <= limit:
        if batch.num_rows:
            yield 0, batch.num_rows
        return
    import pyarrow.compute as pc

    ends = list(accumulate(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()))
    start, base = 0, 0
    for i, end in enumerate(ends):
        if end - base > limit and i > start:
            yield start, i
            start, base = i, ends[i - 1]
    yield start, len(ends)

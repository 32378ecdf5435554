"""Reading and writing tables: schemas are declared or checked, never inferred from text."""

from __future__ import annotations

import hashlib
import json
import os
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shared_folder(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names; one of its own only where none is set and all tasks run in this process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lodestone-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder in the shared one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that later steps don't make it again."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that :func:`written` wrote; tables elsewhere stay."""
    spark = df.sparkSession
    base = shared_folder(spark).split(":", 1)[-1].lstrip("/")
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.toString().split(":", 1)[-1].lstrip("/").startswith(base):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def store_once(spark: SparkSession, name: str, make: Callable[[], DataFrame], by: str | None = None) -> DataFrame:
    """The table of this name in the shared folder; made where there is none yet, with a folder for each value of ``by``.

    It is written beside and moved in whole, so no reader finds a part of it;
    of two writers at once the first wins.
    """
    final = f"{shared_folder(spark)}/{name}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    files = jvm_path(final).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(jvm_path(f"{final}/_SUCCESS")):
        path = scratch(spark, name)
        made = make()
        (made.write.partitionBy(by) if by else made.write).parquet(path)
        if not files.rename(jvm_path(path), jvm_path(final)) or not files.exists(jvm_path(f"{final}/_SUCCESS")):
            final = path
    return spark.read.parquet(final)


def source_key(df: DataFrame) -> str:
    """What a table is made of: the files it reads, with their sizes and times, and its plan; where anything else goes into it, its :func:`fingerprint`.

    No row is read for it. Files that change, or another plan over them, give
    another key.
    """
    spark = df.sparkSession
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    names = [leaves.apply(i).nodeName() for i in range(leaves.size())]
    text = plan.canonicalized().toString()
    folders = sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()})
    if not folders or not all("Relation" in n and "Local" not in n for n in names) or any(word in text for word in ("Python", "InArrow", "InPandas", "ScalaUDF", "rand(", "uuid(")):
        return fingerprint(df)
    jvm_path, told = spark._jvm.org.apache.hadoop.fs.Path, []
    for folder in folders:
        path = jvm_path(folder)
        for status in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path):
            told.append(f"{status.getPath()}|{status.getLen()}|{status.getModificationTime()}")
    return "|".join([*sorted(told), re.sub(r"#\d+L?", "", text), str(df.semanticHash()), df.schema.simpleString()])


def fingerprint(df: DataFrame) -> str:
    """A digest of a table's rows in any order, repeats counted: number of rows, sum and exclusive or of two 64-bit hashes."""
    row = F.struct(*[F.col(c) for c in sorted(df.columns)])
    total = F.sum(F.xxhash64(row).cast("decimal(38,0)"))
    return "|".join(map(str, df.agg(F.count(F.lit(1)), total, F.bit_xor(F.xxhash64(row, F.lit(7)))).first()))


#: Rows of a leaf of an ordered digest.
LEAF = 4096


def ordered_digest(df: DataFrame, order: str = "row_idx", n: int | None = None, leaf: int = LEAF) -> str:
    """A digest of a table's rows in the order of their positions (0, 1, ...), or of the first ``n`` of them.

    Rows lie in leaves by position; a leaf's digest is that of its rows'
    digests in order, and the digests of up to ``leaf`` leaves make one of the
    next level, until one is left. Every level is a grouping, so no task holds
    more than a leaf. Two tables whose first n rows are the same, in the same
    order, have the same digest of n, whatever their partitions. ValueError
    where positions repeat, are missing or don't start at 0.
    """
    rows = df if n is None else df.where(F.col(order) < n)
    row = F.to_json(F.struct(*[F.col(c) for c in sorted(rows.columns)]), {"ignoreNullFields": "false"})
    level = rows.select(F.col(order).cast("long").alias("at"), F.sha2(row, 256).alias("digest"))
    found = level.agg(F.count(F.lit(1)).alias("n"), F.min("at"), F.max("at")).first()
    if found[0] and (found[1] != 0 or found[2] != found[0] - 1 or not level.groupBy("at").count().where("count > 1").isEmpty()) or n is not None and found[0] != n:
        raise ValueError("positions must be 0, 1, ... and as many as are asked for")
    size = found[0]
    while size > 1:
        inner = F.array_sort(F.collect_list(F.struct(F.col("at"), F.col("digest"))))
        level = level.groupBy(F.floor(F.col("at") / leaf).cast("long").alias("up")).agg(inner.alias("own")).select(F.col("up").alias("at"), F.sha2(F.array_join("own.digest", ""), 256).alias("digest"))
        size = -(-size // leaf)
    last = level.first()
    return hashlib.sha256(f"{found[0]}|{','.join(sorted(rows.columns))}|{last['digest'] if last else ''}".encode()).hexdigest()


def require_prefix(corpus: DataFrame, items: DataFrame, order: str = "row_idx", leaf: int = LEAF) -> int:
    """The corpus's number of rows, if its rows are the first of ``items``, in order; else ValueError. Columns are those of the corpus."""
    n = corpus.count()
    first = items.select(*corpus.columns)
    if first.where(F.col(order) < n).count() != n or ordered_digest(corpus, order, n, leaf) != ordered_digest(first, order, n, leaf):
        raise ValueError("the corpus is not a prefix of the items")
    return n


def row_counts(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    """(name, n_rows, n_columns) of tables. The scans read no column: Spark takes the counts from the files' footers."""
    out = None
    for name in names:
        t = table(spark, sf_dir, name)
        own = t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("name"), "n_rows", F.lit(len(t.columns)).cast("long").alias("n_columns"))
        out = own if out is None else out.unionByName(own)
    return out


def require(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def with_row_index(df: DataFrame, *order: str) -> DataFrame:
    """Position of each row by these columns, as ``row_idx``; the rows are dealt to ranges and written once, then numbered by range and shifted."""
    part = written(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "row-index")
    counts = part.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    here = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return part.join(F.broadcast(starts), "__part").withColumn("row_idx", (F.col("__start") + here - 1).cast("long")).drop("__part", "__start")  # a row a partition


def appended(corpus: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    """Items after the corpus (row_idx), in the order of their key; those of the corpus keep their positions and come first."""
    last = corpus.agg(F.coalesce(F.max("row_idx") + 1, F.lit(0))).first()[0]
    new = with_row_index(extra.join(corpus.select(key), key, "left_anti").dropDuplicates([key]), key)
    return corpus.unionByName(new.withColumn("row_idx", F.col("row_idx") + F.lit(last)))


def head(df: DataFrame, n: int, order: str = "row_idx") -> DataFrame:
    """The first ``n`` positions of a table with a row index: a filter, no sort."""
    return df.where(F.col(order) < n)


def number(c: Column) -> Column:
    """A number, or null where the text is none."""
    return c.try_cast("double")


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """Answer CSV (query_id, answer), all strings; an empty answer stays empty."""
    lines = spark.read.text(path).where((F.col("value") != "query_id,answer") & (F.col("value") != ""))
    parts = F.split("value", ",", 2)
    if not lines.where(F.size(parts) != 2).isEmpty():
        raise ValueError("a line of the answer file has no comma")
    return lines.select(parts[0].alias("query_id"), F.regexp_replace(parts[1], '^"(.*)"$', "$1").alias("answer"))


def write_answers(answers: DataFrame, path: str) -> None:
    """One sorted CSV part with a header; the commit makes it visible whole or not at all."""
    rows = answers.select("query_id", "answer").repartitionByRange(1, "query_id").sortWithinPartitions("query_id")
    rows.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_features(features: DataFrame, path: str) -> None:
    """Features of each query together, sorted by (qid, item_idx), as zstd Parquet; numbers other than keys as 32-bit floats."""
    keys = ("qid", "item_idx", "label")
    small = [F.col(c) if c in keys else F.col(c).cast("float").alias(c) for c in require(features, "qid", "item_idx").columns]
    features.select(*small).repartition("qid").sortWithinPartitions("qid", "item_idx").write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_feature_batches(queries: DataFrame, build: Callable[[DataFrame], DataFrame], path: str, size: int = 200, by: str = "qid") -> DataFrame:
    """Features of all queries, built and written batch by batch, so that a run that ended early goes on.

    A batch is ``size`` queries in the order of ``by``, one Parquet folder that
    is whole or absent: it is written beside and moved in. The first batch fixes
    the schema, which a manifest keeps with the batches' bounds; a batch of
    another schema, a missing query's rows aside, is refused, and so is a folder
    whose manifest has other queries or another size. Batches that are there
    are not built again.
    """
    spark = queries.sparkSession
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    files = jvm_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    placed = with_row_index(queries.select(by).distinct(), by).withColumn("batch", F.floor(F.col("row_idx") / size).cast("long"))
    placed = written(placed.select(by, "batch"), "feature-queries")
    n = placed.agg(F.count(F.lit(1)), F.coalesce(F.max("batch"), F.lit(-1))).first()
    said = {"queries": fingerprint(placed), "size": size, "batches": n[1] + 1}
    manifest = f"{path}/manifest"

    def keep(told: dict) -> None:
        beside = f"{path}/_manifest-{uuid.uuid4().hex}"
        spark.createDataFrame([(json.dumps(told, sort_keys=True),)], "told string").coalesce(1).write.parquet(beside)
        files.delete(jvm_path(manifest), True)
        files.rename(jvm_path(beside), jvm_path(manifest))

    told = json.loads(spark.read.parquet(manifest).first()[0]) if files.exists(jvm_path(f"{manifest}/_SUCCESS")) else {**said, "schema": None}
    if {k: told[k] for k in said} != said:
        raise ValueError("the folder holds features of other queries or of another batch size")
    if told["schema"] is None:
        keep(told)
    for batch in range(n[1] + 1):
        final = f"{path}/features/batch={batch}"
        if files.exists(jvm_path(f"{final}/_SUCCESS")):
            continue
        own = build(queries.join(placed.where(F.col("batch") == batch).select(by), by, "left_semi"))
        schema = own.schema.simpleString()
        if told["schema"] is None:
            told["schema"] = schema
            keep(told)
        elif told["schema"] != schema:
            raise ValueError(f"batch {batch} has another schema than the first")
        beside = f"{path}/_batch-{uuid.uuid4().hex}"
        write_features(own, beside)
        files.mkdirs(jvm_path(f"{path}/features"))
        files.rename(jvm_path(beside), jvm_path(final))
    discard(placed)
    return spark.read.parquet(f"{path}/features").drop("batch")


def check_vectors(vectors: DataFrame, dims: int, tolerance: float = 1e-4) -> DataFrame:
    """Counts of vectors that are not finite, not of ``dims`` numbers, or not of unit length."""
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vectors.agg(
        F.count(F.lit(1)).alias("n_vectors"),
        F.coalesce(F.sum((F.size("embedding") != dims).cast("long")), F.lit(0)).alias("wrong_size"),
        F.coalesce(F.sum(F.exists("embedding", odd).cast("long")), F.lit(0)).alias("not_finite"),
        F.coalesce(F.sum((F.abs(norm - 1) > tolerance).cast("long")), F.lit(0)).alias("not_unit"),
    )


def load_vectors(spark: SparkSession, path: str, dims: int, ids: DataFrame) -> DataFrame:
    """Vectors (item_id, embedding) that are sound and belong to exactly the items of ``ids`` (item_id)."""
    vectors = require(spark.read.parquet(path), "item_id", "embedding")
    wrong = {k: v for k, v in check_vectors(vectors, dims).first().asDict().items() if k != "n_vectors" and v}
    if wrong:
        raise ValueError(f"vectors are not sound: {wrong}")
    if vectors.select("item_id").exceptAll(ids.select("item_id")).unionByName(ids.select("item_id").exceptAll(vectors.select("item_id"))).head(1):
        raise ValueError("vectors and items differ")
    return vectors

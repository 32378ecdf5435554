"""Exact deduplication: sorted runs of digests, merged up a binomial tree.

Every input partition sorts the digests of its rows into a run and keeps one
entry of each: the smallest identifier and a count. Runs then merge in
rounds. In round k the ``FAN_IN`` runs whose numbers agree above the lowest
``k * log2(FAN_IN)`` bits become one run: their sorted entries meet by (parent
run, digest), so a merged run is itself spread over many tasks, and a sorted
aggregation walks them and keeps the smallest identifier of equal entries.
Entries are equal only if the SHA-256, the length and a second, independent
hash of the text agree, at every level. The last round leaves one run, whose
entries are the groups.

Defined results: a null text counts as empty; a null doc_id sorts after all
others; rows that repeat both doc_id and text count one by one in
``group_size`` and exactly one of them is kept; an empty table gives an empty
result; further columns of the input stay out of the digest and are carried by
:func:`drop_copies` only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import HOT_KEYS, HOT_ROWS, documents, fresh, materialize, spread_join, text_or_empty

#: Runs merged in one round; a power of two.
FAN_IN = 16
#: What equal texts agree in. The second hash comes first: joins on hot keys are dealt out by a long.
KEY = ["twin", "digest", "n_bytes"]


def normalized(name: str = "text") -> Column:
    """Each run of whitespace as one space. Single spaces, which most runs are, stay as they stand."""
    return F.regexp_replace(text_or_empty(name), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def digest_rows(docs: DataFrame) -> DataFrame:
    """doc_id, run (input partition), row (number of the row) and ``KEY`` of each row; to be materialised, for ``row`` to last."""
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalized().alias("norm"), F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("row"))
    return text.select("doc_id", "run", "row", F.xxhash64("norm").alias("twin"), F.unhex(F.sha2("norm", 256)).alias("digest"), F.octet_length("norm").alias("n_bytes"))


def merge_runs(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """``KEY``, smallest (struct no_id, doc_id, row) and group_size from digest rows, by rounds of multiway merges of sorted runs.

    The smallest entry is a struct, which Spark aggregates over sorted input
    only: each task sorts its entries before the exchange (a run) and after it
    (the merge), and never builds a hash table of them.
    """
    bits = fan_in.bit_length() - 1
    last = rows.agg(F.max("run")).first()[0] or 0
    entry = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")
    runs = rows.select("run", *KEY, entry.alias("smallest"), F.lit(1).cast("long").alias("group_size"))
    while True:
        parent = F.shiftright("run", bits).alias("run")
        runs = runs.groupBy(parent, *KEY).agg(F.min("smallest").alias("smallest"), F.sum("group_size").alias("group_size"))
        last >>= bits
        if last == 0:
            return runs.drop("run")


def marked_rows(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept and ``KEY``."""
    rows = materialize(digest_rows(docs), "exact-digests")
    # Rows of texts that occur once need no join; the others meet their group, those of large groups in many tasks.
    groups = materialize(merge_runs(rows).where("group_size > 1"), "exact-groups")
    hot = groups.where(F.col("group_size") > HOT_ROWS).orderBy(F.desc("group_size"), "twin").limit(HOT_KEYS).select("twin").distinct()
    met = spread_join(rows, groups, KEY, [r[0] for r in hot.collect()], F.col("row"), "left")
    alone = F.col("group_size").isNull()
    return met.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("smallest.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("smallest.row"))).alias("kept"),
        *KEY,
    )


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    return marked_rows(docs).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    marked = materialize(marked_rows(docs), "exact-marks")
    later = ~F.col("doc_id").eqNullSafe(F.col("keep_id"))
    digest, gone_id, gone = fresh(docs.columns, "digest", "gone_id", "gone")
    dropped = marked.where(later).select(F.col("doc_id").alias(gone_id), F.col("digest").alias(gone)).distinct()
    keyed = docs.withColumn(digest, F.unhex(F.sha2(normalized(), 256)))
    rest = keyed.join(dropped, F.col("doc_id").cast("long").eqNullSafe(F.col(gone_id)) & (F.col(digest) == F.col(gone)), "left_anti")
    if not marked.where(~later & ~F.col("kept")).isEmpty():
        rest = rest.dropDuplicates(["doc_id", digest])  # rows that repeat the kept one
    return rest.select(*docs.columns)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(documents(spark, sf_dir))


OP4_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       CAST(count(*) OVER (PARTITION BY text_sha256) AS BIGINT) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM t
"""

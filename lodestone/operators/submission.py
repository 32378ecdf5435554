"""Answers: building, writing and checking them, and the contract of candidate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import require_prefix, write_answers

ITEM_ID = r"\A[0-9a-f]{16}\z"


def answers(ranked: DataFrame, queries: DataFrame, k: int = 50) -> DataFrame:
    """(qid, answer): item ids by rank, joined by one space; queries without candidates have an empty answer."""
    ids = F.transform(F.array_sort(F.collect_list(F.when(F.col("rank") <= k, F.struct("rank", "item_id")))), lambda s: s["item_id"].cast("string"))
    rows = ranked.groupBy("qid").agg(F.array_join(ids, " ").alias("answer"))
    return queries.select("qid").join(rows, "qid", "left").select("qid", F.coalesce("answer", F.lit("")).alias("answer"))


def check_answers(given: DataFrame, queries: DataFrame, items: DataFrame | None = None, most: int = 50, item_id: str = ITEM_ID) -> dict:
    """Statistics of valid answers (query_id, answer); ValueError names what is wrong."""
    if sorted(given.columns) != ["answer", "query_id"]:
        raise ValueError("answers have the two columns query_id and answer")
    ids = F.when(F.col("answer") == "", F.array().cast("array<string>")).otherwise(F.split("answer", " "))
    rows = given.withColumn("ids", ids)
    bad = rows.agg(
        F.sum(F.col("query_id").isNull().cast("long")).alias("a query_id is null"),
        (F.count("query_id") - F.count_distinct("query_id")).alias("query_ids repeat"),
        F.sum(F.col("answer").isNull().cast("long")).alias("an answer is null"),
        F.sum((F.size("ids") > most).cast("long")).alias("an answer is too long"),
        F.sum(F.exists("ids", lambda x: ~x.rlike(item_id)).cast("long")).alias("an item id is malformed"),
        F.sum((F.size(F.array_distinct("ids")) != F.size("ids")).cast("long")).alias("an item repeats"),
    ).first()
    for what, n in bad.asDict().items():
        if n:
            raise ValueError(f"{what} ({n})")
    if not queries.join(given, "query_id", "left_anti").isEmpty() or not given.join(queries, "query_id", "left_anti").isEmpty():
        raise ValueError("the answers don't cover the queries exactly")
    if items is not None and not rows.select(F.explode("ids").alias("item_id")).join(items, "item_id", "left_anti").isEmpty():
        raise ValueError("an item is not in the corpus")
    return answer_stats(given).first().asDict()


def publish(given: DataFrame, queries: DataFrame, items: DataFrame, path: str, most: int = 50) -> dict:
    """Write answers that are valid; their statistics. Nothing is written of others."""
    stats = check_answers(given, queries, items, most)
    write_answers(given, path)
    return stats


def answer_stats(given: DataFrame) -> DataFrame:
    n = F.when(F.col("answer") == "", 0).otherwise(F.size(F.split("answer", " "))).cast("long")
    rows = given.select(n.alias("n"), F.explode_outer(F.when(F.col("answer") != "", F.split("answer", " "))).alias("item_id"), "query_id" if "query_id" in given.columns else F.col("qid").alias("query_id"))
    per = rows.groupBy("query_id").agg(F.first("n").alias("n"))
    return per.agg(F.count(F.lit(1)).alias("queries"), F.sum((F.col("n") == 0).cast("long")).alias("empty_answers"), F.min("n").alias("min_items"), F.max("n").alias("max_items"), F.avg("n").alias("mean_items"), F.sum("n").alias("total_items"))


def check_candidates(candidates: DataFrame, n_queries: int, n_items: int) -> DataFrame:
    """One row of counts, all 0 for a valid table: pairs that repeat, positions out of range, queries without candidates."""
    repeated = candidates.groupBy("qid", "item_idx").count().agg(F.coalesce(F.sum((F.col("count") > 1).cast("long")), F.lit(0)).alias("repeated"))
    rest = candidates.agg(
        F.coalesce(F.sum(((F.col("qid") < 0) | (F.col("qid") >= n_queries) | F.col("qid").isNull()).cast("long")), F.lit(0)).alias("bad_qid"),
        F.coalesce(F.sum(((F.col("item_idx") < 0) | (F.col("item_idx") >= n_items) | F.col("item_idx").isNull()).cast("long")), F.lit(0)).alias("bad_item"),
        (F.lit(n_queries) - F.count_distinct("qid")).alias("uncovered"),
    )
    return repeated.crossJoin(rest)  # one row each


def require_candidates(candidates: DataFrame, queries: DataFrame, corpus: DataFrame, items: DataFrame, order: str = "row_idx") -> int:
    """The number of candidates (qid, item_idx) of exactly the queries asked (qid), of positions in the corpus, each once; else ValueError.

    ``corpus`` must be the first rows of ``items``, in order, so that positions
    mean the same in both.
    """
    n = require_prefix(corpus, items, order)
    found = candidates.select("qid", "item_idx")
    ids = queries.select("qid").distinct()
    if not found.join(ids, "qid", "left_anti").isEmpty() or not ids.join(found, "qid", "left_anti").isEmpty():
        raise ValueError("the candidates are not those of the queries")
    if not found.where(F.col("item_idx").isNull() | (F.col("item_idx") < 0) | (F.col("item_idx") >= n)).isEmpty():
        raise ValueError("a candidate is not in the corpus")
    if not found.groupBy("qid", "item_idx").count().where("count > 1").isEmpty():
        raise ValueError("a candidate is there twice")
    return found.count()

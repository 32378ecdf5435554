"""Deterministic rankings: score descending, then position ascending, exact at the boundary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(scores: DataFrame, k: int, by: str = "qid", score: str = "score", tie: str = "item_idx", rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group; Spark cuts each task's rows to k a group before they move."""
    order = Window.partitionBy(by).orderBy(F.desc(score), F.asc(tie))
    return scores.withColumn(rank, F.row_number().over(order).cast("long")).where(F.col(rank) <= k)


def rank_score(rank: Column) -> Column:
    """1 / sqrt(rank) of a rank from 1; 0 where there is none."""
    return F.coalesce(1 / F.sqrt(rank.cast("double")), F.lit(0.0))


def z_score(df: DataFrame, score: str, name: str, by: str = "qid") -> DataFrame:
    """Standard score within a query, population deviation; 0 where all are equal."""
    w = Window.partitionBy(by)
    mean, sd = F.avg(score).over(w), F.stddev_pop(score).over(w)
    return df.withColumn(name, F.when(sd > 0, (F.col(score) - mean) / sd).otherwise(0.0))


def normalize_weights(weights: list[float] | None, n: int) -> list[float]:
    """Weights that sum to 1 (equal where none are given)."""
    weights = [1.0] * n if weights is None else [float(w) for w in weights]
    total = sum(weights)
    if len(weights) != n or any(w < 0 or w != w for w in weights) or not 0 < total < float("inf"):
        raise ValueError("weights must be finite, not negative, one a model, with a positive finite sum")
    return [w / total for w in weights]


def blend(df: DataFrame, scores: list[str], weights: list[float] | None = None, name: str = "score") -> DataFrame:
    """Weighted sum of standard scores."""
    for s in scores:
        df = z_score(df, s, f"__z_{s}")
    total = sum((F.col(f"__z_{s}") * w for s, w in zip(scores, normalize_weights(weights, len(scores)), strict=True)), F.lit(0.0))
    return df.withColumn(name, total).drop(*[f"__z_{s}" for s in scores])


def weighted_median(df: DataFrame, by: str, value: str, weight: str, name: str) -> DataFrame:
    """Lower weighted median: the first value at which the running weight reaches half."""
    w = Window.partitionBy(by).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = df.groupBy(by, value).agg(F.sum(weight).alias("__w"))
    run = summed.withColumns({"__run": F.sum("__w").over(w), "__all": F.sum("__w").over(Window.partitionBy(by))})
    return run.where(F.col("__run") >= F.col("__all") / 2).groupBy(by).agg(F.min(value).alias(name))

"""Joins that hold to their cardinality, and assertions on splits; each names what is wrong."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, on: list[str], what: str) -> DataFrame:
    """``df`` if its keys don't repeat; ValueError else."""
    if df.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where("n > 1").head(1):
        raise ValueError(f"{what}: keys {on} repeat")
    return df


def one_to_one(left: DataFrame, right: DataFrame, on: list[str], whole: bool = False) -> DataFrame:
    """Inner join of tables whose keys are unique; ``whole``: neither side may lose a row."""
    unique(left, on, "left side")
    unique(right, on, "right side")
    if whole and (left.join(right, on, "left_anti").head(1) or right.join(left, on, "left_anti").head(1)):
        raise ValueError(f"both sides need the same keys {on}")
    return left.join(right, on)


def many_to_one(many: DataFrame, one: DataFrame, on: list[str]) -> DataFrame:
    """Inner join of any rows to a table whose keys are unique."""
    return many.join(unique(one, on, "right side"), on)


def disjoint(parts: dict[str, DataFrame], on: list[str]) -> None:
    """No key in two of the parts."""
    keys = None
    for name, part in parts.items():
        own = part.select(*on).distinct().withColumn("__part", F.lit(name))
        keys = own if keys is None else keys.unionByName(own)
    unique(keys, on, "parts share rows")


def split_facts(contexts: DataFrame, truth: DataFrame, corpus: DataFrame, train: DataFrame) -> DataFrame:
    """One row of counts, all 0 for a sound split: repeated queries and texts, queries without truth, truth outside of the corpus, hidden pairs and cold texts still in the log."""
    one = F.count(F.lit(1)).alias("n")
    facts = {
        "repeated_queries": contexts.groupBy("query_id").agg(one).where("n > 1"),
        "repeated_texts": contexts.groupBy("text").agg(one).where("n > 1"),
        "without_truth": contexts.join(truth, "query_id", "left_anti"),
        "outside_corpus": truth.join(corpus, "item_id", "left_anti"),
        "not_hidden": truth.join(contexts.select("query_id", "context"), "query_id").join(train, ["context", "item_id"], "left_semi"),
        "not_cold": contexts.where("regime = 'cold_text'").join(train, "text", "left_semi"),
    }
    out = None
    for name, rows in facts.items():
        own = rows.agg(F.count(F.lit(1)).alias(name))
        out = own if out is None else out.crossJoin(own)  # one row each
    return out


def assert_split(facts: DataFrame) -> None:
    wrong = {k: v for k, v in facts.first().asDict().items() if v}
    if wrong:
        raise ValueError(f"the split is not sound: {wrong}")

"""Queries on tables on which they failed or took too much."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lodestone.operators import split
from lodestone.plans import ranking, relational  # noqa: F401  they add their queries
from lodestone.plans.queries import QUERIES


def test_validation_takes_the_texts_there_are(spark):
    train = spark.createDataFrame([(f"t{t}", f"t{t}|{c}", 10 * t + c) for t in range(20) for c in range(3)], "text string, context string, item_id int")
    own = spark.range(60).select(F.col("id").cast("int").alias("item_id"), F.col("id").alias("row_idx"))
    with pytest.raises(ValueError):
        split.make_validation(train, own, train.select("item_id").distinct(), 200)
    parts = split.make_validation(train, own, train.select("item_id").distinct(), 200, exact=False)
    queries = parts["queries"].collect()
    assert sorted(r.text for r in queries) == sorted(f"t{t}" for t in range(20)) and {r.regime for r in queries} == {"warm_text"} and {r.split for r in queries} == {"fit"}
    assert parts["train"].count() < 60


def test_digest_of_more_rows_than_a_long_holds(spark, tmp_path):
    n = 70_000
    spark.range(n).select(F.col("id").alias("doc_id"), F.lit("a").alias("text")).write.parquet(str(tmp_path / "documents.parquet"))
    want = sum(int(hashlib.sha256(f"{i}:a".encode()).hexdigest()[:12], 16) for i in range(n))
    assert want >= 2**63
    got = QUERIES["corpus_digest"](spark, str(tmp_path)).first()
    assert got.n == n and got.total == (want + 2**63) % 2**64 - 2**63

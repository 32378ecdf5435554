"""Batches that resume, digests of ordered tables, exact resampling."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.functions.text import query_key
from lodestone.operators import evaluation, submission
from lodestone.sources import tables


def test_batches_resume_and_hold_to_the_first_schema(spark, tmp_path):
    queries = spark.range(0, 50, 2).select(F.col("id").alias("qid"))
    path, built, broken = str(tmp_path / "f"), [], {"at": 2}

    def build(own):
        built.append(sorted(r.qid for r in own.collect()))
        if len(built) - 1 == broken["at"]:
            raise RuntimeError("lost")
        return own.select("qid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("qid") % 3)).alias("item_idx"), (F.col("qid") * 0.5).alias("x"))

    with pytest.raises(RuntimeError):
        tables.write_feature_batches(queries, build, path, 7)
    assert len(built) == 3
    broken["at"] = None
    out = tables.write_feature_batches(queries, build, path, 7)
    assert [b[0] for b in built] == [0, 14, 28, 28, 42]  # the batches that were whole are not built again
    assert {(r.qid, r.item_idx, r.x) for r in out.collect()} == {(q, i, q * 0.5) for q in range(0, 50, 2) for i in range(q % 3 + 1)}
    assert dict(out.dtypes)["x"] == "float"
    again = tables.write_feature_batches(queries, build, path, 7)
    assert len(built) == 5 and again.count() == out.count()
    for wrong in ((queries.where("qid > 0"), 7), (queries, 6)):
        with pytest.raises(ValueError):
            tables.write_feature_batches(wrong[0], build, path, wrong[1])

    def other(own):
        return build(own) if len(built) == 5 else build(own).withColumn("y", F.lit(1))

    with pytest.raises(ValueError):
        tables.write_feature_batches(queries, other, str(tmp_path / "g"), 20)
    told = json.loads(spark.read.parquet(str(tmp_path / "g" / "manifest")).first()[0])
    assert told["batches"] == 2 and "y" not in told["schema"] and spark.read.parquet(str(tmp_path / "g" / "features")).select("qid").distinct().count() == 20
    empty = tables.write_feature_batches
    with pytest.raises(Exception):  # noqa: B017  nothing to read of no query
        empty(queries.where("false"), build, str(tmp_path / "h"), 5)


def test_query_keys_normalise_their_free_text(spark):
    rows = [("Ёлка, ＡＢＣ!", 3, True, "Цвет: КРАСНЫЙ", "x"), ("елка  abc", 3, True, "цвет красный", "x"), ("елка abc", 3, None, "цвет красный", "x"), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "a string, b int, c boolean, d string, e string")
    got = [r.k for r in df.select(query_key(*[F.col(c) for c in "abcde"]).alias("k")).collect()]
    assert got[0] == got[1] == "\x1f".join(["елка abc", "3", "true", "цвет красный", "x"]) and got[2] != got[0] and got[3] == "\x1f" * 4


def test_ordered_digest(spark):
    rows = [(i, f"t{i % 7}" if i % 5 else None, i * 0.5) for i in range(300)]
    make = lambda rs, n=4: spark.createDataFrame(rs, "row_idx long, text string, x double").repartition(n)
    said = tables.ordered_digest(make(rows), leaf=8)
    assert said == tables.ordered_digest(make(rows, 9), leaf=8) == tables.ordered_digest(make(rows[::-1], 2).select("x", "text", "row_idx"), leaf=8)
    swapped = rows[:40] + [(40, *rows[41][1:]), (41, *rows[40][1:])] + rows[42:]
    assert tables.ordered_digest(make(swapped), leaf=8) != said
    assert tables.ordered_digest(make(swapped), n=40, leaf=8) == tables.ordered_digest(make(rows), n=40, leaf=8) == tables.ordered_digest(make(rows[:40]), leaf=8)
    for bad in (rows[1:], rows + rows[:1], rows[:7] + rows[8:]):
        with pytest.raises(ValueError):
            tables.ordered_digest(make(bad), leaf=8)
    assert tables.ordered_digest(make([]), leaf=8) == tables.ordered_digest(make(rows), n=0, leaf=8)
    assert tables.require_prefix(make(rows[:100]), make(rows), leaf=8) == 100
    for corpus in (rows[:9] + [(9, "other", 1.0)], rows + [(300, "more", 1.0)], [(0, *rows[1][1:]), (1, *rows[0][1:])]):
        with pytest.raises(ValueError):
            tables.require_prefix(make(corpus), make(rows), leaf=8)


def test_candidates_of_a_prefix(spark):
    items = spark.range(30).select(F.col("id").alias("row_idx"), F.concat(F.lit("i"), "id").alias("item_id"))
    corpus, queries = items.where("row_idx < 20"), spark.range(4).select(F.col("id").alias("qid"))
    good = queries.select("qid", F.explode(F.sequence("qid", F.col("qid") + 5)).alias("item_idx"))
    assert submission.require_candidates(good, queries, corpus, items) == 24
    add = lambda q, i: good.unionByName(spark.createDataFrame([(q, i)], "qid long, item_idx long"))
    for bad in (add(0, 0), add(9, 1), add(1, 20), add(1, -1), good.where("qid > 0")):
        with pytest.raises(ValueError):
            submission.require_candidates(bad, queries, corpus, items)
    with pytest.raises(ValueError):
        submission.require_candidates(good, queries, corpus.withColumn("item_id", F.lit("x")), items)


def test_resamples_are_draws_with_replacement(spark):
    counts = [40, 0, 7, 53]
    for r in range(1, 40):
        assert sum(int(evaluation.resample_weights(3, r, counts, p).sum()) for p in range(4)) == 100
    first = np.array([[evaluation.resample_weights(3, r, counts, p).sum() for p in range(4)] for r in range(1, 3001)])
    assert np.allclose(first.mean(axis=0), counts, atol=0.6) and first[:, 0].var() == pytest.approx(100 * 0.4 * 0.6, rel=0.12)
    rng = np.random.default_rng(5)
    d = rng.exponential(1.0, 300)
    current = spark.createDataFrame([(f"q{i}", float(x)) for i, x in enumerate(d)], "id string, r double")
    base = current.withColumn("r", F.lit(0.0))
    a = evaluation.paired_bootstrap(current, base, "id", "r", iterations=1000, part_rows=40).first()
    b = evaluation.paired_bootstrap(current.repartition(7), base, "id", "r", iterations=1000, part_rows=40).first()
    assert [a[c] for c in ("n", "delta", "low", "high", "positive")] == pytest.approx([b[c] for c in ("n", "delta", "low", "high", "positive")]) and a.n == 300
    means = np.array([d[rng.integers(0, 300, 300)].mean() for _ in range(4000)])
    assert (a.low, a.high) == pytest.approx((np.quantile(means, 0.025), np.quantile(means, 0.975)), abs=0.02)


def test_streamed_parts_become_one(spark, tmp_path, monkeypatch):
    """After any number of batches, and again after more files, the table has every window's latest row, and few folders."""
    from datetime import datetime, timedelta

    from lodestone.streaming import counters

    monkeypatch.setattr(counters, "PARTS", 3)
    rng, told, start = random.Random(8), [], datetime(2024, 1, 1)
    source, folder = str(tmp_path / "in"), f"file://{tmp_path}/out"

    def more(files):
        for _ in range(files):
            own = [(start + timedelta(minutes=rng.randrange(300)), rng.choice("ab"), rng.randrange(9)) for _ in range(7)]
            told.extend(own)
            spark.createDataFrame(own, "ts timestamp_ntz, event_type string, value long").coalesce(1).write.mode("append").parquet(source)

    for files, folders in ((8, 7), (6, 7)):
        more(files)
        stream = counters.read_stream(spark, source, spark.read.parquet(source).schema)
        got = {(r.start.hour, r.event_type): (r.n, r.total) for r in counters.run_to_table(counters.popularity(stream, "1000 hours"), folder).collect()}
        want = {}
        for ts, kind, value in told:
            n, total = want.get((ts.hour, kind), (0, 0))
            want[ts.hour, kind] = n + 1, total + value
        assert got == want
        assert len(os.listdir(tmp_path / "out" / "table")) <= folders
    counters.compact(spark, f"{folder}/table", 11, spark.createDataFrame([], "start timestamp, event_type string, n long, total long").schema)
    assert counters.newest(spark, f"{folder}/table", None).count() == len(want)


def test_a_stream_without_files(spark, tmp_path):
    from lodestone.streaming import counters

    spark.createDataFrame([], "ts timestamp_ntz, event_type string, value long").write.parquet(str(tmp_path / "in"))
    stream = counters.read_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    assert counters.run_to_table(counters.popularity(stream), f"file://{tmp_path}/out").collect() == []

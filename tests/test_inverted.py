"""Searches that skip: the same rows as full sums, from less of the index."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lodestone.functions import stem
from lodestone.operators import behavior, inverted, lexical


def words(rng, n, size=400):
    return " ".join(f"w{min(int(rng.paretovariate(0.9)), size)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    rows = [(i, words(rng, 3) if i < 3000 else f"rare{i % 9} " + words(rng, 3), None, words(rng, rng.randint(2, 20)), "en" if i % 3 else "fr") for i in range(3200)]
    items = spark.createDataFrame(rows, "item_idx long, title string, params string, description string, location string")
    asks = spark.createDataFrame([(q, f"rare{q} " + words(rng, 4), "en") for q in range(12)], "qid long, text string, location string")
    return items, asks


@pytest.mark.parametrize("channel", ["bm25", "word", "char"])
def test_bounded_search_gives_the_rows_of_the_full_sum(spark, corpus, channel, monkeypatch):
    monkeypatch.setattr(inverted, "BLOCK", 64)
    monkeypatch.setattr(inverted.blocks_of, "__defaults__", (64,))
    items, asks = corpus
    index = lexical.LexicalIndex(items.withColumn("title", F.concat("title", F.lit(f" {channel}"))))
    full = index.scores(asks, channel).withColumn("score", F.round("score", 6)).toPandas()
    for how, keep in (({}, lambda r: True), ({"allowed": 3100}, lambda r: r.item_idx < 3100), ({"local": True}, lambda r: r.item_idx % 3 != 0)):
        found, report = index.bounded_search(asks, channel, 7, **how)
        want = set()
        for q, own in full[[keep(r) for r in full.itertuples()]].groupby("qid"):
            best = own.sort_values(["score", "item_idx"], ascending=[False, True]).head(7)
            want |= {(q, i, r) for r, i in enumerate(best.item_idx, 1)}
        assert {(r.qid, r.item_idx, r["rank"]) for r in found.collect()} == want
        read = report.agg(F.sum("postings"), F.sum("postings_read"), F.sum("blocks"), F.sum("blocks_read")).first()
        assert read[1] <= read[0] and read[3] <= read[2]
        if channel != "char":  # n-grams of short words are everywhere
            assert read[3] < read[2] and read[1] < read[0]


def test_second_search_opens_the_stored_tables(spark, corpus, monkeypatch, tmp_path):
    items, asks = corpus
    items.write.parquet(str(tmp_path / "items"))
    stored = spark.read.parquet(str(tmp_path / "items"))
    made = []
    count = lexical.LexicalIndex._made
    monkeypatch.setattr(lexical.LexicalIndex, "_made", lambda self, channel: made.append(channel) or count(self, channel))
    first = lexical.LexicalIndex(stored)
    rows = {tuple(r) for r in first.search(asks, "bm25", 5).collect()}
    again = lexical.LexicalIndex(spark.read.parquet(str(tmp_path / "items")))
    assert {tuple(r) for r in again.search(asks, "bm25", 5).collect()} == rows and made == ["bm25"]
    # Only the folders of the asked terms are opened, and none of the corpus.
    asked = again.asked(asks.where("qid = 0"), "bm25")
    part = inverted.in_buckets(again.postings("bm25"), asked)
    assert 0 < len({f.rsplit("/", 1)[0] for f in part.where("n > 0").inputFiles()}) and "PartitionFilters: [" in part._jdf.queryExecution().executedPlan().toString()
    assert len({r[0] for r in part.select("bucket").distinct().collect()}) <= asked.count()
    # Other data, parameters or code are another key.
    keys = {again.fingerprint, lexical.LexicalIndex(stored.where("item_idx > 5")).fingerprint, lexical.LexicalIndex(stored, b=0.5).fingerprint}
    source = stem.__dict__.copy()
    monkeypatch.setattr(inverted.inspect, "getsource", lambda module: "other code" if module is stem else str(sorted(source)[:1]))
    keys.add(lexical.LexicalIndex(stored).fingerprint)
    assert len(keys) == 4


def test_saved_index_searches_without_its_corpus(spark, corpus, tmp_path):
    items, asks = corpus
    index = lexical.LexicalIndex(items)
    index.save(str(tmp_path / "i"))
    back = lexical.LexicalIndex.load(spark, str(tmp_path / "i"))
    for channel in ("bm25", "char"):
        a, b = ({tuple(r) for r in x.search(asks, channel, 6, local=True).collect()} for x in (index, back))
        assert a == b and a


def brute(base, asks, k):
    def grams(text, kind):
        ws = text.split()
        if kind == "w":
            return ws + [f"{a} {b}" for a, b in zip(ws, ws[1:], strict=False)]
        return [f" {w} "[i : i + n] for w in ws for n in (3, 4, 5) if n == 3 or len(w) + 2 >= n for i in range(max(1, len(w) + 3 - n))]

    total = [Counter() for _ in asks]
    for share, kind, low in ((0.55, "w", 1), (0.45, "c", 2)):
        df = Counter(g for t in base for g in set(grams(t, kind)))

        def vector(t):
            w = {g: (1 + math.log(n)) * (math.log((1 + len(base)) / (1 + df[g])) + 1) for g, n in Counter(grams(t, kind)).items() if df[g] >= low}
            size = math.sqrt(sum(x * x for x in w.values())) or 1
            return {g: x / size for g, x in w.items()}

        stored = {t: vector(t) for t in base}
        for i, q in enumerate(asks):
            v = vector(q)
            for t, o in stored.items():
                if s := sum(x * o[g] for g, x in v.items() if g in o):
                    total[i][t] += share * s
    return [sorted(((-round(s, 6), t) for t, s in c.items()))[:k] for c in total]


def test_nearest_texts_are_exact_and_meet_fewer_pairs(spark):
    rng = random.Random(6)
    met = []
    for n in (150, 600):
        base = sorted({words(rng, rng.randint(2, 6), 50 * n) for _ in range(n)})
        texts = spark.createDataFrame([(t,) for t in base + [None]], "text string")
        asks = spark.createDataFrame(list(enumerate(base)), "qid long, text string")
        postings, asked = behavior.text_postings(texts, asks)
        found, pairs = inverted.nearest(asked, postings, 5)
        met.append(pairs.count() / len(base) ** 2)
        got = [[] for _ in base]
        for r in found.orderBy("qid", "rank").collect():
            got[r.qid].append((-r.score, r.near))
        for mine, want in zip(got, brute(base, base, 5), strict=True):
            assert [s for s, _ in mine] == pytest.approx([s for s, _ in want], abs=2e-6)
            assert {t for s, t in mine if s < want[-1][0] - 2e-6} == {t for s, t in want if s < want[-1][0] - 2e-6}
    assert met[1] < 0.8 * met[0]  # of all pairs a smaller share

"""Operators on random tables against plain Python, and on cases of their own."""

import math
import random
import statistics
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.functions import stem
from lodestone.functions.text import bigrams, blank, char_grams, composed, flattened, normalized, passage_text, stem_tokens, tokenize, tokens
from lodestone.operators import behavior, candidates, checks, dense, evaluation, geography, lexical, ranker, split, submission, topk
from lodestone.sources import tables

GRID = [k / 8 for k in range(9)]


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(column.alias("x")).first().x


# --- text


def test_text_functions(spark):
    said = ["Жёлтый Лист №7!", None, "ﬀ² ok", "naïve  Ⅷ"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(said)], "i int, t string")
    assert [x for _, x in rows(df.select("i", normalized(F.col("t"), compose=True).alias("n")), "i")] == ["желтый лист no7", "", "ff2 ok", "na ve viii"]
    assert [x for _, x in rows(composed(df, "t"), "i")] == ["Жёлтый Лист No7!", None, "ff2 ok", "naïve  VIII"]
    assert one(spark, bigrams(tokens(F.col("t"))), "one or two") == ["one", "or", "two", "one or", "or two"]
    assert one(spark, char_grams(tokens(F.col("t"))), "q up") == [" q ", " up", "up ", " up "]
    assert [one(spark, blank(F.col("t")), s) for s in (" \t", None, "-")] == [True, True, False]
    assert one(spark, flattened(F.col("t")), " Ёж  и  (кот)\n") == "еж и (кот)"
    assert one(spark, passage_text(F.col("t"), F.lit(None).cast("string"), F.lit(" b ")), "  ") == "b"


def test_stems_inside_the_plan_are_those_of_the_program(spark):
    rng = random.Random(11)
    endings = [e for name in ("GERUND_1", "GERUND_2", "ADJECTIVE", "PARTICIPLE_1", "PARTICIPLE_2", "REFLEXIVE", "VERB_1", "VERB_2", "NOUN", "SUPERLATIVE", "DERIVATIONAL") for e in getattr(stem, name)]
    words = ["", "ж", "route66", "12", "рыба"]
    for _ in range(1500):
        words.append("".join(rng.choices("бвгдклмнрстаеиоуыя", k=rng.randint(0, 6))) + rng.choice(endings) + rng.choice(["", *endings]))
    got = spark.createDataFrame([(words,)], "t array<string>").select(F.transform("t", stem.stem_column).alias("a"), stem_tokens("t").alias("b")).first()
    assert got.a == got.b == [stem.stem_word(w) for w in words]
    assert one(spark, tokenize(F.col("t")), "Книгами и книга, 7 books") == ["книг", "и", "книг", "7", "books"]


@pytest.mark.parametrize("word,short", [("столами", "стол"), ("зелёными".replace("ё", "е"), "зелен"), ("гулявшая", "гуля"), ("смелость", "смелост"), ("добрейшие", "добр"), ("x86", "x86")])
def test_stemmer(word, short):
    assert stem.stem_word(word) == short


# --- lexical evidence


LEXICON = "amber birch cedar delta ember fjord grove heath inlet jetty knoll ledge marsh notch oasis плиты плитами ручей ручьи".split()


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(21)
    phrase = lambda n: " ".join(rng.choices(LEXICON, k=n))
    items = [(i, phrase(rng.randint(0, 4)), rng.choice([None, phrase(2)]), rng.choice([None, phrase(rng.randint(0, 30))]), rng.randint(1, 3)) for i in range(60)]
    asks = [(q, phrase(rng.randint(1, 4)), rng.randint(1, 3)) for q in range(9)] + [(9, "zzz", 1), (10, "", 2)]
    return items, asks, spark.createDataFrame(items, "item_idx long, title string, params string, description string, location int"), spark.createDataFrame(asks, "qid long, text string, location int")


def stems(text):
    return [stem.stem_word(w) for w in (text or "").split()]


def bm25(items, asks, k1=1.2, b=0.65):
    texts = [stems(t) * 3 + stems(p) * 2 + stems(d) for _, t, p, d, _ in items]
    mean, df = max(sum(map(len, texts)) / len(texts), 1.0), Counter(w for t in texts for w in set(t))
    out = {}
    for q, text, _ in asks:
        for i, t in enumerate(texts):
            tf = Counter(t)
            s = sum(math.log(1 + (len(items) - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * (k1 + 1) / (tf[w] + k1 * (1 - b + b * len(t) / mean)) for w in set(stems(text)) if tf[w])
            if s:
                out[q, i] = s
    return out


def words_of(text):
    ws = stems(text)
    return ws + [f"{a} {b}" for a, b in zip(ws, ws[1:], strict=False)]


def grams_of(text):
    return [f" {w} "[i : i + n] for w in stems(text) for n in (3, 4, 5) if n == 3 or len(w) + 2 >= n for i in range(max(1, len(w) + 3 - n))]


def tfidf(items, asks, terms, min_df):
    texts = [terms(f"{t} {p or ''}") for _, t, p, _, _ in items]
    df = Counter(w for t in texts for w in set(t))

    def vector(ts):
        w = {x: (1 + math.log(n)) * (math.log((1 + len(items)) / (1 + df[x])) + 1) for x, n in Counter(ts).items() if df[x] >= min_df}
        length = math.sqrt(sum(x * x for x in w.values())) or 1
        return {x: v / length for x, v in w.items()}

    stored = [vector(t) for t in texts]
    return {(q, i): s for q, text, _ in asks for v in [vector(terms(text))] for i, o in enumerate(stored) if (s := sum(x * o[t] for t, x in v.items() if t in o))}


def best(scores, keep, k):
    out = set()
    for q in {q for q, _ in scores}:
        mine = sorted((-round(s, 6), i) for (x, i), s in scores.items() if x == q and keep(q, i))
        out |= {(q, i, r) for r, (_, i) in enumerate(mine[:k], 1)}
    return out


def test_scores_and_searches(spark, corpus):
    items, asks, df, q = corpus
    index = lexical.LexicalIndex(df)
    want = {"bm25": bm25(items, asks), "word": tfidf(items, asks, words_of, 1), "char": tfidf(items, asks, grams_of, 2)}
    place = {"item": {i: x for i, *_, x in items}, "query": {i: x for i, _, x in asks}}
    for name, scores in want.items():
        got = {(r.qid, r.item_idx): r.score for r in index.scores(q, name).collect()}
        assert got == pytest.approx(scores)
        ways = [({}, lambda q, i: True), ({"local": True}, lambda q, i: place["item"][i] == place["query"][q]), ({"allowed": 25}, lambda q, i: i < 25), ({"allowed": 0}, lambda q, i: False)]
        for how, keep in ways:
            assert {(r.qid, r.item_idx, r["rank"]) for r in index.search(q, name, 5, **how).collect()} == best(scores, keep, 5)
    for bad in (True, 0, 2.0):
        with pytest.raises(ValueError):
            index.search(q, "bm25", bad)
    with pytest.raises(ValueError):
        index.search(q, "bm25", 3, allowed=-1)
    told = index.candidate_scores(q.withColumn("filter", F.lit("grove")))
    share = {(r.qid, r.item_idx): r.score for r in told["full_coverage"].collect()}
    for (a, i), s in share.items():
        have = set(stems(items[i][1])) | set(stems(items[i][2])) | set(stems(items[i][3]))
        assert s == pytest.approx(len(set(stems(asks[a][1])) & have) / len(set(stems(asks[a][1]))))
    assert {(r.qid, r.item_idx): r.score for r in told["context_word"].collect()} == pytest.approx(tfidf(items, [(a, f"{t} grove", x) for a, t, x in asks], words_of, 1))


def test_an_index_is_stored_once_and_opened_by_its_fingerprint(spark, corpus, tmp_path):
    _, _, df, q = corpus
    a, b = lexical.LexicalIndex(df), lexical.LexicalIndex(df.repartition(5))
    assert a.fingerprint == b.fingerprint and a.stems.inputFiles() == b.stems.inputFiles()
    assert lexical.LexicalIndex(df.where("item_idx > 0")).fingerprint != a.fingerprint != lexical.LexicalIndex(df, description_chars=4).fingerprint
    a.save(str(tmp_path / "i"))
    stored = lexical.LexicalIndex.open(spark, str(tmp_path / "i"), "bm25")
    again = lexical.term_scores(a.terms(q, "bm25"), stored)
    assert {tuple(r)[:2]: round(r.score, 9) for r in again.collect()} == {tuple(r)[:2]: round(r.score, 9) for r in a.scores(q, "bm25").collect()}


# --- ranking


def test_ranks_and_standard_scores(spark):
    rng = random.Random(31)
    data = [(rng.randint(0, 6), i, rng.choice(GRID)) for i in rng.sample(range(500), 120)] + [(7, 0, 0.5)]
    df = spark.createDataFrame(data, "qid int, item_idx int, score double")
    groups = defaultdict(list)
    for q, i, s in data:
        groups[q].append((-s, i))
    want = {(q, i, r) for q, g in groups.items() for r, (_, i) in enumerate(sorted(g)[:4], 1)}
    assert {(r.qid, r.item_idx, r["rank"]) for r in topk.top_k(df, 4).collect()} == want
    for r in topk.z_score(df, "score", "z").collect():
        own = [-s for s, _ in groups[r.qid]]
        sd = statistics.pstdev(own)
        assert r.z == pytest.approx((r.score - statistics.fmean(own)) / sd if sd else 0.0)
    assert topk.normalize_weights([6, 2], 2) == [0.75, 0.25] and topk.normalize_weights(None, 4) == [0.25] * 4
    for bad in ([float("inf"), 1.0], [1e308] * 2, [-3, 5], [0.0, 0.0], [1.0, 1.0, 1.0], [float("nan"), 1]):
        with pytest.raises(ValueError):
            topk.normalize_weights(bad, 2)


def test_weighted_median_is_lower(spark):
    rng = random.Random(32)
    data = [(f"k{rng.randint(0, 9)}", float(rng.randint(0, 12)), rng.randint(1, 4)) for _ in range(200)]
    spread = defaultdict(list)
    for k, v, w in data:
        spread[k] += [v] * w
    want = {k: statistics.median_low(v) for k, v in spread.items()}
    df = spark.createDataFrame(data, "k string, v double, w int")
    assert dict(rows(topk.weighted_median(df, "k", "v", "w", "m"), "k")) == want


# --- places


def km(a, b):
    (p, q), (r, s) = (map(math.radians, x) for x in (a, b))
    return 12742 * math.asin(math.sqrt(min(1, math.sin((r - p) / 2) ** 2 + math.cos(p) * math.cos(r) * math.sin((s - q) / 2) ** 2)))


def fine(p):
    return None not in p and abs(p[0]) <= 90 and abs(p[1]) <= 180 and p != (0.0, 0.0)


def affinity_of(log, items, search, item):
    """All features of one pair by the formulas."""
    at = {}
    for place in {x[1] for x in items}:
        own = [x[2:] for x in items if x[1] == place and fine(x[2:])]
        if own:
            at[place] = tuple(statistics.median(c) for c in zip(*own, strict=True))
    went = Counter(b for a, b in log if a == search)
    known = [(at[p], n) for p, n in went.items() if p in at]
    middle = lambda pairs: statistics.median_low([v for v, n in pairs for _ in range(n)])
    point = at.get(search) or (tuple(middle([(p[i], n) for p, n in known]) for i in (0, 1)) if known else None)
    scope = middle([(km(point, p), n) for p, n in known]) if known else 0.0
    seen = Counter(b for _, b in log) if log else Counter(x[1] for x in items)
    prior = {p: seen[p] / sum(seen.values()) for p in {x[1] for x in items}}
    prob = {p: (went[p] + 5 * prior[p]) / (sum(went.values()) + 5) for p in prior}
    place, here = item[1], item[2:]
    lift = prob[place] / prior[place] if prior[place] else 1.0
    far = km(point, here) if point and fine(here) else None
    near = 0.5 if far is None else 1 / (1 + far / (25 + min(scope, 150)))
    usual = went[place] / (went[place] + 5) * (0.7 * math.sqrt(prob[place] / max(max(prob.values()), 1e-12)) + 0.3 * lift / (1 + lift))
    low = 0.9 if scope > 300 else 0.02
    value = 1.0 if point is None or place == search else low + (1 - low) * max(near, 0.85 * usual)
    return {"affinity": min(max(value, 0), 1), "transition_probability": prob[place], "transition_lift": lift, "scope_km": scope, "train_count": sum(went.values()), "has_center": int(far is not None), "log_distance": math.log1p(far or 0), "same_location": int(place == search)}


@pytest.mark.parametrize("moves", [90, 0])
def test_geography(spark, moves):
    rng = random.Random(41 + moves)
    odd = [(None, 3.0), (0.0, 0.0), (95.0, 10.0), (-8.0, 200.0)]
    items = [(f"i{i}", rng.randint(1, 6), *(rng.choice(odd) if rng.random() < 0.2 else (rng.choice([rng.uniform(-9, 9), rng.uniform(-60, 60)]), rng.uniform(-20, 20)))) for i in range(40)]
    log = [(rng.randint(1, 9), rng.randint(1, 8)) for _ in range(moves)]
    df = spark.createDataFrame(items, "item_id string, location long, lat double, lon double")
    train = spark.createDataFrame(log, "search_location long, item_location long")
    searches = spark.range(1, 12).select(F.col("id").alias("search_location"))
    at = geography.centres(df)
    points = geography.query_points(train, at)
    points = points.unionByName(at.select(F.col("location").alias("search_location"), "lat", "lon", F.lit(0.0).alias("scope_km")).join(points, "search_location", "left_anti"))
    got = geography.affinity(geography.features(points, geography.transitions(train), searches.crossJoin(df), geography.priors(train, df)))
    told = {(r.search_location, r.item_id): r for r in got.collect()}
    assert len(told) == 11 * len(items)
    for (s, i), r in told.items():
        for name, value in affinity_of(log, items, s, next(x for x in items if x[0] == i)).items():
            assert r[name] == pytest.approx(value, abs=1e-9), (s, i, name)
    few = searches.where("search_location < 3").crossJoin(df.where("item_id = 'i5'"))  # an affinity is the same whatever else is asked
    alone = geography.affinity(geography.features(points, geography.transitions(train), few, geography.priors(train, df)))
    assert all(r.affinity == pytest.approx(told[r.search_location, r.item_id].affinity) for r in alone.collect())


def test_centres_take_an_item_once(spark):
    own = spark.createDataFrame([("p", 1, 10.0, 10.0), ("q", 1, 20.0, 30.0)], "item_id string, location long, lat double, lon double")
    more = spark.createDataFrame([("q", 1, 80.0, 80.0), ("r", 2, 5.0, 6.0)], own.schema)
    assert rows(geography.centres(own, more), "location") == [(1, 15.0, 20.0), (2, 5.0, 6.0)]


# --- behaviour


def test_behavior(spark):
    rng = random.Random(51)
    asked = [" ".join(rng.sample(LEXICON[:9], rng.randint(1, 3))) for _ in range(12)]
    kinds = {f"p{i}": rng.randint(0, 3) for i in range(10)}
    log = [(t, f"{t}#{rng.randint(0, 1)}", rng.choice(["", "blue", "red"]), i, kinds[i], rng.randint(0, 1)) for t, i in ((rng.choice(asked), rng.choice(list(kinds))) for _ in range(150))]
    train = spark.createDataFrame(log, "text string, context string, filter string, item_id string, category int, local int")
    own = {i: k for i, k in kinds.items() if i != "p3"} | {"fresh": 9}
    items = spark.createDataFrame(list(own.items()), "item_id string, category int")
    asks = [(0, asked[0], f"{asked[0]}#0", "red"), (1, asked[1], "none", ""), (2, "zzz", "zzz", "green"), (3, f"{asked[2]} zzz", "", "blue")]
    q = spark.createDataFrame(asks, "qid int, text string, context string, filter string")
    near = {(r.qid, r.near): r for r in behavior.neighbors(q, train).collect()}
    got = {(r.qid, r.item_id): r for r in behavior.features(q, q.select("qid").crossJoin(items.select("item_id")), train, items, behavior.neighbors(q, train)).collect()}
    assert len(got) == len(asks) * len(own)
    total = statistics.fmean(x[5] for x in log)
    rate = {k: (sum(x[5] for x in log if x[4] == k) + 20 * total) / (sum(x[4] == k for x in log) + 20) for k in {x[4] for x in log}}
    share = lambda xs, k: sum(x[4] == k for x in xs) / len(xs) if xs else 0.0
    for qid, text, context, filter_ in asks:
        mine = {n: r.weight for (x, n), r in near.items() if x == qid}
        assert sum(mine.values()) == pytest.approx(1.0 if mine else 0.0)
        kin = {k: sum(w * share([x for x in log if x[0] == n], k) for n, w in mine.items()) for k in {*own.values(), *rate}}
        for i, k in own.items():
            r, n = got[qid, i], lambda c, v: sum(x[c] == v for x in log)
            both = lambda c, v, i=i: sum(x[c] == v and x[3] == i for x in log)
            want = {
                "popularity": math.log1p(n(3, i)), "text_item_count": math.log1p(both(0, text)), "context_item_count": math.log1p(both(1, context)),
                "memory_score": sum(w * math.log1p(both(0, t)) for t, w in mine.items()), "microcat_probability": kin[k], "category_local_rate": rate.get(k, total),
                "query_local_rate": sum(p * rate[c] for c, p in kin.items() if c in rate), "filter_microcat_probability": share([x for x in log if x[2] == filter_], k) if filter_ else 0.0,
                "filter_train_count": math.log1p(n(2, filter_)), "query_train_count": math.log1p(n(0, text)), "nearest_query_similarity": max((x.score for (a, _), x in near.items() if a == qid), default=0.0),
            }
            for name, value in want.items():
                assert r[name] == pytest.approx(value, abs=1e-5), (qid, i, name)


# --- candidates


def test_channels_union_and_fallback(spark):
    rng = random.Random(61)
    odd = [float("nan"), float("inf"), None, 0.0]
    data = [(q, i, rng.choice(odd) if rng.random() < 0.2 else rng.uniform(-1, 1)) for q in range(4) for i in range(40)]
    s = spark.createDataFrame(data, "qid int, item_idx int, score double")
    usable = lambda x, signed: x is not None and math.isfinite(x) and (signed or x > 0)
    for name, allowed in (("dense", None), ("word", None), ("dense", 9), ("char", 0)):
        want = best({(q, i): x for q, i, x in data if usable(x, name == "dense")}, lambda q, i, n=allowed: not n or i < n, 6)
        assert {(r.qid, r.item_idx, r["rank"]) for r in candidates.channel(s, name, 6, allowed).collect()} == want
    parts = {"dense": candidates.channel(s, "dense", 3), "word": candidates.channel(s, "word", 2)}
    ranks = {n: {(r.qid, r.item_idx): r["rank"] ** -0.5 for r in p.collect()} for n, p in parts.items()}
    got = {(r.qid, r.item_idx): r for r in candidates.union(parts).collect()}
    assert set(got) == set(ranks["dense"]) | set(ranks["word"])
    assert all(r[f"rank_{n}"] == pytest.approx(ranks[n].get(k, 0.0)) for k, r in got.items() for n in ranks)
    pool = spark.createDataFrame([(0, i) for i in range(5)] + [(1, 2)], "qid int, item_idx int")
    asks, popular = spark.range(3).select(F.col("id").cast("int").alias("qid")), spark.createDataFrame([(i, float(i % 7)) for i in range(20)], "item_idx int, score double")
    wide = candidates.with_fallback(pool, asks, popular, below=3, k=4)
    assert {tuple(r) for r in wide.collect()} == {(0, i) for i in range(5)} | {(1, 2)} | {(q, i) for q in (1, 2) for i in (6, 13, 5, 12)}
    own = asks.crossJoin(popular).withColumn("score", F.col("score") * (F.col("qid") - 1))
    assert {tuple(r) for r in candidates.with_fallback(pool, asks, own, below=3, k=2).collect()} == {(0, i) for i in range(5)} | {(1, 2), (2, 6), (2, 13)}


def test_features_of_candidates(spark):
    """The table of all features against plain formulas: every channel, relative scores before the cut, overlaps and heuristics."""
    rng = random.Random(62)
    names = ["word", "bm25", "char", "context_word", "full_coverage", "memory", "dense", "dense_plain"]
    raw = {(q, i): {n: rng.choice([0.0, rng.random(), rng.random() - 0.3 if "dense" in n else rng.random()]) for n in names} for q in range(2) for i in range(30)}
    geo = {k: rng.random() for k in raw}
    title, params = {i: " ".join(rng.choices(LEXICON, k=3)) for i in range(30)}, {i: " ".join(rng.choices(LEXICON, k=2)) for i in range(30)}
    asks = {0: ("birch cedar плита", "heath heath"), 1: ("Marsh", "")}
    table = spark.createDataFrame([(*k, geo[k], *(v[n] for n in names)) for k, v in raw.items()], "qid long, item_idx long, geo double, " + ", ".join(f"{n} double" for n in names))
    q = spark.createDataFrame([(i, *asks[i], i == 1, 5) for i in asks], "qid long, text string, filter string, delivery boolean, category int")
    items = spark.createDataFrame([(i, title[i], params[i], "xy" * i, i % 9, "12.5" if i else "n/a", i, None, i % 2 == 0, None) for i in range(30)], "item_idx long, title string, params string, description string, category int, price string, reviews int, rating double, phone_hidden boolean, message_forbidden boolean")
    told = table.select("qid", "item_idx", F.col("geo").alias("geo_affinity"))
    popular = table.select("qid", "item_idx", F.col("geo").alias("score"))
    for allowed in (None, 20):
        got = {(r.qid, r.item_idx): r for r in candidates.feature_table(table, q, items, told, table.select("qid", "item_idx", F.lit(0.5).alias("memory_score")), popular, allowed).collect()}
        n_items = allowed or 30
        assert set(got) == {(x, i) for x in range(2) for i in range(n_items)}
        for x in range(2):
            mine = {i: raw[x, i] for i in range(n_items)}
            for channel, limit in candidates.CHANNELS.items():
                source = candidates.source_of(channel)
                adjust = {"geo_context": lambda s, g: s * g**0.7, "geo_memory": lambda s, g: s * g}.get(channel) or (
                    (lambda s, g: s) if not channel.startswith("geo_") else (lambda s, g: s + 0.055 * math.log(0.005 + 0.995 * g)) if "dense" in channel else (lambda s, g: s * (0.015 + 0.985 * g) ** 0.7)
                )
                scores = {(x, i): adjust(v[source], geo[x, i]) for i, v in mine.items()}
                ranks = {i: r for _, i, r in best({k: s for k, s in scores.items() if "dense" in channel or s > 0}, lambda q, i: True, limit)}
                assert all(got[x, i][f"rank_{channel}"] == pytest.approx(ranks[i] ** -0.5 if i in ranks else 0.0) for i in mine), channel
            for i, v in mine.items():
                r = got[x, i]
                rel = {n: v[n] / max(max(o[n] for o in mine.values()), 1e-6) for n in names if n != "memory"}
                assert all(r[n] == pytest.approx(v[n]) and r[f"relative_{n}"] == pytest.approx(rel[n]) for n in rel)
                a, t, f = (list(dict.fromkeys(stems(s.lower()))) for s in (asks[x][0], title[i], asks[x][1]))
                low = (rel["word"] + 0.7 * rel["bm25"] + 0.5 * rel["char"]) * geo[x, i] ** 0.7
                want = {
                    "title_coverage": len({*a} & {*t}) / len(a), "title_precision": len({*a} & {*t}) / len(t), "title_exact_phrase": int(asks[x][0].lower() in title[i]), "query_words": len(a), "query_length": len(asks[x][0]),
                    "filter_coverage": len({*f} & {*stems(params[i])}) / max(len(f), 1), "has_filters": int(bool(f)), "delivery_search": x, "category_match": int(i % 9 == 5), "item_price": math.log1p(12.5 if i else 0), "item_rating_reviews_count": math.log1p(i),
                    "item_rating": 0.0, "item_is_phone_hidden": int(i % 2 == 0), "item_is_message_forbidden": 0, "title_length": len(title[i]), "description_length": 2 * i, "lexical_heuristic": low,
                    "hybrid_heuristic": v["dense"] + 0.055 * math.log(0.005 + 0.995 * geo[x, i]) + 0.035 * low, "memory_score": 0.5, "geo_affinity": geo[x, i],
                }
                for name, value in want.items():
                    assert r[name] == pytest.approx(value, abs=1e-9), name
                assert "memory" not in r and "relative_memory" not in r


def test_features_are_written_sorted(spark, tmp_path):
    df = spark.range(200).select((F.col("id") % 7).alias("qid"), (199 - F.col("id")).alias("item_idx"), (F.col("id") / 3).alias("x"), F.lit(1).alias("label"))
    tables.write_features(candidates.labels(df.drop("label"), df.where("x > 30")), str(tmp_path / "f"))
    back = spark.read.parquet(str(tmp_path / "f"))
    assert dict(back.dtypes)["x"] == "float" and back.count() == 200 and back.where("label = 1").count() == df.where("x > 30").count()
    with pytest.raises(ValueError):
        tables.write_features(df.drop("qid"), str(tmp_path / "g"))


# --- evaluation


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(71)
    asks = [(q, rng.choice(["", " ", "f"]), rng.choice(["r1", "r2"]), rng.random() < 0.5) for q in range(30)]
    truth = [(q, rng.randint(0, 19), rng.random() < 0.5) for q in range(30) for _ in range(rng.randint(1, 4))]
    truth = list({(q, i): (q, i, s) for q, i, s in truth}.values())
    found = [(q, i, rng.choice(GRID)) for q in range(27) for i in rng.sample(range(20), rng.randint(1, 15))]
    make = spark.createDataFrame
    return asks, truth, found, make(asks, "qid int, filter string, regime string, seen_text boolean"), make([*truth, truth[0]], "qid int, item_idx int, seen_item boolean"), make(found, "qid int, item_idx int, score double")


def test_evaluation_report(spark, judged):
    asks, truth, found, q, t, c = judged
    out, per = evaluation.report(q, c, t, 20, (2, 5), empty_weight=0.8)
    relevant = {a: {i for x, i, _ in truth if x == a} for a, *_ in asks}
    order = {a: [i for _, i in sorted((-s, i) for x, i, s in found if x == a)] for a, *_ in asks}
    want = {a: {f"recall_{k}": len(set(order[a][:k] if k != "union" else order[a]) & relevant[a]) / len(relevant[a]) for k in (2, 5, "union")} for a in relevant}
    assert {r.qid: {m: r[m] for m in want[0]} for r in per.collect()} == {a: pytest.approx(v) for a, v in want.items()}
    seen = {a: (lambda s: "all_seen" if all(s) else "mixed" if any(s) else "all_unseen")([s for x, _, s in truth if x == a]) for a in relevant}
    groups = {"regime": {a: r for a, _, r, _ in asks}, "seen_text": {a: str(s).lower() for a, *_, s in asks}, "filter_empty": {a: str(not f.strip()).lower() for a, f, *_ in asks}, "seen_item_group": seen, "all": dict.fromkeys(relevant, "all")}
    got = {(r.metric, r.group_name, r.group_value): (r.value, r.n) for r in out.collect()}
    for m in want[0]:
        for g, by in groups.items():
            for value in set(by.values()):
                mine = [want[a][m] for a in by if by[a] == value]
                assert got[m, g, value] == (pytest.approx(statistics.fmean(mine)), len(mine))
        assert got[m, "poststratified", "all"][0] == pytest.approx(0.8 * got[m, "filter_empty", "true"][0] + 0.2 * got[m, "filter_empty", "false"][0])
    assert evaluation.post_stratified(per.where("filter_empty"), "filter_empty", "recall_2", 0.8).first().recall is None
    outcome = Counter("missing" if i not in order[x] else "hit" if order[x].index(i) < 3 else "below" for x, i, _ in truth)
    assert dict(rows(evaluation.loss(t, c, 3), "outcome")) == outcome
    known = spark.createDataFrame([(i,) for i in range(0, 20, 3)], "item_idx int")
    assert {r.qid for r in evaluation.target_disjoint(q, t, known).collect()} == {a for a in relevant if not any(i % 3 == 0 for i in relevant[a])}


def test_evaluation_refuses(spark, judged):
    _, _, found, q, t, c = judged
    more = lambda *row: c.unionByName(spark.createDataFrame([row], c.schema))
    for bad in (more(*found[0]), more(99, 1, 1.0), more(0, 20, 1.0), more(29, -1, 1.0), more(29, 3, float("nan"))):
        with pytest.raises(ValueError):
            evaluation.report(q, bad, t, 20, (2,))
    for args in ((q.unionByName(q.limit(1)), c, t), (q, c, t.where("qid <> 4"))):
        with pytest.raises(ValueError):
            evaluation.report(*args, 20, (2,))
    for ks in ((), (0,), (2.5,), (True,)):
        with pytest.raises(ValueError):
            evaluation.report(q, c, t, 20, ks)


def test_bootstrap(spark):
    rng = np.random.default_rng(72)
    d = rng.normal(0.1, 1.0, 400)
    current = spark.createDataFrame([(f"q{i}", float(x), bool(i % 4)) for i, x in enumerate(d)], "id string, r double, flag boolean")
    base = current.withColumn("r", F.lit(0.0))
    got = evaluation.paired_bootstrap(current, base, "id", "r", iterations=600).first()
    means = np.array([d[rng.integers(0, 400, 400)].mean() for _ in range(3000)])
    assert got.delta == pytest.approx(d.mean()) and got.n == 400 and got.low == pytest.approx(np.quantile(means, 0.025), abs=0.02) and got.high == pytest.approx(np.quantile(means, 0.975), abs=0.02)
    assert got.positive == pytest.approx((means > 0).mean(), abs=0.03)
    same = evaluation.paired_bootstrap(current, current.withColumn("r", F.col("r") - 2), "id", "r", "flag", 0.3, iterations=50).first()
    assert (same.delta, same.low, same.high, same.positive) == pytest.approx((2, 2, 2, 1))
    with pytest.raises(ValueError):
        evaluation.paired_bootstrap(current, base.where("id <> 'q7'"), "id", "r")


def test_checked_joins(spark):
    a, b = (spark.createDataFrame([(k, f"{n}{k}") for k in ks], f"k int, {n} string") for n, ks in (("a", (1, 2, 3)), ("b", (2, 3, 4))))
    assert rows(checks.one_to_one(a, b, ["k"]), "k") == [(2, "a2", "b2"), (3, "a3", "b3")]
    twice = b.unionByName(b.where("k = 3"))
    assert checks.many_to_one(twice, a, ["k"]).count() == 3
    for wrong in (lambda: checks.one_to_one(a, b, ["k"], whole=True), lambda: checks.one_to_one(a, twice, ["k"]), lambda: checks.many_to_one(a, twice, ["k"]), lambda: checks.disjoint({"a": a, "b": b}, ["k"])):
        with pytest.raises(ValueError):
            wrong()
    checks.disjoint({"a": a, "b": b.where("k = 4")}, ["k"])
    asked = tables.with_row_index(a.withColumnRenamed("k", "query_id"), "query_id").withColumnRenamed("row_idx", "qid")
    split_of = a.select(F.col("k").alias("query_id"), F.when(F.col("k") == 2, "dev").otherwise("fit").alias("split"))
    assert [(r.query_id, r.qid) for r in evaluation.load_queries(asked, split_of, ["dev"]).collect()] == [(2, 1)]
    both = evaluation.merged_reports(a.select("k", F.lit(2.0).alias("value")), a.select("k", F.lit(0.5).alias("value")), ["k"])
    assert {r.difference for r in both.collect()} == {1.5}


# --- vectors


def test_dense_against_numpy(spark, tmp_path):
    rng = np.random.default_rng(81)
    q, x = rng.standard_normal((4, 6)), rng.standard_normal((150, 6))
    make = lambda m, n: spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], f"{n} long, embedding array<double>")
    s = np.round(q @ x.T, 6)
    got = rows(dense.dense_top_k(make(q, "qid"), make(x, "item_idx").repartition(4), 9).select("qid", "rank", "item_idx"), "qid", "rank")
    assert [i for _, _, i in got] == np.lexsort((np.broadcast_to(np.arange(150), s.shape), -s), axis=1)[:, :9].ravel().tolist()
    every = {(r.qid, r.item_idx): r.score for r in dense.pair_scores(make(q, "qid"), make(x, "item_idx")).collect()}
    assert every == {(a, b): pytest.approx(s[a, b]) for a in range(4) for b in range(150)}
    assert dense.dense_top_k(make(q, "qid").limit(0), make(x, "item_idx"), 3).count() == 0
    assert one(spark, dense.mean_pool(F.col("t"), F.array(F.lit(1), F.lit(0), F.lit(2))), [[1.0, 2.0], [9.0, 9.0], [3.0, 8.0]], "array<array<double>>") == [2.0, 5.0]
    assert one(spark, dense.mean_pool(F.col("t"), F.array(F.lit(0))), [[1.0, 2.0]], "array<array<double>>") == [0.0, 0.0]


def test_vectors_are_made_in_batches_that_resume(spark, tmp_path):
    texts = spark.createDataFrame([(i, "ab" * i) for i in range(50)], "item_id long, text string")
    log = str(tmp_path / "calls")

    def encode(batch):
        with open(log, "a") as f:
            f.write("x" * len(batch))
        return np.array([[len(t), 1] for t in batch])

    calls = lambda: len(open(log).read())
    path = str(tmp_path / "v")
    out = dense.encode_in_batches(texts, path, encode, {"model": "m"}, batches=4, size=7)
    assert {r.item_id: r.embedding for r in out.collect()} == {i: [2.0 * i, 1.0] for i in range(50)} and calls() == 50
    (tmp_path / "v/vectors/batch=2/_SUCCESS").unlink()  # a batch that was not finished
    again = dense.encode_in_batches(texts, path, encode, {"model": "m"}, batches=4)
    assert again.count() == 50 and 50 < calls() < 100
    with pytest.raises(ValueError):
        dense.encode_in_batches(texts, path, encode, {"model": "other"}, batches=4)
    ids = texts.select("item_id")
    unit = again.withColumn("embedding", dense.unit(F.col("embedding")).cast("array<float>"))
    unit.write.parquet(str(tmp_path / "u"))
    assert tables.load_vectors(spark, str(tmp_path / "u"), 2, ids).count() == 50
    for dims, other in ((3, ids), (2, ids.limit(9))):
        with pytest.raises(ValueError):
            tables.load_vectors(spark, str(tmp_path / "u"), dims, other)


# --- answers, splits, models


def test_answers(spark, tmp_path):
    ids = [f"{x:016x}" for x in (0xC0FFEE, 0xBEEF, 0xFACADE)]
    q, items = spark.createDataFrame([("left",), ("right",)], "query_id string"), spark.createDataFrame([(i,) for i in ids], "item_id string")
    make = lambda answer: spark.createDataFrame([("left", answer), ("right", "")], "query_id string, answer string")
    good = make(" ".join(ids[:2]))
    assert submission.check_answers(good, q, items) == {"queries": 2, "empty_answers": 1, "min_items": 0, "max_items": 2, "mean_items": 1.0, "total_items": 2}
    write = str(tmp_path / "a")
    assert submission.publish(good, q, items, write)["total_items"] == 2
    with pytest.raises(ValueError):
        submission.publish(make(f"{0xDEAD:016x}"), q, items, str(tmp_path / "b"))
    assert not (tmp_path / "b").exists()
    assert rows(tables.read_answers(spark, write), "query_id") == rows(good, "query_id")
    for wrong in (f"{ids[0]} {ids[0]}", f"{0xDEAD:016x}", ids[1].upper(), f"{ids[0]} ", f"{ids[0]}\n", f"{ids[0]}  {ids[1]}", f"{ids[0]},{ids[1]}", None, " ".join(ids * 20)):
        with pytest.raises(ValueError):
            submission.check_answers(make(wrong), q, items)
    with pytest.raises(ValueError):
        submission.check_answers(good, q.limit(1), items)
    bad = spark.createDataFrame([(1, 4), (1, 4), (-1, 3), (0, 77), (0, 2)], "qid int, item_idx int")
    assert tuple(submission.check_candidates(bad, 3, 10).first()) == (1, 1, 1, 0)


def test_splits(spark):
    df = spark.range(90).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 == 0, "warm").otherwise("cold").alias("regime"))
    a = split.assign(df, "k")
    n = {(r.regime, r["split"]): r["count"] for r in a.groupBy("regime", "split").count().collect()}
    assert n == {("warm", "fit"): 15, ("warm", "dev"): 7, ("warm", "audit"): 8, ("cold", "fit"): 30, ("cold", "dev"): 15, ("cold", "audit"): 15}
    parts = {s: a.where(F.col("split") == s) for s in ("fit", "dev")}
    checks.disjoint(parts, ["k"])
    assert split.overlap(*parts.values(), ["k"]).first().shared == 0 and split.hide(a, parts["fit"], ["k"]).count() == 45
    places = rows(tables.with_row_index(spark.range(60).select(((F.col("id") * 7) % 60).alias("x")), "x").select("x", "row_idx"), "x")
    assert places == [(i, i) for i in range(60)]
    assert {r.k for r in split.sample(df, 5, "k").collect()} == {r.k for r in df.withColumn("d", split.draw(F.col("k"), seed=42)).orderBy("d").limit(5).collect()}


def test_validation_split_leaks_nothing(spark):
    rng = random.Random(91)
    log = []
    for _ in range(3000):
        t = rng.randint(0, 400)
        log.append((f"t{t}", f"t{t}|{rng.randint(0, 2)}", rng.randint(0, 99)))
    train = spark.createDataFrame(log, "text string, context string, item_id int")
    own = spark.range(60).select(F.col("id").cast("int").alias("item_id"), F.col("id").alias("row_idx"))
    parts = split.make_validation(train, own, train.select("item_id").distinct(), 120)
    checks.assert_split(checks.split_facts(parts["queries"], parts["truth"], parts["corpus"], parts["train"]))
    queries = parts["queries"].collect()
    assert {r.regime for r in queries} == {"warm_context", "warm_text", "cold_text"} and len({r.text for r in queries}) == len(queries) == 120
    assert Counter(r.regime for r in queries) == {"warm_context": 5, "warm_text": 40, "cold_text": 75} and Counter(r.split for r in queries) == {"fit": 60, "dev": 30, "audit": 30}
    targets = {r.item_id for r in parts["truth"].collect()}
    assert len(targets - {r.item_id for r in parts["train"].collect()}) >= round(len(targets) * split.COLD_ITEMS)
    with pytest.raises(ValueError):
        split.make_validation(train, own, train.select("item_id").distinct(), 100_000)
    corpus = rows(parts["corpus"], "row_idx")
    assert [i for i, _ in corpus[:60]] == list(range(60)) and [r for _, r in corpus] == list(range(len(corpus)))
    by_context = defaultdict(set)
    for _, c, i in log:
        by_context[c].add(i)
    hidden = Counter(r.query_id for r in parts["truth"].collect())
    assert all(hidden[r.query_id] == (len(by_context[r.context]) // 2 if r.regime == "warm_context" else len(by_context[r.context])) for r in queries)
    leak = parts["train"].unionByName(parts["truth"].select(F.lit("t").alias("text"), "context", "item_id"))
    with pytest.raises(ValueError):
        checks.assert_split(checks.split_facts(parts["queries"], parts["truth"], parts["corpus"], leak))


def test_rankers(spark, tmp_path):
    df = spark.range(400).select((F.col("id") % 10).alias("qid"), F.col("id").alias("item_idx"), (F.col("id") * 37 % 101).alias("x"), (F.col("id") % 3).cast("double").alias("y"), F.lit(True).alias("flag"), F.lit(0).alias("category_match"), F.lit("fit").alias("split"))
    df = df.withColumn("label", (F.col("x") + 10 * F.col("y") > 70).cast("double"))
    names = ranker.numeric_inputs(df)
    assert names == ["x", "y", "flag"] and ranker.numeric_inputs(df, ("y",)) == ["x", "flag"]
    model = ranker.train(df, names, trees=6, splits=("fit",))
    out = ranker.score(model, df)
    auc = out.select("label", "score").toPandas()
    assert auc[auc.label == 1].score.mean() > auc[auc.label == 0].score.mean() + 1
    stages = ranker.prefix_scores(model, df, [1, 6]).join(out.select("item_idx", "score"), "item_idx").toPandas()
    assert np.allclose(stages.score_6, stages.score) and not np.allclose(stages.score_1, stages.score)
    truth = df.where("label = 1").select("qid", "item_idx")
    size, tried = ranker.select_trees(model, df, df.select("qid").distinct(), truth, every=2, k=5)
    top = max(r for _, r in tried)
    assert [n for n, _ in tried] == [2, 4, 6] and size == min(n for n, r in tried if r == top)
    ranker.save(model, str(tmp_path / "m"))
    back = ranker.load(str(tmp_path / "m"), names)
    both = ranker.score_models({"a": model, "b": back}, df).toPandas()
    assert np.allclose(both.score_a, both.score_b) and abs(both.groupby("qid").score.mean()).max() < 1e-9
    alone = ranker.score_models({"a": model}, df).toPandas().set_index("item_idx").score
    assert np.allclose(alone.loc[both.item_idx], both.score_a)
    for wrong in (
        lambda: ranker.train(df, names, splits=("audit",)), lambda: ranker.train(df.withColumn("split", F.lit("audit")), names, splits=("fit", "dev")), lambda: ranker.train(df, names, splits=("dev",)),
        lambda: ranker.numeric_inputs(df.withColumn("name", F.lit("a"))), lambda: ranker.load(str(tmp_path / "m"), ["y", "x", "flag"]), lambda: ranker.score(model, df.drop("y")),
    ):
        with pytest.raises(ValueError):
            wrong()


def test_loss_of_a_query_with_many_relevant_items(spark):
    """Ties by position, null scores, repeated truth; equal to counting those ahead."""
    rng = random.Random(12)
    found = [(q, i, None if rng.random() < 0.1 else float(rng.randint(0, 5))) for q in range(4) for i in range(60) if rng.random() < 0.7]
    truth = [(q, rng.randrange(70)) for q in range(5) for _ in range(80)]
    order = {q: [i for _, i, _ in sorted((-s, i, 0) for x, i, s in found if x == q and s is not None)] for q in range(5)}
    want = Counter("missing" if i not in order[q] else "hit" if order[q].index(i) < 7 else "below" for q, i in set(truth))
    t, c = spark.createDataFrame(truth, "qid int, item_idx int"), spark.createDataFrame(found, "qid int, item_idx int, score double")
    assert {r.outcome: r.n for r in evaluation.loss(t, c, 7).collect()} == want
    assert evaluation.loss(t.where("false"), c, 7).count() == 0
    assert {r.outcome: r.n for r in evaluation.loss(t, c.where("false"), 7).collect()} == {"missing": len(set(truth))}

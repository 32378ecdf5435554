"""Ranked search, Jaccard join, clusters and prefix counts, against brute force."""

import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import _common, jaccard, kmeans, search, tokens
from lodestone.llm.queries import QUERIES

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng, n, size=120):
    return " ".join(f"w{min(int(rng.paretovariate(0.7)), size)}" for _ in range(n))


# --- ranked search


def ranking(docs, items, best=50):
    find = re.compile(search.TERM).findall
    terms = [(i, Counter(find((t or "").translate(LOW)))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    n_docs, n_terms = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    asked = defaultdict(set)
    for q, t in items:
        asked[q] |= set(find((t or "").translate(LOW)))
    out = {}
    for q, ts in asked.items():
        scores = []
        for i, c in terms:
            m = 50 + (50 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2.0 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts & c.keys())
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out[q] = [(i, -s) for s, _, _, i in sorted(scores, key=lambda x: x[:3])[:best]]
    return {q: r for q, r in out.items() if r}


@pytest.fixture(scope="module")
def shelf():
    rng = random.Random(9)
    docs = [(i, prose(rng, rng.randint(1, 90))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, " .,;"), (303, "Déjà-vu w1 É"), (304, docs[3][1]), (305, docs[3][1]), (None, docs[4][1]), (None, docs[4][1]), (306, prose(rng, 30_000, 5000)), (7, "w1 w2 twice")]
    shared = prose(rng, 8, 4000)
    items = [(q, f"{shared if q % 3 else ''} {prose(rng, 12)} W{q}") for q in range(40)] + [(40, None), (41, "..."), (42, "nowhere at all"), (43, "DÉJÀ É"), (None, "w5 w9"), (None, "w11"), (2, "w77 w78")]
    return docs, items


def check_search(spark, shelf, **how):
    docs, items = shelf
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(7).withColumns({c: F.lit("x") for c in ("item", "term", "rank", "ids", "block")})
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("source", F.lit(1))
    got = defaultdict(list)
    for r in search.search(d, i, **how).collect():
        got[r.item_id].append((r["rank"], r.doc_id, r.score))
    want = ranking(docs, items, how.get("best", 50))
    assert got.keys() == want.keys()
    for q, rows in got.items():
        assert [r for r, _, _ in sorted(rows, key=lambda r: r[0])] == list(range(1, len(want[q]) + 1))
        assert [(d, s) for _, d, s in sorted(rows, key=lambda r: r[0])] == want[q]


def test_search(spark, shelf):
    check_search(spark, shelf)


def test_search_in_blocks_and_without_a_list_of_terms(spark, shelf, monkeypatch):
    for name, value in (("MOST_ASKED", 3), ("PACK", 16), ("CELLS", 2000)):
        monkeypatch.setattr(search, name, value)
    blocks = search.graph_blocks
    monkeypatch.setattr(search, "graph_blocks", lambda asked, weights: blocks(asked, weights, 7))
    check_search(spark, shelf, best=9)


def test_items_share_term_sets(spark):
    items = [(q, "the of and to in " + ("red stone river " if q % 2 else "old blue sky ") + f"own{q}") for q in range(30)]
    asked = search.item_terms(spark.createDataFrame(items, "item_id long, text string"))
    atoms, pairs, ends = search.share(asked)
    per = defaultdict(set)
    parts = {r.node: (r.low, r.high) for r in pairs.collect()}
    terms = defaultdict(set)
    for r in atoms.collect():
        terms[r.node].add(r.term)

    def under(node):
        return terms[node] if node not in parts else under(parts[node][0]) | under(parts[node][1])

    for r in ends.collect():
        assert not per[r.item] & under(r.node)
        per[r.item] |= under(r.node)
    assert per == {str(q): set(t.split()) for q, t in items}
    assert len(terms) == 33 and 1 <= len(parts) <= 2 and ends.count() == 60  # two shared sets, and one term of its own an item


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    some = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert search.search(none, items).count() == 0
    assert search.search(some, items.where("false")).count() == 0
    assert [tuple(r)[:3] for r in search.search(some, items).collect()] == [(1, 1, 1)]


# --- Jaccard join


def sets_of(rows):
    out = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        out.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def joined(rows):
    """Size and component of each row, by all links."""
    sets = sets_of(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    lists = defaultdict(list)
    for j, s in enumerate(sets):
        for g in s:
            lists[g].append(j)
    for j, s in enumerate(sets):
        for k, n in Counter(k for g in s for k in lists[g] if k > j).items():
            if 100 * n >= 80 * (len(s) + len(sets[k]) - n):
                root[find(j)] = find(k)
    least = {}
    for j, (i, _) in enumerate(rows):
        least[find(j)] = min((x for x in (least.get(find(j)), i) if x is not None), default=None)
    return Counter((i, len(s), least[find(j)] if s else i) for j, ((i, _), s) in enumerate(zip(rows, sets, strict=True)))


def library(seed):
    rng = random.Random(seed)
    voc = [f"v{i}" for i in range(400)]
    texts, stock = [], [" ".join(rng.choice(voc) for _ in range(40)) for _ in range(3)]
    for _ in range(25):
        base = [rng.choice(voc) for _ in range(rng.randint(3, 110))]
        for _ in range(rng.randint(1, 30)):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(voc)
            if rng.random() < 0.2:
                w = w[: rng.randint(1, len(w))] + [rng.choice(voc) for _ in range(rng.randint(0, 9))]
            texts.append(" ".join(w))
    chain = [rng.choice(voc) for _ in range(80)]  # each near to the one before, the ends not to each other
    for k in range(25):
        chain[3 * k : 3 * k + 2] = rng.choices(voc, k=2)
        texts.append(" ".join(chain))
    texts += [f"{rng.choice(stock)} {' '.join(rng.choices(voc, k=30))}" for _ in range(30)]
    texts += ["", None, " \n\t", "one", "One", "one two", "a b c d", "A B  c\nD", "ÀB é c d", "àb é c d", " ".join(rng.choices(voc, k=20_000))]
    texts += [texts[0]] * 12
    rng.shuffle(texts)
    return list(enumerate(texts)) + [(None, texts[1]), (None, None), (5, texts[5]), (6, "another text of the same id here")]


def test_jaccard_join(spark):
    rows = library(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6).withColumns({c: F.lit(1) for c in ("key", "n", "first", "label", "id", "part")})
    got = Counter(tuple(r) for r in jaccard.classes(docs).select("doc_id", "n_shingles", "component_id").collect())
    assert got == joined(rows)


def test_jaccard_join_in_small_parts_with_hot_lists(spark, monkeypatch):
    for name, value in (("CHUNK", 700), ("BYTES_PER_BUCKET", 9000), ("PART_SETS", 9), ("PART_SHINGLES", 400), ("SHARE", 3), ("GROWTH", 2), ("BROADCAST_IDS", 5)):
        monkeypatch.setattr(jaccard, name, value)
    monkeypatch.setattr(_common, "HOT_ROWS", 8)
    import lodestone.llm.graph as graph

    monkeypatch.setattr(graph, "HOT_ROWS", 8)
    rows = [r for r in library(4) if r[0] is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert Counter(tuple(r) for r in jaccard.classes(docs).select("doc_id", "n_shingles", "component_id").collect()) == joined(rows)


def test_jaccard_bounds_and_nothing(spark):
    """Sets of n and n + k shingles with k more at the end: linked exactly up to 80 percent."""
    rows = []
    for at, (n, k) in enumerate(((4, 1), (4, 2), (8, 2), (8, 3), (40, 10), (40, 11), (400, 100), (400, 101), (3, 1), (2, 1))):
        w = [f"d{at}x{i}" for i in range(n + k + 4)]
        rows += [(10 * at, " ".join(w[: n + 4])), (10 * at + 1, " ".join(w))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.classes(docs).collect()}
    assert [got[10 * at + 1] == 10 * at for at in range(10)] == [True, False, True, False, True, False, True, False, False, False]
    assert jaccard.classes(docs.where("false")).count() == 0
    assert [tuple(r) for r in jaccard.classes(docs.where("doc_id = 0").withColumn("text", F.lit(None).cast("string"))).collect()] == [(0, 0, 0)]


def test_registered_search_and_join_on_the_given_tables(spark, data):
    import duckdb

    from lodestone.llm.queries import ORACLE_SQL

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    want = con.execute(ORACLE_SQL["op11_search"]).df()
    got = QUERIES["op11_search"](spark, data).toPandas()[list(want.columns)]
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted(map(tuple, want.to_numpy().tolist())) and len(got)
    rows = [tuple(r) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in QUERIES["op12_jaccard_join"](spark, data).select("doc_id", "n_shingles", "component_id").collect()) == joined(rows)


# --- clusters


def lloyd(rows, k=8, rounds=10, dims=64):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(math.floor(1024 * x)) < kmeans.LARGEST for x in v)]
    if not kept:
        return []
    v = np.array([x for _, x in kept], np.int64)
    order = sorted(range(len(kept)), key=lambda j: (kept[j][0] is None, hashlib.sha256(f"3:{kept[j][0]}".encode()).hexdigest(), kept[j][1]))
    c = v[order[:k]]
    for _ in range(rounds):
        near = ((v[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        c = np.array([v[near == j].sum(axis=0) // (near == j).sum() if (near == j).any() else c[j] for j in range(len(c))])
    d = ((v[:, None] - c[None]) ** 2).sum(axis=2)
    near = d.argmin(axis=1)
    own = d[np.arange(len(v)), near]
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c.tolist()]
    return [(i, int(j), int(x), int(own[near == j].sum()), int(own.sum()), sha[j]) for (i, _), j, x in zip(kept, near, own, strict=True)]


def check_clusters(spark, rows, tmp_path, name="e"):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4).withColumns({c: F.lit(1) for c in ("label", "v", "x", "cluster", "draw")})
    df.write.parquet(str(tmp_path / name / "embeddings.parquet"))
    got = Counter(tuple(r) for r in QUERIES["op13_clusters"](spark, str(tmp_path / name)).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())
    assert got == Counter(lloyd(rows))


def test_clusters(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(11, 64))
    rows = [(i, (centres[i % 11] + rng.normal(size=64) * 0.4).tolist()) for i in range(900)]
    hot = rows[0][1]
    rows += [(1000 + i, hot) for i in range(300)] + [(3, rows[7][1]), (3, rows[8][1]), (None, rows[9][1])]
    rows += [(2000, None), (2001, [0.5] * 63), (2002, [0.5] * 65), (2003, [None] + [0.1] * 63), (2004, [math.nan] + [0.1] * 63), (2005, [math.inf] + [0.1] * 63), (2006, [1e300] + [0.0] * 63), (2007, [])]
    rows += [(3000 + i, [float(x) for x in rng.integers(-20, 20, 64) * 400]) for i in range(12)]  # large components
    monkeypatch.setattr(kmeans, "BLOCK", 100)
    check_clusters(spark, rows, tmp_path)


def test_only_expired_vectors_are_rescanned():
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.normal(c, 3, (200, 4)) for c in (0, 100, 200)]).astype("<i4")
    c = np.array([[1] * 4, [101] * 4, [199] * 4])
    block = kmeans.Block(np.arange(600), np.ones(600, bool), v, np.full(600, 255, np.uint8), [[] for _ in range(3)])
    block.rescan(list(range(600)), c, np.zeros(3))
    assert sum(len(h) for h in block.heaps) == 600
    drift = kmeans.drifts(c, c + np.array([[1], [-1], [1]]))
    assert block.expired(drift) == []
    moved = c + np.array([[93], [0], [0]])
    gone = block.expired(drift + kmeans.drifts(c, moved))
    rest = np.setdiff1d(np.arange(600), gone)
    assert 0 < len(gone) < 600 and sum(len(h) for h in block.heaps) == len(rest)
    assert (kmeans.squared_distances(v[rest], moved).argmin(axis=1) == block.cluster[rest]).all()


def test_few_vectors_and_ties(spark, tmp_path):
    e = lambda *x: [*map(float, x), *[0.0] * (64 - len(x))]
    check_clusters(spark, [(i, e(i % 3)) for i in range(5)], tmp_path, "few")
    check_clusters(spark, [(i, e(i // 2 * 2, 1 if i % 2 else -1)) for i in range(60)], tmp_path, "ties")
    check_clusters(spark, [(i, e(1)) for i in range(40)], tmp_path, "same")
    assert kmeans.cluster(spark.createDataFrame([], "vec_id long, embedding array<double>"))[0].count() == 0
    assert kmeans.report(*kmeans.cluster(spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>"))).count() == 0


# --- prefix counts


@pytest.fixture(scope="module")
def counter():
    return tokens.PrefixCounter(tokens.vocabulary_path())


def test_counts_where_characters_combine(counter):
    rng = random.Random(2)
    letters = [" ", " ", "\x1c", "\x85", " ", "゙", "a", "b", "é", "é", "ộ", "豈", "漢", "한", "한", "й", "'s", "'", "1", "²", "ﬁ", "İ", "ß", "!", "…", "́", "क़", "ொ", "Å", "<|", "<|endoftext|>", "x"]
    for n in range(150):
        t = rng.choice(["", "abc" * 60, "漢字" * 100, "!?" * 90, "가나" * 80]) + "".join(rng.choice(letters) for _ in range(rng.randint(1, 40)))
        counts = counter.prefixes(t)
        for k in rng.sample(range(len(t) + 1), min(25, len(t) + 1)):
            assert counts[k] == len(counter.bpe.library.encode(t[:k], add_special_tokens=False).ids), (t, k)


@pytest.mark.parametrize("run", ["漢字書文語" * 4000, "abcdefghij" * 2000])
def test_long_runs_with_one_odd_character_take_as_long_as_plain_ones(counter, run):
    import time

    def took(t):
        began = time.process_time()
        counts = counter.prefixes(t)
        return time.process_time() - began, counts

    plain = min(took(run)[0] for _ in range(3))
    for odd in ("豈", "é"):
        for at in (0, 10_000, 20_000):
            t = run[:at] + odd + run[at:]
            seconds, counts = took(t)
            assert seconds < 4 * plain + 0.5
            for k in (1, at, at + 1, min(at + 2, len(t)), len(t)):
                assert counts[k] == len(counter.bpe.library.encode(t[:k], add_special_tokens=False).ids)


def test_the_last_open_document_is_drawn(spark, monkeypatch):
    """Like sources take one document more or less, as often as their fraction says; a rerun takes the same, and one table stays."""
    from lodestone.llm import _common, mix

    monkeypatch.setattr(mix, "LARGE", 20)
    rows = [(1000 * s + i, f"s{s:03d}", 10) for s in range(200) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    kept = _common.scratch_dir(spark).removeprefix("file://")
    before = set(os.listdir(kept)) if os.path.isdir(kept) else set()
    out = mix.round_copies(df)
    assert len({f.rsplit("/", 2)[-2] for f in out.inputFiles()}) == 1
    told = out.toPandas()
    again = mix.round_copies(df.repartition(5)).toPandas()
    order = ["source", "doc_id"]
    assert told.sort_values(order).copies.tolist() == again.sort_values(order).copies.tolist()
    told["taken"] = told.copies * 10
    by = told.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    for target, own in by.groupby(by.target.round(6)):
        low = target // 10 * 10
        assert set(own.taken) <= {low, low + 10}
        p = (target - low) / 10
        assert abs((own.taken.mean() - target) / 10) <= 4 * (p * (1 - p) / len(own)) ** 0.5 + 1e-9
    left = {f.rsplit("-", 1)[0] for f in set(os.listdir(kept)) - before}
    assert not left & {"mix-level", "mix-units", "mix-large", "mix-targets"}


def test_quality_of_repeated_rows_is_the_same_again(spark, monkeypatch):
    """More rows than the curve takes: which ones it takes doesn't depend on their places."""
    from lodestone.llm import quality

    monkeypatch.setattr(quality, "SAMPLE", 5)
    words = ["alpha beta gamma delta", "spam spam win now", "one two three", "buy buy buy cheap"]
    docs = spark.createDataFrame([(i, f"{words[(i + j) % 4]} {i} {j} " * (j + 2)) for i in range(20) for j in range(9)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    one, two = (quality.train(d, labels) for d in (docs, docs.orderBy("text").repartition(7)))
    assert one[0] == two[0] and one[1].tolist() == two[1].tolist()

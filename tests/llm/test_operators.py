"""The ten operators against brute force, and their defined results on odd input."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lodestone.llm import exact, langid, mix, pack, quality, shard, simhash, spots, substrings, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def passage(rng, n=60):
    return " ".join(rng.choice(["the", "of", "und", "la", "erste", "river", "stone", "Mountain", "été", "walks", "42", "a"]) + rng.choice("abcdefgh") * rng.randint(0, 3) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Odd texts and a small corpus with copies, near copies and shared passages."""
    rng = random.Random(5)
    base = [passage(rng, rng.randint(1, 300)) for _ in range(60)]
    shared = passage(rng, 50)
    out = [None, "", "  \t\n", "one", "one two", "the the the", "!!! 123", "x" * 3000, "Er " * 400, base[0], base[0].replace(" ", "  \n"), base[0] + " ", "\x85a\x1cb \xa0", "𝒳 ﬁ İ ß 日本語"]
    out += base + base[:20] + [base[7]] * 30
    out += [b + " " + shared + " " + c for b, c in zip(base[20:35], base[35:50], strict=True)]
    for b in base[:25]:  # near copies: one word changed
        w = b.split()
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    return out + [" ".join(passage(rng, 2000) for _ in range(3))]


@pytest.fixture(scope="module")
def docs(spark, texts):
    """Extra columns have names that operators use themselves; two rows repeat, one has null everywhere."""
    rows = [(i, t, [None, "en", "fr"][i % 3], [None, "src0", "src1", "Ä"][min(i % 9, 3)], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[20], rows[20], (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    return df.withColumns({c: F.lit("mine") for c in ("bucket", "shard", "rank", "fp", "part", "row", "size", "key", "copies", "k1", "kept", "tie", "n")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(texts):
    return [*enumerate(texts), (20, texts[20]), (20, texts[20]), (None, None)]


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact(docs, texts, empty):
    got = sorted(exact.duplicate_groups(docs).collect(), key=str)
    groups = {}
    for i, t in pairs(texts):
        groups.setdefault(norm(t), []).append(i)
    assert len(got) == len(pairs(texts))
    by_hash = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for r in got:
        ids = by_hash[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == min(x for x in ids if x is not None)
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(dict.fromkeys(by_hash, 1))
    assert exact.merge_runs(exact.digest_rows(docs), fan_in=2).count() == len(groups)  # more rounds, same groups
    kept = exact.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)
    assert exact.duplicate_groups(empty).count() == 0 and exact.drop_copies(empty).count() == 0


def test_mix(docs, texts, empty, monkeypatch):
    monkeypatch.setattr(mix, "GROUP", 4)
    got = mix.round_copies(mix.sized_rows(docs)).collect()
    again = mix.round_copies(mix.sized_rows(docs.repartition(3))).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    size = {}
    for r in got:
        size[r.source] = size.get(r.source, 0) + r.size * r.rows
        assert 0 <= r.copies <= 2
    assert sum(size.values()) == sum(len(WORD.findall(t or "")) for _, t in pairs(texts))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped = set()
    while True:  # the contract's resharing
        left = 1.5 * sum(size.values()) - sum(2 * size[s] for s in capped)
        goal = {s: 2 * size[s] if s in capped else left * weight[s] / sum(weight[x] for x in size if x not in capped) for s in size}
        over = {s for s in size if goal[s] > 2 * size[s]}
        if not over:
            break
        capped |= over
    for s in size:
        own = [r for r in got if r.source == s]
        assert own[0].target == pytest.approx(goal[s]) and own[0].source_size == size[s]
        assert abs(sum(r.copies * r.size * r.rows for r in own) - goal[s]) <= max(r.size * r.rows for r in own)
    taken = Counter((r.doc_id, r.source) for r in mix.mix(docs).collect())
    assert taken == Counter({(r.doc_id, r.source): r.copies * r.rows for r in got if r.copies})
    assert mix.mix(docs).columns == docs.columns
    assert mix.round_copies(mix.sized_rows(empty)).count() == 0 and mix.mix(empty).count() == 0


def test_pivotal_steps_are_unbiased(spark):
    rows = spark.createDataFrame([(i, f"s{i % 200}", 3 + i % 5) for i in range(4000)], "doc_id long, source string, size long")
    out = mix.round_copies(rows).toPandas()
    want = (out.target / out.source_size).mean()
    assert out.copies.mean() == pytest.approx(want, abs=0.02)


def test_tokens(docs, texts, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.vocabulary_path())
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    odd = ["été 'stop <|endoftext|>abc don't we'll!!'s", "'''re're!!'t", "à̕b 👩‍👩‍👧 <|startoftext|>", "ΑΣ ΣΣ's ½²"]
    bpe = tokens.PrefixCounter(tokens.vocabulary_path())
    for t in [*odd, *(x or "" for x in texts)]:
        assert bpe.total(t) == count(t)
    for t in [*odd, texts[15][:200]]:
        assert bpe.prefixes(t).tolist() == [count(t[:k]) for k in range(len(t) + 1)]
        assert count(t[: bpe.longest_prefix(t, 5)]) <= 5
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(docs, limit=100).collect())
    want = sorted((-1 if i is None else i or -1, len((t or "").encode()), count(t or ""), count(t or "") > 100) for i, t in pairs(texts))
    assert got == want
    table = tokens.prefix_table(docs.where("doc_id = 16"))
    n = tokens.truncation_points(table, 20).first().n_chars
    assert count(texts[16][:n]) <= 20 < count(texts[16][: n + 2])
    assert tokens.count_tokens(empty).count() == 0


def test_pack(docs, texts, empty, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(pack, "TOKENS_PER_PART", 3000)
    library = Tokenizer.from_file(tokens.vocabulary_path())
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in pairs(texts)}
    got = pack.pack(docs, length=256).collect()
    for r in got:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
    covered, sequences = Counter(), {}
    for r in got:
        covered[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    times = Counter(i for i, _ in pairs(texts))
    assert covered == Counter({i: times[i] * len(ids[i]) for i in times})
    for s in sequences.values():
        ends = list(itertools.accumulate(n for _, n in sorted(s)))
        assert [o for o, _ in sorted(s)] == [0, *ends[:-1]] and ends[-1] <= 256 and ends[-1] & (ends[-1] - 1) == 0
    assert sorted(sequences) == list(range(len(sequences)))
    assert pack.pack(empty).count() == 0


def test_hilbert_curve_is_one_path():
    points = np.array(list(itertools.product(range(8), repeat=3)))
    order = points[np.argsort(pack.hilbert_keys(points, bits=3))]
    assert len(set(pack.hilbert_keys(points, bits=3).tolist())) == 512
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_quality(spark, data, docs, empty):
    folds = quality.fold(F.lit("7"), 4)
    assert spark.range(1).select(folds.alias("f")).first().f == zlib.crc32(b"7") % 4
    d = data.replace("sf0.001", "sf0.1")
    out = quality.op2_quality(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (out.predicted == out.quality).mean() > 0.97 and out.score.between(0, 1).all()
    labels = spark.createDataFrame([(1, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        scored = quality.score(docs, *quality.train(docs, some))
        assert scored.count() == docs.count() and scored.where("score between 0 and 1").count() == docs.count()
    assert quality.score(empty, *quality.train(empty, labels)).count() == 0


def test_suffix_automaton_finds_longest_matches():
    text, model = "abracadabra abra", langid.Model({"x": "abracadabra", "y": "zzzz yyy"})
    n, i = 0, 0
    while i < len(text):  # plain parse
        k = 1
        while i + k < len(text) and text[i : i + k + 1] in "abracadabra":
            k += 1
        n, i = n + 1, i + k
    assert model.phrases([text, ""])[:, 0].tolist() == [n, 0]


def test_language(spark, data, docs, texts, empty):
    d = data.replace("sf0.001", "sf0.1")
    out = langid.op5_language(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (out.lang_pred == out.lang).mean() > 0.99
    got = langid.identify(docs, langid.samples(docs)).select("doc_id", "__lang.*").collect()
    assert len(got) == len(pairs(texts))
    for r in got:
        letters = r.doc_id is not None and any(c.isalpha() for c in texts[r.doc_id] or "")
        assert (r.lang_pred in ("en", "fr")) if letters else (r.lang_pred == "und" and r.score == 0)
        assert 0 <= r.score <= 1
    assert langid.identify(empty, langid.samples(empty)).count() == 0
    assert {r.p for r in langid.identify(docs, {}).select(F.col("__lang.lang_pred").alias("p")).collect()} == {"und"}


def spots_of(t):
    words, out = re.findall(r"[^\W_]+", t.lower()), set()
    for i, w in enumerate(words):
        if w in spots.ANCHORS:
            c = [x for x in words[i + 1 : i + 1 + spots.REACH] if x not in spots.ANCHORS][: spots.CHAIN]
            if len(c) == spots.CHAIN:
                out.add((w, *c))
    marks = [-1, *[i for i, w in enumerate(words) if w in spots.ANCHORS], len(words)]
    for a, b in zip(marks, marks[1:], strict=False):
        if b - a - 1 > spots.STRETCH:
            out |= {tuple(words[k : k + spots.SHINGLE]) for k in range(a + 1, b - spots.SHINGLE + 1)}
    return frozenset(out) or frozenset([t])


def test_fingerprints(docs, texts, empty, monkeypatch):
    monkeypatch.setattr(spots, "CHARS_PER_PART", 8000)
    clean = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in spots.fingerprints(clean).collect()}
    likeness = lambda a, b: len(a & b) / len(a | b)
    for i, t in enumerate(texts):
        t, after = t or "", texts[(i + 1) % len(texts)] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(likeness(spots_of(t), spots_of(edited))) and r.near_next == pytest.approx(likeness(spots_of(t), spots_of(after)))
    by_text = {}
    for i, t in enumerate(texts):
        by_text.setdefault(t or "", set()).add(got[i].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert spots.fingerprints(docs).count() == docs.count() and spots.fingerprints(empty).count() == 0


def test_half_equal_texts_are_a_third_alike(spark):
    """Whatever their anchors: words with many, few and none, and texts near the bound between them."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("bcdfgklmnprst", k=6))
    texts = []
    for every in (2, 4, 8, 14, 20, 40, 60, 10_000):
        for n in (60, 90, 150, 400):
            texts.append(" ".join("the" if k % every == every - 1 else word() for k in range(n)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.near_edited for r in spots.fingerprints(docs).orderBy("doc_id").collect()]
    assert all(len(t) > 300 for t in texts) and min(got) > 0.1 and sum(got) / len(got) == pytest.approx(1 / 3, abs=0.06)


def test_substrings(docs, texts, empty, monkeypatch):
    monkeypatch.setattr(substrings, "BYTES_PER_BUCKET", 20_000)
    words = [(i, WORD.findall(t or "")) for i, t in pairs(texts)]
    seen = Counter(tuple(w[j : j + 35]) for _, w in words for j in range(len(w) - 34))
    want = []
    for i, w in words:
        keep = [True] * len(w)
        for j in range(len(w) - 34):
            if seen[tuple(w[j : j + 35])] > 1:
                keep[j : j + 35] = [False] * 35
        left = " ".join(x for x, k in zip(w, keep, strict=True) if k)
        want.append((str(i), len(w), keep.count(False), hashlib.sha256(left.encode()).hexdigest(), left))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in substrings.remove_repeats(docs).collect()) == sorted(want)
    assert any(0 < w[2] < w[1] for w in want)
    assert substrings.remove_repeats(empty).count() == 0


def test_shards(spark, docs, texts, empty, tmp_path):
    got = shard.shard_rows(docs).collect()
    assert len(got) == len(pairs(texts))
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        t = "" if r.doc_id is None else texts[r.doc_id] or ""
        assert r.size == len(t.encode()) + 1 and r.text_crc32 == zlib.crc32(t.encode())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(16))
    where = {}
    for r in got:
        where.setdefault("" if r.doc_id is None else texts[r.doc_id] or "", set()).add(r.shard)
    assert all(len(v) == 1 for v in where.values())
    assert shard.shard_rows(empty).count() == 0
    rng = random.Random(1)
    many = spark.createDataFrame([(i, "hot" * 300 if i % 40 == 0 else "x" * rng.randint(1, 900) + str(i)) for i in range(20_000)], "doc_id long, text string")
    sizes = [r["sum(size)"] for r in shard.shard_rows(many).groupBy("shard").sum("size").collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 0.015 * sum(sizes) / 16
    shard.write_shards(docs.drop("shard"), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == docs.count()


def simhash_of(t):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def components_of(values):
    """Smallest index reachable at two or fewer differing bits."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    array = np.array(values, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= 2).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_simhash(docs, texts, empty):
    got = simhash.near_components(docs).collect()
    fps = [simhash_of(t) for t in texts]
    roots = components_of(fps)
    assert len(got) == len(pairs(texts))
    for r in got:
        i = 0 if r.doc_id is None else r.doc_id
        assert r.fp % (1 << 64) == fps[i] and r.component_id == roots[i]
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(set(roots))
    assert simhash.near_components(empty).count() == 0 and simhash.drop_near_copies(empty).count() == 0


@pytest.mark.parametrize("most", [1 << 15, 10])
def test_gray_index_finds_all_links(spark, most):
    rng = random.Random(3)
    values = {0, (1 << 64) - 1}
    for _ in range(60):
        v = rng.getrandbits(64)
        for _ in range(rng.randint(1, 60)):  # chains and clusters
            values.add(v)
            v ^= (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
    low = rng.getrandbits(32)
    values |= {low | rng.getrandbits(20) << 40 for _ in range(300)}  # many that share two blocks
    values = list(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    root = {r.node: r.root for r in simhash.components(simhash.links(df, most=most)).collect()}
    want = components_of(values)
    got = [root.get(v, v) for v in signed]
    assert len(set(got)) == len(set(want)) and len(set(zip(got, want, strict=True))) == len(set(want))
    x = np.sort(np.array(values, np.uint64))
    q, m = simhash.GrayIndex(x).search(x[:50], 2)
    assert set(zip(q.tolist(), m.tolist(), strict=True)) == {(i, j) for i in range(50) for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= 2).tolist()}


def test_gray_rank(spark):
    ranks = [r.g for r in spark.range(16).select(simhash.gray_rank(F.col("id").bitwiseXOR(F.shiftright("id", 1))).alias("g")).collect()]
    assert ranks == list(range(16)) and math.log2(16) == 4

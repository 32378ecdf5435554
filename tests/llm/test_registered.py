"""The registered queries, with their production parameters, against brute force on one small table."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from lodestone.llm import _common, langid, mix, quality, shard, simhash, spots, substrings, tokens
from lodestone.llm.queries import QUERIES

from .test_operators import SCHEMA, WORD, components_of, norm, passage, simhash_of, spots_of



@pytest.fixture(scope="module")
def table():
    rng = random.Random(8)
    base = [passage(rng, rng.randint(30, 160)) for _ in range(40)]
    shared = passage(rng, 45)
    texts = [None, "", " \n", "one", "ＡＢＣ ёж", "日本語の文章です。", "Ещё один текст о лесе и реке", "ábc é", "<|endoftext|> x"] + base
    texts += [base[3]] * 12 + [base[4].replace(" ", "  ")] + [f"{a} {shared} {b}" for a, b in zip(base[10:18], base[20:28], strict=True)]
    for b in base[:12]:
        w = b.split()
        w[len(w) // 3] = "other"
        texts.append(" ".join(w))
    texts.append(" ".join(passage(rng, 900) for _ in range(2)))
    sources = [None, "a", "b", "c", "Z"]
    return [(i, t, [None, "en", "fr"][i % 3], rng.choice(sources), len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def folder(spark, table, tmp_path_factory):
    path = tmp_path_factory.mktemp("registered")
    df = spark.createDataFrame(table, SCHEMA).repartition(5).withColumns({c: F.lit(1) for c in ("__words", "__lang", "copies", "part", "set_id", "class_id", "salt", "run", "digest")})
    df.write.parquet(str(path / "documents.parquet"))
    labels = [(i, i % 2, 0) for i, *_ in table] + [(2, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


def run(spark, folder, n):
    [name] = [q for q in QUERIES if q.startswith(f"op{n}_")]
    return QUERIES[name](spark, folder).collect()


def test_op1(spark, folder, table):
    got = {r.doc_id: r for r in run(spark, folder, 1)}
    size = {i: len(WORD.findall(t or "")) for i, t, *_ in table}
    own = defaultdict(list)
    for i, _, _, s, _ in table:
        own[s].append(i)
    total, order = {s: sum(size[i] for i in own[s]) for s in own}, sorted(own, key=lambda s: (s is None, s or ""))
    weight, capped = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, set()
    while True:
        left = 1.5 * sum(total.values()) - sum(2 * total[s] for s in capped)
        goal = {s: 2 * total[s] if s in capped else left * weight[s] / sum(weight[x] for x in own if x not in capped) for s in own}
        above = {s for s in own if goal[s] > 2 * total[s]}
        if not above:
            break
        capped |= above
    for s in own:
        assert all(got[i].size == size[i] and got[i].source_size == total[s] and got[i].target == pytest.approx(goal[s]) and 0 <= got[i].taken <= 2 * size[i] for i in own[s])
        assert abs(sum(got[i].taken for i in own[s]) - goal[s]) <= max(size[i] for i in own[s]) / 2


def test_large_documents_leave_little(spark):
    """Every source is within 1 / (2 LARGE) of its size, or half of the smallest document, though few documents hold most words."""
    rng = random.Random(5)
    rows = [(f"s{s}", rng.choice([3000, 9000, 20_000])) for s in range(6) for _ in range(12)] + [(f"s{s}", rng.randint(5, 40)) for s in range(6) for _ in range(700)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, source string, size long")
    out = mix.round_copies(df).toPandas()
    out["taken"] = out.copies * out["size"] * out.rows
    by = out.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("source_size", "first"), smallest=("size", "min"))
    assert (abs(by.taken - by.target) <= np.maximum(by["size"] / (2 * mix.LARGE), by.smallest / 2) + 1e-6).all()


def test_op2(spark, folder, table):
    got = {r.doc_id: r for r in run(spark, folder, 2)}
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    dictionaries, w = quality.train(docs, labels)
    kind = [zstandard.DICT_TYPE_FULLDICT if d[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT for d in dictionaries]
    packers = [zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d, dict_type=k), write_content_size=False, write_checksum=False, write_dict_id=False) for d, k in zip(dictionaries, kind, strict=True)]
    for i, t, *_ in table:
        data = (t or "").encode()
        bad, good = (sum(len(p.compress(data[k : k + 1024])) for k in range(0, len(data), 1024)) for p in packers)
        diff, ratio = ((bad - good) / (bad + good), (bad + good) / (2 * len(data))) if data else (0.0, 1.0)
        d, r = 10 * diff, math.log(max(ratio, 1e-3)) + 1
        score = 1 / (1 + math.exp(-min(max(sum(a * b for a, b in zip((1, d, r, d * r, d * d, r * r), w, strict=True)), -30), 30)))
        assert got[i].score == pytest.approx(score) and got[i].predicted == int(score >= 0.7) and got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)


def test_dictionaries_see_parts_of_whole_texts(spark, monkeypatch):
    monkeypatch.setattr(quality, "PARTS", 40)
    seen = []
    monkeypatch.setattr(quality, "build_dictionary", lambda texts: seen.append(texts) or b"x" * 300)
    text = "".join(f"{i:07d} " for i in range(40_000))
    docs = spark.createDataFrame([(i, text) for i in range(60)], "doc_id long, text string")
    quality.train(docs, spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int"))
    assert all(len(parts) == 40 and max(int(p[8:15]) for p in parts) > 30_000 for parts in seen)


def parse(text, sample):
    n = i = 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i : i + k + 1] in sample:
            k += 1
        n, i = n + 1, i + k
    return n


def test_op5(spark, folder, table, monkeypatch):
    monkeypatch.setattr(langid, "LANE", 32)
    learned = langid.samples(spark.read.parquet(f"{folder}/documents.parquet"))
    assert set(learned) == {"en", "fr"}
    fold = lambda t: re.sub(r"[\W\d_]+", " ", t.lower().replace("́", "Q")).replace("Q", "́")
    for r in run(spark, folder, 5):
        t = table[r.doc_id][1]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if not any(c.isalpha() for c in t or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cost = {x: parse(fold(t), learned[x].lower()) * math.log2(len(learned[x]) + 2) for x in learned}
        best, second = sorted(cost, key=lambda x: (cost[x], x))
        assert r.lang_pred == best and r.score == pytest.approx(1 - cost[best] / cost[second])


@pytest.mark.parametrize("lane", [1, 3, 50, 4096])
def test_lanes_change_no_count(lane, monkeypatch):
    monkeypatch.setattr(langid, "LANE", lane)
    rng = random.Random(lane)
    samples = {x: "".join(rng.choices(letters, k=600)) for x, letters in (("a", "abcd"), ("b", "abce "), ("c", "xyz"))}
    model = langid.Model(samples)
    texts = ["".join(rng.choices("abcdexyz ", k=rng.randint(0, 500))) for _ in range(30)] + [samples["a"] * 40, "", "é" * 60]
    assert model.phrases(texts).tolist() == [[parse(t, samples[x]) for x in model.languages] for t in texts]


def test_little_labelled_text_does_not_lose(spark):
    rng = random.Random(12)
    lexicon = {x: ["".join(rng.choices(letters, k=5)) for _ in range(60)] for x, letters in (("few", "abcdefgh"), ("many", "abcdefgh"))}
    write = lambda x, n: " ".join(rng.choices(lexicon[x], k=n))
    model = langid.Model({"few": write("few", 250), "many": write("many", 3500)})
    asked = [(x, write(x, 30)) for x in lexicon for _ in range(30)]
    assert model.predict([t for _, t in asked])[0] == [x for x, _ in asked]


def test_op6(spark, folder, table):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.vocabulary_path())
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for r in run(spark, folder, 6):
        t = table[r.doc_id][1] or ""
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), count(t), count(t) > 2048)
        assert r.checkpoints == [count(t[:k]) for k in range(1024, len(t) + 1, 1024)]
        if r.over_limit:
            assert count(t[: r.fit_chars]) <= 2048 and all(count(t[:k]) > 2048 for k in range(r.fit_chars + 1, min(r.fit_chars + 40, len(t) + 1)))
        else:
            assert r.fit_chars == len(t)


def test_prefix_counts_of_every_script():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.vocabulary_path())
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    counter, rng = tokens.PrefixCounter(tokens.vocabulary_path()), random.Random(2)
    pieces = [*"aéЖ' ́!s1\nñKΣ日ıİſ한か", "<|endoftext|>", "'ll", "é", "क़", "한"]
    for _ in range(120):
        t = "".join(rng.choices(pieces, k=rng.randint(1, 20)))
        assert counter.prefixes(t).tolist() == [count(t[:k]) for k in range(len(t) + 1)], t
    long = " ".join("".join(rng.choices("абвгдежзиклмнопрст", k=rng.randint(2, 9))) for _ in range(20_000))  # as fast as Latin text
    counts = counter.prefixes(long)
    assert counts[-1] == count(long) and len(counts) == len(long) + 1
    for k in rng.sample(range(3000), 20):
        assert counts[k] == count(long[:k])


def test_op7(spark, folder, table, monkeypatch):
    monkeypatch.setattr(spots, "CHARS_PER_PART", 6000)
    got = {r.doc_id: r for r in run(spark, folder, 7)}
    assert len(got) == len(table)
    for i, t, *_ in table:
        t, after, r = t or "", table[(i + 1) % len(table)][1] or "", got[i]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest()) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    by_text = defaultdict(set)
    for i, t, *_ in table:
        by_text[t or ""].add(got[i].fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    got = {r.doc_id: r for r in spots.classified(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    check_classes([(i, frozenset(re.findall(".{8}", r.fingerprint))) for i, r in got.items()], got)


def check_classes(sets, got):
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if len(a & b) / len(a | b) >= 0.8:
            x, y = find(i), find(j)
            root[max(x, y)] = min(x, y)
    size = Counter(find(i) for i in root)
    assert {i: (got[i].class_id, got[i].class_size) for i in root} == {i: (find(i), size[find(i)]) for i in root}
    assert 1 < max(size.values()) < len(sets)


def test_near_duplicates_with_hot_groups_and_blocks(spark, monkeypatch):
    """Chains of near copies, hot signatures that unlike texts share, and groups larger than a block."""
    for name, value in (("HEAVY_SETS", 6), ("HEAVY", 3), ("BLOCK", 4), ("HOT_ROWS", 8), ("BROADCAST_SETS", 10)):
        monkeypatch.setattr(spots, name, value)
    monkeypatch.setattr(_common, "HOT_ROWS", 8)
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("bcdfgklmnprst", k=6))
    prose = lambda n: " ".join(f"the {word()} of {word()} {word()}" for _ in range(n))
    stock, texts = [prose(2) for _ in range(4)], []
    for _ in range(4):  # chains: each text is near to the one before only
        parts = [prose(1) for _ in range(24)]
        for k in range(14):
            parts[k] = prose(1)
            texts.append(" ".join(parts))
    texts += [" ".join([prose(12), *rng.sample(stock, 2)]) for _ in range(30)]  # share stock sentences and nothing else
    texts += [texts[5]] * 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    sets = [(r.doc_id, frozenset(r.s)) for r in docs.select("doc_id", spots.short_set(spots.signatures(F.col("text"))).alias("s")).collect()]
    check_classes(sets, {r.doc_id: r for r in spots.classified(docs).collect()})


def test_op8(spark, folder, table, monkeypatch):
    monkeypatch.setattr(_common, "HOT_ROWS", 3)
    words = {i: WORD.findall(t or "") for i, t, *_ in table}
    seen = Counter(tuple(w[j : j + 35]) for w in words.values() for j in range(len(w) - 34))
    for r in run(spark, folder, 8):
        w = words[r.doc_id]
        gone = {x for j in range(len(w) - 34) if seen[tuple(w[j : j + 35])] > 1 for x in range(j, j + 35)}
        left = " ".join(x for k, x in enumerate(w) if k not in gone)
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), len(gone), hashlib.sha256(left.encode()).hexdigest())


def test_windows_are_told_apart_by_64_bits_at_any_size(monkeypatch):
    h = np.arange(1, 200, dtype=np.uint64) << np.uint64(56)  # equal but for the highest byte
    starts, one, two = substrings.windows(substrings.mix(h), np.array([199]), 5)
    assert len(set(one.tolist())) == len(set(two.tolist())) == len(starts) == 195 and not set(one.tolist()) & set(two.tolist())


def test_op4_and_op10(spark, folder, table, monkeypatch):
    monkeypatch.setattr(_common, "HOT_ROWS", 3)
    groups = defaultdict(list)
    for i, t, *_ in table:
        groups[norm(t)].append(i)
    for r in run(spark, folder, 4):
        own = groups[norm(table[r.doc_id][1])]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (own[0], len(own), r.doc_id == own[0], hashlib.sha256(norm(table[r.doc_id][1]).encode()).hexdigest())
    fps = [simhash_of(t) for _, t, *_ in table]
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in run(spark, folder, 10)} == {i: (f"{fp:016x}", c) for i, (fp, c) in enumerate(zip(fps, components_of(fps), strict=True))}


def test_hubs_of_components(spark, monkeypatch):
    from lodestone.llm import graph

    monkeypatch.setattr(graph, "HOT_ROWS", 3)
    rng = random.Random(9)
    edges = [(0, i) for i in range(1, 40)] + [(i, i + 1) for i in range(100, 160)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(50)]
    edges = [(max(e), min(e)) for e in edges if e[0] != e[1]]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(200):
        for u, v in edges:
            root[u] = root[v] = min(root[u], root[v])
    assert got == root


def test_op3_and_op9(spark, folder, table):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.vocabulary_path())
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t, *_ in table}
    covered, sequences = defaultdict(list), defaultdict(list)
    for r in run(spark, folder, 3):
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
        covered[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts, total in [*((covered[i], len(ids[i])) for i in ids), *((s, None) for s in sequences.values())]:
        ends = list(itertools.accumulate(n for _, n in sorted(parts)))
        assert [s for s, _ in sorted(parts)] == [0, *ends[:-1]] and (ends[-1] == total if total else ends[-1] <= 2048)
    slots, of_text = defaultdict(list), defaultdict(set)
    for r in run(spark, folder, 9):
        t = (table[r.doc_id][1] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(t) + 1, zlib.crc32(t), "bytes", None) and 0 <= r.shard < 16
        slots[r.shard].append(r.slot)
        of_text[t].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(s) == 1 for s in of_text.values())


def test_columns_keep_names_and_values(spark, tmp_path):
    """No operator that returns rows changes a column, whatever its name."""
    names = ["__lang", "__words", "__n", "__digest", "__text", "shard", "salt", "digest", "told", "words", "copies", "key_of_text", "part", "stay_id"]
    rows = [(i, f"the text number {i} of the few", "en", "s", i, *[f"{n}{i}" for n in names]) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA + ", " + ", ".join(f"{n} string" for n in names))
    import corpus_pipeline as pipeline

    for stage in (pipeline.language, pipeline.exact_dedup, pipeline.near_dedup, pipeline.mix_sources):
        out = stage(spark, df, "").collect()
        assert out and all(tuple(r) == rows[r.doc_id] for r in out)
    name = shard.write_shards(df, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert name == "shard_" and sorted(tuple(r) for r in back.select(*df.columns).collect()) == rows


def test_a_shared_folder_is_required_on_a_cluster(spark):
    class Cluster:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        _common.scratch_dir(Cluster())


def test_materialised_tables_are_deleted_when_done_with(spark):
    a = _common.materialize(spark.range(5), "t")
    [folder] = {f.rsplit("/", 1)[0] for f in a.inputFiles()}
    b = _common.materialize(a.withColumn("x", F.col("id") + 1), "t", a)
    import os

    assert not os.path.exists(folder.removeprefix("file://")) and b.count() == 5


def test_foreign_texts_go(spark):
    """The parse decides: long texts of no learned language go, short ones and those of a learned language stay."""
    import corpus_pipeline as pipeline

    rng = random.Random(4)
    english = [passage(rng, 40) for _ in range(60)]
    foreign = ["".join(rng.choices("абвгдежзиклмнопрстуфхцчшщ ", k=120)) for _ in range(5)]
    rows = [(i, t, "en" if i < 55 else None, "s", len(t)) for i, t in enumerate([*english, *foreign, "ёж", "12 34"])]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.doc_id for r in pipeline.language(spark, docs, "").collect()) == [*range(60), 65]


def test_simhash_links_of_near_copies(spark):
    """What the contract's radius finds of texts with one word changed: the share is the method's own, and every link within the radius is found."""
    rng = random.Random(3)
    base = [passage(rng, 250) for _ in range(40)]
    near = [" ".join("changed" if k == 100 else w for k, w in enumerate(t.split())) for t in base]
    texts = base + near
    fps = [simhash_of(t) for t in texts]
    got = {r.doc_id: r.component_id for r in simhash.near_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == components_of(fps)
    assert spots_of(base[0]) != spots_of(base[1])

"""Operators on large scripts, languages of any words and unlabelled tables."""

import random

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from lodestone.llm import langid, spots

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def parse(text, sample):
    n, i = 0, 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i : i + k + 1] in sample:
            k += 1
        n, i = n + 1, i + k
    return n


def test_two_languages_of_one_large_script():
    rng = random.Random(3)
    script = [chr(0x4E00 + i) for i in range(1500)]
    lexicon = {x: ["".join(rng.choices(script, k=rng.randint(2, 3))) for _ in range(400)] for x in ("ja", "zh")}
    write = lambda x, n: "".join(rng.choices(lexicon[x], k=n))
    samples = {x: write(x, 2500) for x in lexicon} | {x: "".join(rng.choices("abcdefghijklmnopqrstuvwxyzäöüßéèçñ ABCDEFG", k=3000)) for x in ("de", "fr")}
    model = langid.Model(samples)
    texts = [write("zh", 40) + "\U0001f600ab", write("ja", 40), "\u0e01\u0e02\u0e03", "", write("zh", 3)]
    want = [[parse(t.lower(), samples[x].lower()) for x in model.languages] for t in texts]
    assert model.phrases(texts).tolist() == want
    asked = [(x, write(x, 15)) for x in ("ja", "zh") for _ in range(50)]
    assert model.predict([t for _, t in asked])[0] == [x for x, _ in asked]


def test_near_copies_in_any_language(spark):
    rng = random.Random(4)
    ru = [rng.choice("бвгдклмн") + "".join(rng.choices("аеиолнрст", k=5)) for _ in range(300)]
    zh = "".join(chr(0x4E00 + rng.randrange(2000)) for _ in range(300))
    code = [f"x{rng.randrange(10**6)} = f{rng.randrange(10**6)}(y{i})" for i in range(100)]
    prose = "the river and the stone of a mountain in the valley with old trees " * 8
    pairs = {
        "ru": (" ".join(ru), " ".join(ru[:150] + ["слово"] + ru[151:])),
        "zh": (zh, zh[:150] + "\u9fa0" + zh[151:]),
        "code": ("\n".join(code), "\n".join(code[:50] + ["other = 1"] + code[51:])),
        "part": (prose + " ".join(ru), prose + " ".join(ru[:150] + ["слово"] + ru[151:])),
        "other": (prose + " ".join(ru), prose + " ".join(reversed(ru))),
    }
    rows = spark.createDataFrame([(k, a, b) for k, (a, b) in pairs.items()], "name string, a string, b string")
    got = {r.name: r.j for r in rows.select("name", spots.jaccard(spots.signatures(F.col("a")), spots.signatures(F.col("b"))).alias("j")).collect()}
    assert all(0.9 < got[k] < 1 for k in ("ru", "zh", "code", "part")) and got["other"] < 0.2


def test_pipeline_without_labels(spark, tmp_path):
    rows = [(0, "a clean text", None, "s", 12), (1, "еще один текст", None, "s", 14), (2, "123 !!!", None, "s", 7), (3, None, None, "s", None), (4, "", None, None, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.doc_id for r in pipeline.language(spark, docs, "").collect()) == [0, 1]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id for r in pipeline.run(spark, str(tmp_path)).collect()} <= {0, 1}
    assert pipeline.run(spark, str(tmp_path)).count() > 0

"""Each stage of the pipeline on its own input, against brute force."""

from collections import Counter

import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from lodestone.llm.queries import ORACLE_SQL, QUERIES

from .test_operators import SCHEMA, WORD, components_of, docs, norm, simhash_of, texts  # noqa: F401


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    by_name = dict(pipeline.STAGES)
    told = by_name["language"](spark, docs, data).persist()
    assert told.columns == columns
    assert {r.doc_id for r in told.collect()} == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text)}
    first = by_name["exact_dedup"](spark, told, data).persist()
    seen = {}
    for r in sorted(told.collect(), key=lambda r: r.doc_id):
        seen.setdefault(norm(r.text), r.doc_id)
    assert sorted(r.doc_id for r in first.collect()) == sorted(seen.values())
    near = by_name["near_dedup"](spark, first, data).persist()
    rows = sorted(first.collect(), key=lambda r: r.doc_id)
    roots = components_of([simhash_of(r.text) for r in rows])
    assert sorted(r.doc_id for r in near.collect()) == sorted({rows[i].doc_id for i in roots})
    mixed = by_name["mix_sources"](spark, near, data).persist()
    assert mixed.columns == columns and max(Counter(r.doc_id for r in mixed.collect()).values()) <= 2
    size = lambda df: sum(len(WORD.findall(r.text or "")) for r in df.collect())
    assert abs(size(mixed) - 1.5 * size(near)) < 0.1 * size(near)
    pieces = by_name["pack"](spark, mixed, data)
    whole = pieces.groupBy("doc_id").agg((F.sum("length") / F.max("doc_tokens")).alias("times"))
    assert {r.doc_id: r.times for r in whole.collect()} == dict(Counter(r.doc_id for r in mixed.collect()))


def test_odd_input_and_empty_tables(spark, docs, tmp_path):  # noqa: F811
    for name, some in (("odd", docs), ("empty", spark.createDataFrame([], SCHEMA))):
        some.write.parquet(str(tmp_path / name / "documents.parquet"))
        assert (pipeline.run(spark, str(tmp_path / name)).count() > 0) == (name == "odd")


def test_names():
    assert [n for n, _ in pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mix_sources", "pack"]
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)

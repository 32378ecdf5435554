"""Ids stored by packing, and links kept of a large group of near copies."""

import random
import zlib
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.llm import jaccard, pack, tokens

from .test_round3 import joined


@pytest.mark.parametrize("sampled", [False, True])
def test_packing_stores_no_table_of_ids(spark, monkeypatch, sampled):
    from tokenizers import Tokenizer

    stored = []

    def kept(df, label, *done_with):
        table = kept.own(df, label, *done_with)
        stored.append(table.agg(*[F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c, t in table.dtypes if t == "binary"] or [F.lit(0)]).first()[0])
        return table

    kept.own = pack.materialize
    monkeypatch.setattr(pack, "materialize", kept)
    monkeypatch.setattr(pack, "TOKENS_PER_PART", 4000)
    if sampled:
        monkeypatch.setattr(pack, "SAMPLE_ROWS", 60)
        monkeypatch.setattr(pack, "SAMPLE_SHARE", 0.2)
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice(["river", "Stein", "un", "of", "42", "é"]) + rng.choice("abc ") for _ in range(rng.choice([0, 3, 40, 200, 900])))) for i in range(300)]
    rows += [(900, "a " * 9000), (901, None), (902, "x <|endoftext|> y")]
    library = Tokenizer.from_file(tokens.vocabulary_path())
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}
    got = pack.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), length=256).collect()
    covered, sequences = Counter(), {}
    for r in got:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
        covered.update((r.doc_id, k) for k in range(r.start, r.start + r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert covered == Counter((i, k) for i, own in ids.items() for k in range(len(own)))
    ends = {k: [*accumulate(n for _, n in sorted(s))] for k, s in sequences.items()}
    assert all([o for o, _ in sorted(s)] == [0, *ends[k][:-1]] for k, s in sequences.items())
    total = sum(map(len, ids.values()))
    assert [ends[k][-1] for k in range(len(ends))] == [256] * (total // 256) + [1 << b for b in reversed(range(8)) if total % 256 >> b & 1]
    parts = -(-total // 4000)
    assert sum(stored) < 4 * 256 * 2 * parts < 2 * total  # at most an open sequence a partition; all ids take two bytes each at least


def test_links_of_near_copies_grow_with_their_number(spark, monkeypatch):
    found = []

    def kept(df, label, *done_with):
        table = kept.own(df, label, *done_with)
        found.extend([table.count()] if label == "jaccard-links" else [])
        return table

    kept.own = jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", kept)
    monkeypatch.setattr(jaccard, "PART_SETS", 64)
    rng = random.Random(17)
    words = [f"v{i}" for i in range(60)]
    base = [rng.choice(words) for _ in range(150)]
    rows = []
    for i in range(400):
        own = list(base)
        for at in rng.sample(range(150), rng.randint(1, 5)):  # some pairs link, some only by way of others
            own[at] = rng.choice(words[:3])
        rows.append((i, " ".join(own)))
    got = Counter(tuple(r) for r in jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())
    assert got == joined(rows) and max(Counter(c for _, _, c in got).values()) > 280
    assert 280 < sum(found) < 5 * len(rows), found  # pairs that link: tens of thousands

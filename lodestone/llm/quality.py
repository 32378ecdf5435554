"""Quality by compression: which of two dictionaries fits a text better.

From labelled text one zstandard dictionary is built of the bad and one of the
good rows. A text is compressed in blocks of ``BLOCK`` bytes with either; the
difference of the two sizes, normalised by their sum, says which class it
resembles. A logistic curve, fitted on labelled rows that the dictionaries
have not seen, turns it into a probability. The curve also takes the
compression ratio, since the difference means little where hardly anything is
left after compression (a word repeated a thousand times).

Bounds: ``SAMPLE`` rows a class for the dictionaries and as many for the
curve, chosen by a hash; of all parts of ``PART`` characters of the former, a
dictionary sees ``PARTS``, again chosen by a hash, wherever they stand in
their texts. Scores are of whole texts.

Defined results: a null or empty text has the features (0, 1); a class without
labelled rows gives everyone the share of good labels (0.5 if there is no
label); null labels are left out; a row labelled several times counts once for
each label it has; repeated rows are scored one by one.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import documents

BLOCK = 1024
SAMPLE = 3000
PART = 2048
PARTS = 6000
DICTIONARY_BYTES = 112_640
LEVEL = 3
CUT = 0.7


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the identifier as text, modulo ``folds`` (null as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


class Compressors:
    """Compressed sizes of a text under the dictionaries of both classes."""

    def __init__(self, dictionaries: list[bytes]):
        import zstandard

        kind = lambda d: zstandard.DICT_TYPE_FULLDICT if d[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
        self.each = [
            zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=kind(d)), write_content_size=False, write_checksum=False, write_dict_id=False)
            for d in dictionaries
        ]

    def features(self, data: bytes) -> tuple[float, float]:
        """Normalised size difference (positive: like the second class) and compression ratio."""
        if not data:
            return 0.0, 1.0
        bad, good = self.each
        b = g = 0
        for i in range(0, len(data), BLOCK):
            part = data[i : i + BLOCK]
            b += len(bad.compress(part))
            g += len(good.compress(part))
        return (b - g) / (b + g), (b + g) / (2 * len(data))


def build_dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; of too little text, the text itself serves as one."""
    import zstandard

    parts = [d[i : i + 2 * BLOCK] for d in (t.encode() for t in texts) for i in range(0, len(d), 2 * BLOCK)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY_BYTES:] or b" " * 8


def _design(x: np.ndarray) -> np.ndarray:
    diff, ratio = 10 * x[:, 0], np.log(np.maximum(x[:, 1], 1e-3)) + 1
    return np.stack([np.ones(len(x)), diff, ratio, diff * ratio, diff * diff, ratio * ratio], axis=1)


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic coefficients by Newton steps, with a small penalty."""
    a, w = _design(x), np.zeros(6)
    keep = ridge * np.eye(6)
    keep[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + keep, a.T @ (y - p) - keep @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def curve(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_design(x) @ w, -30, 30)))


def _featured(rows: DataFrame, dictionaries: list[bytes], w: np.ndarray | None) -> DataFrame:
    """The first column, and diff, ratio and score of the second."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(dictionaries)
        for batch in batches:
            x = np.array([compressors.features(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(1)]).reshape(-1, 2)
            score = curve(x, w) if w is not None else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x[:, 0]), pa.array(x[:, 1]), pa.array(score)], ["key", "diff", "ratio", "score"])

    return rows.mapInArrow(run, "key long, diff double, ratio double, score double")


def train(docs: DataFrame, labels: DataFrame) -> tuple[list[bytes], np.ndarray]:
    """Dictionaries (bad, good) and curve from the rows whose fold is not 2."""
    usable = labels.where((fold(F.col("doc_id"), 4) != 2) & F.col("quality").isin(0, 1)).select("doc_id", "quality").distinct()
    order = F.xxhash64("doc_id", "quality")
    picked = None
    for quality in (0, 1):
        own = usable.where(F.col("quality") == quality).orderBy(order, "doc_id").limit(2 * SAMPLE)  # a bounded sample
        picked = own if picked is None else picked.unionByName(own)
    # At most 4 x SAMPLE identifiers are broadcast; the texts stay where they are.
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)))
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.length("text"), F.lit(1)), F.lit(PART)))
    parts = sample.where("part = 0").select("quality", "doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("at", at)
    parts = parts.select("quality", F.substring(F.col("text"), F.col("at"), F.lit(PART)).alias("text"), F.xxhash64("doc_id", "at").alias("h"))
    seen = None
    for quality in (0, 1):
        own = parts.where(F.col("quality") == quality).orderBy("h", "text").limit(PARTS)  # a bounded sample
        seen = own if seen is None else seen.unionByName(own)
    texts: dict[int, list[str]] = {0: [], 1: []}
    for row in seen.collect():
        texts[row["quality"]].append(row["text"])
    if not texts[0] or not texts[1]:
        share = usable.agg(F.avg("quality")).first()[0]
        share = min(max(0.5 if share is None else share, 1e-6), 1 - 1e-6)
        return [build_dictionary(texts[0]), build_dictionary(texts[1])], np.array([np.log(share / (1 - share)), 0, 0, 0, 0, 0])
    dictionaries = [build_dictionary(texts[0]), build_dictionary(texts[1])]
    # Repeated doc_ids can bring more rows than were picked: the order is by a hash of the row, whose last bit is the label.
    key = F.shiftleft(F.xxhash64("doc_id", "text"), 1).bitwiseOR(F.col("quality").cast("long"))
    rows = _featured(sample.where("part = 1").select(key, "text"), dictionaries, None).orderBy("key").limit(6 * SAMPLE).collect()
    if not rows:
        return dictionaries, np.array([0.0, 10.0, 0, 0, 0, 0])
    return dictionaries, fit_curve(np.array([[r["diff"], r["ratio"]] for r in rows]), np.array([r["key"] & 1 for r in rows], float))


def score(docs: DataFrame, dictionaries: list[bytes], w: np.ndarray) -> DataFrame:
    """doc_id and score of every whole text; one scan, no exchange."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _featured(rows, dictionaries, w).select(F.col("key").alias("doc_id"), "score")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(os.path.join(sf_dir, "labels.parquet"))
    scored = score(docs, *train(docs, labels))
    return scored.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))

"""A corpus pipeline of the operators of ``lodestone.llm``.

Each stage takes all that its predecessor kept. The stages but the last return
the columns of documents: language ID drops documents of no learned language,
exact dedup keeps the first of equal texts, near dedup keeps one document of
each SimHash component, the mix repeats or leaves out documents so that
sources come to their target sizes, and packing returns the pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import exact, langid, mix, pack, simhash
from lodestone.llm._common import documents, fresh, materialize

#: Phrases of fewer characters on average under the best language say that a text of ``SURE_CHARS`` or more is in none of those learned.
LEAST_REACH, SURE_CHARS = 2.0, 50


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects null texts, those without a letter, and those of no learned language by cross-parsing; shorter texts than ``SURE_CHARS`` need a letter only.

    Where no labelled row teaches a language, every text with a letter stays.
    """
    learned = langid.samples(docs)
    if not learned:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    [told] = fresh(docs.columns, "told")
    rows = langid.identify(docs, learned, told)
    known = (F.col(f"{told}.reach") >= LEAST_REACH) | (F.length("text") < SURE_CHARS)
    return rows.where((F.col(f"{told}.lang_pred") != langid.UNKNOWN) & known).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of equal texts (white space apart) the row with the smallest doc_id, a null one last; null texts count as empty."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of texts linked by SimHash the row with the smallest doc_id, a null one last; texts without words are one group."""
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that each source comes to its target words; texts without words go."""
    return mix.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in full sequences; null texts count as empty, of which the end id is left."""
    return pack.pack(docs)


STAGES = [
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the last stage; a stage's table goes once the next one is written."""
    docs, done = documents(spark, sf_dir), []
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}", *done)
        done = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language models, SimHash links and hashed draws are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None

"""Lexical evidence as postings tables (term, item_idx, weight) and term joins."""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import stem, text as text_functions
from ..functions.text import bigrams, char_grams, composed, context_text, tokenize
from ..sources.tables import discard, source_key, store_once, written
from . import inverted

K1, B = 1.2, 0.65
#: Customary limits, off unless they are asked for.
DESCRIPTION_CHARS = 3000
MOST_CHAR_GRAMS = 250_000
#: How often a field counts in the text that BM25 sees.
FIELD_WEIGHTS = {"title": 3, "params": 2, "description": 1}
CHANNELS = ("bm25", "word", "char")


def version() -> str:
    """What the code that makes stored tables says."""
    return inverted.code_version(stem, text_functions, inverted, sys.modules[__name__])


def term_counts(df: DataFrame, key: str, terms: Column) -> DataFrame:
    return df.select(key, F.explode(terms).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def smooth_idf(counts: DataFrame, n_docs: int, min_df: int = 1, most: int | None = None) -> DataFrame:
    """ln((1 + N) / (1 + df)) + 1 of the vocabulary; ``most`` keeps the terms with the largest total count."""
    stats = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")).where(F.col("df") >= min_df)
    if most is not None:
        stats = stats.orderBy(F.desc("total"), "term").limit(most)
    return stats.select("term", (F.log((1.0 + n_docs) / (1 + F.col("df"))) + 1).alias("idf"))


def tfidf_postings(counts: DataFrame, idf: DataFrame, key: str) -> DataFrame:
    """Sublinear tf times idf, rows of unit length."""
    raw = tfidf_weights(counts, idf, key)
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return raw.select("term", key, (F.col("w") / length).alias("weight"))


def tfidf_weights(counts: DataFrame, idf: DataFrame, key: str) -> DataFrame:
    return counts.join(idf, "term").select("term", key, ((1 + F.log(F.col("tf"))) * F.col("idf")).alias("w"))


def term_scores(query_terms: DataFrame, postings: DataFrame, query_weight: str | None = None) -> DataFrame:
    """Sparse inner product: join on the term, sum by (qid, item_idx). The small query side is left to Spark to broadcast by its size."""
    weight = F.col("weight") if query_weight is None else F.col("weight") * F.col(query_weight)
    return query_terms.join(postings, "term").groupBy("qid", "item_idx").agg(F.sum(weight).alias("score"), F.count(F.lit(1)).alias("n_terms"))


def word_tokens(items: DataFrame, description_chars: int | None = None) -> DataFrame:
    """item_idx, location, the stems of each field and their weighted number ``len``."""
    body = F.col("description") if description_chars is None else F.substring("description", 1, description_chars)
    fields = composed(items.select("item_idx", "location", "title", "params", body.alias("description")), *FIELD_WEIGHTS)
    ts = fields.select("item_idx", "location", *[tokenize(F.col(c)).alias(c) for c in FIELD_WEIGHTS])
    return ts.withColumn("len", sum((F.size(c) * w for c, w in FIELD_WEIGHTS.items()), F.lit(0)).cast("long"))


class LexicalIndex:
    """Word TF-IDF, BM25 and character TF-IDF of items (item_idx, title, params, description, location).

    Terms are stems of the composed text. Whole descriptions and all character
    n-grams, unless ``description_chars`` or ``most_char_grams`` limits them.
    Stems, terms and postings are stored in the folder that all executors
    share, each when it is first needed, under a key of the corpus (files and
    plan, or rows), the parameters and the code that made them; any later
    index of the same key opens them, and a search of it reads the corpus no
    more. :meth:`save` puts them all elsewhere, :meth:`load` opens them there.
    """

    def __init__(self, items: DataFrame | None, k1: float = K1, b: float = B, description_chars: int | None = None, most_char_grams: int | None = None, saved: tuple[SparkSession, str] | None = None):
        self.k1, self.b, self.most, self.saved = k1, b, most_char_grams, saved
        if saved is None:
            said = items.select("item_idx", "title", "params", "description", "location")
            self.spark = items.sparkSession
            whole = "|".join(map(str, (source_key(said), k1, b, description_chars, most_char_grams, version())))
            self.fingerprint = hashlib.sha256(whole.encode()).hexdigest()[:32]
        else:
            self.spark, self.fingerprint, said = saved[0], None, None
        self.stems = self._stored("stems", lambda: word_tokens(said, description_chars))
        stats = self._stored("stats", lambda: self.stems.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("len"), F.lit(0)).alias("words")))
        self.n, self.words = stats.select("n", "words").first()
        self.buckets = inverted.bucket_count(self.n)

    def _stored(self, name: str, make: Callable[[], DataFrame], by: str | None = None) -> DataFrame:
        if self.saved is not None:
            return self.spark.read.parquet(f"{self.saved[1]}/{name}")
        return store_once(self.spark, f"lexical-{self.fingerprint}-{name}", make, by)

    def save(self, path: str) -> None:
        """All tables of all channels, for other engines and sessions."""
        tables = {"stems": self.stems, "stats": self._stored("stats", lambda: self.stems)}
        for channel in CHANNELS:
            tables |= {f"{channel}-terms": self.vocabulary(channel), f"{channel}-postings": self.postings(channel)}
        for name, df in tables.items():
            by = [c for c in df.columns if c == "bucket"]
            laid = df.repartition("bucket").sortWithinPartitions("bucket", "term") if by else df
            laid.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/{name}")

    @staticmethod
    def load(spark: SparkSession, path: str, k1: float = K1, b: float = B) -> LexicalIndex:
        """A saved index, whole: it searches without its corpus."""
        return LexicalIndex(None, k1, b, saved=(spark, path))

    @staticmethod
    def open(spark: SparkSession, path: str, channel: str) -> DataFrame:
        """Postings (term, item_idx, weight) of a channel of a saved index."""
        return inverted.flat(spark.read.parquet(f"{path}/{channel}-postings")).select("term", "item_idx", "weight")

    def _counts(self, channel: str) -> DataFrame:
        """(item_idx, term, tf): of BM25 weighted by field, with the item's len."""
        if channel == "bm25":
            fields = F.array(*[F.struct(F.col(c).alias("ts"), F.lit(w).alias("times")) for c, w in FIELD_WEIGHTS.items()])
            each = self.stems.select("item_idx", "len", F.explode(fields).alias("f")).select("item_idx", "len", "f.times", F.explode("f.ts").alias("term"))
            return each.groupBy("item_idx", "len", "term").agg(F.sum("times").alias("tf"))
        short = F.concat("title", "params")
        if channel == "word":
            return term_counts(self.stems, "item_idx", bigrams(short))
        words = term_counts(self.stems, "item_idx", short)  # n-grams of a word that repeats are made once
        each = words.select("item_idx", "tf", F.explode(char_grams(F.array("term"))).alias("term"))
        return each.groupBy("item_idx", "term").agg(F.sum("tf").alias("tf"))

    def _made(self, channel: str) -> tuple[DataFrame, DataFrame]:
        """Terms (term, idf) and postings (term, item_idx, weight) of a channel; its counts are written once."""
        counts = written(self._counts(channel), f"lexical-{channel}-counts")
        if channel == "bm25":
            df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
            idf = df.select("term", F.log(1 + (F.lit(float(self.n)) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
            norm = self.k1 * (1 - self.b + self.b * F.col("len") / max(self.words / max(self.n, 1), 1.0))
            return idf, counts.join(idf, "term").select("term", "item_idx", (F.col("idf") * F.col("tf") * (self.k1 + 1) / (F.col("tf") + norm)).alias("weight"))
        idf = written(smooth_idf(counts, self.n, min_df=1 if channel == "word" else 2, most=self.most if channel == "char" else None), f"lexical-{channel}-idf")
        raw = written(tfidf_weights(counts, idf, "item_idx"), f"lexical-{channel}-weights")
        length = raw.groupBy("item_idx").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
        return idf, raw.join(length, "item_idx").select("term", "item_idx", (F.col("w") / F.col("length")).alias("weight"))

    def _channel(self, channel: str, name: str) -> DataFrame:
        if channel not in CHANNELS:
            raise ValueError(f"no channel {channel}")
        made: list[DataFrame] = []

        def make(i: int) -> DataFrame:
            if not made:
                made.extend(self._made(channel))
            return made[i]

        terms = self._stored(f"{channel}-terms", lambda: inverted.terms_table(make(0), self.buckets), "bucket")
        postings = self._stored(f"{channel}-postings", lambda: inverted.blocks_of(make(1), self.buckets), "bucket")
        for df in made:
            discard(df)
        return terms if name == "terms" else postings

    def vocabulary(self, channel: str) -> DataFrame:
        """(bucket, term, idf)."""
        return self._channel(channel, "terms")

    def postings(self, channel: str) -> DataFrame:
        """Blocks of postings as ``inverted`` lays them out."""
        return self._channel(channel, "postings")

    @property
    def char_idf(self) -> DataFrame:
        return self.vocabulary("char").select("term", "idf")

    def terms(self, queries: DataFrame, channel: str, text: str = "text") -> DataFrame:
        """(qid, term, tf) of queries; BM25 takes each term once."""
        ts = tokenize(F.col("text"))
        asks = composed(queries.select("qid", F.col(text).alias("text")), "text")
        if channel == "bm25":
            return asks.select("qid", F.explode(F.array_distinct(ts)).alias("term"), F.lit(1).alias("tf"))
        return term_counts(asks, "qid", bigrams(ts) if channel == "word" else char_grams(ts))

    def asked(self, queries: DataFrame, channel: str, text: str = "text") -> DataFrame:
        """(qid, bucket, term, qw) of queries, written: terms that the index has, and their weights."""
        terms = self.terms(queries, channel, text).withColumn("bucket", inverted.bucket(F.col("term"), self.buckets))
        if channel == "bm25":
            return written(terms.select("qid", "bucket", "term", F.lit(1.0).alias("qw")), "search-asked")
        terms = written(terms, "search-terms")
        idf = inverted.in_buckets(self.vocabulary(channel), terms).join(terms.select("bucket", "term").distinct(), ["bucket", "term"], "left_semi").select("term", "idf")
        weighed = tfidf_postings(terms.select("qid", "term", "tf"), idf, "qid").select("qid", inverted.bucket(F.col("term"), self.buckets).alias("bucket"), "term", F.col("weight").alias("qw"))
        out = written(weighed, "search-asked")
        discard(terms)
        return out

    def scores(self, queries: DataFrame, channel: str, text: str = "text") -> DataFrame:
        """(qid, item_idx, score, n_terms) of queries (qid, text), for every item that shares a term."""
        return inverted.all_scores(self.asked(queries, channel, text), self.postings(channel))

    def candidate_scores(self, queries: DataFrame) -> dict[str, DataFrame]:
        """Scores by name: word, bm25 and char of queries (qid, text, filter) without their filters, context_word with them, and full_coverage."""
        out = {c: self.scores(queries, c) for c in ("word", "bm25", "char")}
        n = queries.select("qid", F.greatest(F.size(F.array_distinct(tokenize(F.col("text")))), F.lit(1)).alias("n"))
        out["full_coverage"] = out["bm25"].join(n, "qid").select("qid", "item_idx", (F.col("n_terms") / F.col("n")).alias("score"))
        context = queries.select("qid", context_text(F.col("text"), F.col("filter")).alias("text"))
        return {name: df.select("qid", "item_idx", "score") for name, df in (out | {"context_word": self.scores(context, "word")}).items()}

    def search(self, queries: DataFrame, channel: str, k: int = 300, allowed: int | None = None, local: bool = False) -> DataFrame:
        """Top k (qid, item_idx, score, rank); ``local``: of items in the query's location only; ``allowed``: of items before that position.

        Queries with a column ``filter`` are asked with it. ``allowed`` may be
        0, which allows nothing.
        """
        if isinstance(k, bool) or not isinstance(k, int) or k <= 0:
            raise ValueError("k must be a positive integer")
        if allowed is not None and (isinstance(allowed, bool) or not isinstance(allowed, int) or not 0 <= allowed):
            raise ValueError("allowed must be a number of items")
        return self.bounded_search(queries, channel, k, allowed, local)[0]

    def bounded_search(self, queries: DataFrame, channel: str, k: int, allowed: int | None = None, local: bool = False) -> tuple[DataFrame, DataFrame]:
        """:meth:`search`, and how much of the index each query read (see :func:`inverted.bounded`)."""
        asks = queries.withColumn("text", context_text(F.col("text"), F.col("filter"))) if "filter" in queries.columns else queries
        asked = self.asked(asks, channel)

        def keep(found: DataFrame) -> DataFrame:
            if allowed is not None:
                found = found.where(F.col("item_idx") < allowed)
            if local:
                place = self.stems.select("item_idx", "location")
                wanted = queries.select("qid", F.col("location").alias("wanted"))
                found = found.join(place, "item_idx").join(wanted, "qid").where(same_place(F.col("location"), F.col("wanted")))
            return found.select("qid", "item_idx", "score")

        within = None if allowed is None else F.col("block") * inverted.BLOCK < allowed
        out = inverted.bounded(asked, self.postings(channel), k, keep, within)
        discard(asked)
        return out


def place_key(c: Column) -> Column:
    """A location id as text, by which numbers compare as numbers (7, 7.0 and '7' are one place)."""
    c = c.cast("string")
    plain = F.coalesce(c.try_cast("decimal(20,0)").cast("string"), c)
    return F.when(c.try_cast("double") == c.try_cast("double").cast("long"), c.try_cast("double").cast("long").cast("string")).otherwise(plain)


def same_place(a: Column, b: Column) -> Column:
    """Whether two location ids are one."""
    return place_key(a) == place_key(b)


def coverage(queries: DataFrame, items: DataFrame) -> DataFrame:
    """(qid, item_idx, coverage): share of a query's distinct terms that the item has."""
    asked = composed(queries.select("qid", "text"), "text").select("qid", F.array_distinct(tokenize(F.col("text"))).alias("ts"))
    n = asked.select("qid", F.greatest(F.size("ts"), F.lit(1)).alias("n"))
    short = composed(items.select("item_idx", "title", "params"), "title", "params")
    have = short.select("item_idx", F.explode(F.array_distinct(F.concat(tokenize(F.col("title")), tokenize(F.col("params"))))).alias("term"))
    hits = asked.select("qid", F.explode("ts").alias("term")).join(have, "term").groupBy("qid", "item_idx").agg(F.count(F.lit(1)).alias("hits"))
    return hits.join(n, "qid").select("qid", "item_idx", (F.col("hits") / F.col("n")).alias("coverage"))

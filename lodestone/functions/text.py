"""Text normalisation, tokens, stems and n-grams as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .stem import stem_column, stem_word

TOKEN = "[a-zа-я0-9]+"
#: Characters that compatibility composition leaves alone wherever they stand, and all others (a class that is not negated is found ten times as fast).
STABLE = r"\x00-\x7FÀ-ÖØ-öø-ÿА-яЁё"
OTHERS = r"\x80-\xBF\xD7\xF7\x{100}-\x{400}\x{402}-\x{40F}\x{450}\x{452}-\x{10FFFF}"


@F.arrow_udf(StringType())
def nfkc(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for array in texts:
        yield pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in array.to_pylist()], pa.string())


def composed(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with these columns in form NFKC; only rows with a character that may change leave the JVM."""
    may = F.lit(False)
    for c in columns:
        may = may | F.coalesce(F.col(c).rlike(f"[{OTHERS}]"), F.lit(False))
    return df.where(~may).unionByName(df.where(may).withColumns({c: nfkc(F.col(c)) for c in columns}))


@F.arrow_udf(ArrayType(StringType()))
def stem_tokens(tokens: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for array in tokens:
        yield pa.array([None if ts is None else [stem_word(t) for t in ts] for ts in array.to_pylist()], pa.list_(pa.string()))


def tokens(text: Column) -> Column:
    """Runs of letters a-z, а-я and digits in lower case, ``ё`` as ``е`` (null: none)."""
    low = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("ё"), F.lit("е"))
    return F.regexp_extract_all(low, F.lit(f"({TOKEN})"), 1)


def tokenize(text: Column) -> Column:
    """Stems of the tokens; only texts with Cyrillic letters have any to cut."""
    return F.when(text.rlike("[а-яёА-ЯЁ]"), F.transform(tokens(text), stem_column)).otherwise(tokens(text))


def normalized(text: Column, compose: bool = False) -> Column:
    """Tokens joined by one space; ``compose`` applies NFKC first."""
    return F.array_join(tokens(nfkc(text) if compose else text), " ")


def flattened(text: Column) -> Column:
    """Lower case, ``ё`` as ``е``, runs of white space as one space and none at the ends; punctuation stays (null: empty)."""
    low = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("ё"), F.lit("е"))
    return F.regexp_replace(F.regexp_replace(low, r"(?U)\s+", " "), "^ | $", "")


def context_text(text: Column, filter_: Column) -> Column:
    """A query's text and its filter in one."""
    return F.concat(F.coalesce(text, F.lit("")), F.lit(" "), F.coalesce(filter_, F.lit("")))


def passage_text(*fields: Column) -> Column:
    """The fields that aren't blank, trimmed, on a line each: what an encoder is given."""
    return F.concat_ws("\n", *[F.when(~blank(f), F.trim(f)) for f in fields])


def bigrams(ts: Column) -> Column:
    """Unigrams and bigrams in one array."""

    def both(ws: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.size(ws) - 1), lambda i: F.concat_ws(" ", F.get(ws, i - 1), F.get(ws, i)))
        return F.when(F.size(ws) > 1, F.concat(ws, pairs)).otherwise(ws)

    return F.get(F.transform(F.array(ts), both), 0)  # the tokens are made once


def _part(text: Column, n: int):
    return lambda i: F.substring(text, i, F.lit(n))


def char_grams(ts: Column, low: int = 3, high: int = 5) -> Column:
    """Character n-grams inside words padded by spaces; a padded word shorter than n is taken once, whole."""

    def of_word(word: Column) -> Column:
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        each = []
        for n in range(low, high + 1):
            starts = F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1)))
            grams = F.transform(starts, _part(padded, n))
            each.append(grams if n == low else F.when(F.length(padded) < n, F.array().cast("array<string>")).otherwise(grams))
        return F.concat(*each)

    return F.flatten(F.transform(ts, of_word))


def context_key(*parts: Column) -> Column:
    """Fields joined by U+001F, nulls as empty; free text goes in normalised."""
    return F.concat_ws("\u001f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def query_key(text: Column, location: Column, delivery: Column, filter_: Column, category: Column) -> Column:
    """What makes two rows of a log one query: its fields, the two of free text normalised (composed form, lower case, tokens)."""
    return context_key(normalized(text, compose=True), location, delivery, normalized(filter_, compose=True), category)


def blank(text: Column) -> Column:
    """Null, empty or white space only, in the Unicode sense."""
    return F.coalesce(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), F.lit("")) == ""

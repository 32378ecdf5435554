"""Language identification by cross-parsing entropy.

Of each language a suffix automaton is built from labelled text. A text is
parsed with it into phrases, each the longest piece from where the last ended
that occurs in the language's sample. The number of phrases, normalised by the
sample's size (times its binary logarithm: what it takes to point into it), is
the text's length under that language; the shortest wins. Many texts are
parsed at once: an automaton is a table (state, letter) -> state, and all
lanes of a batch step through it together. Each code point of the samples is a
letter of its own: the frequent ones have a column in the table, transitions
by others are a sorted list that is searched, so large scripts need no more
room than their samples.

Only letters tell languages: any run of other characters, in samples and in
texts, is one space.

A long text is parsed in lanes of ``LANE`` characters, so it doesn't hold up
the others. A lane is first parsed as if a phrase began at its edge; then the
parse of the lane before goes on into it until it begins a phrase where the
lane's own parse does. From there on the two are one, so the counts are those
of one parse of the whole text.

Bounds: ``SAMPLE_CHARS`` characters of labelled text in all, shared between
the languages and at most ``MOST_CHARS`` a language, so the automata that go
to the workers are bounded whatever the corpus. Rows are chosen by a hash and
taken whole; rows of more than ``ROW_CHARS`` characters are not chosen, unless
a language has no other. Only where one row is all of a language's share can
it be cut to it.

Defined results: the language of a null text and of one without a letter is
``und`` with score 0; of equal lengths the first language in code-point order
wins; without any labelled row every text is ``und``; repeated rows are
classified one by one. The score is how much more the second language needs:
1 - best / second (1 if there is no second).
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import documents, text_blocks
from .quality import fold

UNKNOWN = "und"
SAMPLE_CHARS = 160_000
MOST_CHARS = 24_000
ROW_CHARS = 8_000
LANE = 4096
#: Columns of an automaton's table: the most frequent letters have one each, the last is empty and stands for all others.
LETTERS = 96
SCORED = regex.compile(r"\p{L}")
LETTER_RUN, GAP = regex.compile(r"[\p{L}\p{M}]+"), regex.compile(r"[^\p{L}\p{M}]+")


@functools.cache
def letter_points() -> np.ndarray:
    """Which code points are letters or marks."""
    out = np.zeros(0x110000, bool)
    for start, stop in ((0, 0xD800), (0xE000, 0x110000)):
        for run in LETTER_RUN.finditer("".join(map(chr, range(start, stop)))):
            out[start + run.start() : start + run.end()] = True
    return out


def suffix_automaton(text: np.ndarray, letters: int) -> tuple[np.ndarray, dict[int, dict[int, int]]]:
    """Transitions of the automaton of all substrings; state 0 is the start, the last state has no way out.

    A table of those by codes below ``letters - 1`` (-1: none), and by state those of larger codes.
    """
    table = np.full((2 * len(text) + 2, letters), -1, dtype=np.int32)
    rare: dict[int, dict[int, int]] = {}
    link, length = [-1] * len(table), [0] * len(table)
    n, last, common = 1, 0, letters - 1
    for c in text.tolist():
        new, n = n, n + 1
        length[new] = length[last] + 1
        p, to = last, -1
        while p != -1:
            to = int(table[p, c]) if c < common else rare.get(p, {}).get(c, -1)
            if to >= 0:
                break
            if c < common:
                table[p, c] = new
            else:
                rare.setdefault(p, {})[c] = new
            p = link[p]
        if p == -1:
            link[new] = 0
        elif length[p] + 1 == length[to]:
            link[new] = to
        else:
            copy, n = n, n + 1
            length[copy], link[copy] = length[p] + 1, link[to]
            table[copy] = table[to]
            if to in rare:
                rare[copy] = dict(rare[to])
            while p != -1 and (int(table[p, c]) if c < common else rare.get(p, {}).get(c, -1)) == to:
                if c < common:
                    table[p, c] = copy
                else:
                    rare[p][c] = copy
                p = link[p]
            link[to] = link[new] = copy
        last = new
    return table[: n + 1].copy(), rare  # the last row is a dead end: after it every letter begins a phrase


class Model:
    """Automata of all languages over one alphabet: the code points of all samples, and one code that no automaton has."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        points = np.concatenate([np.frombuffer(samples[x].lower().encode("utf-32-le"), "<u4") for x in self.languages])
        values, counts = np.unique(points, return_counts=True)
        order = values[np.argsort(-counts, kind="stable")]
        common = LETTERS - 1
        self.unseen = max(common, len(order))
        self.codes = np.full(0x110000, self.unseen, np.uint16 if self.unseen < 1 << 16 else np.uint32)
        self.codes[order] = np.arange(len(order))
        self.bits = np.array([math.log2(len(samples[x]) + 2) for x in self.languages])
        self.tables, self.rare = [], []
        for x in self.languages:
            table, rare = suffix_automaton(self.encode(samples[x]), LETTERS)
            ways = sorted((state * (self.unseen + 1) + c, to) for state, by in rare.items() for c, to in by.items())
            self.tables.append(table)
            self.rare.append((np.array([k for k, _ in ways], np.int64), np.array([to for _, to in ways], np.int32)))

    def encode(self, text: str) -> np.ndarray:
        return self.codes[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")]

    def letters(self, text: str) -> np.ndarray:
        """Codes of a text, each run of characters other than letters as one space."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        gap = ~letter_points()[points]
        keep = ~gap
        keep[1:] |= ~gap[:-1]
        return np.where(gap, self.codes[ord(" ")], self.codes[points])[keep]

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrase counts of texts as they stand, a row for each text and a column for each language."""
        return self.parsed([self.encode(t) for t in texts])

    def parsed(self, coded: list[np.ndarray]) -> np.ndarray:
        """Phrase counts of texts given as codes."""
        lanes = [c[i : i + LANE] for c in coded for i in range(0, len(c), LANE)]
        per_text = np.array([-(-len(c) // LANE) for c in coded], np.int64)
        out = np.zeros((len(coded), len(self.languages)), dtype=np.int64)
        if not len(lanes):
            return out
        order = np.argsort([-len(x) for x in lanes], kind="stable")
        sizes = np.array([len(lanes[i]) for i in order])
        place = np.empty(len(lanes), np.int64)  # where the order has each lane
        place[order] = np.arange(len(lanes))
        owner, first = np.repeat(np.arange(len(coded)), per_text), np.cumsum(per_text) - per_text
        flat = np.concatenate([lanes[i] for i in order])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        live = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # lanes longer than each step
        common, unseen = LETTERS - 1, self.unseen
        large = bool((flat >= common).any())
        columns = np.minimum(flat, common).astype(np.uint8)
        for k, table in enumerate(self.tables):
            rows, width, dead = table.reshape(-1), table.shape[1], len(table) - 1
            keys, goals = self.rare[k]

            def by_rare(states: np.ndarray, letters: np.ndarray, keys=keys, goals=goals) -> np.ndarray:
                """Where rare letters lead to (-1: nowhere)."""
                wanted = states.astype(np.int64) * (unseen + 1) + letters
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                return np.where(keys[at] == wanted, goals[at], -1)

            def step(states: np.ndarray, at: np.ndarray, rows=rows, width=width, keys=keys, by_rare=by_rare) -> np.ndarray:
                """States after the letters at these places (-1: no way on)."""
                now = rows[states * width + columns[at]]
                if large and len(keys):
                    letter = flat[at]
                    is_rare = np.flatnonzero(letter >= common)
                    if len(is_rare):
                        now[is_rare] = by_rare(states[is_rare], letter[is_rare])
                return now

            start = np.full(unseen + 1, dead, np.int64)  # a letter that the language lacks is a phrase of its own
            start[:common] = np.where(table[0, :common] < 0, dead, table[0, :common])
            if len(keys):
                begun = by_rare(np.zeros(unseen + 1 - common, np.int64), np.arange(common, unseen + 1))
                start[common:] = np.where(begun < 0, dead, begun)
            state, begin = np.full(len(sizes), dead), np.zeros(len(flat) + 1, bool)
            for t in range(sizes[0]):
                n = live[t]
                at = starts[:n] + t
                now = step(state[:n], at)
                new = np.flatnonzero(now < 0)  # a phrase ends before this letter and the next begins with it
                begin[at[new]] = True
                now[new] = start[flat[at[new]]]
                state[:n] = now
            count = np.add.reduceat(begin[:-1], starts, dtype=np.int64)
            out[:, k] = np.bincount(owner, count[place], len(coded))
            going = np.flatnonzero(per_text > 1)  # texts whose parse goes on into their next lane
            into, entered = 1, state[place[first[going]]]
            while len(going):
                lane = place[first[going] + into]
                here, was, agreed = np.arange(len(going)), entered.copy(), state[lane]
                for t in range(int(sizes[lane].max())):
                    here = here[t < sizes[lane[here]]]
                    if not len(here):
                        break
                    at = starts[lane[here]] + t
                    now = step(was[here], at)
                    new = now < 0
                    met = new & begin[at]  # both parses begin a phrase: from here on the lane's own is right
                    now[new] = start[flat[at[new]]]
                    was[here] = now
                    mine, own = new & ~met, begin[at] & ~met
                    np.add.at(out[:, k], going[here], mine.astype(np.int64) - own)
                    was[here[met]] = agreed[here[met]]
                    here = here[~met]
                into += 1
                more = per_text[going] > into
                going, entered = going[more], was[more]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score, and characters a phrase under that language of each text."""
        has = [bool(t and SCORED.search(t)) for t in texts]
        asked = [self.letters(t) for t, ok in zip(texts, has, strict=True) if ok and self.languages]
        counts = self.parsed(asked)
        names, scores, reach, k = [], np.zeros(len(texts)), np.zeros(len(texts)), 0
        for i, ok in enumerate(has):
            if not ok or not self.languages:
                names.append(UNKNOWN)
                continue
            row, n_chars, k = counts[k] * self.bits, len(asked[k]), k + 1
            best = int(row.argmin())
            names.append(self.languages[best])
            scores[i] = 1 - row[best] / np.partition(row, 1)[1] if len(row) > 1 else 1.0
            reach[i] = n_chars / counts[k - 1, best]
        return names, scores, reach


def samples(docs: DataFrame) -> dict[str, str]:
    """Bounded labelled text of each language, from rows whose fold is not 1."""
    n = F.length("text")
    rows = docs.where((fold(F.col("doc_id"), 3) != 1) & F.col("lang").isNotNull() & (n > 0))
    short = n <= ROW_CHARS
    stats = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(short.cast("long")).alias("n_short"), F.sum(F.when(short, n)).alias("n_chars"), F.min(n).alias("shortest")).collect()  # a row for each language
    if not stats:
        return {}
    chars = max(1, min(MOST_CHARS, SAMPLE_CHARS // len(stats)))
    # About four times the text that is needed is sorted, whatever there is: the share of rows is set by exact sums.
    ways = {r["lang"]: (min(1.0, (4 * chars + 50 * ROW_CHARS) / r["n_chars"]), ROW_CHARS) if r["n_short"] else (1.0, r["shortest"]) for r in stats}
    spark = docs.sparkSession
    chosen = spark.createDataFrame([(x, share, most) for x, (share, most) in ways.items()], "sample_lang string, share double, most int")
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 52)) / float(1 << 52)
    met = rows.select("lang", "doc_id", "text", draw.alias("draw"), F.xxhash64("doc_id").alias("h")).join(F.broadcast(chosen), F.col("lang") == F.col("sample_lang"))  # a row for each language
    met = met.where((F.col("draw") < F.col("share")) & (n <= F.col("most"))).select("lang", "h", "doc_id", F.substring("text", 1, chars).alias("text"))
    order = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    before = F.coalesce(F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out: dict[str, list[str]] = {}
    fits = (F.col("before") + F.length("text") <= chars) | (F.col("before") == 0)
    for row in met.withColumn("before", before).where(fits).orderBy("lang", "before").collect():
        out.setdefault(row["lang"], []).append(row["text"])
    return {lang: GAP.sub(" ", "\n".join(texts)) for lang, texts in out.items()}


def predictor(learned: dict[str, str]):
    """A vectorised function text -> struct(lang_pred, score, reach)."""

    @F.arrow_udf("struct<lang_pred:string,score:double,reach:double>")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Model(learned) if learned else None  # for this task only: later stages need the memory
        for array in texts:
            batch = pa.RecordBatch.from_arrays([array], ["text"])
            names, scores, reach = [], [], []
            for start, stop in text_blocks(batch, "text", 8_000_000):
                part = array.slice(start, stop - start).to_pylist()
                n, s, r = model.predict(part) if model else ([UNKNOWN] * len(part), np.zeros(len(part)), np.zeros(len(part)))
                names += n
                scores += s.tolist()
                reach += r.tolist()
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(reach, pa.float64())], ["lang_pred", "score", "reach"])

    return predict


def identify(docs: DataFrame, learned: dict[str, str], name: str = "__lang", text: Column | None = None) -> DataFrame:
    """``docs`` with the column ``name``: struct of lang_pred, score and reach (characters a phrase), of whole texts."""
    text = F.col("text") if text is None else text
    return docs.withColumn(name, predictor(learned)(text.cast("string")))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = identify(docs.select("doc_id", "text"), samples(docs))
    return out.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), F.col("__lang.lang_pred").alias("lang_pred"), F.col("__lang.score").alias("score"))

"""Exact token counts at every prefix, by dynamic programming over BPE pieces.

A byte-pair tokenizer with end-of-word marks treats each piece of the
pre-tokenizer on its own, so the count at a prefix of a text is the count of
the whole pieces before it plus the count of the piece that the prefix cuts.
Within a piece the tokens of the prefix ``piece[:k]`` follow from shorter
prefixes: its last token ``t`` ends at ``k``, and the tokens before are those
of ``piece[:k - len(t)]``; exactly one ``t`` fits, the one that no merge with
its left neighbour would undo (two tokens in a row are what the merges give if
their own merges, undone from the latest to the earliest, meet no earlier
merge across the border). One table for open prefixes (no end mark) and one
step with the end mark give the counts of all prefixes of a piece in one pass.

A text's table is kept as steps, the change of the count from each prefix to
the next, joined from the steps of its pieces; its sums answer how many tokens
there are, whether a budget holds and where to cut, without a second encoding.
The query reads all of its columns off that table, checkpoints of it included.

Steps are kept for each distinct piece, up to ``PIECES`` of them in a worker.
The work is in proportion to the text in every script: a cut changes a
normalised text only behind the last place where characters can't combine, so
where composition changes a text, prefixes that end at such a place are read
off the table of the composed text, and a cut between characters that combine
goes on from that table's tokens, over the few characters behind it.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated
rows are counted one by one; special strings inside a text are one token each,
as the library takes them by default; texts with characters outside of
``PLAIN`` take the library's own normalizer and pre-tokenizer, others an equal
and shorter way. Only tokenizer files of these normalizers are taken.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import documents

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Characters between two checkpoints of a text's table.
STRIDE = 1024
#: Distinct pieces that a worker keeps tables of.
PIECES = 400_000
#: Longer pieces are rare and not kept.
LONGEST_KEPT = 64
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
BLANKS = "\t\n\x0b\x0c\r "
CHUNK = re.compile("[^\t\n\x0b\x0c\r ]+[\t\n\x0b\x0c\r ]*|[\t\n\x0b\x0c\r ]+")
#: Characters before a cut within which pieces are found again, not continued.
NEAR = 128
#: Characters that combine with the one before them though their combining class is 0 (second parts of canonical pairs; vowels and finals of Hangul).
JOINING = "\u09be\u09d7\u0b3e\u0b56\u0b57\u0bbe\u0bd7\u0cc2\u0cd5\u0cd6\u0d3e\u0d57\u0dcf\u0ddf\u102e\u1b35\u1161-\u1175\u11a8-\u11c2\U00011127\U0001133e\U00011357\U000114b0\U000114ba\U000114bd\U000115af\U00011930"
#: A character, or a run of blanks, which become one, and those that can combine with it.
CLUSTER = regex.compile(rf"(?:[\x85\p{{Zs}}\p{{Zl}}\p{{Zp}}]+|[\s\S])(?:[\p{{M}}{JOINING}])*")
#: Letters of which lower case and composed form are plain in every Unicode version.
PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-įı-ňŊ-ž]*")
#: The letters and digits among these in lower case, as parts of a character class.
PLAIN_LETTERS, PLAIN_DIGITS = "a-zß-öø-ÿā-ž", "0-9"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself if printable, else the next free one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class Pieces(dict):
    """piece -> what ``make`` gives for it; forgets all when full, so memory is bounded."""

    def __init__(self, make, most: int = PIECES):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, piece):
        value = self.make(piece)
        if piece is None or len(piece) <= LONGEST_KEPT:
            if len(self) >= self.most:
                self.clear()
            self[piece] = value
        return value


class PieceSplitter:
    """Pieces of texts, as the pre-tokenizer of a tokenizers file makes them."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        if [n["type"] for n in said["normalizer"].get("normalizers", [said["normalizer"]])] != NORMALIZERS:
            raise ValueError(f"the tokenizer's normalizers must be {NORMALIZERS}")
        self.specials = sorted((t["content"] for t in said["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.split = regex.compile(next(p["pattern"]["Regex"] for p in said["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"))
        plain = self.split.pattern.replace(r"\p{L}", PLAIN_LETTERS).replace(r"\p{N}", PLAIN_DIGITS)
        self.split_plain = self.split if r"\p" in plain else re.compile(plain)
        self.symbols = byte_symbols()

    def mapped(self, piece: str) -> str:
        return piece if piece.isascii() and piece.isalnum() else "".join(map(self.symbols.__getitem__, piece.encode()))

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text, specials apart; a special string stands as ``None``."""
        if PLAIN.fullmatch(text) and not (self.special and "<|" in text and self.special.search(text)):
            return self.split_plain.findall(text.lower())
        out: list[str | None] = []
        for i, part in enumerate(self.special.split(text) if self.special else [text]):
            if i % 2:
                out.append(None)
            elif part:
                norm = self.library.normalizer.normalize_str(part)
                out += ["\0" + p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(norm)]  # byte symbols already
        return out


class PieceBpe(PieceSplitter):
    """Byte-pair merges of a tokenizers file with end-of-word marks."""

    def __init__(self, path: str):
        super().__init__(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {m: r for r, m in enumerate(merges)}
        self.parts = {a + b: (r, a, b) for r, (a, b) in reversed(list(enumerate(merges)))}
        import ahocorasick

        ends: dict[str, list[str | None]] = {}  # symbols -> the token of them inside a word, and at its end
        for t in self.ids:
            closed = bool(self.end) and t.endswith(self.end)
            ends.setdefault(t[: -len(self.end)] if closed else t, [None, None])[closed] = t
        self.ending = ahocorasick.Automaton()  # found by where they end, the longest first
        for symbols, (inner, last) in ends.items():
            if symbols:
                self.ending.add_word(symbols, (inner, last, len(symbols)))
        self.ending.make_automaton()
        self.longest = max(map(len, ends), default=1)
        self.fits = Pieces(self._fits, PIECES)

    def _fits(self, pair: tuple[str, str]) -> bool:
        """Whether the merges leave a border between two tokens."""
        a, b = pair
        limit = len(self.rank)
        while True:
            if self.rank.get((a, b), limit) < limit:
                return False
            left, right = self.parts.get(a), self.parts.get(b)
            if left is None and right is None:
                return True
            if right is None or left is not None and left[0] > right[0]:
                limit, a = left[0], left[2]
            else:  # of two equal merges the left one came first
                limit, b = right[0] + 1, right[1]

    def open_states(self, piece: str) -> tuple[list[str], list[int], list[int]]:
        """For byte symbols, at each prefix (0 bytes, 1 byte, ...): the last token and number of tokens where the piece goes on, and the number where it ends."""
        n, fits = len(piece), self.fits
        last, count = [""] * (n + 1), [0] * (n + 1)
        closed = [0] * (n + 1)
        for at, (inner, final, size) in self.ending.iter(piece):
            k, j = at + 1, at + 1 - size
            if inner is not None and not count[k] and (not j or fits[last[j], inner]):
                last[k], count[k] = inner, count[j] + 1
            if final is not None and not closed[k] and (not j or fits[last[j], final]):
                closed[k] = count[j] + 1
        return last, count, closed

    def prefix_counts(self, piece: str) -> list[int]:
        """For byte symbols: token count of each prefix (0 bytes, 1 byte, ...)."""
        return self.open_states(piece)[2]

    def extended(self, piece: str, states: tuple[list[str], list[int], list[int]], k: int, tail: str) -> int:
        """Token count of ``piece[:k] + tail`` (tail not empty), from the states of ``piece``: only tokens that end in the tail are looked for."""
        start, fits = max(0, k - self.longest), self.fits
        window = piece[start:k] + tail
        last, count, closed = {}, {}, 0
        for at, (inner, final, size) in self.ending.iter(window):
            end = start + at + 1
            if end <= k:
                continue
            j = end - size
            before, n = (last[j], count[j]) if j > k else (states[0][j], states[1][j])
            if j and not n:
                continue
            if inner is not None and end not in count and (not j or fits[before, inner]):
                last[end], count[end] = inner, n + 1
            if final is not None and end == k + len(tail) and not closed and (not j or fits[before, final]):
                closed = n + 1
        return closed


class PrefixCounter:
    """Counts at prefixes of texts."""

    def __init__(self, path: str):
        self.bpe = PieceBpe(path)
        plain = self.bpe.split_plain.pattern
        self.spaced = (re if isinstance(self.bpe.split_plain, re.Pattern) else regex).compile(rf"(?:{plain})[{BLANKS}]*|[{BLANKS}]+")
        self.plain_steps = Pieces(self._plain_steps)
        self.chunk_steps = Pieces(self._chunk_steps)
        self.composed = Pieces(self.bpe.library.normalizer.normalize_str)

    @staticmethod
    def _as_steps(counts: list[int]) -> bytes:
        """Steps of counts (of the empty prefix first)."""
        return array("h", [b - a for a, b in pairwise(counts)]).tobytes()

    def _piece_counts(self, piece: str) -> list[int]:
        """Counts of a piece of a normalised text at all its prefixes; a cut may part it (an apostrophe and a letter)."""
        table = self.bpe.prefix_counts(self.bpe.mapped(piece))
        if piece[0] == "'" and len(piece) > 1 and piece[1].isalpha():
            return [0, *(self.total(piece[:k]) for k in range(1, len(piece))), table[-1]]
        if len(table) == len(piece) + 1:
            return table
        return [0, *(table[e] for e in accumulate(len(c.encode()) for c in piece))]

    def _plain_steps(self, spaced: str) -> bytes:
        piece = spaced.rstrip(BLANKS)
        steps = self._as_steps(self._piece_counts(piece)) if piece else b""
        return steps + bytes(2 * (len(spaced) - len(piece)))

    def _chunk_steps(self, chunk: str) -> bytes:
        """Steps of a run without blanks, and of the blanks after it."""
        word = chunk.rstrip(BLANKS)
        steps = self._as_steps(self._word_counts(word)) if word else b""
        return steps + bytes(2 * (len(chunk) - len(word)))

    def _word_counts(self, word: str) -> list[int]:
        special = self.bpe.special
        if special and "<|" in word and special.search(word):
            counts = [0]
            parts = special.split(word)
            for i in range(0, len(parts), 2):
                base = counts[-1]
                counts += [base + c for c in (self._word_counts(parts[i])[1:] if parts[i] else [])]
                if i + 1 < len(parts):  # a cut special string is ordinary text, together with what stands before it
                    counts += [base + self.total(parts[i] + parts[i + 1][:k]) for k in range(1, len(parts[i + 1]))]
                    counts.append(base + (self.total(parts[i]) if parts[i] else 0) + 1)
            return counts
        library = self.bpe.library
        norm, low = library.normalizer.normalize_str(word), [c.lower() for c in word]
        if "".join(low) != norm:
            return self._composed_counts(word, norm)
        # Every prefix is in composed form too, so its normal form is a prefix of the word's.
        at, _ = self._table(norm)
        return [0, *(at[e] for e in accumulate(map(len, low)))]

    def _table(self, norm: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Counts at the prefixes of a normalised text, and the places of its pieces."""
        at, places = [0] * (len(norm) + 1), []
        done = end = 0
        for _, (a, b) in self.bpe.library.pre_tokenizer.pre_tokenize_str(norm):
            at[end + 1 : a + 1] = [done] * (a - end)
            counts = self._piece_counts(norm[a:b])
            at[a + 1 : b + 1] = [done + c for c in counts[1:]]
            done, end = done + counts[-1], b
            places.append((a, b))
        at[end + 1 :] = [done] * (len(norm) - end)
        return at, places

    def _composed_counts(self, word: str, norm: str) -> list[int]:
        """Counts of a word that composition changes, by clusters: characters that can combine with each other."""
        clusters = CLUSTER.findall(word)
        said = [self.composed[c] for c in clusters]
        if "".join(said) != norm or "".join(clusters) != word:
            return self._recounted(word)
        at, places = self._table(norm)
        counts, j, i = [0], 0, 0  # i: the last piece that begins at or before place j - 3
        states: tuple[int, str, list[int], tuple] = (-1, "", [], ())
        for cluster, own in zip(clusters, said, strict=True):
            while i + 1 < len(places) and places[i + 1][0] <= j - 3:
                i += 1
            for r in range(1, len(cluster)):
                tail = self.composed[cluster[:r]]
                base = places[i][0] if places and places[i][0] <= j else j
                if j - base > NEAR and i < len(places) and places[i][1] < j:  # the piece ends before the cut, which doesn't change it
                    base = places[i][1]
                if j - base <= NEAR:
                    counts.append(at[base] + self._normal_total(norm[base:j] + tail))
                    continue
                # One piece reaches from ``base`` to the cut: the tail goes on with it, or begins another.
                if states[0] != base:
                    piece = norm[base : places[i][1]]
                    symbols = self.bpe.mapped(piece)
                    states = (base, symbols, [0, *accumulate(len(c.encode()) for c in piece)], self.bpe.open_states(symbols))
                near = norm[j - NEAR // 2 : j]
                first, *rest = [b for _, (_, b) in self.bpe.library.pre_tokenizer.pre_tokenize_str(near + tail)]
                more = first - len(near)
                if more < 0:
                    counts.append(at[base] + self._normal_total(norm[base:j] + tail))
                    continue
                k = states[2][j - base]
                own_count = self.bpe.extended(states[1], states[3], k, self.bpe.mapped(tail[:more])) if more else at[j] - at[base]
                counts.append(at[base] + own_count + (self._normal_total(tail[more:]) if rest else 0))
            j += len(own)
            counts.append(at[j])
        return counts

    def _recounted(self, word: str) -> list[int]:
        """The same, each cut by what stands of its piece and the three before it: for words that a library composes by a newer Unicode than the patterns here know."""
        from tokenizers import PreTokenizedString

        library, parted = self.bpe.library, PreTokenizedString(word)
        parted.normalize(library.normalizer.normalize)
        library.pre_tokenizer.pre_tokenize(parted)
        starts, end = [0], 0
        for _, (a, b), _ in parted.get_splits(offset_referential="original", offset_type="char"):
            if a >= end and a > starts[-1]:  # else one character became parts of two pieces
                starts.append(a)
            end = max(end, b)
        counts = [0]
        for i, a in enumerate(starts):
            base = starts[max(0, i - 3)]
            counts += [counts[base] + self.total(word[base:k]) for k in range(a + 1, (starts[i + 1] if i + 1 < len(starts) else len(word)) + 1)]
        return counts

    def _normal_total(self, norm: str) -> int:
        """Tokens of a normalised text."""
        return sum(self.bpe.prefix_counts(p)[-1] for p, _ in self.bpe.library.pre_tokenizer.pre_tokenize_str(norm))

    def total(self, text: str) -> int:
        """Tokens of a text, as the library counts them."""
        return sum(1 if p is None else self.bpe.prefix_counts(p[1:] if p[:1] == "\0" else self.bpe.mapped(p))[-1] for p in self.bpe.pieces(text))

    def steps(self, text: str) -> np.ndarray:
        """Change of the token count from text[:k] to text[:k + 1], for each k."""
        if PLAIN.fullmatch(text) and "<|" not in text:
            return np.frombuffer(b"".join(map(self.plain_steps.__getitem__, self.spaced.findall(text.lower()))), "<i2")
        return np.frombuffer(b"".join(map(self.chunk_steps.__getitem__, CHUNK.findall(text))), "<i2")

    def prefixes(self, text: str) -> np.ndarray:
        """Token count of text[:k] for k = 0 .. len(text)."""
        return np.concatenate([[0], np.cumsum(self.steps(text), dtype=np.int64)])

    def longest_prefix(self, text: str, budget: int) -> int:
        """Characters of the longest prefix with at most ``budget`` tokens."""
        return int(np.flatnonzero(self.prefixes(text) <= budget)[-1])


def _counter(path: str, kept: dict = {}) -> PrefixCounter:  # noqa: B006  one for each worker
    if path not in kept:
        kept[path] = PrefixCounter(path)
    return kept[path]


def count_tokens(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT, stride: int = STRIDE) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars and checkpoints of every whole text, off its prefix table; one scan, no exchange.

    ``fit_chars`` is the length of the longest prefix with at most ``limit``
    tokens; ``checkpoints`` has the counts after each ``stride`` characters.
    """
    path = vocabulary or vocabulary_path()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            n_bytes, n_tokens, fits, stops, ends = [], [], [], [], [0]
            for t in batch.column(1):
                n_bytes.append(len(t.as_buffer()) if t.is_valid else 0)
                steps = counter.steps(t.as_py() or "")
                total = int(steps.sum(dtype=np.int64))
                n_tokens.append(total)
                if total <= limit and len(steps) < stride:
                    fits.append(len(steps))
                else:
                    counts = np.cumsum(steps, dtype=np.int64)
                    fits.append(len(steps) if total <= limit else int(np.flatnonzero(np.append(0, counts) <= limit)[-1]))
                    stops.append(counts[stride - 1 :: stride])
                ends.append(ends[-1] + len(steps) // stride)
            flat = pa.array(np.concatenate(stops) if stops else [], pa.int32())
            columns = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(fits, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "fit_chars", "checkpoints"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long, fit_chars long, checkpoints array<int>")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_chars", "checkpoints")


def prefix_table(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, counts array<int>: the token count at every prefix, element k for the first k characters."""
    path = vocabulary or vocabulary_path()

    def tabled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            for i in range(batch.num_rows):
                counts = counter.prefixes(batch.column(1)[i].as_py() or "")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([counts.tolist()], pa.list_(pa.int32()))], ["doc_id", "counts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tabled, "doc_id long, counts array<int>")


def truncation_points(table: DataFrame, budget: int) -> DataFrame:
    """doc_id, n_chars: the longest prefix within ``budget`` tokens, from a prefix table alone."""
    fits = F.filter(F.sequence(F.lit(0), F.size("counts") - 1), lambda k: F.get("counts", k) <= budget)
    return table.select("doc_id", F.array_max(fits).alias("n_chars"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir))

"""Packing documents into sequences along a space-filling curve.

Each document's token ids are hashed into a vector, which is projected to
``DIMS`` dimensions; its Hilbert key orders the documents so that neighbours
on the curve have like texts. The documents are range-partitioned by that key,
laid end to end along the curve, and cut every ``LENGTH`` tokens, so sequences
hold neighbouring documents and are full. What each partition leaves after its
last full sequence, less than ``LENGTH`` tokens, is laid end to end over all
partitions and cut in the same way. The tokens left at the very end become
sequences of powers of two, which need no padding either.

Ids move once, from the task that encodes them to the partition that lays
them, and are stored nowhere but for those leftovers. The bounds of the
partitions are quantiles of the keys of a sample, as those of any range
partitioning: they decide how even the partitions are and nothing else. The
partitions' numbers of sequences and of tokens left are exact, two numbers
each, at most ``MOST_PARTS`` partitions.

Defined results: a null text counts as empty, and an empty text is the end id
alone; rows with equal keys are ordered by a hash of doc_id, then doc_id, so a
group of copies spreads over several partitions; repeated rows are packed one
by one; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import count_at_or_below, discard, documents, long_array, materialize
from .tokens import Pieces, PieceSplitter, vocabulary_path

LENGTH = 2048
END_ID = 1
DIMS, BITS = 4, 10
#: Buckets of the hashed document vector.
BUCKETS = 256
SEED = 7
#: Distinct pieces of which a worker keeps the ids.
PIECES = 200_000
TOKENS_PER_PART = 8_000_000
MOST_PARTS = 20_000
#: Rows whose keys bound the partitions: all up to ``SAMPLE_ROWS``, of larger tables as many or this share.
SAMPLE_ROWS, SAMPLE_SHARE = 2_000, 1 / 64
TIE_BITS = 23


class Encoder:
    """Ids of whole texts, joined from the ids that the library's merges give for their pieces."""

    def __init__(self, path: str):
        self.splitter = PieceSplitter(path)
        self.merges = self.splitter.library.model
        self.pieces = Pieces(self._ids, PIECES)
        self.wide = "<u4" if max(self.splitter.library.get_vocab().values()) >= 1 << 16 else "<u2"

    def _ids(self, piece: str | None) -> bytes:
        mapped = piece[1:] if piece[:1] == "\0" else self.splitter.mapped(piece)
        return array("I", [t.id for t in self.merges.tokenize(mapped)]).tobytes()

    def ids(self, text: str) -> np.ndarray:
        pieces = self.splitter.pieces(text)
        if None in pieces:  # special strings: the library knows their ids
            return np.array(self.splitter.library.encode(text, add_special_tokens=False).ids, "<u4")
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, pieces)), "<u4")


def _encoder(path: str, kept: dict = {}) -> Encoder:  # noqa: B006  one for each worker
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def hilbert_keys(coords: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions on the Hilbert curve of points with ``bits``-bit coordinates (rows), by Skilling's transform."""
    x = coords.astype(np.int64).T.copy()
    dims, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip, q = np.zeros_like(x[0]), top
    while q > 1:
        flip ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _projection() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((BUCKETS, DIMS))


def curve_keys(counts: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Hilbert keys of hashed count vectors (rows)."""
    v = np.log1p(counts)
    v /= np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), 1e-9)
    at = 0.5 + 0.5 * np.tanh(0.8 * (v @ projection))
    return hilbert_keys(np.minimum((at * (1 << BITS)).astype(np.int64), (1 << BITS) - 1))


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, place (curve key and tie), n, ids (little-endian unsigned 16 or 32 bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, projection = _encoder(path), _projection()
        wide = encoder.wide
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                counts, ids = np.zeros((part.num_rows, BUCKETS)), []
                for i, text in enumerate(part.column(1)):
                    own = encoder.ids(text.as_py() or "")
                    counts[i] = np.bincount((own * np.uint32(2654435761)) >> np.uint32(24), minlength=BUCKETS)
                    ids.append(np.append(own, np.uint32(END_ID)).astype(wide).tobytes())
                key = curve_keys(counts, projection)
                tie = np.asarray(part.column(2)).astype(np.int64)
                n = pa.array([len(x) // int(wide[2]) for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(key << TIE_BITS | tie), n, pa.array(ids, pa.binary())], ["doc_id", "place", "n", "ids"])

    tie = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << TIE_BITS) - 1))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), tie.alias("tie"))
    return rows.mapInArrow(run, "doc_id long, place long, n long, ids binary")


def tail_cuts(total: int, length: int = LENGTH) -> list[int]:
    """Ends of the sequences after the last full one: the rest as descending powers of two."""
    at, cuts = total // length * length, []
    for b in reversed(range(length.bit_length())):
        if (total - at) >> b & 1:
            cuts.append((cuts[-1] if cuts else at) + (1 << b))
    return cuts


LAID = "part int, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence long, offset long, ids binary"
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], list(names))


def part_bounds(docs: DataFrame, path: str, length: int) -> list[int]:
    """Ascending places that part ``docs`` into about ``TOKENS_PER_PART`` tokens each, from a sample of the rows."""
    n = docs.count()
    share = 1.0 if n <= SAMPLE_ROWS else max(SAMPLE_ROWS / n, SAMPLE_SHARE)
    table = materialize(encoded(docs if share == 1 else docs.sample(share, SEED), path).select("place", "n"), "pack-sample")
    total = (table.agg(F.sum("n")).first()[0] or 0) / share
    parts = min(max(1, int(-(-total // TOKENS_PER_PART))), MOST_PARTS)
    bounds: list[int] = []
    if parts > 1:
        at = [i / parts for i in range(1, parts)]
        by_tokens = table.select(F.explode(F.array_repeat("place", F.ceil(F.col("n") / length).cast("int"))).alias("place"))
        found = by_tokens.agg(F.percentile_approx("place", at, max(10_000, 10 * parts))).first()[0]
        bounds = sorted(set(found or []))
    discard(table)
    return bounds


def _lay(length: int):
    """Rows (part, doc_id, n, ids) come by part: the pieces of its full sequences, and with their ids those after the last one."""
    left = lambda held: [(*piece[:6], None, piece[6], bytes(piece[7])) for piece in held]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sequence, at, held = None, 0, 0, []  # held: the pieces of the open sequence, of which at tokens are laid
        for batch in batches:
            out: list[tuple] = []
            for p, doc, n, raw in zip(*(batch.column(c).to_pylist() for c in range(3)), batch.column(3), strict=True):
                if p != now:
                    out += left(held)
                    now, sequence, at, held = p, 0, 0, []
                raw = raw.as_buffer()
                data = memoryview(np.frombuffer(raw, f"<u{len(raw) // n}").astype("<u4").tobytes())
                for a, b in pairwise([0, *range(length - at, n, length), n]):
                    ids = data[4 * a : 4 * b]
                    held.append((p, doc, a, b - a, zlib.crc32(ids), n, at, ids))
                    at += b - a
                    if at == length:
                        out += [(*piece[:6], sequence, piece[6], None) for piece in held]
                        sequence, at, held = sequence + 1, 0, []
            yield _batch(out, LAID)
        yield _batch(left(held), LAID)

    return run


def _rest(before: list[int], full: int, total: int, length: int):
    """Cuts what partitions left, each from the place ``before`` it, into sequences from number ``full`` on."""
    whole, cuts = total // length, tail_cuts(total, length)
    edges = [whole * length, *cuts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for p, doc, start, size, n, offset, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = before[p] + offset
                stops = [*range((at // length + 1) * length, min(at + size, whole * length), length)]
                stops += [e for e in edges if at < e < at + size and e not in stops[-1:]]
                for a, b in pairwise([at, *stops, at + size]):
                    if a < whole * length:
                        sequence, place = divmod(a, length)
                    else:
                        k = next(i for i, e in enumerate(cuts) if a < e)
                        sequence, place = whole + k, a - edges[k]
                    out.append((doc, start + a - at, b - a, zlib.crc32(ids[4 * (a - at) : 4 * (b - at)]), n, full + sequence, place))
            yield _batch(out, PIECE)

    return run


def pack(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    path = vocabulary or vocabulary_path()
    bounds = part_bounds(docs, path, length)
    part = count_at_or_below(bounds, F.col("place"))
    rows = encoded(docs, path).select(part.alias("part"), "doc_id", "n", "ids", "place")
    rows = rows.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "place", "doc_id", "n", "ids")
    laid = materialize(rows.select("part", "doc_id", "n", "ids").mapInArrow(_lay(length), LAID), "pack-laid")
    in_full = F.col("sequence").isNotNull()
    told = laid.groupBy("part").agg(F.coalesce(F.max("sequence") + 1, F.lit(0)), F.coalesce(F.sum(F.when(~in_full, F.col("length"))), F.lit(0)))
    told = {p: rest for p, *rest in told.collect()}  # two numbers for each partition
    each = np.array([told.get(p, (0, 0)) for p in range(len(bounds) + 1)], np.int64)
    before = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(each, axis=0)])
    (*first, full), (*left, total) = before.T.tolist()
    whole = laid.where(in_full).withColumn("sequence_id", F.get(long_array(first), F.col("part")) + F.col("sequence"))
    rest = laid.where(~in_full).select("part", "doc_id", "start", "length", "doc_tokens", "offset", "ids")
    return whole.select(*(c.split()[0] for c in PIECE.split(", "))).unionByName(rest.mapInArrow(_rest(left, full, total, length), PIECE))


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))

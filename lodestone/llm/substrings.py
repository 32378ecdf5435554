"""Removal of repeated passages: every window of ``WINDOW`` words, by Rabin-Karp hash.

1. Each task reads whole texts, hashes the words, and rolls the window hash
   over them (sums of word hash times a power, so a window is a difference of
   two prefix sums). Windows of up to ``CHUNK`` words form a chunk. A hash
   that occurs twice in a chunk is settled there and then sent on once, so
   even a passage that every document holds is sent once a chunk.
2. A second, independent hash deals the hashes into buckets, packed as arrays;
   the task of a bucket counts them and answers each chunk with the places of
   the repeated.
3. Each chunk's places, with those settled before, merge into the maximal
   intervals of covered words of each text.
4. Texts meet their intervals by a 128-bit key of the text, and lose them. The
   copies of a frequent text are dealt to many tasks.

Windows are equal if the 64 bits of one hash and the bucket by the other are:
64 bits whatever the input, and one more with each doubling of it beyond
``BYTES_PER_BUCKET``. Of n windows, about n * n / buckets / 2**65 pairs would
be taken for equal wrongly: under one in a million at 1 TB, one at 100 TB. The
hash of a word mixes a polynomial of its bytes.

Defined results: a null or blank text has no words and the hash of the empty
text; a text of fewer words than a window loses nothing; equal texts of at
least a window lose all their words, as do rows that repeat; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import documents, hot_keys, spread_join, text_blocks, text_or_empty

WINDOW = 35
#: Words of a chunk, or one text if it has more.
CHUNK = 700_000
#: Bytes of text a bucket; about a sixth as many windows.
BYTES_PER_BUCKET = 16_000_000
MOST_BUCKETS = 2_000_000
_BYTE_BASE, _WORD_BASE, _DEAL_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: int, n: int, kept: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006  one for each worker
    """Powers of an odd base and of its inverse, modulo 2**64."""
    have = kept.get(base)
    if have is None or len(have[0]) < n:
        n = 1 << (n - 1).bit_length()
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        have = kept[base] = tuple(both)
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of splitmix)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spans(values: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of values[start:end], whatever the place."""
    up, down = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of texts laid end to end, and the number of words of each text."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    space = _IS_SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    after = np.concatenate([space[1:], [True]])
    filled = offsets[:-1][np.diff(offsets) > 0]
    before[filled] = True
    after[filled[1:] - 1] = True
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    hashes = mix(_spans(data.astype(np.uint64) + np.uint64(1), _BYTE_BASE, starts, ends) + (ends - starts).astype(np.uint64))
    return hashes, np.diff(np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (word number), hash and second hash of every window that lies in one text."""
    stops = np.cumsum(counts)
    last = np.repeat(stops, counts)  # end of each word's text
    starts = np.arange(len(hashes))
    starts = starts[starts + size <= last]
    return starts, *(mix(_spans(hashes, base, starts, starts + size)) for base in (_WORD_BASE, _DEAL_BASE))


def text_buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array, nulls as empty."""
    if array.null_count:
        array = array.fill_null("")
    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    offsets = np.frombuffer(array.buffers()[1], kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(array.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def covered(starts: np.ndarray, n_words: int, size: int) -> np.ndarray:
    """Which words lie in a window that begins at one of ``starts``."""
    edge = np.zeros(n_words + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + size, n_words), -1)
    return np.cumsum(edge[:-1]) > 0


SENT = "bucket int, chunk long, meta boolean, singles int, hashes binary, places binary"


def _send(buckets: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        keys, hashes, counts, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number, held
            chunk = (task << 32) | number
            all_counts = np.concatenate(counts)
            starts, h, deal = windows(np.concatenate(hashes), all_counts, size)
            to = ((deal >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            order = np.lexsort((h, to))
            sorted_h, sorted_to = h[order], to[order]
            new = np.concatenate([[True], (sorted_h[1:] != sorted_h[:-1]) | (sorted_to[1:] != sorted_to[:-1])])[: len(h)]
            first = np.flatnonzero(new)
            many = np.diff(np.concatenate([first, [len(h)]])) > 1
            local = np.sort(starts[order[np.repeat(many, np.diff(np.concatenate([first, [len(h)]])))]])
            once, twice = order[first[~many]], order[first[many]]
            rows: list[tuple] = [(int(chunk % buckets), chunk, True, 0, np.concatenate([np.concatenate(keys).ravel(), all_counts]).astype("<i8").tobytes(), local.astype("<u4").tobytes())]
            once = once[np.lexsort((once, to[once]))]
            b1, b2 = to[once], to[twice]
            cut1, cut2 = np.searchsorted(b1, np.arange(buckets + 1)), np.searchsorted(b2, np.arange(buckets + 1))
            for b in np.union1d(b1, b2).tolist():
                one, two = once[cut1[b] : cut1[b + 1]], twice[cut2[b] : cut2[b + 1]]
                at = starts[one]
                step = np.diff(at, prepend=0)
                wide = "<u4" if len(step) and step.max() >= 1 << 16 else "<u2"
                rows.append((b, chunk, False, len(one), np.concatenate([h[one], h[two]]).astype("<u8").tobytes(), step.astype(wide).tobytes()))
            number, held = number + 1, 0
            for x in (keys, hashes, counts):
                x.clear()
            kinds = [pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["bucket", "chunk", "meta", "singles", "hashes", "places"])

        for batch in batches:
            for start, stop in text_blocks(batch, "text"):
                part = batch.slice(start, stop - start)
                h, n = word_hashes(*text_buffers(part.column("text")))
                keys.append(np.stack([np.asarray(part.column("k1")), np.asarray(part.column("k2"))], axis=1))
                hashes.append(h)
                counts.append(n)
                held += len(h)
                if held >= CHUNK:
                    yield flush()
        if keys:
            yield flush()

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket: passes the chunks' own rows on, and answers each chunk with the places of repeated hashes."""
    names = ["chunk", "meta", "hashes", "places"]
    chunks, parts, places, singles = [], [], [], []
    for batch in batches:
        for chunk, meta, n, hashes, at in zip(*(batch.column(c).to_pylist() for c in ("chunk", "meta", "singles", "hashes", "places")), strict=True):
            if meta:
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([True]), pa.array([hashes], pa.binary()), pa.array([at], pa.binary())], names)
                continue
            parts.append(np.frombuffer(hashes, "<u8"))
            places.append(np.cumsum(np.frombuffer(at, f"<u{len(at) // n}" if n else "<u2").astype(np.int64)))
            chunks.append(chunk)
            singles.append(n)
    if not parts:
        return
    sizes = np.array([len(p) for p in parts])
    every = np.concatenate(parts)
    ends = np.cumsum(sizes)
    order = np.argsort(every, kind="stable")
    same = every[order[1:]] == every[order[:-1]]
    again = np.zeros(len(every), bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    del order, same
    # A hash that a chunk has settled itself is repeated for every other chunk; two entries of one hash make both repeated either way.
    out = []
    for i, n in enumerate(singles):
        hit = places[i][again[ends[i] - sizes[i] : ends[i] - sizes[i] + n]]
        if len(hit):
            out.append((chunks[i], hit.astype("<u4").tobytes()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out]), pa.array([False] * len(out)), pa.array([b""] * len(out), pa.binary()), pa.array([p for _, p in out], pa.binary())], names)


def _merge(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by chunk, its own row first: intervals of each text that loses words."""
        now, own, places = None, b"", []

        def close() -> Iterator[pa.RecordBatch]:
            meta = np.frombuffer(own, "<i8")
            n = len(meta) // 3
            keys, counts = meta[: 2 * n].reshape(-1, 2), meta[2 * n :]
            starts = np.concatenate([np.frombuffer(p, "<u4") for p in places]).astype(np.int64)
            ends = np.cumsum(counts)
            gone = covered(starts, int(ends[-1]) if n else 0, size)
            hit = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(gone)])[np.concatenate([[0], ends])]) > 0)
            blobs = []
            for i in hit.tolist():
                edge = np.flatnonzero(np.diff(np.concatenate([[0], gone[ends[i] - counts[i] : ends[i]].view(np.int8), [0]])))
                blobs.append(edge.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys[hit, 0]), pa.array(keys[hit, 1]), pa.array(blobs, pa.binary())], ["k1", "k2", "spans"])

        for batch in batches:
            for chunk, meta, blob, at in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if chunk != now and now is not None:
                    yield from close()
                if meta:
                    now, own, places = chunk, blob, []
                places.append(at)
        if now is not None:
            yield from close()

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, digests, kept = [], [], [], []
        for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
            words = text.as_buffer().to_pybytes().split() if text.is_valid else []
            total, lost = len(words), 0
            edges = np.frombuffer(spans.as_buffer(), "<u4").tolist() if spans.is_valid else []
            for a, b in zip(edges[-2::-2], edges[::-2], strict=True):
                lost += b - a
                del words[a:b]
            left = b" ".join(words)
            n_words.append(total)
            n_removed.append(lost)
            digests.append(hashlib.sha256(left).hexdigest())
            kept.append(left.decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
        )


def repeated_spans(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """k1, k2 (key of a text) and spans: word numbers at which its removal intervals begin and end."""
    keyed = _keyed(docs)
    n_bytes = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(max(1, -(-n_bytes // BYTES_PER_BUCKET)), MOST_BUCKETS))
    sent = keyed.select("k1", "k2", "text").mapInArrow(_send(buckets, size), SENT)
    answered = sent.repartitionById(buckets, F.col("bucket")).mapInArrow(_answer, "chunk long, meta boolean, hashes binary, places binary")
    merged = answered.repartition("chunk").sortWithinPartitions("chunk", F.desc("meta")).mapInArrow(_merge(size), "k1 long, k2 long, spans binary")
    return merged.groupBy("k1", "k2").agg(F.max("spans").alias("spans"))  # copies have equal intervals


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty().cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2"))


def remove_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (the words that stay, joined by one space)."""
    keyed = _keyed(docs)
    joined = spread_join(keyed, repeated_spans(docs, size), ["k1", "k2"], hot_keys(keyed, "k1"), F.col("doc_id"), "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).drop("kept")

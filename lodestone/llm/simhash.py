"""SimHash near duplicates through a Gray-order hierarchical index.

A fingerprint has a bit set if over half of the text's shingle hashes have it.
Distinct fingerprints (copies collapse first) link at ``RADIUS`` or fewer
differing bits. Of four 16-bit blocks such a pair shares two at least, so each
fingerprint goes to the six buckets that its pairs of blocks name, and only
the 32 other bits (``rest``) can differ there. A bucket with more than ``MOST`` members
is split again by thirds of the bits left, as often as needed: a pair shares
one third at least, and after two splits at most 15 bits are left.

In a bucket the members are sorted by Gray rank, so that neighbours differ
little. Consecutive members form nodes that keep the bits all of them share;
the bits that the nodes of a group share move up to the group's own node, and
so on. A query descends from the top, adds the differences found in each
node's own bits, and leaves a whole group once they exceed the radius. A
bucket returns a spanning forest of its links, never all pairs.

Components of the links come from large-star and small-star rounds.

Defined results: a null or blank text has fingerprint zero, linked like any
other; texts of one or two words are one shingle; a null doc_id counts for no
component's name unless all are null; repeated rows are equal; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import documents, fresh, materialize, spread_join
from .graph import components, hot_of

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Members that one bucket's index is built of.
MOST = 1 << 15
FAN = 8
#: Queries that descend together.
QUERIES = 2048


def fingerprint(text: bytes) -> int:
    """SimHash of a text in UTF-8, as a signed 64-bit integer."""
    import xxhash

    words = text.lower().split()  # of bytes: A-Z and ASCII whitespace only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    n = max(1, len(words) - SHINGLE + 1)
    stops = (ends[min(SHINGLE, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[:n], stops, strict=True)], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        part = hashes[i : i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = [fingerprint(t.as_buffer().to_pybytes()) if t.is_valid else 0 for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(fps, pa.int64())], ["doc_id", "row", "fp"])


def fingerprint_rows(docs: DataFrame) -> DataFrame:
    """doc_id, row (hash of the text) and fp of every row."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("row"))
    return rows.mapInArrow(_fingerprinted, "doc_id long, row long, fp long")


def gray_rank(x: Column) -> Column:
    """Place of a bit pattern in Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, shift))
    return x


class GrayIndex:
    """Hierarchical index over bit patterns (unsigned, sorted by Gray rank)."""

    def __init__(self, values: np.ndarray, fan: int = FAN):
        patterns, masks = values, np.full(len(values), np.uint64(0xFFFFFFFFFFFFFFFF))
        levels = [(patterns, masks)]
        while len(patterns) > fan:
            at = np.arange(0, len(patterns), fan)
            first = np.repeat(patterns[at], np.diff(np.append(at, len(patterns))))
            masks = np.bitwise_and.reduceat(masks & ~(patterns ^ first), at)  # bits shared below
            patterns = patterns[at]
            levels.append((patterns, masks))
        self.fan, self.levels = fan, []
        for k, (patterns, masks) in enumerate(levels):
            up = np.repeat(levels[k + 1][1], fan)[: len(masks)] if k + 1 < len(levels) else np.uint64(0)
            self.levels.append((patterns, masks & ~up))  # a node's own bits: those not factored out above

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (query number, member number) within the radius."""
        patterns, own = self.levels[-1]
        q, node = (x.ravel() for x in np.meshgrid(np.arange(len(queries)), np.arange(len(patterns)), indexing="ij"))
        seen = np.zeros(len(q), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            patterns, own = self.levels[k]
            seen = seen + np.bitwise_count((queries[q] ^ patterns[node]) & own[node])
            stay = seen <= radius
            q, node, seen = q[stay], node[stay], seen[stay]
            if k:
                below = len(self.levels[k - 1][0])
                child = (node[:, None] * self.fan + np.arange(self.fan)).ravel()
                real = child < below
                q, seen, node = np.repeat(q, self.fan)[real], np.repeat(seen, self.fan)[real], child[real]
        return q, node


def forest(values: np.ndarray, radius: int) -> np.ndarray:
    """For members sorted by Gray rank: the number of the first member of each one's connected group."""
    root = np.arange(len(values))
    index = GrayIndex(values)
    for start in range(0, len(values), QUERIES):
        q, found = index.search(values[start : start + QUERIES], radius)
        a, b = root[q + start], root[found]
        open_ = a != b
        for x, y in np.unique(np.stack([np.minimum(a, b)[open_], np.maximum(a, b)[open_]], axis=1), axis=0).tolist():
            while root[x] != x:
                x = int(root[x])
            while root[y] != y:
                y = int(root[y])
            root[max(x, y)] = min(x, y)
        while (root != root[root]).any():
            root = root[root]
    return root


def _links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (bucket, fp) sorted by bucket and Gray rank."""
        held: list[np.ndarray] = []

        def close(rows: np.ndarray) -> pa.RecordBatch:
            """Links of whole buckets."""
            edges = np.flatnonzero(np.diff(rows[:, 0])) + 1
            bounds = np.concatenate([[0], edges, [len(rows)]])
            a, b = [], []
            for i in np.flatnonzero(np.diff(bounds) > 1).tolist():
                part = rows[bounds[i] : bounds[i + 1]]
                root = forest(part[:, 1].astype(np.uint64), radius)
                linked = root != np.arange(len(root))
                a.append(part[linked, 1])
                b.append(part[root[linked], 1])
            pick = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64))
            return pa.RecordBatch.from_arrays([pick(a), pick(b)], ["u", "v"])

        for batch in batches:
            held.append(np.stack([np.asarray(batch.column(c)) for c in ("bucket", "fp")], axis=1))
            if held[-1].shape[0] and held[0][0, 0] != held[-1][-1, 0]:  # the last bucket may go on
                rows = np.concatenate(held)
                cut = np.searchsorted(rows[:, 0], rows[-1, 0])
                yield close(rows[:cut])
                held = [rows[cut:]]
        if held:
            yield close(np.concatenate(held))

    return run


def _bits(x: Column, low: int, n: int) -> Column:
    return F.shiftrightunsigned(x, low).bitwiseAND(F.lit((1 << n) - 1))


def buckets(fps: DataFrame, most: int = MOST) -> DataFrame:
    """(bucket, rest, fp): buckets that hold every pair within two differing bits, none larger than ``most``."""
    pairs = [(i, j) for i in range(4) for j in range(i)]
    block = lambda i: _bits(F.col("fp"), 16 * i, 16)
    each = []
    for t, (i, j) in enumerate(pairs):
        k, m = (x for x in range(4) if x not in (i, j))
        name = F.shiftleft(block(i), 16).bitwiseOR(block(j)).bitwiseOR(F.lit(t << 32))
        each.append(F.struct(name.alias("bucket"), F.shiftleft(block(k), 16).bitwiseOR(block(m)).alias("rest")))
    rows = fps.select("fp", F.explode(F.array(*each)).alias("s")).select("s.bucket", "s.rest", "fp")
    done, width = None, 32
    while width > 15:
        large = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > most).select("bucket")
        large = materialize(large, "simhash-large")
        if large.isEmpty():
            break
        kept = rows.join(large, "bucket", "left_anti")
        done = kept if done is None else done.unionByName(kept)
        third = -(-width // 3)
        spans = [(0, third), (third, third), (2 * third, width - 2 * third)]
        subs = []
        for t, (low, n) in enumerate(spans):
            others = [s for s in spans if s[0] != low]
            name = F.shiftleft(F.col("bucket"), 2 + third).bitwiseOR(F.shiftleft(_bits(F.col("rest"), low, n), 2)).bitwiseOR(F.lit(t))
            rest = F.shiftleft(_bits(F.col("rest"), *others[1]), others[0][1]).bitwiseOR(_bits(F.col("rest"), *others[0]))
            subs.append(F.struct(name.alias("bucket"), rest.alias("rest")))
        rows = rows.join(large, "bucket", "left_semi").select("fp", F.explode(F.array(*subs)).alias("s")).select("s.bucket", "s.rest", "fp")
        rows, width = materialize(rows, "simhash-split"), width - width // 3
    return rows if done is None else done.unionByName(rows)


def links(fps: DataFrame, radius: int = RADIUS, most: int = MOST) -> DataFrame:
    """Links (u > v) that connect what the radius connects."""
    if radius > 2:
        raise ValueError("the buckets hold pairs of up to two differing bits")
    rows = buckets(fps, most)
    dealt = rows.select("bucket", "fp").repartition("bucket").sortWithinPartitions("bucket", gray_rank(F.col("fp")))
    found = dealt.mapInArrow(_links(radius), "u long, v long")
    return found.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def near_components(docs: DataFrame, most: int = MOST) -> DataFrame:
    """doc_id, row, fp and component_id of every row."""
    rows = materialize(fingerprint_rows(docs), "simhash-rows")
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "simhash-classes")
    edges = materialize(links(classes.select("fp"), most=most), "simhash-links")
    if edges.isEmpty():
        named = classes.select("fp", F.col("first").alias("component_id"))
    else:
        member = components(edges)
        held = materialize(classes.join(member, classes["fp"] == member["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-roots")
        names = materialize(held.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n")), "simhash-names")
        named = spread_join(held, names.select("root", "component_id"), ["root"], hot_of(names, "root"), F.col("fp")).select("fp", "component_id")
    return spread_join(rows, named, ["fp"], hot_of(classes, "fp"), F.struct("doc_id", "row")).select("doc_id", "row", "fp", "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component: its smallest doc_id (of several such rows, that with the smallest hash of its text)."""
    marked = near_components(docs)
    first = marked.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")).alias("s"))
    id_, row, text = fresh(docs.columns, "stay_id", "stay_row", "text_hash")
    stay = materialize(first.select(F.col("s.doc_id").alias(id_), F.col("s.row").alias(row)), "simhash-stay")
    keyed = docs.withColumn(text, F.xxhash64(F.col("text").cast("string")))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.col(text) == F.col(row))
    kept = keyed.join(stay, on, "left_semi")
    if stay.count() != kept.select("doc_id").count():
        kept = kept.dropDuplicates(["doc_id", text])  # rows that repeat both are one document
    return kept.select(*docs.columns)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_components(documents(spark, sf_dir))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

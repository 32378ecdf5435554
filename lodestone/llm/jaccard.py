"""N-gram Jaccard join: T-occurrence search over inverted lists, by DivideSkip.

A document's set has the 64-bit hashes of its five-word shingles. Two sets
link if 100 times their intersection is at least 80 times their union.

1. Each text is read once. Shingles that a chunk of texts has in two different
   sets are settled there; all others, and each settled one once, go to
   buckets by hash, packed, and the bucket's task says which occur in two
   different sets. The chunk adds up the answers. Only sets that share enough
   shingles with others at all, one document for all with equal sets, go on:
   their texts are read again.
2. Of those, shingles are counted, and each set's are put in order of the
   length of their inverted lists. Two similar sets share one of the first few
   of each; sets that do, of near sizes, are a group.
3. Sets lie in parts, each with inverted lists of its own. A set is asked in
   the parts that its groups reach: its short lists are merged by a heap, and
   sets that occur often enough there are looked for by binary search in the
   long ones (all but those without which the required overlap could be
   missed). What reaches the overlap that both sizes require is a link.
4. In the first round the sets ask that share most of their shingles in all
   their groups, in the next one each group's best. A set that links to an
   asked one takes its label. Only a group with sets of two labels that were
   not asked asks on: more of them each round, until none is left. So every
   pair that could connect two components is compared. Of links between sets
   that links found before in the same part connect, none is kept: a part has
   fewer links than sets and labels that ask, so a large group of near copies
   makes no table of its pairs.

Components of the links come from large-star and small-star rounds.

Defined results: a null or blank text has an empty set, no links, and is its
own component; a text of one to four words has one shingle, all of it; a null
doc_id counts for no component's name unless all are null; rows that repeat
are documents with equal sets; an empty table gives an empty result; further
columns are ignored. Sets are told apart by a 64-bit sum of hashes of their
shingles, together with their size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import discard, documents, materialize, number_rows, spread_join, text_blocks, text_or_empty
from .graph import components, hot_of
from .substrings import _WORD_BASE, _spans, mix, text_buffers, word_hashes

SHINGLE = 5
#: Similarity in hundredths.
PERCENT = 80
#: Shingles that a task settles among themselves before it sends them on.
CHUNK = 1_000_000
#: Bytes of text a bucket, about a sixth as many shingles.
BYTES_PER_BUCKET = 16_000_000
MOST_BUCKETS = 2_000_000
#: Sets of a part, and shingles of a part on average.
PART_SETS, PART_SHINGLES = 256, 500_000
#: Of the required overlap, one in so many must be found on short lists.
SHARE = 16
#: Sets that a group asks in a round: one, then these times as many.
GROWTH = 8
#: Rows of ids up to which a table is broadcast; larger ones are joined by shuffle.
BROADCAST_IDS = 1_000_000


def shingle_sets(part: pa.RecordBatch, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch's texts: shingle hashes (sorted and distinct in a text), their text numbers, set sizes, and keys of the sets."""
    data, offsets = text_buffers(part.column("text"))
    upper = (data >= 65) & (data <= 90)
    words, counts = word_hashes(data + (upper.astype(np.uint8) << 5), offsets)
    stops = np.cumsum(counts)
    begins = stops - counts
    last = np.repeat(stops, counts)
    starts = np.arange(len(words))
    whole = starts + size <= last
    short = np.flatnonzero((counts > 0) & (counts < size))
    at = np.concatenate([starts[whole], begins[short]])
    ends = np.concatenate([starts[whole] + size, stops[short]])
    hashes = mix(_spans(words, _WORD_BASE, at, ends) + (ends - at).astype(np.uint64))
    text = np.searchsorted(stops, at, side="right")
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    if len(hashes):
        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])])
        hashes, text = hashes[new], text[new]
    sizes = np.bincount(text, minlength=len(counts)).astype(np.int64)
    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    sums = total[cuts[1:]] - total[cuts[:-1]]
    return hashes, text, sizes, mix(sums + sizes.astype(np.uint64)).view(np.int64)


def least_overlap(n: Column) -> Column:
    """Shingles that a set of n shares with any that it links to."""
    return F.ceil(n * F.lit(PERCENT) / F.lit(100.0) - 1e-9).cast("int")


def required(a: np.ndarray | int, b: np.ndarray | int):
    """Overlap of two linked sets of sizes a and b: 100 i >= PERCENT (a + b - i)."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


SENT = "bucket int, chunk long, kind int, keys binary, numbers binary, hashes binary"
_SENT = [c.split()[0] for c in SENT.split(", ")]
_DOCS, _COUNTS, _HASHES = 0, 1, 2
#: Stands for sets whose counts are settled.
_NO_KEY = np.iinfo(np.int64).min


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _SENT)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values of a sorted array."""
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(values)))


def _send(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, np.ndarray]] = []
        seen: set[int] = set()

        def flush() -> pa.RecordBatch:
            nonlocal chunk
            keys, hashes = (np.concatenate([h[i] for h in held]) for i in range(2))
            order = np.argsort(hashes)
            keys, hashes = keys[order], hashes[order]
            first, n = _runs(hashes)
            many = n > 1
            settled, times = np.unique(keys[np.repeat(many, n)], return_counts=True)
            rows = [(chunk % buckets, chunk, _COUNTS, settled.tobytes(), times.astype("<i8").tobytes(), b"")]
            to = ((hashes[first] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            by = np.lexsort((keys[first], many, to))
            at, many = first[by], many[by]
            starts, lengths = _runs(to[by])
            for a, length in zip(starts.tolist(), lengths.tolist(), strict=True):
                own = at[a : a + length]
                who, n = np.unique(keys[own[~many[a : a + length]]], return_counts=True)  # a settled hash goes on with no key: nobody waits for an answer
                rows.append((int(to[by[a]]), chunk, _HASHES, who.tobytes(), n.astype("<u4").tobytes(), hashes[own].astype("<u4").tobytes()))
            chunk += 1
            held.clear()
            seen.clear()
            return _rows(rows)

        for batch in batches:
            for start, stop in text_blocks(batch, "text"):
                part = batch.slice(start, stop - start)
                hashes, text, sizes, keys = shingle_sets(part)
                ids = part.column("doc_id")
                told = np.stack([np.asarray(ids.fill_null(0), np.int64), np.asarray(ids.is_valid()).astype(np.int64), sizes], axis=1)
                yield _rows([(chunk % buckets, chunk, _DOCS, keys.tobytes(), told.tobytes(), b"")])
                fresh = np.array([k not in seen and not seen.add(k) for k in keys.tolist()], bool) & (sizes > 0)  # of equal sets one
                mine = fresh[text]
                held.append((keys[text[mine]], hashes[mine]))
                if sum(len(h[0]) for h in held) >= CHUNK:
                    yield flush()
        if held:
            yield flush()

    return run


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket. Those of documents and settled counts pass; of a bucket's hashes, those of two sets are counted for their sets, chunk by chunk."""
    held: list[tuple[int, np.ndarray, np.ndarray]] = []
    now = None

    def counted() -> pa.RecordBatch:
        keys, hashes = (np.concatenate([h[i] for h in held]) for i in (1, 2))
        order = np.argsort(hashes)
        first, n = _runs(hashes[order])
        by_hash = keys[order]
        low, high = np.minimum.reduceat(by_hash, first), np.maximum.reduceat(by_hash, first)
        shared = np.zeros(len(keys), bool)
        shared[order] = np.repeat(low != high, n)
        rows, at = [], 0
        for chunk, own, _ in held:
            hit = own[shared[at : at + len(own)] & (own > _NO_KEY + 1)]
            at += len(own)
            if len(hit):
                first, n = _runs(hit)  # keys come sorted
                rows.append((0, chunk, _COUNTS, hit[first].tobytes(), n.astype("<i8").tobytes(), b""))
        held.clear()
        return _rows(rows) if rows else pa.RecordBatch.from_arrays([pa.array([], k) for k in (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())], _SENT)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            bucket, chunk, kind, keys, numbers, hashes = row
            if kind != _HASHES:
                yield _rows([row])
                continue
            if bucket != now and held:
                yield counted()
            now = bucket
            keys, hashes = np.repeat(np.frombuffer(keys, "<i8"), np.frombuffer(numbers, "<u4")), np.frombuffer(hashes, "<u4")
            rest = np.repeat(hashes[len(keys) :], 2)  # settled hashes stand for two sets
            ends = np.tile(np.array([_NO_KEY, _NO_KEY + 1]), len(rest) // 2)
            held.append((chunk, np.concatenate([keys, ends]), np.concatenate([hashes[: len(keys)], rest])))
    if held:
        yield counted()


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by chunk: a row a document, with whether its set shares enough shingles with others."""
    now, docs, counts = None, [], []

    def told() -> pa.RecordBatch:
        keys, rows = np.concatenate([d[0] for d in docs]), np.concatenate([d[1] for d in docs])
        known, at = np.unique(keys, return_inverse=True)
        shared = np.zeros(len(known), np.int64)
        for own, n in counts:
            shared[np.searchsorted(known, own)] += n  # own has each key once
        enough = (rows[:, 2] > 0) & (100 * shared[at] >= PERCENT * rows[:, 2])
        return pa.RecordBatch.from_arrays([pa.array(rows[:, 0], mask=rows[:, 1] == 0), pa.array(keys), pa.array(rows[:, 2]), pa.array(enough)], ["doc_id", "key", "n", "enough"])

    for batch in batches:
        for _, chunk, kind, keys, numbers, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if chunk != now:
                if docs:
                    yield told()
                now, docs, counts = chunk, [], []
            keys = np.frombuffer(keys, "<i8")
            if kind == _DOCS:
                docs.append((keys, np.frombuffer(numbers, "<i8").reshape(-1, 3)))
            else:
                counts.append((keys, np.frombuffer(numbers, "<i8")))
    if docs:
        yield told()


def set_rows(docs: DataFrame) -> DataFrame:
    """doc_id, key, n, enough: a row a document with the key and size of its set, and whether it may have a partner."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("string").alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(max(1, -(-n_bytes // BYTES_PER_BUCKET)), MOST_BUCKETS)
    sent = rows.mapInArrow(_send(buckets), SENT).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    met = sent.mapInArrow(_met, SENT).repartition("chunk").sortWithinPartitions("chunk")
    return met.mapInArrow(_told, "doc_id long, key long, n long, enough boolean")


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, stop in text_blocks(batch, "text"):
            part = batch.slice(start, stop - start)
            hashes, _, sizes, keys = shingle_sets(part)
            stops = np.concatenate([[0], np.cumsum(sizes)])
            sets = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(keys), sets], ["key", "shingles"])


def sets_of(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """key, n, shingles of the sets of ``asked`` (key, n, first: the doc_id of one of its documents)."""
    few = asked.count() <= BROADCAST_IDS
    side = asked.select(F.col("first").alias("wanted"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("string").alias("text"))
    rows = rows.join(F.broadcast(side) if few else side, F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi")
    found = rows.select("text").mapInArrow(_whole_sets, "key long, shingles array<long>").dropDuplicates(["key"])
    return found.join(asked.select("key", "n"), "key")


def ordered_sets(sets: DataFrame) -> DataFrame:
    """id, key, n, least (overlap), lists: the shingles that other sets have too, those on short lists first; only sets with enough of them.

    Sets with the largest share of such shingles have the smallest ids.
    """
    each = sets.select("key", "n", F.explode("shingles").alias("t"))
    lengths = materialize(each.groupBy("t").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "jaccard-lengths")
    met = spread_join(each, lengths.select("t", F.col("n").cast("int").alias("length")), ["t"], hot_of(lengths, "t"), F.col("key"))
    held = met.groupBy("key", "n").agg(F.array_sort(F.collect_list(F.struct("length", "t"))).alias("lists"))
    rows = held.select("key", "n", least_overlap(F.col("n")).alias("least"), F.col("lists.t").alias("lists")).where(F.size("lists") >= F.col("least"))
    rows = materialize(rows, "jaccard-ordered", lengths)
    named = number_rows(rows.select("key", (F.size("lists") / F.col("n")).alias("share")), [F.desc("share"), F.col("key")], "id", "jaccard-ids")
    return materialize(rows.join(named.select("key", "id"), "key"), "jaccard-ordered", rows)


class Part:
    """Sets (ids, sizes, labels, shingles) and their inverted lists."""

    def __init__(self, ids: list[int], sizes: list[int], labels: list[int], sets: list[np.ndarray]):
        self.ids, self.sizes, self.labels = (np.array(x, np.int64) for x in (ids, sizes, labels))
        shingles, who = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.lexsort((who, shingles))
        self.who = who[order]
        self.starts, self.lengths = _runs(shingles[order])
        self.shingles = shingles[order][self.starts]
        self.codes = np.repeat(np.arange(len(self.starts)), self.lengths) * len(sets) + self.who  # ascending: (list, set)
        self.into: dict[int, int] = {}  # labels that links of this part have made one with another

    def one_with(self, label: int) -> int:
        while label in self.into:
            label = self.into[label]
        return label

    def links(self, asked: int, n: int, least: int, label: int, lists: np.ndarray) -> list[tuple[int, int]]:
        """(id, overlap) of sets similar to the asked one, one of each label that no link of this part connects to its own yet."""
        label = self.one_with(label)
        at = np.searchsorted(self.shingles, lists)
        at = at[self.shingles[np.minimum(at, len(self.shingles) - 1)] == lists]
        enough = max(1, least // SHARE)
        n_short = len(at) - (least - enough)
        if n_short < enough:
            return []
        at = at[np.argsort(self.lengths[at], kind="stable")]
        short, long = at[:n_short], at[n_short:]
        runs = [self.who[a : a + k].tolist() for a, k in zip(self.starts[short].tolist(), self.lengths[short].tolist(), strict=True)]
        found = [(x, c) for x, own in groupby(heapq.merge(*runs)) if (c := sum(1 for _ in own)) >= enough]
        if not found:
            return []
        who, counts = np.array(found, np.int64).T
        fits = (100 * np.minimum(self.sizes[who], n) >= PERCENT * np.maximum(self.sizes[who], n)) & (self.ids[who] != asked) & (self.labels[who] != label)
        who, counts = who[fits], counts[fits]
        wanted = (long[None, :] * len(self.ids) + who[:, None]).ravel()
        place = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
        overlap = counts + (self.codes[place] == wanted).reshape(len(who), len(long)).sum(axis=1)
        good = overlap >= required(n, self.sizes[who])
        who, overlap = who[good], overlap[good]
        met, one = np.unique(self.labels[who], return_index=True)
        self.into |= dict.fromkeys(met.tolist(), label)
        self.labels[np.isin(self.labels, met)] = label
        return list(zip(self.ids[who[one]].tolist(), overlap[one].tolist(), strict=True))


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, asks, id, n, least, label, lists) come by part, sets before those that ask, which come by label."""
    now, held, part = None, [], None
    for batch in batches:
        told = list(zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True))
        out = []
        for i, (number, asks, own, n, least, label) in enumerate(told):
            if number != now:
                now, held, part = number, [], None
            lists = np.asarray(batch.column(6)[i].values)
            if not asks:
                held.append((own, n, label, lists))
                continue
            if part is None:
                part = Part(*(list(x) for x in zip(*held, strict=True)))
            out += [(own, *link) for link in part.links(own, n, least, label, lists)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["asked", "id", "overlap"])


def occurrences(asked: DataFrame, members: DataFrame, ordered: DataFrame, labels: DataFrame, parts: int) -> DataFrame:
    """Links (asked, id, overlap) of the asked sets (id) to sets of other labels in their groups (members: t, class, id), by T-occurrence search."""
    group = ["t", "class"]
    part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    reach = members.groupBy(*group).agg(F.collect_set(part).alias("parts"))  # numbers of parts: no more than there are
    way = members.join(asked, "id", "left_semi").join(reach, group).groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("parts"))).alias("parts"))
    way = materialize(way.select("id", F.explode("parts").alias("part")), "jaccard-ways")
    told = ordered.join(labels.select("id", "label"), "id").select("id", "n", "least", "label", "lists")
    names = ["part", "asks", "id", "n", "least", "label", "lists"]
    said = told.withColumns({"part": part, "asks": F.lit(False)}).join(way.select("part").distinct(), "part", "left_semi").select(*names)
    asks = way.join(told, "id").withColumn("asks", F.lit(True)).select(*names)
    rows = said.unionByName(asks).repartition("part").sortWithinPartitions("part", "asks", "label", "id")
    return materialize(rows.mapInArrow(_asked, "asked long, id long, overlap long"), "jaccard-links", way)


def linked(ordered: DataFrame) -> DataFrame | None:
    """(node, root) of the sets (id) that links connect; None if there are no links."""
    n_sets, n_shingles = ordered.agg(F.count(F.lit(1)), F.sum(F.size("lists"))).first()
    parts = max(1, -(-n_sets // PART_SETS), -(-(n_shingles or 0) // PART_SHINGLES))
    # Sets of a class of sizes are at home in its groups, and guests in those of the class below.
    size = F.floor(F.log(F.col("n").cast("double")) / -np.log(PERCENT / 100) + 1e-9).cast("int")
    roles = F.array(F.struct(size.alias("class"), F.lit(True).alias("home")), F.struct((size - 1).alias("class"), F.lit(False).alias("home")))
    first = ordered.select("id", F.explode(roles).alias("r"), F.slice("lists", F.lit(1), F.size("lists") - F.col("least") + 1).alias("ts"))
    members = materialize(first.select("id", "r.class", "r.home", F.explode("ts").alias("t")), "jaccard-members")
    group = ["t", "class"]
    labels = materialize(ordered.select("id", F.col("id").alias("label"), F.lit(False).alias("done")), "jaccard-labels")
    links, width = None, 0
    while True:
        undone = members.join(labels, "id").where("not done")
        own = undone.groupBy(*group).agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max("home").alias("lived"), F.min("id").alias("best"), F.count(F.lit(1)).alias("n"))
        still = materialize(own.where("low <> high and lived").select(*group, "best", "n"), "jaccard-open")
        if still.isEmpty():
            break
        # A group without two labels among those not asked has nothing more to say.
        hot = hot_of(still, "t")
        members = materialize(spread_join(members, still.select(*group), group, hot, F.col("id"), "left_semi"), "jaccard-members", members)
        if width == 0:
            least = spread_join(members, still.select(*group, "best"), group, hot, F.col("id")).groupBy("id").agg(F.min("best").alias("best"))
            asked = least.where("best = id").select("id")
        elif width == 1:
            asked = still.select(F.col("best").alias("id")).distinct()
        else:
            place = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("label") != F.col("id"), "id"))  # those without a label first
            asked = members.join(labels, "id").where("not done").withColumn("place", place).where(F.col("place") <= width).select("id").distinct()
        asked = materialize(asked, "jaccard-asked", still)
        found = occurrences(asked, members, ordered, labels, parts)
        links = found if links is None else materialize(links.unionByName(found), "jaccard-all-links", links, found)
        # A set that was alone takes the label of an asked one it links to.
        given = links.join(labels.select(F.col("id").alias("asked"), F.col("label").alias("given")), "asked").groupBy("id").agg(F.min("given").alias("given"))
        now = labels.join(given, "id", "left").join(asked.withColumn("was_asked", F.lit(True)), "id", "left")
        label = F.when((F.col("label") == F.col("id")) & F.col("given").isNotNull(), F.col("given")).otherwise(F.col("label"))
        labels = materialize(now.select("id", label.alias("label"), (F.col("done") | F.coalesce("was_asked", F.lit(False))).alias("done")), "jaccard-labels", labels, asked)
        width = width * GROWTH or 1
    for done in (still, members, labels):
        discard(done)
    return None if links is None or links.isEmpty() else components(links.select(F.col("asked").alias("u"), F.col("id").alias("v")))


def classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    rows = materialize(set_rows(docs), "jaccard-sets")
    own = materialize(rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("first"), F.max("n").alias("n"), F.count(F.lit(1)).alias("n_docs"), F.max("enough").alias("enough")), "jaccard-distinct")
    asked = materialize(own.where("enough").select("key", "n", "first"), "jaccard-asked-sets")
    whole = materialize(sets_of(docs, asked), "jaccard-whole", asked)
    ordered = ordered_sets(whole)
    discard(whole)
    found = linked(ordered)
    name = own.select("key", "first", "n_docs")
    if found is not None:
        members = ordered.select("key", F.col("id").alias("node")).join(found, "node").select("key", "root")
        held = materialize(name.join(members, "key"), "jaccard-roots", ordered)
        roots = materialize(held.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("n")), "jaccard-components")
        named = spread_join(held, roots.select("root", "component_id"), ["root"], hot_of(roots, "root"), F.col("key")).select("key", "component_id")
        name = name.join(named, "key", "left").select("key", F.coalesce("component_id", "first").alias("first"), "n_docs")
    # Only sets of several documents, or in a component of several, tell a document a name it doesn't know.
    many = materialize(name.join(own.select("key", F.col("first").alias("alone")), "key").where((F.col("n_docs") > 1) | ~F.col("first").eqNullSafe(F.col("alone"))).select("key", "first", F.col("n_docs").alias("n")), "jaccard-names")
    out = spread_join(rows, many.select("key", "first", F.lit(True).alias("met")), ["key"], hot_of(many, "key"), F.coalesce("doc_id", F.lit(0)), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("met"), F.col("first")).otherwise(F.col("doc_id")).alias("component_id"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(documents(spark, sf_dir))

"""Document fingerprints from spot signatures.

Words are runs of letters and digits, in lower case. Every common word (an
anchor, from ``ANCHORS``) starts a chain: the next ``CHAIN`` content words
among the ``REACH`` words after it, common words skipped. Anchor and chain
hash to a signature; the set of signatures, sorted, is the fingerprint. Common
words stand where an author's prose is, so the set follows the prose.

Where anchors are rare, in text of any other language, code or lists, the set
has the hashes of runs of ``SHINGLE`` words too: all of every stretch of more
than ``STRETCH`` words without an anchor. This depends on the words around a
place alone, so texts that share a part share its signatures, whatever else
they hold. In scripts written without spaces each character is a word.

Sets are compared by Jaccard. Two sets can only reach a similarity if their
sizes are close, so near duplicates are sought within partitions of set size,
and among those only between sets that share one of the first signatures in a
common order, in which the most frequent come last. Of those that meet, pairs
are dropped whose sizes, or the parities of whose signatures, allow too little
in common; the others' sets are compared. :func:`classified` gives each
document the class that these links connect it to. Links are sought in two steps: all
members of a group with one of them, then only members that aren't linked to
the same set, large groups in blocks; so no pair is left out that could
connect two classes, but a large group whose members are similar to each other
and not to its first one is compared in pairs.

Defined results: a null text counts as empty; a text with neither chain
nor run of words has one signature, the hash of all of it;
a null doc_id comes last in the order of documents; documents with equal
doc_id are ordered by a hash of their text; the document after the last is the
first, which may be the document itself; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import HOT_KEYS, HOT_ROWS, count_at_or_below, documents, hot_keys, long_array, materialize, spread_join, text_or_empty
from .graph import components, hot_of

#: Common words of several languages.
ANCHORS = (
    "a an and are as at be by for from has he in is it its of on or that the this to was were will with "
    "au aux de des du elle en est et il la le les leur ou par pas pour que qui sur un une "
    "als auf aus bei das dem den der des die ein eine er es für im in ist mit nicht sich sie und von zu "
    "al como con del el en es las lo los no o para por que se su un una y"
).split()
CHAIN = 2
REACH = 8
SHINGLE = 4
STRETCH = 16
#: Similarity of near duplicates.
TAU = 0.8
#: Signatures that come last: the ``HEAVY`` most frequent of those in ``HEAVY_SETS`` sets or more.
HEAVY, HEAVY_SETS = 10_000, 64
#: Members of a group that are compared in one block.
BLOCK = 256
#: Tables of up to this many sets (of two longs, or three) are broadcast; larger ones are joined by shuffle.
BROADCAST_SETS = 1_000_000
WORDS = 4
MAY_BE_UNSPACED = r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\uA9FF\uAA60-\uAA7F\uF900-\uFAFF\uFF00-\uFFEF]|[^\u0000-\uFFFF]"
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
WORDS_END = rf"[^\p{{L}}\p{{N}}]+|(?<={UNSPACED})(?=[\p{{L}}\p{{N}}])|(?<=[\p{{L}}\p{{N}}])(?={UNSPACED})"
CHARS_PER_PART = 16_000_000
MOST_PARTS = 10_000


def once(value: Column, f) -> Column:
    """``f`` of a value that is made once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), 0)


def shingles(ws: Column) -> Column:
    """Hashes of all runs of ``SHINGLE`` words."""
    starts = F.when(F.size(ws) >= SHINGLE, F.sequence(F.lit(0), F.size(ws) - SHINGLE)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(SHINGLE)]))


def words_of(text: Column) -> Column:
    """Words in lower case; only texts with unspaced scripts are tried at each character."""
    low = F.lower(text)
    may = (F.octet_length(text) - F.length(text) >= 2) & text.rlike(MAY_BE_UNSPACED)
    return F.array_remove(F.when(may, F.split(low, WORDS_END)).otherwise(F.split(low, r"[^\p{L}\p{N}]+")), "")


def signatures(text: Column) -> Column:
    """Sorted distinct signatures of a text, an ``array<bigint>`` with one element at least."""
    anchors = sorted(set(ANCHORS))

    def chains(ws: Column, marks: Column, content: Column) -> Column:
        """Of the j-th anchor, at place m, the content words after it begin with the (m - j)-th."""

        def chain(m: Column, j: Column) -> Column:
            at = [F.get(content, m - j + k) for k in range(CHAIN)]
            return F.when(at[-1] <= m + REACH, F.xxhash64(F.get(ws, m), *[F.get(ws, i) for i in at]))

        return F.array_compact(F.transform(marks, chain))

    def stretches(ws: Column, marks: Column) -> Column:
        """Runs of words in the long gaps between anchors (and both ends)."""
        edges = F.concat(F.array(F.lit(-1)), marks, F.array(F.size(ws)))

        def gaps(edges: Column) -> Column:
            each = F.transform(F.sequence(F.lit(1), F.size(edges) - 1), lambda i: F.struct((F.get(edges, i - 1) + 2).alias("start"), (F.get(edges, i) - F.get(edges, i - 1) - 1).alias("n")))
            return F.flatten(F.transform(F.filter(each, lambda g: g["n"] > STRETCH), lambda g: once(F.slice(ws, g["start"], g["n"]), shingles)))

        return once(edges, gaps)

    def of(ws: Column) -> Column:
        def flagged(is_anchor: Column) -> Column:
            places = F.when(F.size(ws) > 0, F.sequence(F.lit(0), F.size(ws) - 1)).otherwise(F.array().cast("array<int>"))
            both = F.struct(F.filter(places, lambda i: F.get(is_anchor, i)).alias("marks"), F.filter(places, lambda i: ~F.get(is_anchor, i)).alias("content"))
            return once(both, lambda b: F.concat(chains(ws, b["marks"], b["content"]), stretches(ws, b["marks"])))

        return once(F.transform(ws, lambda w: w.isin(*anchors)), flagged)

    return once(F.array_sort(F.array_distinct(once(words_of(text), of))), lambda s: F.when(F.size(s) > 0, s).otherwise(F.array(F.xxhash64(text))))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when(a == b, F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def as_text(sigs: Column) -> Column:
    """Eight hexadecimal digits a signature."""
    return F.array_join(F.transform(sigs, lambda s: F.lower(F.lpad(F.hex(s.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, sigs and those of the next document (next_text, next_sigs); the texts move once.

    Documents are dealt to parts by exact doc_id boundaries. The first
    document of a part is also dealt to the part before, behind all others,
    so each document finds its next one in its own part.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("string").alias("text"))
    n_chars = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(max(1, -(-n_chars // CHARS_PER_PART)), MOST_PARTS)
    at = [i / parts for i in range(1, parts)]
    bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", at, max(10_000, 10 * parts))).first()[0] or [])) if at else []
    part = F.when(F.col("doc_id").isNull(), F.lit(len(bounds))).otherwise(count_at_or_below(bounds, F.col("doc_id")))
    firsts = {r["part"]: r["first"] for r in rows.groupBy(part.alias("part")).agg(F.min("doc_id").alias("first")).collect()}  # a row a part
    there = sorted(firsts)
    before = {p: there[i - 1] for i, p in enumerate(there)}
    first = F.array(*[F.lit(firsts.get(p)).cast("long") for p in range(len(bounds) + 1)]) if None in firsts.values() else long_array([firsts.get(p, 0) for p in range(len(bounds) + 1)])
    target = long_array([before.get(p, 0) for p in range(len(bounds) + 1)])
    is_first = F.col("doc_id").eqNullSafe(F.get(first, F.col("part")))
    own = F.struct(F.col("part").cast("long").alias("part"), F.lit(0).alias("ghost"))
    ghost = F.struct(F.get(target, F.col("part")).alias("part"), F.lit(1).alias("ghost"))
    dealt = rows.withColumn("part", part).withColumn("to", F.explode(F.when(is_first, F.array(own, ghost)).otherwise(F.array(own))))
    dealt = dealt.select("doc_id", "text", "to.*").repartition(max(1, len(there)), "part")
    dealt = dealt.withColumns({"sigs": signatures(F.col("text")), "tie": F.xxhash64("text")})
    order = Window.partitionBy("part").orderBy("ghost", F.col("doc_id").asc_nulls_last(), "tie")
    found = dealt.withColumns({"next_text": F.lead("text").over(order), "next_sigs": F.lead("sigs").over(order)})
    return found.where("ghost = 0").drop("part", "ghost", "tie")


def likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness; set_id names the text's set."""
    n, half = F.length("text"), F.floor(F.length("text") / 2)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (n - half).cast("int")), F.substring(F.col("next_text"), F.lit(1), half.cast("int")))
    rows = with_next(docs).withColumn("edited", edited).withColumn("edited_sigs", signatures(F.col("edited")))
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sigs")).alias("fingerprint"),
        as_text(F.col("edited_sigs")).alias("edited_fingerprint"),
        jaccard(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        jaccard(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
        F.xxhash64(short_set(F.col("sigs"))).alias("set_id"),
    )


def short_set(sigs: Column) -> Column:
    """The set as the fingerprint shows it: distinct 32-bit values, sorted."""
    return F.array_sort(F.array_distinct(F.transform(sigs, lambda s: F.shiftright(F.shiftleft(s, 32), 32).cast("int"))))


def parities(sigs: Column) -> Column:
    """``WORDS`` longs with a bit for each residue of the signatures, set if an odd number of them have it."""
    powers = long_array([1 << k if k < 63 else -(1 << 63) for k in range(64)])
    bits = F.transform(sigs, lambda s: F.struct(F.shiftrightunsigned(s, 6).bitwiseAND(F.lit(WORDS - 1)).alias("word"), F.get(powers, s.bitwiseAND(F.lit(63))).alias("bit")))

    def parity(bs: Column, k: int) -> Column:
        return F.aggregate(bs, F.lit(0).cast("long"), lambda acc, b: F.when(b["word"] == k, acc.bitwiseXOR(b["bit"])).otherwise(acc))

    return once(bits, lambda bs: F.array(*[parity(bs, k) for k in range(WORDS)]))


def set_rows(docs: DataFrame) -> DataFrame:
    """doc_id, set_id, n, bits and sigs of the set of each document."""
    sets = docs.select(F.col("doc_id").cast("long").alias("doc_id"), short_set(signatures(text_or_empty())).alias("sigs"))
    return sets.select("doc_id", F.xxhash64("sigs").alias("set_id"), F.size("sigs").alias("n"), parities(F.col("sigs")).alias("bits"), "sigs")


def distinct_sets(rows: DataFrame) -> DataFrame:
    """set_id, first (smallest doc_id), n_docs, n and bits of each distinct set; the sets themselves stay where they are."""
    return rows.groupBy("set_id").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n_docs"), F.max("n").alias("n"), F.max("bits").alias("bits"))


def _close(a: Column, b: Column, tau: float) -> Column:
    return F.least(a, b) >= F.greatest(a, b) * tau - 1e-9


def _may_be_similar(a: dict[str, Column], b: dict[str, Column], tau: float) -> Column:
    """Whether sizes and parities (n, bits) allow the similarity: two sets differ in as many signatures as their parities at least."""
    differ = F.lit(0)
    for k in range(WORDS):
        differ = differ + F.bit_count(F.get(a["bits"], F.lit(k)).bitwiseXOR(F.get(b["bits"], F.lit(k))))
    return _close(a["n"], b["n"], tau) & (differ <= (a["n"] + b["n"]) * ((1 - tau) / (1 + tau)) + 1e-9)


def _verified(pairs: DataFrame, rows: DataFrame, sets: DataFrame, tau: float) -> DataFrame:
    """Pairs (u, v) of set ids whose sets are similar, written; only sets in a pair that may be are moved."""
    side = lambda df, c, *names: df.select(F.col("set_id").alias(c), *[F.col(n).alias(f"{n}_{c}") for n in names])
    met = materialize(pairs, "spots-pairs")
    hot = hot_keys(met.select(F.explode(F.array("u", "v")).alias("key")), "key")
    for c, other in (("v", "u"), ("u", "v")):
        met = spread_join(met, side(sets, c, "n", "bits"), [c], hot, F.col(other))
    told = lambda c: {n: F.col(f"{n}_{c}") for n in ("n", "bits")}
    pairs = materialize(met.where(_may_be_similar(told("u"), told("v"), tau)).select("u", "v"), "spots-close")
    if pairs.isEmpty():
        return pairs
    ids = materialize(pairs.select(F.explode(F.array("u", "v")).alias("set_id")).distinct(), "spots-ids")
    few = ids.count() <= BROADCAST_SETS
    asked = rows.join(F.broadcast(ids) if few else ids, "set_id", "left_semi").groupBy("set_id").agg(F.max("sigs").alias("sigs"))  # copies have one set
    asked = materialize(asked, "spots-asked", ids)
    met = pairs
    for c, other in (("v", "u"), ("u", "v")):
        met = spread_join(met, side(asked, c, "sigs"), [c], hot, F.col(other))
    return materialize(met.where(jaccard(F.col("sigs_u"), F.col("sigs_v")) >= tau).select("u", "v"), "spots-links", pairs, asked)


def _first_signatures(rows: DataFrame, sets: DataFrame, heavy: list[int], tau: float) -> DataFrame:
    """(sig, set_id, n): the first n - ceil(tau n) + 1 signatures of each set, the heavy ones last; two sets with Jaccard tau share one of them."""
    ordered = F.concat(F.filter("sigs", lambda s: ~s.isin(heavy)), F.filter("sigs", lambda s: s.isin(heavy))) if heavy else F.col("sigs")
    n_first = (F.col("n") - F.ceil(F.col("n") * tau - 1e-9) + 1).cast("int")
    one = spread_join(rows.select("set_id", "doc_id", "n", "sigs"), sets.select("set_id", "first"), ["set_id"], hot_of(sets.withColumnRenamed("n", "size").withColumnRenamed("n_docs", "n"), "set_id"), F.col("doc_id"))
    one = one.where(F.col("doc_id").eqNullSafe(F.col("first")))  # of copies one
    return one.select("set_id", "n", F.explode(F.slice(ordered, F.lit(1), n_first)).alias("sig")).select("sig", "set_id", "n")


def linked_sets(rows: DataFrame, sets: DataFrame, tau: float = TAU) -> DataFrame | None:
    """(node, root) of sets that links of similarity ``tau`` connect; None if there are no links.

    ``rows`` are :func:`set_rows` and ``sets`` :func:`distinct_sets`, both materialised.
    """
    counted = lambda first: first.groupBy("sig").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
    first = materialize(_first_signatures(rows, sets, [], tau), "spots-first")
    shared = materialize(counted(first), "spots-shared")
    heavy = [r[0] for r in shared.where(F.col("n_rows") >= HEAVY_SETS).orderBy(F.desc("n_rows"), "sig").limit(HEAVY).select("sig").collect()]
    if heavy:
        first = materialize(_first_signatures(rows, sets, heavy, tau), "spots-first", first)
        shared = materialize(counted(first), "spots-shared", shared)
    frequent = [r[0] for r in shared.where(F.col("n_rows") > HOT_ROWS).orderBy(F.desc("n_rows"), "sig").limit(HOT_KEYS).select("sig").collect()]
    met = spread_join(first, shared.select("sig"), ["sig"], frequent, F.col("set_id"))
    # Sets of a size partition meet each other and, as guests, those of the next larger one.
    size_part = F.floor(F.log(F.col("n").cast("double")) / -math.log(tau) + 1e-9)
    roles = F.array(F.struct(size_part.alias("part"), F.lit(False).alias("guest")), F.struct((size_part - 1).alias("part"), F.lit(True).alias("guest")))
    members = materialize(met.select("sig", "set_id", "n", F.explode(roles).alias("r")).select("sig", "r.part", "r.guest", "set_id", "n"), "spots-members", first, shared)
    key = ["sig", "part"]

    def groups(rows: DataFrame, *more: Column) -> DataFrame:
        own = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"), F.min(F.struct("set_id", "n")).alias("pivot"), F.min("guest").alias("guests_only"), *more)
        return own.where("n_rows > 1 and not guests_only")

    def in_groups(rows: DataFrame, own: DataFrame) -> DataFrame:
        hot = [r[0] for r in own.where(F.col("n_rows") > HOT_ROWS).orderBy(F.desc("n_rows"), "sig").limit(HOT_KEYS).select("sig").distinct().collect()]
        return spread_join(rows, own, key, hot, F.col("set_id"))

    own = materialize(groups(members).select(*key, "n_rows", "pivot"), "spots-groups")
    pairs = in_groups(members, own).where((F.col("set_id") != F.col("pivot.set_id")) & _close(F.col("n"), F.col("pivot.n"), tau))
    links = _verified(pairs.select(F.greatest("set_id", "pivot.set_id").alias("u"), F.least("set_id", "pivot.set_id").alias("v")).distinct(), rows, sets, tau)
    # A set's label is the smallest it is linked to, or itself: sets of one label are connected.
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("set_id")).agg(F.min("v").alias("low"))
    told = spread_join(members, least, ["set_id"], hot_keys(members, "set_id"), F.col("sig"), "left").withColumn("label", F.least("set_id", F.coalesce("low", "set_id")))
    told = materialize(told.select("sig", "part", "guest", "set_id", "n", "label"), "spots-labelled", members, own)
    # Only groups whose members are not all of one label have pairs to compare, and only between labels.
    apart = materialize(groups(told, F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select(*key, "n_rows"), "spots-apart")
    if apart.isEmpty():
        return None if links.isEmpty() else components(links)
    rest = in_groups(told, apart)
    rest = spread_join(rest, sets.select("set_id", "bits"), ["set_id"], hot_keys(rest, "set_id"), F.col("sig"))
    n_blocks = F.ceil(F.col("n_rows") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("set_id"), n_blocks).cast("int")
    rest = materialize(rest.withColumns({"block": block, "n_blocks": n_blocks}), "spots-blocked", told, apart)
    fields = ("set_id", "n", "label", "guest", "bits")
    left = rest.select(*key, F.col("block").alias("i"), F.explode(F.sequence("block", F.col("n_blocks") - 1)).alias("j"), *[F.col(c).alias(f"{c}_a") for c in fields])
    right = rest.select(*key, F.explode(F.sequence(F.lit(0), "block")).alias("i"), F.col("block").alias("j"), *[F.col(c).alias(f"{c}_b") for c in fields])
    sides = [{c: F.col(f"{c}_{x}") for c in ("n", "bits")} for x in "ab"]
    may = (F.col("label_a") != F.col("label_b")) & ~(F.col("guest_a") & F.col("guest_b")) & ((F.col("i") != F.col("j")) | (F.col("set_id_a") < F.col("set_id_b")))
    pairs = left.join(right, [*key, "i", "j"]).where(may & _may_be_similar(*sides, tau)).select(F.greatest("set_id_a", "set_id_b").alias("u"), F.least("set_id_a", "set_id_b").alias("v")).distinct()
    every = materialize(links.unionByName(_verified(pairs, rows, sets, tau)), "spots-all-links", links, rest)
    return None if every.isEmpty() else components(every)


def near_duplicates(docs: DataFrame, tau: float = TAU) -> DataFrame:
    """set_id, class_id (smallest doc_id) and class_size (documents) of each set whose class has more than one document."""
    rows = materialize(set_rows(docs), "spots-sets")
    sets = materialize(distinct_sets(rows), "spots-distinct")
    found = linked_sets(rows, sets, tau)
    named = sets.select("set_id", "first", "n_docs")
    if found is None:
        return materialize(named.where("n_docs > 1").select("set_id", F.col("first").alias("class_id"), F.col("n_docs").alias("class_size")), "spots-classes", rows, sets)
    held = materialize(named.join(found, named["set_id"] == found["node"], "left").select("set_id", "first", "n_docs", F.coalesce("root", "set_id").alias("root")), "spots-roots", rows, sets)
    classes = materialize(held.groupBy("root").agg(F.min("first").alias("class_id"), F.sum("n_docs").alias("class_size"), F.count(F.lit(1)).alias("n")).where("class_size > 1"), "spots-names")
    out = spread_join(held, classes.select("root", "class_id", "class_size"), ["root"], hot_of(classes, "root"), F.col("set_id"))
    return materialize(out.select("set_id", "class_id", "class_size"), "spots-classes", held, classes)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness."""
    return likeness(docs).drop("set_id")


def classified(docs: DataFrame, tau: float = TAU) -> DataFrame:
    """:func:`fingerprints` with the class of near duplicates that each document is in: class_id (its smallest doc_id) and class_size."""
    classes = near_duplicates(docs, tau)
    rows = likeness(docs)
    if classes.count() <= BROADCAST_SETS:
        met = rows.join(F.broadcast(classes), "set_id", "left")
    else:
        counted = classes.withColumnRenamed("class_size", "n")
        met = spread_join(rows, classes, ["set_id"], hot_of(counted, "set_id"), F.col("doc_id"), "left")
    return met.withColumns({"class_id": F.coalesce("class_id", "doc_id"), "class_size": F.coalesce("class_size", F.lit(1)).cast("long")}).drop("set_id")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))

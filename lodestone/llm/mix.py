"""Mixing sources to target weights by pivotal dependent rounding.

Sources in code-point order (null last) get the weights 5, 2, 1, repeating.
They share ``BUDGET`` times all words; a source stops at ``MOST`` times its own
size and what it can't take is shared again by weight until none is above.
A document of a source then has the copy number target / size: the whole part
is sure, the fraction is a probability. Pivotal steps round the fractions: two open units of a source exchange word
mass at random, so that the expectation of each stays and their common mass
stays exactly, until one of them is 0 or 1.

Large documents come first, those of more than 1 / (2 ``LARGE``) of their source's
words, of which a source has fewer than 2 ``LARGE``. Each in turn, the largest
first, is paired with all that is still open below it, taken as one unit
whose members share what it gains or loses; so it is settled unless too
little is left below. Where only one of its two outcomes leaves the rest
within bounds, that one is taken; there nearness goes before expectation. Then groups of about ``GROUP`` open documents leave one
open document each; these residuals meet in groups again, up a reduction tree.
The last open document of a source is drawn like all others, with its fraction
as the probability. It is a small one, so a source's taken words differ from
its target by 1 / (2 ``LARGE``) of its size at most. Only in a source without
small documents the last large one is rounded to the nearer side: then the
difference is half of one document at most.

All draws hash identifiers and ``SEED``: reruns and retried tasks agree.

Defined results: a null text has size 0 and takes no part in the rounding
(taken 0); a null source is a source of its own; rows equal in doc_id, source
and size are one unit and get the same number of copies; a source without
words has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import discard, documents, fresh, materialize, number_rows, word_count

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
MOST = 2.0
GROUP = 48
LARGE = 400
SEED = 20_011
#: A table of sources up to this many rows is broadcast; a larger one is joined by shuffle.
BROADCAST_SOURCES = 100_000


def source_targets(sized: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: float = MOST) -> tuple[DataFrame, int]:
    """(source, source_size, n_rows, target) for the rows (source, size), and the number of sources."""
    stats = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    ranked = number_rows(stats, [F.col("source").asc_nulls_last()], "rank", "mix-sources")
    pick = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights)).cast("int"))
    ranked = materialize(ranked.withColumn("weight", pick), "mix-weights")
    n, total = ranked.agg(F.count(F.lit(1)), F.sum("source_size")).first()
    wanted = budget * (total or 0)
    cap = F.col("source_size") * most
    level = 0.0
    capped = F.lit(False)
    while True:
        # Mass for the sources that are not at their cap, by weight; the level only rises, so the capped set only grows.
        taken, weight, n_capped = ranked.agg(F.sum(F.when(capped, cap).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))), F.sum(capped.cast("int"))).first()
        if not weight:
            break
        level = (wanted - taken) / weight
        above = F.col("weight") * F.lit(level) >= cap
        if ranked.where(above).count() == n_capped:
            break
        capped = above
    target = F.when(capped, cap).otherwise(F.col("weight") * F.lit(level))
    return ranked.select("source", "source_size", "n_rows", target.alias("target")), n


def _uniform(*of: Column) -> Column:
    return F.pmod(F.xxhash64(*of), F.lit(1 << 53)) / float(1 << 53)


def _settle(group: Column) -> Column:
    """Chain of pivotal steps over a sorted array of open documents: all settled ones, and the residual."""

    def settled(item: Column, one: bool) -> Column:
        return F.struct(item["doc_id"].alias("doc_id"), item["size"].alias("size"), item["rows"].alias("rows"), F.lit(one).alias("one"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["open"]
        gain, loss = F.least(a["w"] - a["mass"], x["mass"]), F.least(a["mass"], x["w"] - x["mass"])
        up = _uniform(a["h"], x["h"], F.lit(SEED)) * (gain + loss) < loss
        full, gone = a["w"] - a["mass"] <= x["mass"], a["mass"] <= x["w"] - x["mass"]
        first = (up & full) | (~up & gone)  # the document at hand is settled, else the one that comes in
        done = F.when(first, F.when(up, settled(a, True)).otherwise(settled(a, False))).otherwise(F.when(up, settled(x, False)).otherwise(settled(x, True)))
        moved = F.when(up, gain).otherwise(-loss)
        left = F.when(first, x.withField("mass", x["mass"] - moved)).otherwise(a.withField("mass", a["mass"] + moved))
        return F.struct(left.alias("open"), F.concat(acc["done"], F.array(done)).alias("done"))

    none = F.array().cast("array<struct<doc_id:bigint,size:bigint,rows:bigint,one:boolean>>")
    start = F.struct(F.get(group, 0).alias("open"), none.alias("done"))
    return F.aggregate(F.slice(group, 2, F.greatest(F.size(group) - 1, F.lit(0))), start, step)


def _settle_large(items: Column, p: Column, words: Column) -> Column:
    """Large documents (sorted, the largest first) against all open below them: the settled ones, and the fraction of the rest.

    All open documents of a source have one fraction p, so the unit of all
    below is told by p and its words.
    """

    def step(acc: Column, x: Column) -> Column:
        rest, p = acc["words"] - x["w"], acc["p"]
        mass, below = p * x["w"], p * rest
        gain, loss = F.least(x["w"] - mass, below), F.least(mass, rest - below)
        up = _uniform(x["h"], F.lit(SEED + 1)) * (gain + loss) < loss
        fills, empties = x["w"] - mass <= below, mass <= rest - below  # what the others can give, and take
        moved = F.when(fills == empties, F.when(up, gain).otherwise(-loss)).when(fills, gain).otherwise(-loss)
        done = F.struct(x["doc_id"].alias("doc_id"), x["size"].alias("size"), x["rows"].alias("rows"), ((mass + moved) * 2 >= x["w"]).alias("one"))
        left = F.when(rest > 0, F.least(F.greatest((below - moved) / rest, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
        return F.struct(left.alias("p"), rest.alias("words"), F.concat(acc["done"], F.array(done)).alias("done"))

    none = F.array().cast("array<struct<doc_id:bigint,size:bigint,rows:bigint,one:boolean>>")
    return F.aggregate(items, F.struct(p.alias("p"), words.alias("words"), none.alias("done")), step)


def round_copies(sized: DataFrame) -> DataFrame:
    """(doc_id, source, size, rows, source_size, target, copies): one row per unit of equal rows.

    ``sized`` has doc_id, source and size and should be materialised. Only the
    result stays in the shared folder.
    """
    targets, n_sources = source_targets(sized)
    targets = materialize(targets, "mix-targets")
    small = n_sources <= BROADCAST_SOURCES  # a row a source
    by_source = lambda rows, side: rows.alias("u").join(F.broadcast(side.alias("t")) if small else side.alias("t"), F.col("u.source").eqNullSafe(F.col("t.source")), "left")
    units = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    units = by_source(units, targets).select("u.*", "source_size", "n_rows", "target")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = units.withColumns({"base": F.floor(share), "p": share - F.floor(share), "w": (F.col("size") * F.col("rows")).cast("double"), "h": F.xxhash64("doc_id", "size", "source", F.lit(SEED))})
    units = materialize(units, "mix-units")
    is_open = (F.col("p") > 0) & (F.col("size") > 0)
    is_large = F.col("w") * (2 * LARGE) > F.col("source_size")
    item = F.struct((-F.col("w")).alias("order"), "h", "doc_id", "size", "rows", "w")
    large = units.where(is_open & is_large).groupBy("source").agg(F.array_sort(F.collect_list(item)).alias("items"), F.max("p").alias("p"), F.max("source_size").cast("double").alias("words"))
    large = materialize(large.select("source", _settle_large(F.col("items"), F.col("p"), F.col("words")).alias("out")), "mix-large")
    settled, steps = [large.select("source", F.explode("out.done").alias("d")).select("source", "d.*")], [large]
    fractions = large.select("source", F.col("out.p").alias("p_left"))
    level = by_source(units.where(is_open & ~is_large), fractions).select("u.*", (F.col("w") * F.coalesce("p_left", "p")).alias("mass"))
    item = F.struct("h", "doc_id", "size", "rows", "w", "mass")
    level = level.select("source", item.alias("item"), F.ceil(F.col("n_rows") / GROUP).alias("buckets"))
    most = targets.agg(F.max("n_rows")).first()[0] or 0
    buckets = -(-most // GROUP)
    while True:
        bucket = F.pmod(F.xxhash64("item.h", F.lit(len(settled) + SEED)), F.col("buckets"))
        merged = level.groupBy("source", bucket.alias("bucket"), "buckets").agg(_settle(F.array_sort(F.collect_list("item"))).alias("out"))
        merged = materialize(merged.select("source", "buckets", "out"), "mix-level")
        steps.append(merged)
        settled.append(merged.select("source", F.explode("out.done").alias("d")).select("source", "d.*"))
        level = merged.select("source", F.col("out.open").alias("item"), F.ceil(F.col("buckets") / GROUP).alias("buckets"))
        if buckets <= 1:
            break
        buckets = -(-buckets // GROUP)
    last = _uniform(F.col("item.h"), F.lit(SEED + 2)) * F.col("item.w") < F.col("item.mass")
    drawn = level.select("source", "item.doc_id", "item.size", "item.rows", last.alias("one"))
    for part in settled:
        drawn = drawn.unionByName(part)
    drawn = by_source(drawn, targets).select("u.*", "source_size", "target")
    share = F.floor(F.col("target") / F.col("source_size"))
    names = ["doc_id", "source", "size", "rows", "source_size", "target"]
    sure = units.where(~is_open).select(*names, F.when(F.col("size") > 0, F.col("base")).otherwise(F.when(F.col("source_size") > 0, F.col("base")).otherwise(1)).cast("int").alias("copies"))
    drawn = drawn.select(*names, (share + F.col("one").cast("int")).cast("int").alias("copies"))
    return materialize(sure.unionByName(drawn), "mix-copies", targets, units, *steps)


def sized_rows(docs: DataFrame) -> DataFrame:
    return materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count().alias("size")), "mix-sizes")


def mix(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their own columns only."""
    id_, source, size, n, words, copy = fresh(docs.columns, "unit_id", "unit_source", "unit_size", "copies", "words", "copy")
    sized = sized_rows(docs)
    rounded = round_copies(sized)
    discard(sized)
    copies = rounded.where("copies > 0").select(F.col("doc_id").alias(id_), F.col("source").alias(source), F.col("size").alias(size), F.col("copies").alias(n))
    keyed = docs.withColumn(words, word_count())
    on = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & keyed["source"].cast("string").eqNullSafe(F.col(source)) & (F.col(words) == F.col(size))
    taken = keyed.join(copies, on)
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = sized_rows(documents(spark, sf_dir))
    units = round_copies(sized)
    discard(sized)
    rows = units.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "source", "copies")

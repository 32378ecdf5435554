"""Recall of ranked candidates against the full truth, by groups, post-stratified, and compared by bootstrap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank
from ..sources.tables import written
from .checks import one_to_one
from .topk import top_k

#: Pairs of a part of a bootstrap.
BOOTSTRAP_ROWS = 50_000
#: Breakdowns of a report, of the columns that the queries have.
BREAKDOWNS = ("regime", "seen_text", "seen_context", "filter_empty", "seen_item_group")


def load_queries(queries: DataFrame, identities: DataFrame, splits: list[str]) -> DataFrame:
    """Queries of these splits with their positions: ``qid`` is the place in the whole table, found before the filter."""
    return one_to_one(queries, identities, ["query_id"]).where(F.col("split").isin(splits))


def per_query_recall(queries: DataFrame, candidates: DataFrame, truth: DataFrame, ks: list[int], score: str = "score") -> DataFrame:
    """queries with n_relevant, n_candidates, recall@k and recall_union; truth (qid, item_idx) may repeat pairs; queries without candidates have recall 0."""
    pairs = truth.select("qid", "item_idx").distinct()
    ranked = top_k(candidates.select("qid", "item_idx", F.col(score).alias("score")), max(ks))
    hits = ranked.join(pairs, ["qid", "item_idx"], "left_semi").groupBy("qid").agg(*[F.sum((F.col("rank") <= k).cast("long")).alias(f"hits_{k}") for k in ks])
    relevant = pairs.groupBy("qid").agg(F.count(F.lit(1)).alias("n_relevant"))
    marked = candidates.select("qid", "item_idx").join(pairs.withColumn("__hit", F.lit(1)), ["qid", "item_idx"], "left")
    pool = marked.groupBy("qid").agg(F.count(F.lit(1)).alias("n_candidates"), F.count("__hit").alias("hits_union"))
    joined = queries.join(relevant, "qid", "left").join(pool, "qid", "left").join(hits, "qid", "left")
    recall = {f"recall_{k}": F.when(F.col("n_relevant") > 0, F.coalesce(f"hits_{k}", F.lit(0)) / F.col("n_relevant")) for k in [*ks, "union"]}
    return joined.withColumns({"n_candidates": F.coalesce("n_candidates", F.lit(0)), **recall}).drop(*[f"hits_{k}" for k in [*ks, "union"]])


def seen_groups(truth: DataFrame, by: str = "qid", seen: str = "seen_item") -> DataFrame:
    """(qid, seen_item_group): whether all, some or none of a query's relevant items are known from the log."""
    every, some = F.bool_and(seen), F.bool_or(seen)
    return truth.groupBy(by).agg(F.when(every, "all_seen").when(some, "mixed").otherwise("all_unseen").alias("seen_item_group"))


def recall_by_group(per_query: DataFrame, groups: list[str], metric: str) -> DataFrame:
    """Means overall and for each value of each group, in one pass of grouping sets."""
    known = per_query.where(F.col(metric).isNotNull())
    sets = [[], *[[F.col(g)] for g in groups]]
    out = known.groupingSets(sets, *groups).agg(F.avg(metric).alias("recall"), F.count(F.lit(1)).alias("n"), *[F.grouping(g).alias(f"__{g}") for g in groups])
    name, value = F.lit("all"), F.lit("all")
    for g in groups:
        name = F.when(F.col(f"__{g}") == 0, g).otherwise(name)
        value = F.when(F.col(f"__{g}") == 0, F.coalesce(F.col(g).cast("string"), F.lit(""))).otherwise(value)
    return out.select(name.alias("group_name"), value.alias("group_value"), "recall", "n")


def post_stratified(per_query: DataFrame, flag: str, metric: str, weight: float) -> DataFrame:
    """weight * mean(flag) + (1 - weight) * mean(not flag); null if a group that counts is empty."""
    if not 0 <= weight <= 1:
        raise ValueError("the weight is a fraction")
    yes, no = F.avg(F.when(F.col(flag), F.col(metric))), F.avg(F.when(~F.col(flag), F.col(metric)))
    parts = ([F.lit(weight) * yes] if weight > 0 else []) + ([F.lit(1 - weight) * no] if weight < 1 else [])
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return per_query.agg(total.alias("recall"))


def check_evaluation(queries: DataFrame, candidates: DataFrame, truth: DataFrame, n_items: int, score: str = "score") -> None:
    """ValueError names what makes an evaluation meaningless."""
    value = F.col(score).cast("double")
    wrong = {
        "queries repeat": queries.groupBy("qid").count().where("count > 1"),
        "a candidate repeats": candidates.groupBy("qid", "item_idx").count().where("count > 1"),
        "a candidate's query is not asked": candidates.join(queries, "qid", "left_anti"),
        "an item is outside of the corpus": candidates.where(F.col("item_idx").isNull() | (F.col("item_idx") < 0) | (F.col("item_idx") >= n_items)),
        "a score is not finite": candidates.where(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf"))),
        "a query has no relevant item": queries.join(truth, "qid", "left_anti"),
    }
    for what, rows in wrong.items():
        if rows.head(1):
            raise ValueError(what)


def report(queries: DataFrame, candidates: DataFrame, truth: DataFrame, n_items: int, ks: tuple[int, ...] = (10, 50, 100), score: str = "score", empty_weight: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows (metric, group_name, group_value, value, n), and the recall of each query.

    Queries may have regime, seen_text, seen_context and filter, truth
    seen_item; the breakdowns are by those there are. Post-stratified values
    are null where one of the two groups is missing.
    """
    if not ks or any(isinstance(k, bool) or not isinstance(k, int) or k < 1 for k in ks):
        raise ValueError("cut-offs are positive integers")
    check_evaluation(queries, candidates, truth, n_items, score)
    asked = queries.withColumn("filter_empty", blank(F.col("filter"))) if "filter" in queries.columns else queries
    asked = asked.join(seen_groups(truth), "qid", "left") if "seen_item" in truth.columns else asked
    per = per_query_recall(asked, candidates, truth, sorted(set(ks)), score)
    groups = [g for g in BREAKDOWNS if g in per.columns]
    metrics = [f"recall_{k}" for k in [*sorted(set(ks)), "union"]]
    sets = [[], *[[F.col(g)] for g in groups]]
    means = per.groupingSets(sets, *groups).agg(*[F.avg(m).alias(m) for m in metrics], F.avg("n_candidates").alias("n_candidates"), F.count(F.lit(1)).alias("n"), *[F.grouping(g).alias(f"__{g}") for g in groups])
    name, value = F.lit("all"), F.lit("all")
    for g in groups:
        name = F.when(F.col(f"__{g}") == 0, g).otherwise(name)
        value = F.when(F.col(f"__{g}") == 0, F.coalesce(F.col(g).cast("string"), F.lit(""))).otherwise(value)
    wide = means.select(name.alias("group_name"), value.alias("group_value"), "n", *metrics, "n_candidates")
    out = wide.unpivot(["group_name", "group_value", "n"], [*metrics, "n_candidates"], "metric", "value").select("metric", "group_name", "group_value", "value", "n")
    if empty_weight is not None and "filter_empty" in groups:
        for m in metrics:
            strata = post_stratified(per, "filter_empty", m, empty_weight).crossJoin(per.agg(F.count(F.lit(1)).alias("n")))  # one row each
            strata = strata.select(F.lit(m).alias("metric"), F.lit("poststratified").alias("group_name"), F.lit("all").alias("group_value"), F.col("recall").alias("value"), "n")
            out = out.unionByName(strata)
    return out, per


def target_disjoint(queries: DataFrame, truth: DataFrame, train_items: DataFrame) -> DataFrame:
    """Queries none of whose relevant items occurs in the training truth (item_idx)."""
    shared = truth.join(train_items.select("item_idx").distinct(), "item_idx", "left_semi").select("qid").distinct()
    return queries.join(shared, "qid", "left_anti")


def empty_fraction(queries: DataFrame, column: str) -> DataFrame:
    return queries.agg(F.avg(blank(F.col(column)).cast("double")).alias("empty_fraction"))


def loss(truth: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """Truth pairs by outcome: hit, below the cut, or not among the candidates (qid, item_idx, score; a pair once).

    Hits are the pairs among the first k candidates of their query, of which
    each task keeps k a query before they move: the work is that of one pass
    over the candidates, however many relevant items a query has. A null score
    is no candidate.
    """
    pairs = truth.select("qid", "item_idx").distinct()
    known = candidates.where("score is not null").select("qid", "item_idx", "score")
    cut = top_k(known, k).select("qid", "item_idx", F.lit(True).alias("__hit"))
    told = pairs.join(known.select("qid", "item_idx", F.lit(True).alias("__met")), ["qid", "item_idx"], "left").join(cut, ["qid", "item_idx"], "left")
    kind = F.when(F.col("__hit"), "hit").when(F.col("__met"), "below").otherwise("missing")
    return told.groupBy(kind.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def _drawn(seed: int, resample: int, n: int, counts: list[int], part: int) -> int:
    """How many of ``n`` draws with replacement fall to rows of ``part``: binomial draws down a tree over the parts, the same in every task."""
    low, high = 0, len(counts)
    while high - low > 1:
        mid = (low + high) // 2
        left, whole = sum(counts[low:mid]), sum(counts[low:high])
        rng = np.random.default_rng([seed, resample, low, high])
        own = int(rng.binomial(n, left / whole)) if whole else 0
        low, high, n = (low, mid, own) if part < mid else (mid, high, n - own)
    return n


def resample_weights(seed: int, resample: int, counts: list[int], part: int) -> np.ndarray:
    """How often each row of a part is drawn in a resample of as many draws as there are rows; resample 0 has each row once."""
    if not resample or not counts[part]:
        return np.ones(counts[part], np.int64)
    rng = np.random.default_rng([seed, resample, part, len(counts), 1])
    return rng.multinomial(_drawn(seed, resample, sum(counts), counts, part), np.full(counts[part], 1 / counts[part]))


def paired_bootstrap(
    current: DataFrame, baseline: DataFrame, key: str, metric: str, flag: str | None = None, weight: float | None = None, iterations: int = 2000, seed: int = 42, part_rows: int = BOOTSTRAP_ROWS
) -> DataFrame:
    """One row: mean difference, its 95 % interval, the share of positive resamples, and the number of pairs.

    A resample is exactly as many draws with replacement as there are pairs.
    Pairs lie in parts by a hash of their key; a tree of binomial draws over the
    parts, seeded by its nodes, tells each task how many draws are its own, and
    a multinomial draw which, so no row leaves its task and a rerun draws the
    same: a row a part and resample is all that is gathered. With ``flag`` and
    ``weight`` the means are post-stratified in every resample.
    """
    side = baseline.select(F.col(key).alias("__key"), F.col(metric).alias("__base"))
    joined = current.join(side, current[key] == side["__key"], "full_outer").select(key, "__key", (F.col(metric) - F.col("__base")).cast("double").alias("d"), (F.col(flag) if flag else F.lit(True)).alias("flag"))
    if joined.where(F.col("__key").isNull() | F.col(key).isNull()).head(1):
        raise ValueError("both sides need the same queries")
    known = written(joined.where("d is not null and flag is not null").select(key, "d", "flag"), "bootstrap-pairs")
    n_parts = max(1, -(-known.count() // part_rows))
    parted = known.withColumn("part", F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(n_parts)).cast("int"))
    sizes = dict(parted.groupBy("part").agg(F.count(F.lit(1))).collect())  # a row a part
    counts = [sizes.get(i, 0) for i in range(n_parts)]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, d, flags = None, [], []

        def told() -> pa.RecordBatch:
            values, yes = np.array(d), np.array(flags, bool)
            out = np.zeros((iterations + 1, 4))
            for r in range(iterations + 1):
                w = resample_weights(seed, r, counts, now)
                out[r] = (w[yes] @ values[yes], w[yes].sum(), w[~yes] @ values[~yes], w[~yes].sum())
            return pa.RecordBatch.from_arrays([pa.array(np.arange(iterations + 1)), *[pa.array(c) for c in out.T]], ["resample", "yes", "n_yes", "no", "n_no"])

        for batch in batches:
            for part, x, f in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != now:
                    if d:
                        yield told()
                    now, d, flags = part, [], []
                d.append(x)
                flags.append(f)
        if d:
            yield told()

    dealt = parted.repartition("part").sortWithinPartitions("part", key).select("part", "d", "flag")
    each = dealt.mapInArrow(sums, "resample long, yes double, n_yes double, no double, n_no double").groupBy("resample").agg(*[F.sum(c).alias(c) for c in ("yes", "n_yes", "no", "n_no")])
    share = lambda total, n: F.col(total) / F.nullif(F.col(n), F.lit(0))
    every = (F.col("yes") + F.col("no")) / F.nullif(F.col("n_yes") + F.col("n_no"), F.lit(0))
    value = every if weight is None else weight * share("yes", "n_yes") + (1 - weight) * share("no", "n_no")
    means = each.select("resample", value.alias("m"), (F.col("n_yes") + F.col("n_no")).cast("long").alias("n"))
    resampled = F.when(F.col("resample") > 0, F.col("m"))
    ends = F.percentile(resampled, [0.025, 0.975])
    out = means.agg(F.max(F.when(F.col("resample") == 0, F.col("m"))).alias("delta"), ends.alias("ends"), F.avg((resampled > 0).cast("double")).alias("positive"), F.max("n").alias("n"))
    return out.select("delta", F.col("ends")[0].alias("low"), F.col("ends")[1].alias("high"), "positive", "n")


def merged_reports(current: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Two reports side by side, each row with exactly one partner."""
    return one_to_one(current, other.select(*keys, F.col("value").alias("other")), keys, whole=True).withColumn("difference", F.col("value") - F.col("other"))


def tagged(parts: dict[str, DataFrame], name: str = "model") -> DataFrame:
    """Tables of one shape in one, with the name of each as a column."""
    out = None
    for tag, part in parts.items():
        own = part.withColumn(name, F.lit(tag))
        out = own if out is None else out.unionByName(own)
    return out

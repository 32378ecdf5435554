"""Leakage-free splits by hashed draws, and the assertions that hold for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import appended, with_row_index, written

#: Shares of the regimes among validation queries; the rest are cold texts.
WARM_CONTEXT, WARM_TEXT = 0.044, 0.33
#: Share of the target items that leave the log altogether.
COLD_ITEMS = 0.904


def draw(*key: Column, seed: int) -> Column:
    """A reproducible draw in [0, 2^32) by md5, equal in every engine."""
    text = F.concat_ws("|", *[k.cast("string") for k in key], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def query_id(key: Column) -> Column:
    return F.substring(F.sha2(key, 256), 1, 16)


def sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, those of the smallest draws; Spark cuts each task's rows to n before they move."""
    return df.withColumn("__draw", draw(F.col(key), seed=seed)).orderBy("__draw", key).limit(n).drop("__draw")


def place_in(df: DataFrame, group: str, key: str, seed: int, name: str = "place", size: str = "of") -> DataFrame:
    """Place of each row (from 0) in the order of draws within its group, and the group's size; no group is sorted by one task."""
    drawn = df.withColumn("__draw", draw(F.col(key), seed=seed))
    placed = with_row_index(drawn, group, "__draw", key)
    starts = placed.groupBy(group).agg(F.min("row_idx").alias("__start"), F.count(F.lit(1)).alias(size))
    return placed.join(starts, group).withColumn(name, F.col("row_idx") - F.col("__start")).drop("__draw", "row_idx", "__start")


def assign(contexts: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """``split``: half fit, a quarter dev, a quarter audit, in the order of draws within ``regime``."""
    placed = place_in(contexts, "regime", key, seed, "__place", "__of")
    p = F.when(F.col("__of") > 1, F.col("__place") / (F.col("__of") - 1)).otherwise(0.0)
    return placed.withColumn("split", F.when(p < 0.5, "fit").when(p < 0.75, "dev").otherwise("audit")).drop("__place", "__of")


def hide(train: DataFrame, hidden: DataFrame, on: list[str]) -> DataFrame:
    return train.join(hidden.select(*on).distinct(), on, "left_anti")


def overlap(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Number of distinct keys that both tables hold."""
    return a.select(*on).intersect(b.select(*on)).agg(F.count(F.lit(1)).alias("shared"))


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key; the rows before it never leave their task."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(order)).alias("__s")).select(*[key if c == key else F.col(f"__s.{c}").alias(c) for c in df.columns])


def quota(rows: DataFrame, n: int, key: str, seed: int, exact: bool = True) -> DataFrame:
    """``n`` rows, those of the smallest draws of their key, by places in range partitions; if there are fewer, ValueError, or all of them where ``exact`` is off."""
    placed = with_row_index(rows.withColumn("__draw", draw(F.col(key), seed=seed)), "__draw", key)
    taken = written(placed.where(F.col("row_idx") < n).drop("row_idx", "__draw"), "split-quota")
    found = taken.count()
    if exact and found < n:
        raise ValueError(f"{n} of {key} are wanted, and there are {found}")
    return taken


def make_validation(log: DataFrame, corpus: DataFrame, items: DataFrame, count: int, seed: int = 42, exact: bool = True) -> dict[str, DataFrame]:
    """Queries, truth, training log and corpus of a validation split of a log (text, context, item_id, ...).

    Exactly ``count`` contexts become queries, each text once, in the shares of
    the regimes: first warm contexts (two items or more, of which half is
    hidden), then of the texts left warm texts (in two contexts or more), then
    of those left cold texts, whose every row leaves the log. A regime takes the
    texts of the smallest draws, and of a text's contexts that serve it the one
    with the smallest draw; ValueError where they don't suffice, or without
    ``exact`` a regime takes all there are and the split has fewer queries (its
    cuts stay at the shares of ``count``). Exactly the share ``COLD_ITEMS`` of
    the target items leaves the log altogether, and all hidden pairs do. Half of
    the queries are fit, a quarter dev, the rest audit; the corpus gets the targets it lacks behind its own items. Rows
    without text, context or item take no part in the choice.
    """
    pairs = written(log.select("context", "text", "item_id").dropna().distinct(), "split-pairs")
    contexts = pairs.groupBy("context", "text").agg(F.count(F.lit(1)).alias("n_items"))
    spread = contexts.groupBy("text").agg(F.count(F.lit(1)).alias("n_contexts"))
    told = written(contexts.join(spread, "text"), "split-contexts")
    warm = round(count * WARM_CONTEXT), round(count * WARM_TEXT)
    regimes = [("warm_context", warm[0], F.col("n_items") >= 2), ("warm_text", warm[1], F.col("n_contexts") >= 2), ("cold_text", count - sum(warm), F.lit(True))]
    chosen = None
    for i, (regime, n, serves) in enumerate(regimes):
        pool = told.where(serves)
        if chosen is not None:
            pool = pool.join(chosen.select("text"), "text", "left_anti")
        texts = quota(pool.select("text").distinct(), n, "text", seed + 1 + i, exact)
        first = F.min_by(F.struct("context", "n_items"), F.struct(draw(F.col("context"), seed=seed), "context"))
        own = pool.join(texts, "text", "left_semi").groupBy("text").agg(first.alias("s")).select("text", F.lit(regime).alias("regime"), "s.*")
        chosen = written(own if chosen is None else chosen.unionByName(own), "split-chosen")
    placed = with_row_index(chosen.withColumn("__draw", draw(F.col("context"), seed=seed + 9)), "__draw", "context")
    part = F.when(F.col("row_idx") < count // 2, "fit").when(F.col("row_idx") < count // 2 + count // 4, "dev").otherwise("audit")
    queries = written(placed.withColumns({"split": part, "query_id": query_id(F.col("context"))}).drop("row_idx", "__draw"), "split-queries")
    targets = pairs.join(queries.select("context", "regime", "query_id", "n_items"), "context")
    order = Window.partitionBy("context").orderBy(draw(F.col("context"), F.col("item_id"), seed=seed), "item_id")  # one query's items
    keep = (F.col("regime") != "warm_context") | (F.row_number().over(order) <= F.greatest(F.floor(F.col("n_items") / 2), F.lit(1)))
    truth = written(targets.withColumn("keep", keep).where("keep").select("query_id", "context", "item_id"), "split-truth")
    goals = truth.select("item_id").distinct()
    goal = quota(goals, round(goals.count() * COLD_ITEMS), "item_id", seed + 5)
    train = hide(log, queries.where("regime = 'cold_text'"), ["text"])
    train = hide(hide(train, goal, ["item_id"]), truth, ["context", "item_id"])
    return {"queries": queries, "truth": truth, "train": train, "corpus": appended(corpus, items.join(truth.select("item_id").distinct(), "item_id", "left_semi"), "item_id")}

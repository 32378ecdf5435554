"""Boosted symmetric trees over histograms, for lists (softmax within a query) or single rows (log loss).

Feature values become numbers of borders once, and rows are packed by query
into the shared folder. Each level of a tree is one pass: tasks make the
gradients of their queries from the margins, sum them by leaf, feature and
border in whole numbers (so sums are the same in any order), Spark adds the
tasks' sums, and the driver, which sees a table of fixed size (leaves x
features x borders), takes the split that serves all leaves best. All leaves
of a level have one split, so a tree is ``depth`` borders and a table of leaf
values, and a model's margins are one pass of array work, however many trees
it has. Margins are packed anew every few trees, so a lost executor costs
little and no plan grows.

A query of more than ``MOST_ROWS`` rows is packed in parts; the maximum and
sum of its softmax are then Spark's sums over the parts.

Defined results: a null or NaN feature lies below every border; a null label
is 0; a query without a positive label has no gradient in the softmax; rows of
a null qid are one query; an empty table gives a model without trees.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import discard, written
from .ranker import guard
from .topk import top_k

#: Rows of a pack, whole queries where they fit; more rows of one query are packed in parts.
PACK_ROWS, MOST_ROWS = 1 << 15, 1 << 16
#: Trees after which margins are packed anew.
KEEP = 8
#: Between a query and its part.
PART = "\0"
OBJECTIVES = ("softmax", "logloss")


@dataclass(frozen=True)
class Trees:
    """A model: names of features, and for each tree its borders (feature, value), outermost first, and leaf values."""

    features: list[str]
    splits: list[list[tuple[int, float]]] = field(default_factory=list)
    leaves: list[list[float]] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def shrunk(self, n: int) -> Trees:
        """The model of the first ``n`` trees."""
        if not 0 <= n <= len(self.splits):
            raise ValueError(f"the model has {len(self.splits)} trees")
        return replace(self, splits=self.splits[:n], leaves=self.leaves[:n], losses=self.losses[: n + 1])

    def margins(self, x: np.ndarray, sizes: list[int] | None = None) -> np.ndarray:
        """Margins (row, size) after the first n trees for each n of ``sizes`` (ascending), of features (row, feature)."""
        sizes = [len(self.splits)] if sizes is None else sizes
        out, now = np.zeros((len(x), len(sizes))), np.zeros(len(x))
        columns = np.ascontiguousarray(x.T)
        at = 0
        for i, n in enumerate(sizes):
            for splits, leaves in zip(self.splits[at:n], self.leaves[at:n], strict=True):
                leaf = np.zeros(len(x), np.int64)
                for feature, border in splits:
                    leaf = 2 * leaf + (columns[feature] > border)
                now += np.asarray(leaves)[leaf]
            at = n
            out[:, i] = now
        return out


def softmax_gradients(df: DataFrame, margin: str = "margin", label: str = "label", by: str = "qid") -> DataFrame:
    """``df`` with share (softmax of the margins within a query), gradient (label - total label * share), curvature, and the query's loss."""
    w = Window.partitionBy(by)
    top = F.max(margin).over(w)
    power = F.exp(F.col(margin) - top)
    total = F.sum(F.coalesce(label, F.lit(0.0))).over(w)
    out = df.withColumns({"share": power / F.sum(power).over(w), "__total": total, "__log": F.log(F.sum(power).over(w)) + top})
    y = F.coalesce(label, F.lit(0.0))
    gradient, curvature = y - F.col("__total") * F.col("share"), F.col("__total") * F.col("share") * (1 - F.col("share"))
    return out.withColumns({"gradient": gradient, "curvature": curvature, "loss": F.sum(y * (F.col("__log") - F.col(margin))).over(w)}).drop("__total", "__log")


def borders_of(df: DataFrame, features: list[str], borders: int) -> list[list[float]]:
    """Ascending values of each feature that part its rows evenly; one pass, ``borders`` numbers a feature."""
    at = [(i + 1) / (borders + 1) for i in range(borders)]
    sound = lambda c: F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
    found = df.agg(*[F.percentile_approx(sound(F.col(c).cast("double")), at, 100 * borders).alias(f"b{i}") for i, c in enumerate(features)]).first()
    return [sorted(set(found[f"b{i}"] or [])) for i in range(len(features))]


PACKED = "qids array<string>, stops array<long>, bins binary, labels binary, margins binary"
_NAMES = [c.split()[0] for c in PACKED.split(", ")]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), width)


def _packed(borders: list[list[float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def pack(rows: list[tuple]) -> pa.RecordBatch:
            qids = np.concatenate([r[0] for r in rows])
            stops = np.append(np.flatnonzero(qids[1:] != qids[:-1]) + 1, len(qids))
            bins, labels = np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows])
            values = [[[q.split(PART)[0] for q in qids[stops - 1]]], [stops.tolist()], [bins.tobytes()], [labels.tobytes()], [np.zeros(len(labels)).tobytes()]]
            kinds = [pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], _NAMES)

        for batch in batches:
            x = _matrix(batch.column(1), len(borders))
            bins = np.stack([np.searchsorted(b, x[:, i], "left") for i, b in enumerate(borders)], axis=1) if borders else np.zeros(x.shape)
            bins = np.where(np.isnan(x), 0, bins).astype(np.uint8)
            qids = np.asarray(batch.column(0).to_pylist(), object)
            labels = np.asarray(batch.column(2), np.float64)
            held.append((qids, bins, labels))
            while sum(len(r[0]) for r in held) > PACK_ROWS:  # all but the last query, which may go on
                rows = [tuple(np.concatenate(c) for c in zip(*held, strict=True))]
                last = np.flatnonzero(rows[0][0] != rows[0][0][-1])
                cut = int(last[-1]) + 1 if len(last) else 0
                if not cut:
                    held[:] = rows
                    break
                yield pack([tuple(c[:cut] for c in rows[0])])
                held[:] = [tuple(c[cut:] for c in rows[0])]
        if held and sum(len(r[0]) for r in held):
            yield pack(held)

    return run


def packs(df: DataFrame, features: list[str], borders: list[list[float]], most_rows: int = MOST_ROWS) -> tuple[DataFrame, list[str]]:
    """Rows of ``PACKED`` and the queries that are packed in parts (one for ``most_rows`` rows of the table, at most)."""
    qid = F.coalesce(F.col("qid").cast("string"), F.lit("")).alias("qid")
    rows = df.select(qid, F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in features]).alias("x"), F.coalesce(F.col("label").cast("double"), F.lit(0.0)).alias("label"))
    counted = rows.groupBy("qid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most_rows).collect()
    large = [r[0] for r in counted]
    if large:
        part = F.pmod(F.monotonically_increasing_id(), F.lit(-(-max(r[1] for r in counted) // most_rows)))
        rows = rows.withColumn("qid", F.when(F.col("qid").isin(large), F.concat("qid", F.lit(PART), part.cast("string"))).otherwise(F.col("qid")))
    laid = rows.repartition("qid").sortWithinPartitions("qid")
    return written(laid.mapInArrow(_packed(borders), PACKED), "boosting-packs"), large


class _Pack:
    """A pack in a task, with the margins that ``trees`` (bins for borders) add to the packed ones."""

    def __init__(self, batch: pa.RecordBatch, r: int, width: int, trees: list[tuple[list[tuple[int, int]], list[float]]]):
        self.qids, self.stops = batch.column(0)[r].as_py(), np.asarray(batch.column(1)[r].values)
        self.bins = np.frombuffer(batch.column(2)[r].as_buffer(), np.uint8).reshape(-1, width)
        self.labels, packed = (np.frombuffer(batch.column(c)[r].as_buffer()) for c in (3, 4))
        self.margins = packed.copy()
        for splits, leaves in trees:
            self.margins += np.asarray(leaves)[self.leaf(splits)]

    def leaf(self, splits: list[tuple[int, int]]) -> np.ndarray:
        at = np.zeros(len(self.bins), np.int64)
        for feature, border in splits:
            at = 2 * at + (self.bins[:, feature] > border)
        return at

    def softmax(self, totals: dict[str, tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray, float]:
        """Gradients, curvatures and loss; ``totals`` has (maximum, sum, labels) of queries in parts."""
        starts = np.concatenate([[0], self.stops[:-1]])
        own, n = np.arange(len(self.stops)), np.diff(np.concatenate([[0], self.stops]))
        top = np.maximum.reduceat(self.margins, starts)
        for i, q in enumerate(self.qids if totals else ()):
            if q in totals:
                top[i] = totals[q][0]
        of = np.repeat(own, n)
        power = np.exp(self.margins - top[of])
        powers, labels = np.add.reduceat(power, starts), np.add.reduceat(self.labels, starts)
        for i, q in enumerate(self.qids if totals else ()):
            if q in totals:
                powers[i], labels[i] = totals[q][1:]
        share = power / powers[of]
        loss = float((self.labels * (np.log(powers)[of] + top[of] - self.margins)).sum())
        return self.labels - labels[of] * share, labels[of] * share * (1 - share), loss

    def logloss(self) -> tuple[np.ndarray, np.ndarray, float]:
        p = 1 / (1 + np.exp(-self.margins))
        loss = float((np.logaddexp(0, self.margins) - self.labels * self.margins).sum())
        return self.labels - p, p * (1 - p), loss


def _sums(width: int, cells: int, trees: list, splits: list, objective: str, totals: dict, scale: float):
    """Sums of gradients and curvatures by leaf, feature and border, and of the loss (cell -1), of a task's packs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaves = 1 << len(splits)
        sums = np.zeros((2, leaves, width, cells), np.int64)
        loss = 0
        for batch in batches:
            for r in range(batch.num_rows):
                pack = _Pack(batch, r, width, trees)
                g, h, own = pack.softmax(totals) if objective == "softmax" else pack.logloss()
                loss += round(own * scale / 64)
                leaf, parts = pack.leaf(splits) * cells, []
                for k, v in enumerate((g, h)):
                    v = np.rint(v * scale)
                    high = np.floor(v / (1 << 24))
                    parts += [(k, high, 1 << 24), (k, v - high * (1 << 24), 1)]  # of a pack, both add up below 2**53: exactly
                for f in range(width):
                    at = leaf + pack.bins[:, f]
                    for k, part, unit in parts:
                        sums[k, :, f] += np.bincount(at, part, leaves * cells).astype(np.int64).reshape(leaves, cells) * unit
        sums = sums.reshape(2, -1)
        at = np.flatnonzero(sums.any(axis=0))
        columns = [np.append(at, -1), np.append(sums[0, at], loss), np.append(sums[1, at], 0)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["cell", "g", "h"])

    return run


def _large_totals(packed: DataFrame, width: int, trees: list, large: list[str]) -> dict[str, tuple[float, float, float]]:
    """(maximum, sum, labels) of the softmax of queries in parts; a row a query."""
    if not large:
        return {}
    wanted = set(large)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                pack = _Pack(batch, r, width, trees)
                rows = []
                for i, (q, b) in enumerate(zip(pack.qids, pack.stops.tolist(), strict=True)):
                    if q in wanted:
                        own = slice(pack.stops[i - 1] if i else 0, b)
                        top = float(pack.margins[own].max())
                        rows.append((q, top, float(np.exp(pack.margins[own] - top).sum()), float(pack.labels[own].sum())))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["qid", "top", "powers", "labels"])

    held = packed.where(F.exists("qids", lambda q: q.isin(large))).mapInArrow(run, "qid string, top double, powers double, labels double")
    top = F.max("top").over(Window.partitionBy("qid"))
    found = held.withColumn("all", top).groupBy("qid").agg(F.first("all"), F.sum(F.col("powers") * F.exp(F.col("top") - F.col("all"))), F.sum("labels"))
    return {q: (a, b, c) for q, a, b, c in found.collect()}


def _repacked(width: int, trees: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = [_Pack(batch, r, width, trees).margins.tobytes() for r in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(margins, pa.binary())], _NAMES)

    return run


def best_split(sums: np.ndarray, n_borders: list[int], ridge: float) -> tuple[int, int]:
    """(feature, border) whose split of all leaves gains most, of sums (g or h, leaf, feature, border); of equals the first."""
    below = np.cumsum(sums, axis=3)
    whole = below[..., -1:]
    gain = sum(part[0] ** 2 / (part[1] + ridge) for part in (below, whole - below)).sum(axis=0)
    for f, n in enumerate(n_borders):
        gain[f, n:] = -np.inf  # the last value has no border above it
    best = int(np.argmax(gain))
    return best // gain.shape[1], best % gain.shape[1]


def fit(
    df: DataFrame, features: list[str], objective: str = "softmax", trees: int = 100, depth: int = 6, step: float = 0.07, borders: int = 32, ridge: float = 3.0, splits: tuple[str, ...] | None = None, most_rows: int = MOST_ROWS
) -> Trees:
    """A model of ``label`` for rows (qid, label, features...); ``splits`` are those the table may hold. ``losses`` are those before each tree and after the last."""
    if objective not in OBJECTIVES or not 0 < borders < 256 or not 0 < depth <= 10 or not features:
        raise ValueError("unknown objective, or borders, depth or features out of range")
    if splits is not None:
        guard(df, splits)
    known = borders_of(df, features, borders)
    width, cells, counts = len(features), borders + 1, [len(b) for b in known]
    packed, large = packs(df, features, known, most_rows)
    weight = df.agg(F.sum(F.abs(F.coalesce(F.col("label").cast("double"), F.lit(0.0)))), F.count(F.lit(1))).first()
    most = max(1.0, 2 * (weight[0] or 0.0) if objective == "softmax" else float(weight[1]))
    model, recent, losses = Trees(features), [], []
    if not weight[1] or not any(counts):
        return model
    scale = 2.0 ** (60 - math.ceil(math.log2(most)))

    def summed(own: list[tuple[int, int]], totals: dict) -> tuple[np.ndarray, float]:
        rows = packed.mapInArrow(_sums(width, cells, recent, own, objective, totals, scale), "cell long, g long, h long")
        table = rows.groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
        cell, g, h = (np.asarray(c) for c in table.columns)
        out = np.zeros((2, (1 << len(own)) * width * cells))
        out[:, cell[cell >= 0]] = np.stack([g, h])[:, cell >= 0] / scale
        return out.reshape(2, 1 << len(own), width, cells), float(g[cell < 0].sum()) * 64 / scale

    for _ in range(trees):
        totals, own = _large_totals(packed, width, recent, large) if objective == "softmax" else {}, []
        for level in range(depth):
            sums, loss = summed(own, totals)
            if not level:
                losses.append(loss)
            own.append(best_split(sums, counts, ridge))
        feature, border = own[-1]
        low = np.cumsum(sums[:, :, feature], axis=2)[:, :, border]
        high = sums[:, :, feature].sum(axis=2) - low
        g, h = (np.stack([low[k], high[k]], axis=1).ravel() for k in range(2))
        leaves = (step * g / (h + ridge)).tolist()
        recent.append((own, leaves))
        model = replace(model, splits=[*model.splits, [(f, known[f][b]) for f, b in own]], leaves=[*model.leaves, leaves])
        if len(recent) == KEEP:
            now = written(packed.mapInArrow(_repacked(width, recent), PACKED), "boosting-packs")
            discard(packed)
            packed, recent = now, []
    losses.append(summed([], _large_totals(packed, width, recent, large) if objective == "softmax" else {})[1])
    discard(packed)
    return replace(model, losses=losses)


def score(model: Trees, df: DataFrame, name: str = "score", sizes: list[int] | None = None) -> DataFrame:
    """``df`` with the margin; with ``sizes``, an array of the margins after so many trees. The plan is the same for any number of trees."""
    missing = [c for c in model.features if c not in df.columns]
    if missing:
        raise ValueError(f"features that the model was trained on are missing: {missing}")
    if sizes is not None and (sorted(sizes) != sizes or not sizes or not 0 <= sizes[0] <= sizes[-1] <= len(model.splits)):
        raise ValueError("sizes must ascend and be no larger than the model")
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in model.features])
    kind: T.DataType = T.DoubleType() if sizes is None else T.ArrayType(T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.margins(_matrix(batch.column(batch.num_columns - 1), len(model.features)), sizes)
            stops = pa.array(np.arange(0, found.size + 1, found.shape[1]), pa.int32())
            last = pa.array(found[:, 0]) if sizes is None else pa.ListArray.from_arrays(stops, pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], last], [*batch.schema.names[:-1], name])

    base = df.drop(name)
    return base.select("*", x.alias("__x")).mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(name, kind)]))


def recall_by_size(model: Trees, dev: DataFrame, truth: DataFrame, sizes: list[int], k: int = 50) -> dict[int, float]:
    """Mean recall at ``k`` of the queries of ``truth`` (qid, item_idx), for each number of trees; one pass over ``dev``."""
    scored = score(model, dev.select("qid", "item_idx", *model.features), "__m", sizes).select("qid", "item_idx", F.posexplode("__m").alias("at", "score"))
    ranked = top_k(scored.withColumn("__g", F.struct("qid", "at")), k, by="__g")
    pairs = truth.select("qid", "item_idx").distinct()
    hits = ranked.join(pairs, ["qid", "item_idx"], "left_semi").groupBy("qid", "at").agg(F.count(F.lit(1)).alias("hits"))
    relevant = pairs.groupBy("qid").agg(F.count(F.lit(1)).alias("n"))
    n_queries = relevant.count()
    found = hits.join(relevant, "qid").groupBy("at").agg(F.sum(F.col("hits") / F.col("n")).alias("total"))
    totals = dict(found.collect())
    return {n: totals.get(i, 0.0) / max(1, n_queries) for i, n in enumerate(sizes)}


def select_trees(model: Trees, dev: DataFrame, truth: DataFrame, every: int = 50, k: int = 50) -> tuple[Trees, dict[int, float]]:
    """The model cut to the number of trees with the best recall on dev rows (of equals the fewest), and all that were tried."""
    n = len(model.splits)
    tried = recall_by_size(model, dev, truth, sorted({*range(every, n + 1, every), n}), k)
    return model.shrunk(max(tried, key=lambda size: (round(tried[size], 12), -size))), tried


def save(model: Trees, spark: SparkSession, path: str) -> None:
    """The model as a table, a row a tree, behind one of its features and losses."""
    rows = [(-1, json.dumps({"features": model.features, "losses": model.losses}))]
    rows += [(i, json.dumps({"splits": s, "leaves": v})) for i, (s, v) in enumerate(zip(model.splits, model.leaves, strict=True))]
    spark.createDataFrame(rows, "tree int, told string").coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str, features: list[str] | None = None) -> Trees:
    """A saved model; ValueError if it was trained on other features."""
    (_, head), *rows = sorted(spark.read.parquet(path).select("tree", "told").collect())
    told, trees = json.loads(head), [json.loads(r) for _, r in rows]
    if features is not None and told["features"] != features:
        raise ValueError("the model was trained on other features")
    return Trees(told["features"], [[(f, b) for f, b in t["splits"]] for t in trees], [t["leaves"] for t in trees], told["losses"])


def keep_best(model: Trees, dev: DataFrame, truth: DataFrame, path: str, every: int = 50, k: int = 50) -> tuple[Trees, dict[int, float]]:
    """:func:`select_trees`, saved to ``path``; ValueError if what is read back doesn't rank dev rows as the prefix did."""
    spark = dev.sparkSession
    best, tried = select_trees(model, dev, truth, every, k)
    save(best, spark, path)
    back = load(spark, path, model.features)
    size = len(best.splits)
    again = recall_by_size(back, dev, truth, [size], k)[size]
    if abs(again - tried[size]) > 1e-12:
        raise ValueError(f"the saved model has recall {again}, its prefix had {tried[size]}")
    return back, tried


def margin(df: DataFrame, model: Trees) -> Column:
    """The margin as one expression, for small models in plans that shouldn't leave the JVM."""
    total = F.lit(0.0)
    for splits, leaves in zip(model.splits, model.leaves, strict=True):
        leaf = F.lit(0)
        for feature, border in splits:
            x = F.col(model.features[feature]).cast("double")
            leaf = leaf * 2 + F.when(~F.isnan(x) & (x > border), 1).otherwise(0)
        total = total + F.element_at(F.array(*[F.lit(v) for v in leaves]), leaf + 1)
    return total

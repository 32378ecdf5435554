"""Ranked lexical search: many queries at once, with shared partial scores.

1. The terms of all items are grouped by the items that hold them: terms that
   the same items hold always score together and form an atom. In rounds,
   neighbouring nodes of an item's list (atoms first, those of most items
   leading) that stand together in several items become a node of their own,
   whose two parts it names. So the items share a directed acyclic graph of
   term sets, mined by Spark's counts.
2. Documents are read once into packed rows: lengths, and the terms that items
   ask for with their occurrences. Document counts and frequencies are Spark's
   sums over them.
3. Batches of documents meet blocks of items. A batch adds up the partial
   scores of every node of the block once, atoms from their terms and each
   other node from its two parts, and each item from its last nodes; only the
   items' best documents leave the task, and a ranking by item ends it.

All scores are 64-bit integers, so every order of addition gives the same.

Defined results: a null text has no term; an item without terms, or whose
terms no document has, has no rows; rows that repeat an item_id form one item
with the terms of all of them, also where it is null; a null doc_id ranks
behind the others of its score; rows that repeat a doc_id are documents of
their own; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import discard, documents, materialize

#: What is no part of a term: ASCII other than letters and digits.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BEST = 50
#: Rounds of mining; what they leave unshared is added up for each item alone.
ROUNDS = 12
#: Items of a block, which a task holds with their graph.
ITEMS = 2000
#: Asked terms up to which documents are cut to asked terms as they are read; beyond it they keep all.
MOST_ASKED = 1_000_000
#: Documents of a row of the packed table, and partial scores that a task holds at a time.
PACK, CELLS = 4096, 4_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms_of(text: Column) -> Column:
    low = F.translate(text.cast("string"), _UPPER, _LOWER)
    return F.regexp_extract_all(low, F.lit(f"({TERM})"), F.lit(1))


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, term): the distinct terms of each item; ``item`` names it, also where its id is null."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(terms_of(F.col("text"))).alias("term")).distinct()
    return rows.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "item_id", "term")


def share(asked: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The graph of term sets that items (item, term) share: atoms, pairs and ends, all written.

    atoms (item, term, node): the atom of each term. pairs (item, level, node,
    low, high): the nodes with two parts that an item uses. ends (item, node):
    the nodes whose sums make up the item.
    """
    spark = asked.sparkSession
    # Terms of the same items: as many items, and the same sum and exclusive or of two hashes of them.
    held = asked.groupBy("term").agg(F.count(F.lit(1)).alias("n_items"), F.sum(F.xxhash64("item").cast("decimal(38,0)")).alias("total"), F.bit_xor(F.xxhash64("item", F.lit(1))).alias("mixed"))
    named = held.select("term", "n_items", F.md5(F.concat_ws("|", "n_items", "total", "mixed")).alias("node"))
    atoms = materialize(asked.join(named, "term").select("item", "term", "n_items", "node"), "search-atoms")
    row = Window.partitionBy("item").orderBy("place")
    first = atoms.select("item", "node", "n_items").distinct()
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("n_items"), "node"))
    lists = materialize(first.select("item", "node", place.alias("place")), "search-lists")
    levels = []
    for level in range(rounds):
        follows = lists.select("item", "place", "node", F.lead("node").over(row).alias("next"))
        counted = follows.where("next is not null").groupBy("node", "next").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        told = follows.join(counted, ["node", "next"], "left").select("item", "place", "node", "next", F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.md5(F.concat("node", "next")).alias("tie")).alias("own"))
        none = F.struct(F.lit(0).cast("long").alias("n"), F.lit("").alias("tie"))
        before, after = F.coalesce(F.lag("own").over(row), none), F.coalesce(F.lead("own").over(row), none)
        taken = (F.col("own.n") > 1) & (F.col("own") > before) & (F.col("own") > after)
        tried = told.withColumn("taken", taken)
        useful = tried.where("taken").groupBy("node", "next").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
        tried = tried.join(useful, ["node", "next"], "left").withColumn("taken", F.col("taken") & F.col("times").isNotNull())
        gone = F.coalesce(F.lag("taken").over(row), F.lit(False))
        merged = F.when(F.col("taken"), F.col("own.tie")).otherwise(F.col("node"))
        now = tried.withColumn("gone", gone).where(~F.col("gone")).select("item", "place", merged.alias("node"), F.when(F.col("taken"), F.col("node")).alias("low"), F.when(F.col("taken"), F.col("next")).alias("high"))
        now = materialize(now, "search-lists")
        made = now.where("low is not null").select("item", F.lit(level).alias("level"), "node", "low", "high")
        if made.isEmpty():
            discard(now)
            break
        levels.append(now)
        lists = now
    ends = lists.select("item", "node")
    schema = "item string, level int, node string, low string, high string"
    pairs = spark.createDataFrame([], schema)
    for level, now in enumerate(levels):
        pairs = pairs.unionByName(now.where("low is not null").select("item", F.lit(level).alias("level"), "node", "low", "high"))
    return atoms, pairs, ends


def pack_documents(docs: DataFrame, asked: list[str] | None) -> DataFrame:
    """Rows of up to ``PACK`` documents that have a term: ids, lengths (terms with repeats), ends (of their entries), terms, tfs; only ``asked`` terms if given."""
    wanted = None if asked is None else frozenset(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        find = re.compile(TERM).findall
        ids, lengths, ends, terms, tfs = ([] for _ in range(5))

        def packed() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([x], pa.list_(k)) for x, k in zip((ids, lengths, ends, terms, tfs), kinds, strict=True)], ["ids", "lengths", "ends", "terms", "tfs"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = find(text.as_buffer().to_pybytes().lower().decode()) if text.is_valid else ()  # of bytes: A-Z only
                if not words:
                    continue
                counts = Counter(words)
                kept = list(counts) if wanted is None else [t for t in counts if t in wanted]
                terms += kept
                tfs += map(counts.__getitem__, kept)
                ids.append(doc_id)
                lengths.append(len(words))
                ends.append(len(terms))
                if len(ids) >= PACK or len(terms) >= 64 * PACK:
                    yield packed()
                    for x in (ids, lengths, ends, terms, tfs):
                        x.clear()
        if ids:
            yield packed()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "ids array<long>, lengths array<long>, ends array<long>, terms array<string>, tfs array<long>")


def _lists(rows: DataFrame, *names: str) -> DataFrame:
    """``names`` of the rows of each block as parallel arrays, in one order."""
    held = rows.groupBy("block").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("rows"))
    return held.select("block", *[F.col(f"rows.{n}").alias(n) for n in names])


def graph_blocks(asked: DataFrame, weights: DataFrame, items: int = ITEMS) -> DataFrame:
    """One row for each block of items: the graph of their term sets, with the weights of the terms (term, w)."""
    n_items = asked.select("item").distinct().count()
    block = F.pmod(F.xxhash64("item"), F.lit(max(1, -(-n_items // items)))).alias("block")
    atoms, pairs, ends = share(asked)
    leaves = atoms.select(block, "term", F.col("node").alias("atom")).distinct().join(weights, "term")
    joints = pairs.groupBy(block, "node", "low", "high").agg(F.min("level").alias("level"))
    named = ends.join(asked.select("item", "item_id").distinct(), "item").select(block, "item", "item_id", F.col("node").alias("end"))
    out = _lists(leaves, "term", "atom", "w").join(_lists(joints, "level", "node", "low", "high"), "block", "left")
    return out.join(_lists(named, "item", "item_id", "end"), "block")


class Graph:
    """A block of items in a task: nodes by number, each after its parts."""

    def __init__(self, row: dict[str, list]):
        self.terms = pa.array(row["term"], pa.string())
        self.weights = np.array(row["w"], np.int64)
        number: dict[str, int] = {}
        self.atom_of = np.array([number.setdefault(a, len(number)) for a in row["atom"]], np.int64)
        self.levels = []
        joints = list(zip(row["level"] or [], row["node"] or [], row["low"] or [], row["high"] or [], strict=True))
        made = {j[1] for j in joints}
        for node in [x for _, _, *parts in joints for x in parts] + row["end"]:
            if node not in made:
                number.setdefault(node, len(number))  # an atom of terms that no document has
        self.n_atoms = len(number)
        at = self.n_atoms
        for level in sorted({j[0] for j in joints}):
            own = [j for j in joints if j[0] == level]
            for k, (_, node, _, _) in enumerate(own):
                number[node] = at + k
            self.levels.append((at, np.array([number[j[2]] for j in own]), np.array([number[j[3]] for j in own])))
            at += len(own)
        self.size = at
        rows = sorted(zip(row["item"], row["item_id"], row["end"], strict=True), key=lambda r: r[0])
        self.ends = np.array([number[r[2]] for r in rows], np.int64)
        self.starts = np.array([i for i, r in enumerate(rows) if not i or rows[i - 1][0] != r[0]], np.int64)
        self.items = [rows[i][:2] for i in self.starts]
        self.found = [np.zeros((4, 0), np.int64)]  # item, score, doc_id, whether it has one
        self.least = np.ones(len(self.items), np.int64)

    def scores(self, doc: np.ndarray, atom: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
        """Scores (item, document), from the values of terms: every node is added up once."""
        sums = np.empty((self.size, n_docs), np.int64)
        sums[: self.n_atoms] = np.bincount(atom * n_docs + doc, value, self.n_atoms * n_docs).reshape(self.n_atoms, n_docs)  # sums below 2**53
        for at, low, high in self.levels:
            np.add(sums[low], sums[high], out=sums[at : at + len(low)])
        return np.add.reduceat(sums[self.ends], self.starts, axis=0)

    def keep(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray, best: int) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        self.found.append(np.stack([item, scores[item, doc], ids[doc], known[doc]]))
        if sum(f.shape[1] for f in self.found) > 4 * best * len(self.items):
            self.cut(best)

    def cut(self, best: int) -> np.ndarray:
        """What was found, cut to the best of each item."""
        all_found = np.concatenate(self.found, axis=1)
        item, score, doc, known = all_found
        order = np.lexsort((doc, 1 - known, -score, item))
        item = item[order]
        first = np.searchsorted(item, np.arange(len(self.items)))
        place = np.arange(len(item)) - first[item]
        last = np.flatnonzero(place == best - 1)
        self.least[item[last]] = all_found[1, order[last]]
        self.found = [all_found[:, order[place < best]]]
        return self.found[0]


def _ranked(n_docs: int, n_terms: int, best: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        graphs: dict[int, Graph] = {}
        names = ("term", "atom", "w", "level", "node", "low", "high", "item", "item_id", "end")
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for r in range(batch.num_rows):
                block = column["block"][r].as_py()
                if block not in graphs:
                    graphs[block] = Graph({n: column[n][r].as_py() for n in names})
                graph = graphs[block]
                ids = column["ids"][r].values
                known = np.asarray(ids.is_valid()).astype(np.int64)
                ids = np.asarray(ids.fill_null(0))
                lengths, ends, tfs = (np.asarray(column[n][r].values) for n in ("lengths", "ends", "tfs"))
                at = pc.index_in(column["terms"][r].values, value_set=graph.terms)
                here = np.asarray(at.is_valid())
                term, tf = np.asarray(at.fill_null(0))[here], tfs[here]
                doc = np.repeat(np.arange(len(ids)), np.diff(ends, prepend=0))[here]
                m = 50 + (50 * lengths * n_docs) // n_terms
                value = graph.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
                atom = graph.atom_of[term]
                step = max(1, min(512, CELLS // max(1, graph.size)))
                for a in range(0, len(ids), step):
                    b = min(a + step, len(ids))
                    own = slice(*np.searchsorted(doc, (a, b)))
                    graph.keep(graph.scores(doc[own] - a, atom[own], value[own], b - a), ids[a:b], known[a:b], best)
        for graph in graphs.values():
            item, score, doc, known = graph.cut(best)
            columns = [[graph.items[i][0] for i in item], [graph.items[i][1] for i in item], [d if k else None for d, k in zip(doc.tolist(), known.tolist(), strict=True)], score.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["item", "item_id", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """The ``best`` documents (item_id, rank, doc_id, score) of each item."""
    asked = materialize(item_terms(items), "search-asked")
    terms = asked.select("term").distinct()
    few = terms.count() <= MOST_ASKED
    packs = materialize(pack_documents(docs, [r[0] for r in terms.collect()] if few else None), "search-packs")
    n_docs, n_terms = packs.agg(F.sum(F.size("ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, n: s + n))).first()
    # Two numbers in doubles, as the score's formula has them.
    weight = F.floor(1000 * F.log(F.lit(2.0 * (n_docs or 0) + 2) / (2 * F.count(F.lit(1)) + 1))).cast("long")
    held = packs.select(F.explode("terms").alias("term")).groupBy("term").agg(weight.alias("w"))
    weights = materialize(held if few else held.join(terms, "term"), "search-weights")
    blocks = materialize(graph_blocks(asked, weights), "search-graph", weights)
    found = packs.crossJoin(blocks).mapInArrow(_ranked(n_docs or 0, max(1, n_terms or 0), best), "item string, item_id long, doc_id long, score long")  # a stated set of queries, in blocks
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    out = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select("item_id", "rank", "doc_id", "score")
    return materialize(out, "search-found", packs, blocks, asked)


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
parts AS (
  SELECT a.item_id, tf.doc_id,
         CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT)
         * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS part
  FROM asked a JOIN tf USING (term) JOIN df USING (term) JOIN sizes ON sizes.doc_id = tf.doc_id CROSS JOIN total
),
scored AS (SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM parts GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

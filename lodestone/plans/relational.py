"""Queries of scans, functions, checked joins, set operations, samples and profiles, with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import composed, flattened, passage_text, tokenize
from ..operators import checks, dense, evaluation, lexical, split
from ..sources.tables import appended, head, number, row_counts, table, with_row_index
from .queries import TOK, query, r6

TABLES = {"customer": 5, "part": 6, "orders": 6, "lineitem": 11, "supplier": 4, "documents": 5, "events": 6, "embeddings": 3, "benchmark": 2, "labels": 3}


@query(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n_rows, CAST({n} AS BIGINT) AS n_columns FROM {t}" for t, n in TABLES.items()))
def table_counts(spark, d):
    return row_counts(spark, d, list(TABLES))


@query("SELECT doc_id, concat_ws(chr(10), CASE WHEN trim(source) <> '' THEN trim(source) END, CASE WHEN trim(lang) <> '' THEN trim(lang) END, CASE WHEN trim(text) <> '' THEN trim(text) END) AS passage FROM documents")
def passage_texts(spark, d):
    """What an encoder is given of each document: the fields that aren't blank, whole, a line each."""
    return table(spark, d, "documents").select("doc_id", passage_text(F.col("source"), F.col("lang"), F.col("text")).alias("passage"))


@query(f"SELECT term, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM (SELECT doc_id, unnest({TOK.format('text')}) AS term FROM documents) GROUP BY term")
def stem_counts(spark, d):
    """Occurrences and documents of each stem of the composed texts."""
    docs = composed(table(spark, d, "documents").select("doc_id", "text"), "text")
    tf = lexical.term_counts(docs, "doc_id", tokenize(F.col("text")))
    return tf.groupBy("term").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("n_docs"))


@query(r"""
SELECT count(*) AS n, count(DISTINCT t) AS n_distinct, CAST(sum(length(t)) AS BIGINT) AS n_chars FROM (
  SELECT regexp_replace(regexp_replace(replace(lower(coalesce(text, '')), 'ё', 'е'), '\s+', ' ', 'g'), '^ | $', '', 'g') AS t FROM documents)""")
def flat_texts(spark, d):
    flat = table(spark, d, "documents").select(flattened(F.col("text")).alias("t"))
    return flat.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("t").alias("n_distinct"), F.sum(F.length("t")).cast("long").alias("n_chars"))


@query("SELECT event_id, TRY_CAST(substr(props, 7, 2) AS DOUBLE) AS number, TRY_CAST(event_type AS DOUBLE) AS word FROM events")
def coerced_numbers(spark, d):
    return table(spark, d, "events").select("event_id", number(F.substring("props", 7, 2)).alias("number"), number(F.col("event_type")).alias("word"))


@query("SELECT c_custkey, to_json({'name': c_name, 'segment': c_mktsegment, 'nation': c_nationkey}) AS said FROM customer")
def json_rows(spark, d):
    said = F.to_json(F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")))
    return table(spark, d, "customer").select("c_custkey", said.alias("said"))


@query("""
SELECT vec_id, round(list_sum(p), 4) AS total, round(list_inner_product(p, p), 4) AS square FROM (
  SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN list_transform(v, lambda x: 0.0) WHEN vec_id % 3 = 1 THEN v ELSE list_transform(list_zip(v, list_reverse(v)), lambda t: (t[1] + t[2]) / 2) END AS p
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings))""")
def pooled_vectors(spark, d):
    """Mean of two token vectors under masks of none, one and both."""
    e = table(spark, d, "embeddings")
    mask = F.array((F.col("vec_id") % 3 > 0).cast("int"), (F.col("vec_id") % 3 == 2).cast("int"))
    p = e.select("vec_id", dense.mean_pool(F.array("embedding", F.reverse("embedding")), mask).alias("p"))
    return p.select("vec_id", F.round(F.aggregate("p", F.lit(0.0), lambda s, x: s + x), 4).alias("total"), F.round(dense.dot(F.col("p"), F.col("p")), 4).alias("square"))


@query("SELECT vec_id, round(sqrt(list_inner_product(u, u)), 6) AS length, round(u[1], 6) AS first FROM (SELECT vec_id, list_transform(v, lambda x: x * 3 / (3 * sqrt(list_inner_product(v, v)))) AS u FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings))")
def unit_vectors(spark, d):
    tripled = F.transform("embedding", lambda x: x.cast("double") * 3)
    u = table(spark, d, "embeddings").select("vec_id", dense.unit(tripled).alias("u"))
    return u.select("vec_id", r6(F.sqrt(dense.dot(F.col("u"), F.col("u")))).alias("length"), r6(F.col("u")[0]).alias("first"))


@query("SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment")
def orders_of_segments(spark, d):
    """Any number of orders to one customer each, which is checked."""
    one = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    met = checks.many_to_one(table(spark, d, "orders").select("o_custkey", "o_totalprice"), one, ["o_custkey"])
    return met.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT a.o_custkey AS o_custkey, a.n AS n, b.top AS top FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) a JOIN (SELECT o_custkey, max(o_totalprice) AS top FROM orders GROUP BY 1) b ON a.o_custkey = b.o_custkey")
def paired_reports(spark, d):
    """Two reports of the same customers, one row to one."""
    o = table(spark, d, "orders").groupBy("o_custkey")
    return checks.one_to_one(o.agg(F.count(F.lit(1)).alias("n")), o.agg(F.max("o_totalprice").alias("top")), ["o_custkey"], whole=True)


@query("SELECT c_custkey, s_suppkey FROM (SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS a FROM customer) JOIN (SELECT s_suppkey, CAST(s_nationkey AS VARCHAR) AS b FROM supplier WHERE s_suppkey % 20 = 0) ON a = CAST(b AS DOUBLE)")
def same_places(spark, d):
    """Customers (nation as a floating number) at the places (nation as text) of the suppliers asked about, every twentieth."""
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("double").alias("a"))
    s = table(spark, d, "supplier").where("s_suppkey % 20 = 0").select("s_suppkey", F.col("s_nationkey").cast("string").alias("b"))
    key = lambda x: x.cast("double").cast("long")
    met = c.withColumn("k", key(F.col("a"))).join(s.withColumn("k", key(F.col("b"))), "k")
    return met.where(lexical.same_place(F.col("a"), F.col("b"))).select("c_custkey", "s_suppkey")


@query("""
SELECT qid, CASE WHEN bool_and(seen) THEN 'all_seen' WHEN bool_or(seen) THEN 'mixed' ELSE 'all_unseen' END AS seen_item_group
FROM (SELECT l_orderkey AS qid, l_partkey IN (SELECT p_partkey FROM part WHERE p_size % 3 = 0) AS seen FROM lineitem) GROUP BY qid""")
def seen_labels(spark, d):
    known = table(spark, d, "part").where("p_size % 3 = 0").select(F.col("p_partkey").alias("l_partkey"), F.lit(True).alias("seen_item"))
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("qid"), "l_partkey").join(known, "l_partkey", "left")
    return evaluation.seen_groups(rows.withColumn("seen_item", F.coalesce("seen_item", F.lit(False))))


@query("SELECT o_orderkey, o_totalprice FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS row_idx FROM orders) WHERE row_idx < (SELECT count(*) // 2 FROM orders)")
def first_half(spark, d):
    """The first half of the positions, found without a sort of all rows in one task."""
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return head(with_row_index(o, "o_totalprice", "o_orderkey"), o.count() // 2).drop("row_idx")


@query("SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || '|7'), 1, 8) AS BIGINT), c_custkey) AS place FROM customer) WHERE place <= 100")
def drawn_sample(spark, d):
    """100 rows without replacement, a sampling operator."""
    return split.sample(table(spark, d, "customer").select("c_custkey"), 100, "c_custkey", seed=7)


@query("""
WITH own AS (SELECT p_partkey AS item_id, row_number() OVER (ORDER BY p_partkey) - 1 AS row_idx FROM part WHERE p_size > 10),
extra AS (SELECT DISTINCT l_partkey AS item_id FROM lineitem WHERE l_partkey NOT IN (SELECT item_id FROM own))
SELECT item_id, row_idx FROM own UNION ALL SELECT item_id, (SELECT count(*) FROM own) + row_number() OVER (ORDER BY item_id) - 1 FROM extra""")
def appended_corpus(spark, d):
    """A corpus and, behind it, the items of a log that it lacks."""
    own = with_row_index(table(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("item_id")), "item_id")
    return appended(own, table(spark, d, "lineitem").select(F.col("l_partkey").alias("item_id")), "item_id")


@query("SELECT o_orderstatus, avg_price, part FROM (SELECT o_orderstatus, round(avg(o_totalprice), 4) AS avg_price, 'urgent' AS part FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1 UNION ALL SELECT o_orderstatus, round(avg(o_totalprice), 4), 'other' FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1)")
def tagged_union(spark, d):
    o = table(spark, d, "orders")
    mean = lambda rows: rows.groupBy("o_orderstatus").agg(F.round(F.avg("o_totalprice"), 4).alias("avg_price"))
    return evaluation.tagged({"urgent": mean(o.where("o_orderpriority = '1-URGENT'")), "other": mean(o.where("o_orderpriority <> '1-URGENT'"))}, "part")


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10")
def most_frequent(spark, d):
    """The ten most frequent customers, a top-k report."""
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "o_custkey").limit(10)


QUANTILES = (0.0, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0)


@query(f"SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS sd, {', '.join(f'round(quantile_cont(o_totalprice, {q}), 4) AS q{round(q * 100)}' for q in QUANTILES)} FROM orders GROUP BY o_orderstatus")
def price_quantiles(spark, d):
    o = table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean"), F.round(F.stddev_samp("o_totalprice"), 4).alias("sd"), F.percentile("o_totalprice", list(QUANTILES)).alias("q"))
    return o.select("o_orderstatus", "n", "mean", "sd", *[F.round(F.col("q")[i], 4).alias(f"q{round(q * 100)}") for i, q in enumerate(QUANTILES)])


@query("SELECT count(*) AS n, CAST(sum(CAST('0x' || substr(h, 1, 12) AS BIGINT)) AS BIGINT) AS total, bit_xor(CAST('0x' || substr(h, 13, 15) AS BIGINT)) AS x FROM (SELECT sha256(CAST(doc_id AS VARCHAR) || ':' || text) AS h FROM documents)")
def corpus_digest(spark, d):
    """Digests of all rows in any order, with their sum: rows that repeat count as often as they stand.

    The sum is one of 64 bits that starts again at the other end (from some
    65,000 rows on; there the SQL has no result).
    """
    h = table(spark, d, "documents").select(F.sha2(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("text")), 256).alias("h"))
    part = lambda i, n: F.conv(F.substring("h", i, n), 16, 10).cast("long")
    turn = F.lit(str(2**64)).cast("decimal(20,0)")
    rest = F.sum(part(1, 12).cast("decimal(20,0)")) % turn
    total = F.when(rest < turn / 2, rest).otherwise(rest - turn).cast("long")
    return h.agg(F.count(F.lit(1)).alias("n"), total.alias("total"), F.bit_xor(part(13, 15)).alias("x"))


@query("SELECT count(*) FILTER (WHERE len(embedding) <> 63) AS wrong_size, count(*) FILTER (WHERE list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: CASE WHEN isfinite(x / (CASE WHEN vec_id % 7 = 0 THEN 0.0 ELSE 1.0 END)) THEN 0 ELSE 1 END)) > 0) AS not_finite, count(*) AS n_vectors FROM embeddings")
def unsound_vectors(spark, d):
    """The vector checks on a table where every seventh vector is infinite and the size is another than said."""
    from ..sources.tables import check_vectors

    e = table(spark, d, "embeddings")
    spoiled = e.withColumn("embedding", F.transform("embedding", lambda x: F.when(F.col("vec_id") % 7 == 0, F.lit(float("inf"))).otherwise(x.cast("double"))))
    return check_vectors(spoiled, 63).select("wrong_size", "not_finite", "n_vectors")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey LEFT JOIN (SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F') h ON h.o_custkey = o.o_custkey AND h.o_orderkey = l_orderkey WHERE h.o_orderkey IS NULL GROUP BY 1, 2")
def hidden_by_two_keys(spark, d):
    """Lines whose (customer, order) isn't hidden: an anti join on both keys."""
    o = table(spark, d, "orders")
    lines = table(spark, d, "lineitem").join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    hidden = o.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return split.hide(lines, hidden, ["o_custkey", "l_orderkey"]).groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))

"""Projections, filters, joins, top-k, sampling, indexing and set operations."""

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tidewright.catalog import query
from tidewright.functions.columns import day_key, on_calendar_day
from tidewright.operators import relational as rel
from tidewright.operators.aggregates import word_counts, word_rows

# ---- projections ----------------------------------------------------------------------


@query("prj_01_element_map", "SELECT p_partkey, p_size * 2 AS doubled FROM part")
def _(spark, t):
    return t.part.select("p_partkey", (F.col("p_size") * 2).alias("doubled"))


@query("prj_02_select_alias", """
SELECT l_returnflag AS flag, round(avg(l_quantity), 6) AS avg_qty, max(l_tax) AS top_tax
FROM lineitem GROUP BY l_returnflag""")
def _(spark, t):
    a = t.lineitem.groupBy("l_returnflag").agg({"l_quantity": "avg", "l_tax": "max"})
    return a.select(a["l_returnflag"].alias("flag"),
                    F.round(a["avg(l_quantity)"], 6).alias("avg_qty"),
                    a["max(l_tax)"].alias("top_tax"))


@query("prj_03_cast_columns", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS qty,
       CAST(l_partkey AS VARCHAR) AS part_text, CAST(l_linenumber AS DOUBLE) AS line_value
FROM lineitem""")
def _(spark, t):
    return (t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey")
            .withColumn("qty", F.col("l_quantity").cast("int"))
            .withColumn("part_text", F.col("l_partkey").cast("string"))
            .withColumn("line_value", F.col("l_linenumber").cast("double"))
            .drop("l_quantity", "l_partkey"))


@query("prj_04_flat_map_words", """
SELECT doc_id, count(*) AS n_words, CAST(sum(length(w)) AS BIGINT) AS n_letters
FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '[ \\r\\n]')) AS w FROM documents)
WHERE regexp_matches(w, '[^ \\t\\n\\f\\r]') GROUP BY doc_id""")
def _(spark, t):
    w = word_rows(t.documents, keep=["doc_id"])
    return w.groupBy("doc_id").agg(F.count("*").alias("n_words"),
                                   F.sum(F.length("word")).alias("n_letters"))


@query("prj_05_flat_map_to_pairs", """
WITH deg AS (SELECT l_orderkey, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
             GROUP BY l_orderkey)
SELECT l_suppkey AS dst, round(sum(1.0 / n), 6) AS received
FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) JOIN deg USING (l_orderkey)
GROUP BY l_suppkey""")
def _(spark, t):
    # Each order shares one unit equally between its suppliers.
    links = t.lineitem.select("l_orderkey", "l_suppkey").distinct()
    degree = links.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return (links.join(degree, "l_orderkey").groupBy(F.col("l_suppkey").alias("dst"))
            .agg(F.round(F.sum(1.0 / F.col("n")), 6).alias("received")))


@query("prj_06_key_value_swap", """
SELECT o_orderstatus AS v, o_custkey AS k, CAST(o_totalprice AS DOUBLE) * 2 AS mapped FROM orders""")
def _(spark, t):
    pairs = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("v"),
                            "o_totalprice")
    return pairs.select("v", "k", (F.col("o_totalprice") * 2).alias("mapped"))


@query("prj_07_sql_projection", """
SELECT l_orderkey, l_linenumber, l_quantity + l_tax AS v3, l_quantity * l_tax AS v4 FROM lineitem""")
def _(spark, t):
    step = SQLTransformer(statement="SELECT l_orderkey, l_linenumber, (l_quantity + l_tax) AS v3, "
                                    "(l_quantity * l_tax) AS v4 FROM __THIS__")
    return step.transform(t.lineitem)


@query("prj_08_parameterised_sql", """
SELECT event_id, value FROM events WHERE user_id = 7 AND event_type = 'click'""")
def _(spark, t):
    return spark.sql("SELECT event_id, value FROM {flights} "
                     "WHERE user_id = :airport AND event_type = :carrier",
                     args={"airport": 7, "carrier": "click"}, flights=t.events)


# ---- filters --------------------------------------------------------------------------


@query("flt_01_sql_text_filter", """
SELECT p_partkey, p_size, p_type FROM part
WHERE (p_size = 1 OR p_size = 2 OR p_size = 3) AND p_type <> 'ECONOMY'""")
def _(spark, t):
    return (t.part.filter("(p_size = 1 OR p_size = 2 OR p_size = 3) AND p_type <> 'ECONOMY'")
            .select("p_partkey", "p_size", "p_type"))


@query("flt_02_condition_filter", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
WHERE l_extendedprice > 0 AND l_quantity > 0 AND l_returnflag = 'N'""")
def _(spark, t):
    return (t.lineitem.filter((F.col("l_extendedprice") > 0) & (F.col("l_quantity") > 0)
                              & (F.col("l_returnflag") == "N"))
            .select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"))


@query("flt_03_contains", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')")
def _(spark, t):
    return t.part.filter(F.col("p_name").contains("ring")).select("p_partkey", "p_name")


@query("flt_04_equal_to", """
SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def _(spark, t):
    return t.customer.filter(F.col("c_mktsegment") == "MACHINERY").select("c_custkey", "c_name")


@query("flt_05_threshold_after_group", """
SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey HAVING count(*) >= 25""")
def _(spark, t):
    return (t.lineitem.groupBy("l_partkey").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= 25))


@query("flt_06_rows_at_max", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)""")
def _(spark, t):
    return rel.rows_at_max(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice")


@query("flt_07_rows_of_calendar_day", """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
WHERE month(o_orderdate) = 7 AND day(o_orderdate) = 4""")
def _(spark, t):
    return (t.orders.filter(on_calendar_day(F.col("o_orderdate"), 7, 4))
            .select("o_orderkey", "o_custkey", day_key(F.col("o_orderdate")).alias("day")))


# ---- joins ----------------------------------------------------------------------------


@query("jn_01_inner_join", """
SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(spark, t):
    o, c = t.orders, t.customer
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name", "o_totalprice")


RATINGS_SQL = """ratings AS (
SELECT o_custkey AS user, l_partkey AS item, avg(l_quantity) AS rating, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_partkey)"""


def ratings(t):
    """Mean quantity bought, as the rating of an item by a user."""
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user"))
    return (t.lineitem.select("l_orderkey", F.col("l_partkey").alias("item"), "l_quantity")
            .join(o, "l_orderkey").groupBy("user", "item")
            .agg(F.avg("l_quantity").alias("rating"), F.count("*").alias("n")))


@query("jn_02_composite_key_join", """
WITH a AS (SELECT l_orderkey, l_linenumber, sum(l_quantity) AS qty FROM lineitem GROUP BY ALL),
     b AS (SELECT l_orderkey, l_linenumber, max(l_discount) AS disc FROM lineitem
           WHERE l_returnflag = 'R' GROUP BY ALL)
SELECT a.l_orderkey, a.l_linenumber, qty, disc FROM a
JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber""")
def _(spark, t):
    key = ["l_orderkey", "l_linenumber"]
    a = t.lineitem.groupBy(*key).agg(F.sum("l_quantity").alias("qty"))
    b = (t.lineitem.filter("l_returnflag = 'R'").groupBy(*key)
         .agg(F.max("l_discount").alias("disc")))
    return a.join(b, key)


@query("jn_03_using_join", """
SELECT n_regionkey AS regionkey, n_nationkey, n_name, r_name
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def _(spark, t):
    n = t.nation.withColumnRenamed("n_regionkey", "regionkey")
    return n.join(t.region.withColumnRenamed("r_regionkey", "regionkey"), "regionkey")


@query("jn_04_three_way_join", """
WITH a AS (SELECT l_partkey, count(*) AS n, avg(l_quantity) AS q FROM lineitem GROUP BY l_partkey)
SELECT p_partkey, p_name, n, round(q, 6) AS avg_qty, sold.suppliers FROM part
JOIN a ON p_partkey = a.l_partkey
JOIN (SELECT l_partkey, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY l_partkey) sold
  ON p_partkey = sold.l_partkey""")
def _(spark, t):
    # Both views of the lines group by the same key: one pass sums per supplier first, which also counts them.
    per_supplier = t.lineitem.withColumnRenamed("l_partkey", "p_partkey").groupBy("p_partkey", "l_suppkey").agg(
        F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), F.count("l_quantity").alias("m"))
    rated = per_supplier.groupBy("p_partkey").agg(
        F.sum("n").alias("n"), (F.sum("qty") / F.sum("m")).alias("q"), F.count("l_suppkey").alias("suppliers"))
    return (rated.join(t.part.select("p_partkey", "p_name"), "p_partkey")
            .select("p_partkey", "p_name", "n", F.round("q", 6).alias("avg_qty"), "suppliers"))


@query("jn_05_self_join_on_reversed_edges", """
WITH edge AS (SELECT p_partkey AS src, p_partkey // 2 AS dst FROM part WHERE p_partkey > 0)
SELECT a.src, b.dst FROM edge a JOIN edge b ON a.dst = b.src""")
def _(spark, t):
    edge = part_tree(t)
    a, b = edge.alias("a"), edge.alias("b")
    return a.join(b, F.col("a.dst") == F.col("b.src")).select("a.src", "b.dst")


def part_tree(t):
    """Edges from each part to the part of half its number."""
    return t.part.filter("p_partkey > 0").select(
        F.col("p_partkey").alias("src"), F.floor(F.col("p_partkey") / 2).alias("dst"))


@query("jn_06_anti_join", """
SELECT p_partkey FROM part WHERE p_partkey NOT IN
 (SELECT l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey = 1)""")
def _(spark, t):
    o = t.orders.filter("o_custkey = 1").select(F.col("o_orderkey").alias("l_orderkey"))
    bought = t.lineitem.join(o, "l_orderkey").select(F.col("l_partkey").alias("p_partkey"))
    return rel.not_in(t.part.select("p_partkey"), bought, ["p_partkey"])


@query("jn_07_lookup_with_default", """
WITH dim AS (SELECT s_suppkey, s_acctbal, s_nationkey FROM supplier WHERE s_acctbal > 5000)
SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(s_acctbal, 0.0) AS s_acctbal,
       coalesce(s_nationkey, 0) AS s_nationkey
FROM lineitem LEFT JOIN dim ON l_suppkey = s_suppkey""")
def _(spark, t):
    dim = t.supplier.filter("s_acctbal > 5000").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_acctbal", "s_nationkey")
    return rel.lookup(t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey"), dim,
                      "l_suppkey", {"s_acctbal": 0.0, "s_nationkey": 0})


@query("jn_08_lookup_by_date_text", """
WITH daily AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, sum(l_extendedprice) AS price_sum,
                      count(*) AS lines FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_linenumber, l_partkey, day, round(price_sum, 2) AS price_sum, lines
FROM lineitem JOIN daily ON strftime(l_shipdate, '%Y-%m-%d') = day""")
def _(spark, t):
    # The parts of the mean, not the mean: a sum of cents rounds alike in any order of adding,
    # while a mean may lie on the border between two roundings.
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
                           day_key(F.col("l_shipdate")).alias("day"))
    daily = li.groupBy("day").agg(F.sum("l_extendedprice").alias("price_sum"), F.count("*").alias("lines"))
    return li.join(daily, "day").select("l_orderkey", "l_linenumber", "l_partkey", "day",
                                        F.round("price_sum", 2).alias("price_sum"), "lines")


@query("jn_10_left_join_scores", """
WITH s AS (SELECT l_partkey, avg(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey)
SELECT p_partkey, p_name, round(q, 6) AS score FROM part LEFT JOIN s ON p_partkey = l_partkey
WHERE contains(p_name, 'widget')""")
def _(spark, t):
    scores = (t.lineitem.filter("l_returnflag = 'R'")
              .groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.avg("l_quantity").alias("q")))
    hits = t.part.filter(F.col("p_name").contains("widget")).select("p_partkey", "p_name")
    return hits.join(scores, "p_partkey", "left").select(
        "p_partkey", "p_name", F.round("q", 6).alias("score"))


# ---- sort, top-k ----------------------------------------------------------------------


@query("srt_01_sorted_head", """
SELECT w AS word, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(text, '[ \\r\\n]')) AS w FROM documents)
WHERE regexp_matches(w, '[^ \\t\\n\\f\\r]') GROUP BY w ORDER BY n DESC, word LIMIT 10""")
def _(spark, t):
    return rel.top_n(word_counts(t.documents), 10, F.desc("n"), F.asc("word"))


@query("srt_02_top_25_by_comparator", """
SELECT l_partkey, round(avg(l_quantity), 6) AS rating, count(*) AS n FROM lineitem
GROUP BY l_partkey ORDER BY rating DESC, l_partkey LIMIT 25""")
def _(spark, t):
    rated = t.lineitem.groupBy("l_partkey").agg(
        F.round(F.avg("l_quantity"), 6).alias("rating"), F.count("*").alias("n"))
    return rel.top_n(rated, 25, F.desc("rating"), F.asc("l_partkey"))


@query("srt_03_take", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def _(spark, t):
    return rel.top_n(t.orders.select("o_orderkey", "o_totalprice"), 5, F.asc("o_orderkey"))


@query("srt_04_top_n_for_every_user", f"""
WITH {RATINGS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY user ORDER BY rating DESC, item) AS rank FROM ratings)
SELECT user, item, round(rating, 6) AS rating, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""")
def _(spark, t):
    best = rel.top_n_each(ratings(t), 10, ["user"], F.desc("rating"), F.asc("item"))
    return best.select("user", "item", F.round("rating", 6).alias("rating"), "rank")


# ---- sampling, indexing ---------------------------------------------------------------


@query("smp_01_random_split", """
SELECT count(*) AS n_rows, count(*) AS in_parts, CAST(0 AS BIGINT) AS in_two_parts,
       TRUE AS shares_near_weights FROM orders""")
def _(spark, t):
    parts = rel.key_split(t.orders, ["o_orderkey"], [0.6, 0.2, 0.2], seed=5)
    tagged = None
    for i, p in enumerate(parts):
        p = p.select("o_orderkey", F.lit(i).alias("part"))
        tagged = p if tagged is None else tagged.union(p)
    per_key = tagged.groupBy("o_orderkey").agg(F.count_distinct("part").alias("places"),
                                               F.min("part").alias("part"))
    joined = t.orders.select("o_orderkey").join(per_key, "o_orderkey", "left")
    return joined.agg(F.count("*").alias("n_rows"), F.count("places").alias("in_parts"),
                      F.count_if(F.col("places") > 1).alias("in_two_parts"),
                      (F.abs(F.avg(F.when(F.col("part") == 0, 1.0).otherwise(0.0)) - 0.6) < 0.05)
                      .alias("shares_near_weights"))


@query("smp_02_sample_fraction", """
SELECT TRUE AS size_near_tenth, CAST(0 AS BIGINT) AS not_in_table, count(*) AS n_rows FROM lineitem""")
def _(spark, t):
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    picked = t.lineitem.sample(False, 0.1, seed=3).select(*key)
    strange = picked.join(t.lineitem.select(*key).distinct(), key, "left_anti").agg(
        F.count("*").alias("not_in_table"))
    n = t.lineitem.agg(F.count("*").alias("n_rows"))
    share = picked.agg(F.count("*").alias("k"))
    return n.select("n_rows", (F.abs(share.scalar() / F.col("n_rows") - 0.1) < 0.01)
                    .alias("size_near_tenth"), strange.scalar().alias("not_in_table"))


@query("smp_03_take_exact_sample", """
SELECT 'without' AS kind, CAST(100 AS BIGINT) AS n, CAST(100 AS BIGINT) AS n_known, TRUE AS unique_rows
UNION ALL SELECT 'with', 20000, 20000, FALSE""")
def _(spark, t):
    orders = t.orders.select("o_orderkey", "o_custkey")
    kinds = {"without": rel.take_sample(orders, 100, seed=7, key=["o_orderkey"]),
             "with": rel.take_sample(orders, 20000, True, seed=7, key=["o_orderkey"])}
    out = None
    for kind, s in kinds.items():
        known = s.join(orders.select("o_orderkey"), "o_orderkey", "left_semi")
        row = s.agg(F.count("*").alias("n"),
                    (F.count("*") == F.count_distinct("o_orderkey")).alias("unique_rows")).select(
            F.lit(kind).alias("kind"), "n", known.agg(F.count("*")).scalar().alias("n_known"),
            "unique_rows")
        out = row if out is None else out.unionByName(row)
    return out


@query("idx_01_dense_index", """
SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS index, n_chars FROM documents""")
def _(spark, t):
    return rel.dense_index(t.documents.select("doc_id", "n_chars"), F.asc("doc_id")).select(
        "doc_id", F.col("index").cast("bigint").alias("index"), "n_chars")


# ---- sets -----------------------------------------------------------------------------


@query("set_01_union_all", """
SELECT c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
UNION ALL SELECT s_nationkey, s_acctbal FROM supplier""")
def _(spark, t):
    c = t.customer.select(F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"))
    s = t.supplier.select(F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nationkey"))
    return c.unionByName(s)


@query("set_02_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def _(spark, t):
    return t.lineitem.select("l_partkey", "l_suppkey").distinct()


@query("set_03_bag_subtract", """
SELECT l_suppkey, l_quantity FROM lineitem a WHERE l_returnflag = 'R' AND NOT EXISTS
 (SELECT 1 FROM lineitem b WHERE b.l_returnflag = 'A'
  AND a.l_suppkey IS NOT DISTINCT FROM b.l_suppkey AND a.l_quantity IS NOT DISTINCT FROM b.l_quantity)""")
def _(spark, t):
    cols = ["l_suppkey", "l_quantity"]
    return rel.bag_subtract(t.lineitem.filter("l_returnflag = 'R'").select(*cols),
                            t.lineitem.filter("l_returnflag = 'A'").select(*cols).distinct())

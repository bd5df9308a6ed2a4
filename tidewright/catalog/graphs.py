"""Graph iteration and gradient descent."""

from pyspark.sql import functions as F

from tidewright.catalog import query
from tidewright.catalog.relational import part_tree
from tidewright.operators import graphs

ROUNDS = 10

LINKS_SQL = """links AS MATERIALIZED (
 SELECT DISTINCT 'c' || o_custkey AS src, 's' || l_suppkey AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 UNION SELECT DISTINCT 's' || l_suppkey, 'c' || o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 WHERE l_returnflag = 'R'),
deg AS MATERIALIZED (SELECT src, count(*) AS d FROM links GROUP BY src),
r0 AS (SELECT src AS node, 1.0::DOUBLE AS rank FROM deg)"""


def trade_links(t):
    """Customers link to their suppliers, suppliers to the customers who returned something."""
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    pairs = t.lineitem.select("l_orderkey", "l_suppkey", "l_returnflag").join(o, "l_orderkey").select(
        F.concat(F.lit("c"), "o_custkey").alias("c"), F.concat(F.lit("s"), "l_suppkey").alias("s"), "l_returnflag")
    back = pairs.filter("l_returnflag = 'R'").select(F.col("s").alias("src"), F.col("c").alias("dst"))
    return pairs.select(F.col("c").alias("src"), F.col("s").alias("dst")).union(back)


def rank_sql(rounds):
    steps = ",\n".join(
        f"r{i} AS MATERIALIZED (SELECT dst AS node, 0.15 + 0.85 * sum(rank / d) AS rank FROM links "
        f"JOIN deg USING (src) JOIN r{i - 1} ON r{i - 1}.node = links.src GROUP BY dst)"
        for i in range(1, rounds + 1))
    return f"WITH {LINKS_SQL},\n{steps}\nSELECT node, round(rank, 6) AS rank FROM r{rounds}"


@query("gr_01_page_rank", rank_sql(ROUNDS))
def _(spark, t):
    return graphs.page_rank(trade_links(t), ROUNDS).withColumn("rank", F.round("rank", 6))


@query("gr_02_transitive_closure", """
WITH RECURSIVE edge AS (SELECT p_partkey AS src, p_partkey // 2 AS dst FROM part WHERE p_partkey > 0),
path AS (SELECT src, dst FROM edge UNION SELECT path.src, edge.dst FROM path JOIN edge ON path.dst = edge.src)
SELECT src, dst FROM path""")
def _(spark, t):
    return graphs.transitive_closure(part_tree(t))


WIDTH, STEP = 64, 0.1


def descent_sql():
    dims = range(1, WIDTH + 1)
    dot = " + ".join(f"a{i} * x{i}" for i in dims)
    ctes = ["pts AS MATERIALIZED (SELECT CASE WHEN label < 5 THEN 1.0 ELSE -1.0 END::DOUBLE AS y, "
            + ", ".join(f"embedding[{i}]::DOUBLE AS x{i}" for i in dims) + " FROM embeddings)",
            "w0 AS (SELECT " + ", ".join(f"{i / 10}::DOUBLE AS a{i}" for i in dims) + ")"]
    for k in range(1, ROUNDS + 1):
        cols = ", ".join(f"any_value(a{i}) - {STEP} * sum((1 / (1 + exp(-y * ({dot}))) - 1) * y * x{i}) AS a{i}"
                         for i in dims)
        ctes.append(f"w{k} AS MATERIALIZED (SELECT {cols} FROM pts, w{k - 1})")
    rows = " UNION ALL ".join(f"SELECT {i - 1} AS pos, round(a{i}, 6) AS weight FROM w{ROUNDS}" for i in dims)
    return "WITH " + ",\n".join(ctes) + "\n" + rows


@query("gr_03_logistic_gradient_descent", descent_sql())
def _(spark, t):
    points = t.embeddings.select(
        F.when(F.col("label") < 5, 1.0).otherwise(-1.0).alias("y"),
        F.col("embedding").cast("array<double>").alias("x"))
    w = graphs.logistic_descent(points, [i / 10 for i in range(1, WIDTH + 1)], ROUNDS, STEP)
    return spark.createDataFrame(list(enumerate(w)), "pos int, weight double").withColumn(
        "weight", F.round("weight", 6))

"""Frequent patterns and matrix factors."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewright.catalog import query
from tidewright.catalog.features import vectors
from tidewright.operators import algebra, patterns
from tidewright.operators.features import assemble, principal_components

BASKET_SQL = """b AS (SELECT l_orderkey, list_sort(list_distinct(list(p_brand))) AS items FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
sets AS (SELECT items, count(*) AS f FROM (SELECT list_filter(items, lambda x, i: (m >> (i - 1)) & 1 = 1) AS items
  FROM (SELECT items, unnest(range(1, CAST(2 ** len(items) AS BIGINT))) AS m FROM b))
  GROUP BY items HAVING count(*) >= ceil(0.002 * (SELECT count(*) FROM b)))"""


def brand_baskets(t):
    """Brands of each order; there are few brands, so a basket stays small."""
    brands = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return patterns.baskets(t.lineitem.select("l_orderkey", "l_partkey").join(brands, "l_partkey"),
                            "l_orderkey", "p_brand")


@query("fp_01_frequent_sets", f"""
WITH {BASKET_SQL} SELECT array_to_string(items, ',') AS items, f AS freq FROM sets""")
def _(spark, t):
    model = patterns.frequent_sets(brand_baskets(t), support=0.002)
    return model.freqItemsets.select(F.array_join(F.array_sort("items"), ",").alias("items"), "freq")


RULES_SQL = f"""
WITH {BASKET_SQL}, r AS (SELECT list_filter(items, lambda x: x <> y) AS a, y, f FROM (SELECT items, f, unnest(items) AS y FROM sets WHERE len(items) > 1))
SELECT array_to_string(a, ',') AS antecedent, y AS consequent, round(r.f / sets.f, 6) AS confidence FROM r JOIN sets ON a = sets.items WHERE r.f / sets.f >= 0.12"""


@query("fp_02_association_rules", RULES_SQL)
def _(spark, t):
    model = patterns.frequent_sets(brand_baskets(t), support=0.002, confidence=0.12)
    return model.associationRules.select(
        F.array_join(F.array_sort("antecedent"), ",").alias("antecedent"), F.array_join("consequent", ",").alias("consequent"),
        F.round("confidence", 6).alias("confidence"))


@query("fp_02b_rules_from_saved_sets", RULES_SQL)
def _(spark, t):
    sets = patterns.frequent_sets(brand_baskets(t), support=0.002).freqItemsets
    return patterns.rules_from_sets(sets, 0.12).select(
        F.array_join("antecedent", ",").alias("antecedent"), "consequent", F.round("confidence", 6).alias("confidence"))


@query("fp_03_frequent_sequences", """
WITH h AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d, hour(ts) // 6 AS h, event_type AS e FROM events),
s AS (SELECT user_id, d, list({'h': h, 'e': e} ORDER BY h, e) AS l FROM h GROUP BY ALL),
m AS (SELECT user_id, d, list_filter(l, lambda x, i: (k >> (i - 1)) & 1 = 1) AS f
  FROM (SELECT *, unnest(range(1, CAST(2 ** len(l) AS BIGINT))) AS k FROM s) WHERE bit_count(k) <= 5),
p AS (SELECT DISTINCT user_id, d, array_to_string(list_transform(f, lambda x, i:
  (CASE WHEN i = 1 THEN '' WHEN f[i - 1].h = x.h THEN '+' ELSE '>' END) || x.e), '') AS pattern FROM m)
SELECT pattern, count(*) AS freq FROM p GROUP BY pattern HAVING count(*) >= (SELECT ceil(0.002 * count(*)) FROM s)""")
def _(spark, t):
    # A day of a user is at most four quarters of at most five kinds of event.
    kinds = t.events.select("user_id", F.to_date("ts").alias("d"), F.floor(F.hour("ts") / 6).alias("h"),
                            "event_type").distinct()
    sets = kinds.groupBy("user_id", "d", "h").agg(F.sort_array(F.collect_set("event_type")).alias("kinds"))
    days = sets.groupBy("user_id", "d").agg(F.sort_array(F.collect_list(F.struct("h", "kinds"))).alias("s")).select(
        F.col("s.kinds").alias("sequence"))
    found = patterns.frequent_sequences(days, support=0.002, max_length=5)
    text = F.array_join(F.transform("sequence", lambda s: F.array_join(F.array_sort(s), "+")), ">")
    return found.select(text.alias("pattern"), "freq")


PAIR_SQL = """x AS (SELECT l_quantity AS a, l_extendedprice / 1000 AS b FROM lineitem)"""


def quantity_and_price(t):
    pair = t.lineitem.select(F.col("l_quantity").alias("a"), (F.col("l_extendedprice") / 1000).alias("b"))
    return assemble(pair, ["a", "b"])


@query("la_01_principal_components_of_two", f"""
WITH {PAIR_SQL}, c AS (SELECT var_samp(a) AS p, var_samp(b) AS q, covar_samp(a, b) AS r FROM x),
v AS (SELECT (p + q) / 2 + sqrt(((p - q) / 2) ** 2 + r * r) AS l1, (p + q) / 2 - sqrt(((p - q) / 2) ** 2 + r * r) AS l2 FROM c)
SELECT 0 AS component, round(l1 / (l1 + l2), 6) AS share FROM v UNION ALL SELECT 1, round(l2 / (l1 + l2), 6) FROM v""")
def _(spark, t):
    _, model = principal_components(quantity_and_price(t), "features", 2)
    rows = [(i, float(s)) for i, s in enumerate(model.explainedVariance.toArray())]
    return spark.createDataFrame(rows, "component int, share double").withColumn("share", F.round("share", 6))


@query("la_02_singular_values_of_two", f"""
WITH {PAIR_SQL}, g AS (SELECT sum(a * a) AS p, sum(b * b) AS q, sum(a * b) AS r FROM x)
SELECT 0 AS at, round(sqrt((p + q) / 2 + sqrt(((p - q) / 2) ** 2 + r * r)), 4) AS s FROM g
UNION ALL SELECT 1, round(sqrt((p + q) / 2 - sqrt(((p - q) / 2) ** 2 + r * r)), 4) FROM g""")
def _(spark, t):
    s, _ = algebra.singular_values(quantity_and_price(t), "features", 2)
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(s)], "at int, s double").withColumn(
        "s", F.round("s", 4))


@query("la_02b_rows_rebuilt_from_factors", """
SELECT vec_id, TRUE AS rebuilt FROM embeddings""")
def _(spark, t):
    v = vectors(t)
    s, right = algebra.singular_values(v, "features", 64)
    u = algebra.times_matrix(v, "features", right / s, "u")
    back = algebra.times_matrix(u, "u", (right * s).T, "back")
    gap = F.zip_with("back", vector_to_array("features"), lambda a, b: F.abs(a - b))
    return back.select("vec_id", F.forall(gap, lambda x: x < 1e-6).alias("rebuilt"))

"""Scalar functions on table columns."""

from pyspark.sql import functions as F

from tidewright.catalog import query
from tidewright.catalog.aggregates import FLIGHTS_SQL, airports, flights, log_lines
from tidewright.fixed import ACCESS_LOG_PATTERN
from tidewright.functions import columns as fx


@query("fn_s1_split_trim_case", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, upper(p_name) AS loud,
       lower(p_brand) AS brand, trim('  ' || p_type || ' ') AS kind,
       regexp_split_to_array(p_brand, '#')[2] AS brand_no FROM part""")
def _(spark, t):
    return t.part.select(
        "p_partkey", F.get(F.split("p_name", " "), 0).alias("first_word"),
        F.upper("p_name").alias("loud"), F.lower("p_brand").alias("brand"),
        F.trim(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("kind"),
        F.get(F.split("p_brand", "#"), 1).alias("brand_no"))


@query("fn_s2_regex_groups", """
SELECT event_id, NOT (event_type = 'view' AND value > 200) AS matched,
 CASE WHEN event_type = 'view' AND value > 200 THEN '' ELSE '200' END AS status,
 CASE WHEN event_type = 'view' AND value > 200 THEN '' ELSE strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000' END AS at
FROM events""")
def _(spark, t):
    return log_lines(t).select(
        "event_id", F.col("value").rlike(ACCESS_LOG_PATTERN).alias("matched"),
        F.regexp_extract("value", ACCESS_LOG_PATTERN, 6).alias("status"),
        F.regexp_extract("value", ACCESS_LOG_PATTERN, 4).alias("at"))


@query("fn_s3_title_and_year", """
SELECT p_partkey, p_name || ' (' || (1950 + p_size) || ')' AS title, 1950 + p_size AS year FROM part""")
def _(spark, t):
    quoted = F.concat(F.lit('"'), "p_name", F.lit(" ("), (F.col("p_size") + 1950).cast("string"), F.lit(")"))
    return t.part.select("p_partkey", fx.without_leading_quote(quoted).alias("title"),
                         fx.title_year(quoted).alias("year"))


@query("fn_s4_concat", "SELECT c_custkey, 'Name: ' || c_name || ', Segment: ' || c_mktsegment AS line FROM customer")
def _(spark, t):
    return t.customer.select("c_custkey", F.concat(F.lit("Name: "), "c_name", F.lit(", Segment: "),
                                                   "c_mktsegment").alias("line"))


@query("fn_s5_exclude_words", """
SELECT p_partkey, p_name FROM part WHERE NOT (contains(p_name, 'ring') OR contains(p_name, 'widget'))""")
def _(spark, t):
    return t.part.filter(~fx.mentions_any(F.col("p_name"), ["ring", "widget"])).select("p_partkey", "p_name")


@query("fn_d1_dates_from_text", """
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at,
       CAST(NULL AS VARCHAR) AS broken FROM events""")
def _(spark, t):
    day, clock = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")
    return t.events.select(
        "event_id", fx.date_of(day).cast("string").alias("day"),
        F.date_format(fx.instant_of(day, clock), "yyyy-MM-dd HH:mm:ss").alias("at"),
        fx.date_of(F.concat(F.lit("NA"), clock)).cast("string").alias("broken"))


@query("fn_d2_date_parts", """
SELECT event_id, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
       CAST(hour(ts) AS INTEGER) AS hour, strftime(ts, '%Y-%m-%d') AS key, epoch_us(ts) // 1000 AS ms FROM events""")
def _(spark, t):
    return t.events.select("event_id", F.month("ts").alias("month"), F.day("ts").alias("day"),
                           F.hour("ts").alias("hour"), fx.day_key(F.col("ts")).alias("key"),
                           F.unix_millis("ts").alias("ms"))


@query("fn_m1_log_exp_pow_sqrt", """
SELECT l_orderkey, l_linenumber, l_partkey, round(ln(l_quantity + 1), 6) AS log_units,
       round(exp(ln(l_quantity + 1)) - 1, 6) AS back, round(l_discount ** 2, 6) AS squared,
       round(sqrt(l_extendedprice), 6) AS root, round(ln(100000 / (l_extendedprice / l_quantity)), 6) AS log_ratio
FROM lineitem""")
def _(spark, t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(F.ln(F.col("l_quantity") + 1), 6).alias("log_units"),
        F.round(F.exp(F.ln(F.col("l_quantity") + 1)) - 1, 6).alias("back"),
        F.round(F.pow("l_discount", F.lit(2.0)), 6).alias("squared"),
        F.round(F.sqrt("l_extendedprice"), 6).alias("root"),
        F.round(fx.log_ratio(F.lit(100000.0), F.col("l_extendedprice") / F.col("l_quantity")), 6)
        .alias("log_ratio"))


@query("fn_m2_bearing_and_region", f"""
WITH {FLIGHTS_SQL} SELECT event_id, origin, destination, region FROM marked""")
def _(spark, t):
    from tidewright.plans.flights import place
    return place(flights(t), airports(t)).select("event_id", "origin", "destination", "region")


@query("fn_m3_clamp_shift_binarise", """
SELECT l_orderkey, l_linenumber, l_partkey, least(greatest(l_quantity - 2.5, 0.0), 40.0) AS clamped,
       CASE WHEN l_quantity - 2.5 > 0 THEN 1.0::DOUBLE ELSE 0.0 END AS liked FROM lineitem""")
def _(spark, t):
    shifted = F.col("l_quantity") - 2.5
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                             fx.clamp(shifted, 0, 40).alias("clamped"), fx.above(shifted, 0).alias("liked"))


@query("fn_m4_three_way_status", """
SELECT event_id, CASE WHEN value <= 10 THEN 'ontime' WHEN value <= 45 THEN 'delay_minor' ELSE 'delay_major' END AS status,
       CASE WHEN value <= 10 THEN 'ontime' WHEN value <= 60 THEN 'delay_minor' ELSE 'delay_major' END AS fallback
FROM events""")
def _(spark, t):
    from tidewright.fixed import FALLBACK_DELAY_LIMITS
    v = F.col("value")
    return t.events.select("event_id", fx.delay_status(v).alias("status"),
                           fx.delay_status(v, FALLBACK_DELAY_LIMITS).alias("fallback"))


@query("fn_a1_array_access", """
SELECT vec_id, round(CAST(embedding[3] AS DOUBLE), 6) AS third, len(list_prepend(1.5, embedding)) AS longer,
       list_contains(embedding, embedding[2]) AS found, embedding[999] IS NULL AS beyond FROM embeddings""")
def _(spark, t):
    e = F.col("embedding")
    return t.embeddings.select(
        "vec_id", F.round(F.get(e, 2).cast("double"), 6).alias("third"),
        F.size(F.concat(F.array(F.lit(1.5).cast("float")), e)).cast("bigint").alias("longer"),
        F.array_contains(e, F.element_at(e, 2)).alias("found"), F.get(e, 998).isNull().alias("beyond"))


@query("fn_j1_json_both_ways", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       '{"type":"' || event_type || '","k":' || json_extract(props, '$.k') || '}' AS packed FROM events""")
def _(spark, t):
    e = t.events.select("event_id", "event_type", F.from_json("props", "k int").alias("p"))
    return e.select("event_id", F.col("p.k").alias("k"),
                    F.to_json(F.struct(F.col("event_type").alias("type"), F.col("p.k").alias("k"))).alias("packed"))


@query("fn_c1_lenient_numbers", """
SELECT o_orderkey, o_orderkey AS plain, CAST(floor(o_totalprice) AS INTEGER) AS prefix,
       CAST(NULL AS INTEGER) AS word, 0 AS blank, o_totalprice AS number,
       CAST(string_split(o_orderpriority, '-')[1] AS INTEGER) AS priority FROM orders""")
def _(spark, t):
    price = F.concat(F.format_string("%.2f", "o_totalprice"), F.lit("abc"))
    return t.orders.select(
        "o_orderkey", fx.lenient_int(F.col("o_orderkey")).cast("bigint").alias("plain"),
        fx.lenient_int(price).alias("prefix"), fx.lenient_int(F.col("o_orderstatus")).alias("word"),
        fx.lenient_int(F.lit(" "), blank="zero").alias("blank"),
        fx.lenient_double(price).alias("number"), fx.lenient_int(F.col("o_orderpriority")).alias("priority"))

"""Aggregates and windows."""

from pyspark.sql import functions as F

from tidewright.catalog import query
from tidewright.functions.columns import day_key
from tidewright.operators import aggregates as agg

WORDS_SQL = """(SELECT doc_id, w FROM
 (SELECT doc_id, unnest(regexp_split_to_array({text}, '[ \\r\\n]')) AS w FROM documents)
 WHERE regexp_matches(w, '[^ \\t\\n\\f\\r]'))"""


@query("ag_01_word_count", f"""
SELECT w AS word, count(*) AS n FROM {WORDS_SQL.format(text='text')} GROUP BY w""")
def _(spark, t):
    return agg.word_counts(t.documents)


def log_lines(t):
    """Access-log lines from events: errors carry no bytes, signups are anonymous, and
    views above 200 are cut short, so no parser can read them."""
    user = F.when(F.col("event_type") == "signup", '"-"').otherwise(
        F.concat(F.lit('"U'), "user_id", F.lit('"')))
    sent = F.when(F.col("event_type") == "error", "-").otherwise(F.floor("value").cast("string"))
    line = F.concat(
        F.lit("10.20."), F.floor(F.col("user_id") / 256).cast("string"), F.lit("."),
        (F.col("user_id") % 256).cast("string"), F.lit(" - "), user, F.lit(" ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0000] "GET /'), "event_type",
        F.lit(' HTTP/1.1" 200 '), sent, F.lit(' "http://from/" "agent 1"'))
    broken = (F.col("event_type") == "view") & (F.col("value") > 200)
    return t.events.select("event_id", F.when(broken, F.substring(line, 1, 20)).otherwise(line)
                           .alias("value"))


LOG_SQL = """
WITH e AS (SELECT *, event_type = 'signup' OR (event_type = 'view' AND value > 200) AS hidden,
                  (event_type = 'view' AND value > 200) OR event_type = 'error' AS no_bytes FROM events)
SELECT CASE WHEN NOT hidden THEN '10.20.' || (user_id // 256) || '.' || (user_id % 256) END AS ip,
       CASE WHEN NOT hidden THEN '"U' || user_id || '"' END AS "user",
       CASE WHEN NOT hidden THEN 'GET /' || event_type || ' HTTP/1.1' END AS query,
       count(*) AS n,
       CAST(sum(CASE WHEN no_bytes THEN 0 ELSE floor(value) END) AS BIGINT) AS bytes
FROM e GROUP BY 1, 2, 3"""


@query("ag_02_log_hits_and_bytes", LOG_SQL)
def _(spark, t):
    return agg.log_traffic(log_lines(t))


@query("ag_03_count_and_mean_per_key", """
SELECT l_partkey, count(*) AS n, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY l_partkey""")
def _(spark, t):
    return (agg.count_and_mean(t.lineitem, ["l_partkey"], "l_quantity")
            .withColumn("mean", F.round("mean", 6)))


@query("ag_04_item_lists_per_key", """
WITH p AS (SELECT DISTINCT o_custkey, o_orderkey, o_orderkey // 1000 AS page FROM orders)
SELECT o_custkey, page, string_agg(o_orderkey, ',' ORDER BY o_orderkey) AS items
FROM p GROUP BY o_custkey, page""")
def _(spark, t):
    pages = agg.item_pages(t.orders, "o_custkey", "o_orderkey")
    return pages.select("o_custkey", "page", F.array_join("items", ",").alias("items"))


@query("ag_05_averages_by_group", """
SELECT l_returnflag, round(avg(l_quantity), 6) AS avg_l_quantity,
       round(avg(l_extendedprice), 4) AS avg_l_extendedprice, round(avg(l_discount), 6) AS avg_l_discount,
       round(avg(l_tax), 6) AS avg_l_tax, round(avg(l_linenumber), 6) AS avg_l_linenumber,
       round(avg(l_suppkey), 6) AS avg_l_suppkey
FROM lineitem GROUP BY l_returnflag""")
def _(spark, t):
    m = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]
    a = agg.means_by(t.lineitem, "l_returnflag", m)
    return a.select("l_returnflag", *[
        F.round(f"avg_{c}", 4 if c == "l_extendedprice" else 6).alias(f"avg_{c}") for c in m])


@query("ag_06_array_group_key", """
SELECT strftime(l_shipdate, '%Y-%m-%d') AS day,
       list_aggregate(list_transform(range(1, 8), lambda d: CAST(CASE WHEN d = dayofweek(l_shipdate) + 1
         THEN 1.0 ELSE 0.0 END AS DECIMAL(2,1))), 'string_agg', ',') AS flags,
       sum(l_quantity) AS units, round(sum(l_extendedprice), 2) AS price
FROM lineitem GROUP BY 1, 2""")
def _(spark, t):
    flags = F.array(*[F.when(F.dayofweek("l_shipdate") == d, 1.0).otherwise(0.0) for d in range(1, 8)])
    days = t.lineitem.withColumn("day", day_key(F.col("l_shipdate"))).withColumn("flags", flags)
    sums = days.groupBy("day", "flags").agg({"l_extendedprice": "sum", "l_quantity": "sum"})
    return sums.select("day", F.array_join(F.transform("flags", lambda x: x.cast("string")), ",")
                       .alias("flags"), F.col("sum(l_quantity)").alias("units"),
                       F.round("sum(l_extendedprice)", 2).alias("price"))


@query("ag_07_group_count", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def _(spark, t):
    return t.events.groupBy("event_type").count()


@query("ag_08_global_reduce", """
SELECT sum(l_quantity) AS total, count(*) AS n, round(avg(l_discount), 6) AS mean FROM lineitem""")
def _(spark, t):
    return t.lineitem.agg(F.sum("l_quantity").alias("total"), F.count("*").alias("n"),
                          F.round(F.avg("l_discount"), 6).alias("mean"))


@query("ag_09_vector_sum", """
SELECT CAST(pos - 1 AS INTEGER) AS pos, round(sum(CAST(embedding[pos] AS DOUBLE)), 6) AS total
FROM embeddings, range(1, 65) r(pos) GROUP BY pos""")
def _(spark, t):
    return agg.vector_sum(t.embeddings, "embedding").select("pos", F.round("total", 6).alias("total"))


@query("ag_10_max", "SELECT max(o_totalprice) AS top, max(o_orderdate)::DATE::VARCHAR AS latest FROM orders")
def _(spark, t):
    return t.orders.agg(F.max("o_totalprice").alias("top"),
                        F.to_date(F.max("o_orderdate")).cast("string").alias("latest"))


@query("ag_11_distinct_under_filter", "SELECT DISTINCT event_type AS carrier FROM events WHERE user_id = 3")
def _(spark, t):
    return t.events.filter("user_id = 3").select(F.col("event_type").alias("carrier")).distinct()


# Airports are nations at made coordinates; every event is a flight.
FLIGHTS_SQL = """airport AS (SELECT n_nationkey AS code, (n_nationkey * 37) % 180 - 90.0 AS lat,
   (n_nationkey * 61) % 360 - 180.0 AS lon FROM nation),
flight AS (SELECT event_id, ts, user_id % 25 AS origin, (event_id * 7 + 3) % 25 AS destination,
   value AS delay, event_type AS carrier FROM events),
placed AS (SELECT f.*, coalesce(a.lat, 0.0) AS lat1, coalesce(a.lon, 0.0) AS lon1,
   coalesce(b.lat, 0.0) AS lat2, coalesce(b.lon, 0.0) AS lon2
   FROM flight f LEFT JOIN airport a ON origin = a.code LEFT JOIN airport b ON destination = b.code),
turned AS (SELECT *, 360 - (degrees(atan2(lat2 - lat1, lon2 - lon1)) + 360) % 360 AS angle FROM placed),
marked AS (SELECT *, CAST(CASE WHEN floor(angle / 30) < 9 THEN floor(angle / 30) + 3
                          ELSE floor(angle / 30) - 9 END AS INTEGER) AS region,
   CASE WHEN delay <= 10 THEN 'ontime' WHEN delay <= 45 THEN 'delay_minor' ELSE 'delay_major' END AS status
   FROM turned)"""


def flights(t):
    return t.events.select(
        "event_id", "ts", (F.col("user_id") % 25).alias("origin"),
        ((F.col("event_id") * 7 + 3) % 25).alias("destination"),
        F.col("value").alias("delay"), F.col("event_type").alias("carrier"))


def airports(t):
    key = F.col("n_nationkey")
    return t.nation.select(key.cast("bigint").alias("code"),
                           ((key * 37) % 180 - 90.0).alias("lat"),
                           ((key * 61) % 360 - 180.0).alias("lon"))


@query("ag_12_delay_shares_by_direction", f"""
WITH {FLIGHTS_SQL},
c AS (SELECT origin, region, count(*) AS n, count(*) FILTER (status = 'ontime') AS a,
      count(*) FILTER (status = 'delay_minor') AS b, count(*) FILTER (status = 'delay_major') AS c
      FROM marked GROUP BY origin, region)
SELECT origin, region, 'ontime' AS status, CAST(floor(a / n * 100 + 0.5) AS INTEGER) AS pct FROM c
UNION ALL SELECT origin, region, 'delay_minor', CAST(floor(b / n * 100 + 0.5) AS INTEGER) FROM c
UNION ALL SELECT origin, region, 'delay_major', CAST(floor(c / n * 100 + 0.5) AS INTEGER) FROM c""")
def _(spark, t):
    from tidewright.plans.flights import delay_shares, place
    return delay_shares(place(flights(t), airports(t)))


HOURLY_SQL = """hourly AS (SELECT CAST(ts AS DATE) AS day, hour(ts) AS hour, sum(value) AS total
  FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)"""


@query("ag_13_running_day_totals", f"""
WITH {HOURLY_SQL}, d AS (SELECT day, max(hour) AS last_hour FROM hourly GROUP BY day)
SELECT CAST(d.day AS VARCHAR) AS day, CAST(s.hour AS INTEGER) AS hour,
  round(CASE WHEN s.hour <= last_hour THEN (SELECT coalesce(sum(total), 0) FROM hourly h
        WHERE h.day = d.day AND h.hour <= s.hour) ELSE 0 END, 2) AS so_far
FROM d, range(24) s(hour)""")
def _(spark, t):
    sales = t.events.filter("event_type = 'purchase'")
    curve = agg.day_curve(agg.hourly_totals(sales, "ts", "value"))
    return curve.select(F.col("day").cast("string").alias("day"), "hour",
                        F.round("so_far", 2).alias("so_far"))


@query("ag_14_daily_actual_rows", """
SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, sum(l_quantity) AS units,
       round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY 1""")
def _(spark, t):
    d = agg.daily_sales(t.lineitem, "l_shipdate", "l_quantity", "l_extendedprice")
    return d.withColumn("price", F.round("price", 2))


@query("ag_15_share_of_max", """
WITH n AS (SELECT c_nationkey AS nation, avg(o_totalprice) AS a, avg(o_totalprice) / 12 AS monthly
           FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey)
SELECT nation, round(a, 4) AS a, round(monthly, 4) AS monthly, round(a / (SELECT max(a) FROM n), 6) AS share
FROM n""")
def _(spark, t):
    o, c = t.orders, t.customer
    n = (o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_nationkey").alias("nation"))
         .agg(F.avg("o_totalprice").alias("a")))
    return agg.share_of_max(n, "a", "share").select(
        "nation", F.round("a", 4).alias("a"), F.round(F.col("a") / 12, 4).alias("monthly"),
        F.round("share", 6).alias("share"))


@query("ag_16_fraction_estimate", """
WITH p AS (SELECT ((o_orderkey * 7919) % 10007) / 10007.0 * 2 - 1 AS x,
                  ((o_orderkey * 104729) % 10009) / 10009.0 * 2 - 1 AS y FROM orders)
SELECT count(*) AS n, round(4.0 * avg(CASE WHEN x * x + y * y < 1 THEN 1.0 ELSE 0.0 END), 6) AS estimate
FROM p""")
def _(spark, t):
    k = F.col("o_orderkey")
    p = t.orders.select((k * 7919 % 10007 / 10007.0 * 2 - 1).alias("x"),
                        (k * 104729 % 10009 / 10009.0 * 2 - 1).alias("y"))
    inside = F.col("x") * F.col("x") + F.col("y") * F.col("y") < 1
    return p.agg(F.count("*").alias("n"), F.round(agg.fraction(inside) * 4, 6).alias("estimate"))


@query("ag_17_error_rate", """
SELECT count(*) AS n, round(avg(CASE WHEN (CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END) <> quality
       THEN 1.0 ELSE 0.0 END), 6) AS error_rate
FROM labels JOIN documents USING (doc_id)""")
def _(spark, t):
    d = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    guess = F.when(F.col("n_chars") > 1000, 1).otherwise(0)
    return d.agg(F.count("*").alias("n"),
                 F.round(agg.fraction(guess != F.col("quality")), 6).alias("error_rate"))


@query("ag_18_rmse_of_joined_pairs", """
WITH a AS (SELECT l_orderkey, l_linenumber, sum(l_quantity) AS q, sum(l_discount) AS d FROM lineitem GROUP BY ALL),
     b AS (SELECT l_orderkey, avg(l_quantity) AS guess FROM lineitem GROUP BY l_orderkey)
SELECT count(*) AS n, round(avg((q - guess) ** 2), 6) AS mse, round(sqrt(avg((q - guess) ** 2)), 6) AS rmse
FROM a JOIN b ON a.l_orderkey = b.l_orderkey""")
def _(spark, t):
    a = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.sum("l_quantity").alias("q"))
    b = t.lineitem.groupBy("l_orderkey").agg(F.avg("l_quantity").alias("guess"))
    rmse = agg.root_mean_square(F.col("q"), F.col("guess"))
    return a.join(b, "l_orderkey").agg(
        F.count("*").alias("n"), F.round(F.avg(F.pow(F.col("q") - F.col("guess"), 2)), 6).alias("mse"),
        F.round(rmse, 6).alias("rmse"))


@query("win_01_cumulative_by_hour", f"""
WITH {HOURLY_SQL}
SELECT CAST(day AS VARCHAR) AS day, CAST(hour AS INTEGER) AS hour, round(sum(total) OVER (PARTITION BY day ORDER BY hour), 2) AS so_far
FROM hourly""")
def _(spark, t):
    curve = agg.hourly_totals(t.events.filter("event_type = 'purchase'"), "ts", "value")
    filled = agg.day_curve(curve).join(curve.select("day", "hour"), ["day", "hour"], "left_semi")
    return filled.select(F.col("day").cast("string").alias("day"), "hour",
                         F.round("so_far", 2).alias("so_far"))


@query("win_02_latest_unbroken_days", """
WITH d AS (SELECT o_orderstatus AS series, CAST(o_orderdate AS DATE) AS day, count(*) AS n,
                  round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1, 2),
g AS (SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY series ORDER BY day) = 1 THEN 0 ELSE 1 END AS new FROM d),
r AS (SELECT *, sum(new) OVER (PARTITION BY series ORDER BY day) AS run FROM g),
k AS (SELECT *, max(run) OVER (PARTITION BY series) AS newest,
             row_number() OVER (PARTITION BY series ORDER BY day DESC) AS back FROM r)
SELECT series, CAST(day AS VARCHAR) AS day, n, total, CAST(back AS INTEGER) AS back
FROM k WHERE run = newest AND back <= 7""")
def _(spark, t):
    daily = t.orders.groupBy(F.col("o_orderstatus").alias("series"),
                             F.to_date("o_orderdate").alias("day")).agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    return agg.last_run(daily, "day", ["series"]).select(
        "series", F.col("day").cast("string").alias("day"), "n", "total", "back")

"""Streams over the event table, drained and compared with their batch twins in SQL."""

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tidewright.catalog import query
from tidewright.catalog.aggregates import FLIGHTS_SQL, airports, flights
from tidewright.functions.columns import day_key
from tidewright.plans.flights import parse_flights, place
from tidewright.session import Scratch, fresh_path
from tidewright.sources import live
from tidewright.streaming import buffers, run, sales, windows

EVENTS = ("event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string")
STAMP = "yyyy-MM-dd HH:mm:ss"


class Live:
    """The same table names as `Tables`, with events as a stream."""

    def __init__(self, t):
        self.spark, self.nation = t.spark, t.nation
        # A pattern, so that a single file and a folder of files both work.
        self.events = live.replay_table(t.spark, f"{t.folder}/event[s].parquet", EVENTS)


def finished(spark, stream, label):
    """Run a stream over everything there is into parquet and read the result."""
    path = fresh_path(spark, label)
    run.drain([run.start_files(stream, path, fresh_path(spark, f"{label}-log"))])
    return spark.read.schema(stream.schema).parquet(path)


def stamped(df):
    return df.withColumn("start", F.date_format("start", STAMP)).withColumn("end", F.date_format("end", STAMP))


def flight_lines(events):
    """Flight records of 18 comma-separated fields; errors have no delay."""
    delay = F.when(F.col("event_type") == "error", "NA").otherwise(F.format_string("%.2f", "value"))
    at = {8: F.col("event_type"), 9: F.col("event_id"), 15: delay, 16: F.col("user_id") % 25,
          17: (F.col("event_id") * 7 + 3) % 25}
    return events.select(F.concat_ws(",", *[at.get(i, F.lit(i)).cast("string") for i in range(18)]).alias("value"))


PARSED = """SELECT event_type AS carrier, CAST(event_id AS VARCHAR) AS flight_num,
 CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value) AS INTEGER) END AS take_off_delay_mins,
 CAST(user_id % 25 AS VARCHAR) AS origin, CAST((event_id * 7 + 3) % 25 AS VARCHAR) AS destination FROM events"""


@query("src_16_lines_from_any_stream", "SELECT event_type AS carrier, count(*) AS n FROM events GROUP BY 1")
def _(spark, t):
    folder = fresh_path(spark, "lines")
    flight_lines(t.events).write.text(folder)
    lines = live.open_lines(spark, "text", {"path": folder})
    return finished(spark, parse_flights(lines), "any").groupBy("carrier").agg(F.count("*").alias("n"))


@query("src_18_replay_folder_paced", """
SELECT event_type AS carrier, count(*) AS n, TRUE AS every_file_its_batch FROM events GROUP BY 1""")
def _(spark, t):
    folder, out = fresh_path(spark, "replay"), fresh_path(spark, "batches")
    flight_lines(t.events).repartition(4).write.text(folder)
    stream = parse_flights(live.replay_lines(spark, folder, files_per_batch=1))
    run.drain([run.start_batches(stream, run.batch_folder(out), fresh_path(spark, "log"))])
    saved = spark.read.parquet(out)
    batches = saved.agg(F.count_distinct("batch")).scalar()
    return saved.groupBy("carrier").agg(F.count("*").alias("n")).withColumn("every_file_its_batch", batches == 4)


@query("snk_09_batches_to_folders", "SELECT event_id, user_id, value FROM events WHERE value > 50")
def _(spark, t):
    path, limit = fresh_path(spark, "batches"), 50
    write = run.batch_folder(path)

    def handle(batch, number):
        write(batch.filter(F.col("value") > limit), number)

    run.drain([run.start_batches(Live(t).events.select("event_id", "user_id", "value"), handle, fresh_path(spark, "log"))])
    return spark.read.parquet(path).select("event_id", "user_id", "value")


@query("jn_09_stream_static_join", """
WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS date, round(avg(value), 4) AS usual FROM events GROUP BY 1)
SELECT event_id, date, usual FROM events JOIN d ON strftime(ts, '%Y-%m-%d') = date""")
def _(spark, t):
    # Saved first: the static side of a stream is read again in every batch.
    dates = Scratch(spark).settle(t.events.groupBy(day_key(F.col("ts")).alias("date")).agg(F.round(F.avg("value"), 4).alias("usual")))
    stream = Live(t).events.select("event_id", day_key(F.col("ts")).alias("date"))
    return finished(spark, sales.with_dates(stream, dates), "dated")


@query("st_01_interval_is_a_parameter", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(spark, t):
    path = fresh_path(spark, "ticks")
    q = run.start_files(Live(t).events.select("event_type"), path, fresh_path(spark, "log"), interval="250 milliseconds")
    q.processAllAvailable()
    run.stop_all([q])
    return spark.read.parquet(path).groupBy("event_type").agg(F.count("*").alias("n"))


CLOSED = "(SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"


@query("st_02_sliding_window", f"""
WITH w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - k * INTERVAL 5 MINUTE AS s, value FROM events, range(3) r(k))
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start, strftime(s + INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS end,
 count(*) AS n, round(sum(value), 2) AS total FROM w WHERE s + INTERVAL 15 MINUTE <= {CLOSED} GROUP BY s""")
def _(spark, t):
    w = windows.sliding(Live(t).events, "ts", [F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")],
                        slide="5 minutes")
    return stamped(finished(spark, w, "sliding"))


@query("st_03_parse_chunked_lines", PARSED)
def _(spark, t):
    folder = fresh_path(spark, "lines")
    flight_lines(t.events).write.text(folder)
    return finished(spark, parse_flights(live.replay_lines(spark, folder, 2)), "parsed")


WINDOWED_SQL = f"""
WITH {FLIGHTS_SQL}, w AS (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - k * INTERVAL 5 MINUTE AS s, origin, region, status FROM marked, range(3) r(k)),
c AS (SELECT s, origin, region, count(*) AS n, count(*) FILTER (status = 'ontime') AS a, count(*) FILTER (status = 'delay_minor') AS b,
  count(*) FILTER (status = 'delay_major') AS c FROM w WHERE s + INTERVAL 15 MINUTE <= {CLOSED} GROUP BY ALL)
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start, strftime(s + INTERVAL 15 MINUTE, '%Y-%m-%d %H:%M:%S') AS end, origin, region,
 n AS flights, CAST(floor(a / n * 100 + 0.5) AS INTEGER) AS ontime, CAST(floor(b / n * 100 + 0.5) AS INTEGER) AS delay_minor,
 CAST(floor(c / n * 100 + 0.5) AS INTEGER) AS delay_major FROM c"""


@query("st_04_windowed_delays_by_direction", WINDOWED_SQL)
def _(spark, t):
    placed = place(flights(Live(t)), airports(t))
    return stamped(finished(spark, windows.delay_windows(placed, slide="5 minutes"), "delays"))


@query("st_05_release_buffered_rows", """
WITH e AS (SELECT user_id, event_id, ts, event_type = 'signup' AS reg,
  sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seg FROM events),
m AS (SELECT user_id, max(seg) AS last FROM e GROUP BY user_id),
d AS (SELECT user_id, event_id, seg, row_number() OVER (PARTITION BY user_id, seg ORDER BY ts, event_id) - 1 AS i,
  count(*) OVER (PARTITION BY user_id, seg) AS n FROM e WHERE NOT reg),
x AS (SELECT d.user_id, event_id, seg, CASE WHEN seg = 0 THEN 0 ELSE i // 5 END AS sub,
  CASE WHEN seg > 0 AND i // 5 < n // 5 THEN 'full' WHEN seg < last THEN 'registered' END AS reason FROM d JOIN m USING (user_id))
SELECT CAST(user_id AS VARCHAR) AS airport, dense_rank() OVER (PARTITION BY user_id ORDER BY seg, sub) - 1 AS chunk, reason, event_id
FROM x WHERE reason IS NOT NULL""")
def _(spark, t):
    # Signups register their user; all other events are buffered.
    e = Live(t).events
    data = e.filter("event_type <> 'signup'").select("user_id", "ts", "event_id", "event_type", "value")
    notes = e.filter("event_type = 'signup'").select(
        F.col("user_id").alias("airport"), F.col("ts").alias("at"), F.lit("register").alias("kind"))
    both = buffers.with_messages(data, notes, airport="user_id")
    started, release = buffers.start_release(both, fresh_path(spark, "release"), fresh_path(spark, "log"), release_at=5)
    run.drain([started])
    return release.released().select("airport", "chunk", "reason", "event_id")


@query("st_06_day_closes", f"""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, round(sum(value), 2) AS units, count(*) AS n FROM events
WHERE event_type = 'purchase' AND CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events WHERE event_type = 'purchase') - INTERVAL 10 MINUTE GROUP BY CAST(ts AS DATE)""")
def _(spark, t):
    buys = Live(t).events.filter("event_type = 'purchase'")
    d = windows.daily(buys, "ts", [F.round(F.sum("value"), 2).alias("units"), F.count("*").alias("n")])
    return finished(spark, d, "days").withColumn("day", F.col("day").cast("string"))


@query("st_07_hour_totals_as_they_grow", """
WITH h AS (SELECT CAST(ts AS DATE) AS day, hour(ts) AS hour, sum(value) AS total, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT CAST(day AS VARCHAR) AS day, CAST(hour AS INTEGER) AS hour, round(sum(total) OVER (PARTITION BY day ORDER BY hour), 2) AS so_far FROM h""")
def _(spark, t):
    from tidewright.operators.aggregates import day_curve
    # Each purchase day becomes a file, so that the totals grow over several batches.
    folder, out = fresh_path(spark, "purchases"), fresh_path(spark, "hours")
    buys = t.events.filter("event_type = 'purchase'").select(F.col("ts").alias("time"), F.col("value").alias("units"))
    buys.repartition(3).write.parquet(folder)
    stream = live.replay_table(spark, folder, "time timestamp, units double", files_per_batch=1)
    hours = sales.hour_totals(stream, lateness="31 days")
    run.drain([run.start_batches(hours, run.batch_folder(out), fresh_path(spark, "log"), mode="update")])
    hourly = run.latest_rows(spark.read.parquet(out), ["day", "hour"], ["total", "n"])
    curve = day_curve(hourly).join(hourly.select("day", "hour"), ["day", "hour"], "left_semi")
    return curve.select(F.col("day").cast("string").alias("day"), "hour", F.round("so_far", 2).alias("so_far"))


@query("st_08_enrich_and_score", """
WITH x AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, value AS price, CAST(json_extract(props, '$.k') AS INTEGER) AS units FROM events),
m AS (SELECT regr_slope(units, price) AS a, regr_intercept(units, price) AS b FROM x),
d AS (SELECT date, count(*) AS day_sales FROM x GROUP BY date)
SELECT event_id, date, day_sales, round(price * a + b, 5) AS predicted FROM x JOIN d USING (date), m""")
def _(spark, t):
    def sold(events):
        return events.select("event_id", day_key(F.col("ts")).alias("date"), F.col("value").alias("price"),
                             F.from_json("props", "k int").getField("k").cast("double").alias("units"))

    history = sold(t.events)
    dates = Scratch(spark).settle(history.groupBy("date").agg(F.count("*").alias("day_sales")))
    model = Pipeline(stages=[VectorAssembler(inputCols=["price"], outputCol="features"),
                             LinearRegression(labelCol="units", solver="normal")]).fit(history)
    live_sales = sales.scored(sold(Live(t).events), dates, model)
    out = live_sales.select("event_id", "date", "day_sales", F.round("prediction", 5).alias("predicted"))
    return finished(spark, out, "scored")


@query("st_09_two_streams_at_once", """
SELECT event_id, 'small' AS stream FROM events WHERE value < 20 UNION ALL SELECT event_id, 'large' FROM events WHERE value >= 20""")
def _(spark, t):
    paths = {"small": fresh_path(spark, "small"), "large": fresh_path(spark, "large")}
    started = [run.start_files(Live(t).events.filter(c).select("event_id"), paths[k], fresh_path(spark, "log"))
               for k, c in (("small", "value < 20"), ("large", "value >= 20"))]
    run.drain(started)
    both = [spark.read.parquet(p).select("event_id", F.lit(k).alias("stream")) for k, p in paths.items()]
    return both[0].union(both[1])


@query("st_11_restart_from_checkpoint", "SELECT event_id, CAST(1 AS BIGINT) AS times FROM events")
def _(spark, t):
    folder, out, log = fresh_path(spark, "in"), fresh_path(spark, "out"), fresh_path(spark, "log")
    half = t.events.agg(F.expr("approx_percentile(event_id, 0.5)")).first()[0]
    for part in (F.col("event_id") <= half, F.col("event_id") > half):
        t.events.select("event_id").filter(part).write.mode("append").parquet(folder)
        stream = live.replay_table(spark, folder, "event_id bigint")
        run.drain([run.start_files(stream, out, log)])
    return spark.read.parquet(out).groupBy("event_id").agg(F.count("*").alias("times"))


@query("st_11b_rows_that_come_too_late", """
SELECT count(*) AS late FROM events WHERE event_id % 2 = 1 AND date_trunc('hour', ts) + INTERVAL 1 HOUR
 <= (SELECT max(ts) FROM events WHERE event_id % 2 = 0) - INTERVAL 10 MINUTE""")
def _(spark, t):
    # Rows of even number come first and move the watermark, which holds for late rows a batch later; the others come
    # in the third batch.
    folder = fresh_path(spark, "in")
    kept = t.events.select("event_id", "ts")
    even = kept.filter("event_id % 2 = 0").coalesce(1)
    even.write.mode("append").parquet(folder)
    even.orderBy(F.desc("ts"), "event_id").limit(1).write.mode("append").parquet(folder)
    kept.filter("event_id % 2 = 1").coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(kept.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    # Each row has a key of its own, so that each counts.
    per_hour = windows.hourly(stream, "ts", [F.count("*").alias("n")], by=["event_id"], lateness="10 minutes")
    done = run.start_files(per_hour, fresh_path(spark, "out"), fresh_path(spark, "log"))
    run.drain([done])
    return spark.createDataFrame([(run.late_rows(done),)], "late bigint")

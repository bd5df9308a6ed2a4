import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewright.streaming import buffers, run, sales, windows
from tidewright.sources import live

SCHEMA = "event_id bigint, ts timestamp, origin string"


def at(minute, day=1):
    return dt.datetime(2024, 1, day) + dt.timedelta(minutes=minute)


class Feed:
    """A folder of parquet files, a stream over it, and where its output goes."""

    def __init__(self, spark, tmp_path, schema):
        self.spark, self.root, self.schema = spark, str(tmp_path), schema
        spark.createDataFrame([], schema).write.parquet(f"{self.root}/in")

    def add(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(f"{self.root}/in")

    def stream(self, **kw):
        return live.replay_table(self.spark, f"{self.root}/in", self.schema, **kw)

    def drain(self, df):
        run.drain([run.start_files(df, f"{self.root}/out", f"{self.root}/log")])
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/out")


def test_late_rows_are_dropped_and_restart_continues(spark, tmp_path):
    feed = Feed(spark, tmp_path, "event_id bigint, ts timestamp, value double")

    def days():
        return windows.daily(feed.stream(), "ts", [F.count("*").alias("n")], lateness="10 minutes")

    feed.add([(1, at(5), 1.0), (2, at(10), 1.0), (3, at(0, 2), 1.0)])
    assert feed.drain(days()).count() == 0
    feed.add([(4, at(30, 2), 1.0)])
    assert [r["n"] for r in feed.drain(days()).collect()] == [2]
    feed.add([(5, at(20), 1.0), (6, at(40, 3), 1.0)])  # the first is a day late
    assert {(str(r["day"]), r["n"]) for r in feed.drain(days()).collect()} == {("2024-01-01", 2), ("2024-01-02", 2)}


def test_batch_twin_of_sliding_windows(spark, tmp_path):
    feed = Feed(spark, tmp_path, "event_id bigint, ts timestamp, value double")
    feed.add([(i, at(7 * i), float(i)) for i in range(40)])
    aggs = [F.count("*").alias("n"), F.sum("value").alias("s")]
    got = feed.drain(windows.sliding(feed.stream(), "ts", aggs, slide="5 minutes"))
    twin = windows.sliding(spark.read.parquet(f"{feed.root}/in"), "ts", aggs, slide="5 minutes")
    closed = twin.filter(F.col("end") <= F.lit(at(7 * 39 - 10)))
    assert got.count() == closed.count() > 0 and got.exceptAll(closed).isEmpty()


def release(feed, **kw):
    rows = feed.stream(**kw)
    kind = F.when(F.col("event_id") == -1, "register").otherwise("unregister")
    notes = rows.filter("event_id < 0").select(F.col("origin").alias("airport"), F.col("ts").alias("at"), kind.alias("kind"))
    both = buffers.with_messages(rows.filter("event_id >= 0"), notes)
    started, out = buffers.start_release(both, f"{feed.root}/release", f"{feed.root}/log")
    run.drain([started])
    return out.released()


def test_buffers_release_full_chunks_and_backlog(spark, tmp_path):
    feed = Feed(spark, tmp_path, SCHEMA)
    feed.add([(i, at(i), "A") for i in range(40)] + [(1000 + i, at(i), "B") for i in range(350)])
    assert release(feed).count() == 0                                  # nobody listens yet
    feed.add([(-1, at(500), "A")] + [(50 + i, at(501 + i), "A") for i in range(650)])
    got = release(feed).groupBy("airport", "chunk", "reason").count().collect()
    assert sorted(map(tuple, got)) == [("A", 0, "registered", 40), ("A", 1, "full", 300), ("A", 2, "full", 300)]
    feed.add([(-2, at(2000), "A"), (-1, at(2000), "B")] + [(5000 + i, at(2001 + i), "A") for i in range(400)])
    later = release(feed)
    assert later.filter("airport = 'A'").count() == 640                # unregistered again: held back
    assert later.filter("airport = 'B'").select("chunk", "reason").distinct().collect()[0][:] == (0, "registered")
    assert later.filter("airport = 'B'").count() == 350
    feed.add([(-1, at(3000), "A"), (9000, at(3001), "A")])
    last = release(feed).filter("airport = 'A' AND chunk = 3")
    assert last.count() == 450 and {r["reason"] for r in last.collect()} == {"registered"}
    held = spark.read.parquet(f"{feed.root}/release/state/3/held")
    assert [r["seq"] for r in held.collect()] == [9000]


@pytest.mark.parametrize("batch", ["100", "10000"])
def test_busy_airport_is_released_in_its_order(spark, tmp_path, batch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, batch)
    try:
        feed = Feed(spark, tmp_path, SCHEMA)
        feed.add([(i, at(2 * i), "A") for i in range(30_000)] + [(-1, at(2 * 15_000 + 1), "A"), (-2, at(2 * 15_000 + 3), "A")])
        out = release(feed)
        assert out.count() == 15_001
        assert {r["reason"] for r in out.select("reason").distinct().collect()} == {"registered"}
    finally:
        spark.conf.set(key, before)


def test_a_batch_that_comes_again_gives_the_same(spark, tmp_path):
    feed = Feed(spark, tmp_path, SCHEMA)
    rows = spark.createDataFrame([(i, at(i), "A") for i in range(700)], SCHEMA)
    notes = spark.createDataFrame([("A", at(-1), "register")], "airport string, at timestamp, kind string")
    both = buffers.with_messages(rows, notes)
    handle = buffers.ChunkRelease(spark, f"{feed.root}/r", "event_id: bigint, ts: timestamp, origin: string")
    for number in (0, 0, 1, 1):
        handle(both if number == 0 else both.filter("kind = 'data'"), number)
    got = handle.released().groupBy("batch", "chunk", "reason").count().collect()
    assert sorted(map(tuple, got)) == [(0, 0, "full", 300), (0, 1, "full", 300), (1, 2, "full", 300), (1, 3, "full", 300)]


def test_repeated_batch_leaves_no_double_rows(spark, tmp_path):
    write = run.batch_folder(str(tmp_path / "b"))
    for n in (0, 1, 1):
        write(spark.range(5), n)
    assert spark.read.parquet(str(tmp_path / "b")).count() == 10


def test_growing_totals_keep_the_newest(spark, tmp_path):
    feed = Feed(spark, tmp_path, "time timestamp, units double")

    def hours():
        out = sales.hour_totals(feed.stream(), lateness="2 days")
        run.drain([run.start_batches(out, run.batch_folder(f"{feed.root}/h"), f"{feed.root}/log", mode="update")])
        rows = run.latest_rows(spark.read.parquet(f"{feed.root}/h"), ["day", "hour"], ["total", "n"])
        return {r["hour"]: (r["total"], r["n"]) for r in rows.collect()}

    feed.add([(at(10), 1.0), (at(70), 2.0)])
    assert hours() == {0: (1.0, 1), 1: (2.0, 1)}
    feed.add([(at(20), 5.0)])
    assert hours() == {0: (6.0, 2), 1: (2.0, 1)}


def test_streams_run_side_by_side_and_stop(spark, tmp_path):
    feed = Feed(spark, tmp_path, SCHEMA)
    feed.add([(1, at(1), "A")])
    qs = [run.start_files(feed.stream(), f"{tmp_path}/o{i}", f"{tmp_path}/l{i}", interval="250 milliseconds", name=f"side{i}")
          for i in range(2)]
    for q in qs:
        q.processAllAvailable()
    assert all(q.isActive for q in qs)
    run.stop_all(qs, 5)
    assert not any(q.isActive for q in qs)
    assert all(spark.read.parquet(f"{tmp_path}/o{i}").count() == 1 for i in range(2))


def test_late_rows_are_counted(spark, tmp_path):
    schema = "event_id bigint, ts timestamp, origin string"
    counter = run.LateRows()
    spark.streams.addListener(counter)
    try:
        feed = Feed(spark, tmp_path, schema)
        feed.add([(1, at(0), "a"), (2, at(300), "a")])
        feed.add([(3, at(301), "a")])
        feed.add([(4, at(5), "a"), (5, at(6), "b"), (6, at(302), "b")])
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        done = run.start_files(windows.hourly(stream, "ts", [F.count("*").alias("n")], by=["origin"], lateness="10 minutes"),
                               f"{tmp_path}/out", f"{tmp_path}/log")
        run.drain([done])
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        assert run.late_rows(done) == 2 == counter.of(done)
    finally:
        spark.streams.removeListener(counter)

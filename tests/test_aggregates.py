import datetime as dt

from pyspark.sql import functions as F

from tidewright.operators import aggregates as agg


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_word_counts(spark):
    df = spark.createDataFrame([("To be or\nnot to  be",)], "text string")
    assert rows(agg.word_counts(df, lower=True)) == [("be", 2), ("not", 1), ("or", 1), ("to", 2)]
    assert ("To", 1) in rows(agg.word_counts(df))


def test_log_traffic_groups_same_request(spark):
    line = '10.0.0.1 - "FRED" [18/Jan/2013:17:56:07 +1100] "GET /i.jpg HTTP/1.1" 304 {} "http://r/" "m"'
    df = spark.createDataFrame([(line.format(315),), (line.format(306),), ("broken",)], "value string")
    assert agg.log_traffic(df).orderBy(F.desc("n")).first()[2:] == ("GET /i.jpg HTTP/1.1", 2, 621)


def test_item_pages_are_bounded_and_whole(spark):
    df = spark.createDataFrame([(1, i) for i in range(25)] + [(1, 3), (2, 7)], "k int, i int")
    pages = agg.item_pages(df, "k", "i", span=10).collect()
    assert max(len(p["items"]) for p in pages) == 10
    assert sorted(i for p in pages if p["k"] == 1 for i in p["items"]) == list(range(25))


def test_day_curve_fills_gaps_but_not_the_future(spark):
    h = spark.createDataFrame([(dt.date(2024, 1, 1), 2, 5.0), (dt.date(2024, 1, 1), 5, 1.0)], "day date, hour int, total double")
    curve = [r["so_far"] for r in agg.day_curve(h).orderBy("hour").collect()]
    assert len(curve) == 24
    assert curve[:7] == [0.0, 0.0, 5.0, 5.0, 5.0, 6.0, 0.0] and not any(curve[6:])


def test_last_run_resets_at_a_gap(spark):
    days = [1, 2, 3, 5, 6, 7, 8, 9, 10, 11, 12, 13]
    df = spark.createDataFrame([("s", dt.date(2024, 1, d)) for d in days] + [("t", dt.date(2024, 1, 4))], "k string, day date")
    got = rows(agg.last_run(df, "day", ["k"]).select("k", F.dayofmonth("day"), "back"))
    assert got == [("s", 7 + i, 7 - i) for i in range(7)] + [("t", 4, 1)]


def test_status_shares_round_half_up(spark):
    df = spark.createDataFrame([("x", "a")] * 1 + [("x", "b")] * 7, "g string, s string")
    assert rows(agg.status_shares(df, ["g"], "s", ["a", "b", "c"])) == [("x", "a", 13), ("x", "b", 88), ("x", "c", 0)]


def test_vector_sum_and_share(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 4.0],)], "v array<double>")
    assert rows(agg.vector_sum(df, "v")) == [(0, 4.0), (1, 6.0)]
    s = spark.createDataFrame([(2.0,), (4.0,)], "v double")
    assert rows(agg.share_of_max(s, "v", "share")) == [(2.0, 0.5), (4.0, 1.0)]

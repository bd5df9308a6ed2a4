from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewright.operators import relational as rel

quick = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_bag_subtract_keeps_repeats_and_matches_nulls(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "a int, b string")
    b = spark.createDataFrame([(2, None), (3, "y")], "a int, b string")
    assert Counter(rows(rel.bag_subtract(a, b))) == Counter([(1, "x"), (1, "x"), (3, "z")])


@quick
@given(st.lists(st.integers(-50, 50), unique=True, min_size=1, max_size=40))
def test_running_totals_match_a_loop(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    got = dict(rows(rel.running_totals(df, [F.asc("k")], {"s": F.col("k")}, slices=3).select("k", "s")))
    total, want = 0, {}
    for k in sorted(keys):
        total += k
        want[k] = total
    assert got == want


def test_dense_index_by_text_and_number(spark):
    df = spark.createDataFrame([("b", 2), ("a", 9), ("b", 1), ("c", 0)], "t string, n int")
    got = rel.dense_index(df, F.asc("t"), F.desc("n"))
    assert sorted(rows(got.select("index", "t", "n"))) == [(0, "a", 9), (1, "b", 2), (2, "b", 1), (3, "c", 0)]


def test_key_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(2000)
    parts = rel.key_split(df, ["id"], [3, 1], seed=4)
    ids = [set(r.id for r in p.collect()) for p in parts]
    assert not ids[0] & ids[1] and len(ids[0] | ids[1]) == 2000
    assert 1350 < len(ids[0]) < 1650
    again = rel.key_split(df.repartition(7), ["id"], [3, 1], seed=4)
    assert [set(r.id for r in p.collect()) for p in again] == ids


def test_take_sample_sizes(spark):
    df = spark.range(50)
    assert len(set(rows(rel.take_sample(df, 20, seed=1)))) == 20
    assert rel.take_sample(df, 80, seed=1).count() == 50
    drawn = rows(rel.take_sample(df, 80, True, seed=1))
    assert len(drawn) == 80 and set(drawn) <= set(rows(df))


def test_top_n_each_and_max(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 5)], "g string, v int")
    assert sorted(rows(rel.top_n_each(df, 2, ["g"], F.desc("v")))) == [("a", 2, 2), ("a", 3, 1), ("b", 5, 1)]
    assert rows(rel.rows_at_max(df, "v")) == [("b", 5)]
    plan = rel.top_n_each(df, 2, ["g"], F.desc("v"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # also applied before the shuffle


def test_lookup_defaults_and_not_in(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(1, 7.0)], "k int, v double")
    assert Counter(rows(rel.lookup(df, dim, "k", {"v": 0.0}))) == Counter([(1, 7.0), (2, 0.0), (None, 0.0)])
    assert Counter(rows(rel.not_in(df, dim, ["k"]))) == Counter([(2,), (None,)])


def test_large_samples_and_equal_rows(spark):
    many = spark.range(300_000).select((F.col("id") % 3).alias("v"))
    got = rel.take_sample(many, 100_000, seed=4)
    assert got.count() == 100_000
    assert all(30_000 < r["count"] < 37_000 for r in got.groupBy("v").count().collect())
    assert rel.take_sample(spark.createDataFrame([(1,), (1,), (2,)], "v int"), 2).count() == 2


def test_many_rows_of_a_hot_group(spark):
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("g"), "id")
    got = rel.top_n_each(rows, 5000, ["g"], F.desc("id"))
    hot = got.filter("g = -1")
    assert hot.count() == 5000 and hot.agg(F.min("id")).first()[0] == 59_997 - 3 * 4999
    assert sorted(r["rank"] for r in hot.select("rank").collect()) == list(range(1, 5001))


def test_lookup_keeps_nulls_that_matched(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    dim = spark.createDataFrame([(1, None)], "k int, v int")
    assert sorted(map(tuple, rel.lookup(left, dim, "k", {"v": 9}).collect())) == [(1, None), (2, 9)]

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidewright.operators import models as md
from tidewright.operators import recommend as rc


def points(spark, rows):
    return spark.createDataFrame([(float(y), Vectors.dense(x)) for y, x in rows], ["label", "features"])


def test_bisecting_finds_four_pairs(spark):
    rows = [(0, (v, v)) for base in (0, 10, 20, 30) for v in (base + .1, base + .3)]
    m = md.bisecting_k_means(points(spark, rows), 4, seed=1)
    assert np.allclose(sorted(c[0] for c in m.clusterCenters()), [.2, 10.2, 20.2, 30.2])


def test_k_means_cost(spark):
    d = points(spark, [(0, (v, v, v)) for v in (0.0, 0.1, 0.2, 9.0, 9.1, 9.2)])
    m = md.k_means(d, 2, seed=1)
    assert np.allclose(sorted(c[0] for c in m.clusterCenters()), [0.1, 9.1])
    assert np.isclose(md.within_cost(m.transform(d), m.clusterCenters()).first()["cost"], 0.12)


def test_power_iteration_places_every_node(spark):
    # The start vector is random, so only the shape of the answer is certain.
    edges = spark.createDataFrame([(0, 1, .9), (1, 2, .9), (2, 3, .9), (3, 4, .1), (4, 5, .9)], "src long, dst long, similarity double")
    got = {r["id"]: r["cluster"] for r in md.power_iteration_groups(edges, 2, 20).collect()}
    assert got.keys() == set(range(6)) and set(got.values()) <= {0, 1}


def test_survival(spark):
    rows = [(1.218, 1.0, (1.560, -0.605)), (2.949, 0.0, (0.346, 2.158)), (3.627, 0.0, (1.380, 0.231)),
            (0.273, 1.0, (0.520, 1.151)), (4.199, 0.0, (0.795, -0.226))]
    d = spark.createDataFrame([(a, b, Vectors.dense(c)) for a, b, c in rows], ["label", "censor", "features"])
    for r in md.survival(d).transform(d).collect():
        assert 0 < r["quantiles"][0] < r["quantiles"][1]


def test_isotonic_equals_merging_by_hand(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (2, 3.0), (3, 2.0), (4, 5.0)], "x int, y double")
    m, pts = md.isotonic(df, "x", "y")
    got = [r["prediction"] for r in m.transform(pts).orderBy("feature").collect()]
    assert np.allclose(got, [1.0, 8 / 3, 8 / 3, 5.0])


def test_perceptron_and_trees_learn_a_rule(spark):
    rng = np.random.default_rng(0)
    rows = [(int(x > 0), (float(x), float(y))) for x, y in rng.normal(size=(120, 2))]
    d = points(spark, rows)
    for m in (md.tree_classifier(d), md.forest_classifier(d, seed=1), md.boosted_classifier(d, 3),
              md.margin_classifier(d, maxIter=20), md.perceptron(d, [2, 3, 2], rounds=60)):
        wrong = m.transform(d).filter("prediction <> label").count()
        assert wrong <= 6, m


def test_best_threshold_is_applied(spark):
    d = points(spark, [(0, (0.,)), (0, (1.,)), (0, (2.,)), (1, (1.5,)), (1, (3.,)), (0, (0.2,)), (0, (0.4,))])
    tuned, best = md.with_best_threshold(md.logistic(d, regParam=0.01), md.logistic(d, regParam=0.01).transform(d))
    tp = tuned.transform(d).filter("prediction = 1 AND label = 1").count()
    pred = tuned.transform(d).filter("prediction = 1").count()
    assert np.isclose(2 * tp / (pred + 2), best["f1"])


def test_later_parameter_maps_win(spark):
    d = points(spark, [(0, (0., 1.)), (1, (1., 0.)), (0, (.2, .9)), (1, (.9, .3))])
    lr = LogisticRegression(maxIter=10)
    m = md.fit_with(lr, d, {lr.maxIter: 20}, {lr.maxIter: 7, lr.probabilityCol: "chance"})
    assert md.settings_of(m)["maxIter"] == 7 and "chance" in m.transform(d).columns


def test_text_classifier_scores_new_rows(spark):
    train = spark.createDataFrame([(0, "good day good", 1.0), (1, "b d", 0.0), (2, "good f g", 1.0), (3, "bad fish", 0.0)],
                                  "id int, text string, label double")
    new = spark.createDataFrame([(4, "good g"), (5, "d fish")], "id int, text string")
    got = [r["prediction"] for r in md.text_classifier(train).transform(new).orderBy("id").collect()]
    assert got == [1.0, 0.0]


def test_recommendations(spark):
    block = [(u, i, 5.0 if (u + i) % 2 == 0 else 1.0) for u in range(1, 5) for i in range(1, 5)]
    df = spark.createDataFrame(block, "user int, item int, rating float")
    m = rc.fit_factors(df, rank=4, rounds=15, reg=0.01, blocks=2, seed=1)
    assert rc.rmse(m, df) < 0.3
    items = spark.createDataFrame([(i,) for i in range(1, 7)], "item int")
    assert {r["item"] for r in rc.unrated(items, df, 1).collect()} == {5, 6}
    titles = items.select("item", F.concat(F.lit("movie "), "item").alias("title"))
    found = {r["item"]: r["prediction"] for r in rc.search_titles(m, titles, "movie", 1).collect()}
    assert found[6] is None and found[1] is not None
    guess = items.select("item", F.lit(1.0).alias("prediction"))
    counts = spark.createDataFrame([(1, 30), (2, 24), (3, 25)], "item int, ratings long")
    assert [r["item"] for r in rc.report(guess, titles, counts).collect()] == [1, 3]


def test_a_constant_guess_is_not_better_than_itself(spark):
    from tidewright.catalog.models import constant_error, held_out

    df = spark.createDataFrame([(float(i % 5 == 0),) for i in range(100)], "label double")

    class Constant:
        def transform(self, rows):
            return rows.withColumn("prediction", F.lit(0.0))

    class Perfect:
        def transform(self, rows):
            return rows.withColumn("prediction", F.col("label"))

    assert abs(spark.range(1).select(constant_error(df)).first()[0] - 0.2) < 1e-12
    assert held_out(Constant(), df, df).collect()[0][:] == (200, False)
    assert held_out(Perfect(), df, df).collect()[0][:] == (200, True)

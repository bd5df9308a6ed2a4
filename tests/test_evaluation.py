import math

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, MulticlassClassificationEvaluator, MultilabelClassificationEvaluator,
    RankingEvaluator, RegressionEvaluator,
)
from pyspark.sql import functions as F

from tidewright.operators import evaluation as ev

SETS = [([0.0, 1.0], [0.0, 2.0]), ([0.0, 2.0], [0.0, 1.0]), ([2.0], [2.0]), ([2.0, 0.0], [2.0, 0.0]),
        ([0.0, 1.0, 2.0], [0.0, 1.0]), ([1.0], [1.0, 2.0])]


def close(a, b):
    return math.isclose(a, b, abs_tol=1e-6)


def test_label_sets(spark):
    df = spark.createDataFrame(SETS, "prediction array<double>, label array<double>")
    got = ev.label_set_measures(df).first().asDict()
    want = {"precision": .777778, "recall": .75, "f1": .744444, "accuracy": .638889, "micro_f1": .727273,
            "hamming_loss": .333333, "subset_accuracy": .333333}
    assert all(close(got[k], v) for k, v in want.items())
    names = {"precision": "precision", "recall": "recall", "f1": "f1Measure", "accuracy": "accuracy",
             "micro_precision": "microPrecision", "micro_recall": "microRecall", "micro_f1": "microF1Measure",
             "hamming_loss": "hammingLoss", "subset_accuracy": "subsetAccuracy"}
    for mine, theirs in names.items():
        assert close(got[mine], MultilabelClassificationEvaluator(metricName=theirs).evaluate(df)), mine
    for r in ev.label_set_measures_by_label(df).collect():
        e = MultilabelClassificationEvaluator(metricLabel=r["class"])
        assert close(r["precision"], e.setMetricName("precisionByLabel").evaluate(df))
        assert close(r["recall"], e.setMetricName("recallByLabel").evaluate(df))


def scores(spark):
    data = [(0.9, 1.0), (0.8, 1.0), (0.8, 0.0), (0.7, 1.0), (0.5, 0.0), (0.4, 1.0), (0.2, 0.0), (0.2, 0.0)]
    return spark.createDataFrame(data, "rawPrediction double, label double")


def test_two_class_curves(spark):
    df = scores(spark)
    counts = ev.threshold_counts(df, "rawPrediction", "label")
    assert close(ev.area_under_roc(counts).first()["auc"], BinaryClassificationEvaluator().evaluate(df))
    pr = {r["threshold"]: r for r in ev.precision_recall(counts).collect()}
    assert close(pr[0.8]["precision"], 2 / 3) and close(pr[0.8]["recall"], 0.5)
    assert close(pr[0.2]["recall"], 1.0) and len(pr) == 6
    assert close(ev.best_threshold(counts).first()["f1"], max(r["f1"] for r in pr.values()))
    assert {(r["fpr"], r["tpr"]) for r in ev.roc(counts).collect()} >= {(0.0, 0.25), (1.0, 1.0)}


def test_several_classes(spark):
    pairs = [(0, 0)] * 4 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(2, 1)] + [(2, 2)] * 5 + [(1, 3)]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")
    got = ev.overall_measures(ev.confusion(df)).first()
    for mine, theirs in {"accuracy": "accuracy", "weighted_precision": "weightedPrecision", "weighted_recall": "weightedRecall",
                         "weighted_f1": "weightedFMeasure", "weighted_fpr": "weightedFalsePositiveRate"}.items():
        assert close(got[mine], MulticlassClassificationEvaluator(metricName=theirs).evaluate(df)), mine
    assert close(ev.accuracy(df).first()["test_error"], 4 / 16)


@pytest.mark.parametrize("k", [1, 3, 5])
def test_rankings(spark, k):
    data = [("u", [1, 6, 2, 7, 8], [1, 2, 3]), ("v", [4, 1], [9, 1, 4, 5]), ("w", [1, 2], [7])]
    lists = spark.createDataFrame(data, "user string, prediction array<int>, label array<int>").select(
        "user", *[F.col(c).cast("array<double>").alias(c) for c in ("prediction", "label")])
    predicted = lists.select("user", F.posexplode("prediction").alias("pos", "item"))
    actual = lists.select("user", F.explode("label").alias("item"))
    got = {r["measure"]: r["value"] for r in ev.ranking_measures(predicted, actual, [k]).collect()}
    for mine, theirs in {f"precision_at_{k}": "precisionAtK", f"ndcg_at_{k}": "ndcgAtK",
                         "mean_average_precision": "meanAveragePrecision"}.items():
        assert close(got[mine], RankingEvaluator(metricName=theirs, k=k).evaluate(lists)), mine


def test_ranking_counts_only_users_on_both_sides(spark):
    predicted = spark.createDataFrame([("u", 0, 1), ("x", 0, 1)], "user string, pos int, item int")
    actual = spark.createDataFrame([("u", 1), ("y", 2)], "user string, item int")
    got = {r["measure"]: r["value"] for r in ev.ranking_measures(predicted, actual, [1]).collect()}
    assert got["precision_at_1"] == 1.0


def test_regression(spark):
    df = spark.createDataFrame([(3.0, 2.5), (-0.5, 0.0), (2.0, 2.0), (7.0, 8.0)], "label double, prediction double")
    got = ev.regression_measures(df).first()
    for mine, theirs in {"mse": "mse", "rmse": "rmse", "mae": "mae", "r2": "r2", "explained_variance": "var"}.items():
        assert close(got[mine], RegressionEvaluator(metricName=theirs).evaluate(df)), mine

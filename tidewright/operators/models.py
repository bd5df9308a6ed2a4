"""Fitted models: tables of (label, features) in, a model out. Scoring is `model.transform`."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel, classification, clustering, regression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import HashingTF, IndexToString, StringIndexer, Tokenizer, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.mllib.clustering import KMeansModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators.evaluation import best_threshold, threshold_counts
from tidewright.session import shared_dir


def spread(df: DataFrame, rows_each: int = 500_000) -> DataFrame:
    """The same rows in even partitions of at most so many: every round of a fit reads whole partitions as they were cached, which
    follow the layout of the files otherwise."""
    parts = -(-df.count() // rows_each)
    return df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism))


# ---- classes --------------------------------------------------------------------------


def logistic(df: DataFrame, **params):
    """Logistic regression by L-BFGS, two or more classes.

    maxIter, tol, regParam and elasticNetParam steer it; `probability` is the raw score.
    """
    return classification.LogisticRegression(**params).fit(df)


def with_best_threshold(model, scored: DataFrame, label: str = "label"):
    """Set a two-class model to the threshold of highest f1 on a scored table."""
    s = scored.select(F.get(vector_to_array("probability"), 1).alias("score"), label)
    row = best_threshold(threshold_counts(s, "score", label)).first()
    # A row belongs to class 1 above the threshold; at the border it must still count.
    return model.copy({model.threshold: max(0.0, row["threshold"] - 1e-12)}), row


def margin_classifier(df: DataFrame, **params):
    """Linear support vector machine; `rawPrediction` is the score without a threshold."""
    return classification.LinearSVC(**params).fit(df)


def naive_bayes(df: DataFrame, smoothing: float = 1.0, kind: str = "multinomial"):
    return classification.NaiveBayes(smoothing=smoothing, modelType=kind).fit(df)


def tree_classifier(df: DataFrame, **params):
    return classification.DecisionTreeClassifier(**{"impurity": "gini", "maxDepth": 5, "maxBins": 32, **params}).fit(df)


def forest_classifier(df: DataFrame, trees: int = 3, seed: int = 0, **params):
    return classification.RandomForestClassifier(numTrees=trees, featureSubsetStrategy="auto", seed=seed, **params).fit(df)


def boosted_classifier(df: DataFrame, rounds: int = 3, **params):
    shared_dir(df.sparkSession)  # long fits checkpoint there
    return classification.GBTClassifier(**{"maxIter": rounds, "maxDepth": 5, **params}).fit(spread(df))


def perceptron(df: DataFrame, layers: Sequence[int], block: int = 128, seed: int = 1234, rounds: int = 100):
    return classification.MultilayerPerceptronClassifier(
        layers=list(layers), blockSize=block, seed=seed, maxIter=rounds).fit(spread(df))


# ---- numbers --------------------------------------------------------------------------


def linear(df: DataFrame, **params):
    """Linear regression; `summary` holds objective history, residuals, rmse and r2."""
    return regression.LinearRegression(**params).fit(df)


def shifted(scored: DataFrame, delta: float) -> DataFrame:
    """Predictions moved by a constant."""
    return scored.withColumn("prediction", F.col("prediction") + F.lit(float(delta)))


def survival(df: DataFrame, censor: str = "censor", quantiles: Sequence[float] = (0.3, 0.6)):
    """Accelerated failure time model with the given survival quantiles."""
    return regression.AFTSurvivalRegression(censorCol=censor, quantileProbabilities=list(quantiles),
                                            quantilesCol="quantiles").fit(df)


def tree_regressor(df: DataFrame, **params):
    return regression.DecisionTreeRegressor(**{"impurity": "variance", "maxDepth": 5, "maxBins": 32, **params}).fit(df)


def forest_regressor(df: DataFrame, trees: int = 3, seed: int = 0, **params):
    return regression.RandomForestRegressor(numTrees=trees, featureSubsetStrategy="auto", seed=seed, **params).fit(df)


def boosted_regressor(df: DataFrame, rounds: int = 3, **params):
    shared_dir(df.sparkSession)
    return regression.GBTRegressor(**{"maxIter": rounds, "maxDepth": 5, **params}).fit(df)


def isotonic(df: DataFrame, feature: str, label: str, increasing: bool = True):
    """Monotone fit. Rows are first averaged per feature value, with their number as the
    weight: the same solution, and the last merging step sees distinct values only."""
    points = df.groupBy(F.col(feature).cast("double").alias("feature")).agg(
        F.avg(label).alias("label"), F.count("*").cast("double").alias("weight"))
    model = regression.IsotonicRegression(featuresCol="feature", weightCol="weight", isotonic=increasing).fit(points)
    return model, points


# ---- groups ---------------------------------------------------------------------------


def k_means(df: DataFrame, k: int, rounds: int = 20, seed: int = 0, **params):
    return clustering.KMeans(k=k, maxIter=rounds, seed=seed, initMode="k-means||", **params).fit(df)


def bisecting_k_means(df: DataFrame, k: int, seed: int = 0, **params):
    return clustering.BisectingKMeans(k=k, seed=seed, **params).fit(df)


def within_cost(scored: DataFrame, centers: Sequence[Sequence[float]], features: str = "features") -> DataFrame:
    """Sum of squared distances to the assigned centre; the centres join as a table of k rows."""
    table = scored.sparkSession.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(centers)], "prediction int, _center array<double>")
    square = F.aggregate(F.zip_with(vector_to_array(features), "_center", lambda a, b: (a - b) * (a - b)),
                         F.lit(0.0), lambda acc, x: acc + x)
    return scored.join(table, "prediction").agg(F.sum(square).alias("cost"))


def cost_by_distances(df: DataFrame, centers: Sequence[Sequence[float]], features: str = "features") -> float:
    """Sum of squared distances to the nearest centre, as `pyspark.mllib` adds it up; a model's own assignments play no part."""
    return KMeansModel(list(centers)).computeCost(df.select(features).rdd.map(lambda row: row[0].toArray()))


def topics(df: DataFrame, k: int, rounds: int = 10, seed: int = 0, **params):
    shared_dir(df.sparkSession)
    return clustering.LDA(k=k, maxIter=rounds, seed=seed, **params).fit(df)


def power_iteration_groups(edges: DataFrame, k: int, rounds: int = 20) -> DataFrame:
    """(id, cluster) of the nodes of an undirected graph (src, dst, similarity)."""
    return clustering.PowerIterationClustering(k=k, maxIter=rounds, weightCol="similarity").assignClusters(edges)


# ---- stages and tuning ----------------------------------------------------------------


def text_classifier(df: DataFrame, text: str = "text", features: int = 1000, rounds: int = 10,
                    reg: float = 0.001) -> PipelineModel:
    """Tokens, hashed counts, logistic regression; scores unlabelled rows as well."""
    return Pipeline(stages=[
        Tokenizer(inputCol=text, outputCol="words"),
        HashingTF(inputCol="words", outputCol="features", numFeatures=features),
        classification.LogisticRegression(maxIter=rounds, regParam=reg)]).fit(df)


def with_label_names(df: DataFrame, estimator: Estimator, label: str, features: str = "features",
                     max_categories: int = 4) -> PipelineModel:
    """Index labels and categorical components, fit, and turn predictions back into labels.

    The fitted stages are `model.stages[0..3]`: labels, components, the model, the names.
    """
    labels = StringIndexer(inputCol=label, outputCol="_label", handleInvalid="keep").fit(df)
    parts = VectorIndexer(inputCol=features, outputCol="_features", maxCategories=max_categories,
                          handleInvalid="keep")
    fit = estimator.copy({estimator.labelCol: "_label", estimator.featuresCol: "_features"})
    back = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=labels.labels)
    return Pipeline(stages=[labels, parts, fit, back]).fit(df)


def settings_of(stage) -> dict[str, object]:
    """All parameters of a stage by name, defaults included."""
    return {p.name: v for p, v in stage.extractParamMap().items()}


def fit_with(estimator: Estimator, df: DataFrame, *overrides: Mapping):
    """Fit with parameter maps; later maps win."""
    merged = {}
    for m in overrides:
        merged.update(m)
    return estimator.fit(df, merged)


def search(estimator: Estimator, df: DataFrame, grid: Mapping, evaluator: Evaluator, train: float = 0.8,
           seed: int = 0, parallelism: int = 2):
    """Grid search with one train/validation split; `bestModel` is fitted on all rows."""
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(param, list(values))
    return TrainValidationSplit(estimator=estimator, estimatorParamMaps=builder.build(), evaluator=evaluator,
                                trainRatio=train, seed=seed, parallelism=parallelism).fit(df)

"""Sales forecast: a model of daily units from price and date, set against live days."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.operators.features import price_features
from tidewright.streaming.sales import day_totals, with_dates


def daily_training(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """(date, values, units, price): sums per date; price is the mean price of a unit.

    Sales are summed per date before the date inputs are joined, so the join is small.
    """
    sums = sales.groupBy("date").agg(F.sum("units").alias("units"), F.sum("price").alias("total"))
    return with_dates(sums, dates).select("date", "values", "units", (F.col("total") / F.col("units")).alias("price"))


def top_price(days: DataFrame) -> float:
    return days.agg(F.max("price")).first()[0]


def train(days: DataFrame, highest: float, **params) -> LinearRegressionModel:
    points = price_features(days, F.col("price"), F.col("units"), F.lit(highest), "values")
    return LinearRegression(**{"solver": "normal", **params}).fit(points)


def forecast(days: DataFrame, model: LinearRegressionModel, highest: float) -> DataFrame:
    """Add `predicted` units to rows with price and date values; streams as well."""
    points = price_features(days.withColumn("_u", F.lit(0.0)), F.col("price"), F.col("_u"), F.lit(highest), "values")
    return (model.transform(points).withColumn("predicted", F.exp("prediction") - 1)
            .drop("_u", "label", "features", "prediction"))


def live_forecast(sales: DataFrame, days: DataFrame, model: LinearRegressionModel, highest: float) -> DataFrame:
    """Actual and predicted units of every finished day of a sales stream.

    days: (date, values, price), date inputs and usual price, one small row per date. Read it
    from a saved table: the static side is evaluated again in every batch.
    """
    live = day_totals(sales).select(F.col("day").alias("date"), F.col("units").alias("actual"), "n")
    return forecast(with_dates(live, days), model, highest)

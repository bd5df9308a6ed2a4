"""Live sales: enrichment with date inputs, hourly and daily totals, scoring of finished days."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.streaming.windows import daily, hourly


def with_dates(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """Join sales to the inputs of their date; sales of unknown dates drop out."""
    return sales.join(dates, "date")


def hour_totals(sales: DataFrame, ts: str = "time", **window) -> DataFrame:
    return hourly(sales, ts, [F.sum("units").alias("total"), F.count("*").alias("n")], **window)


def day_totals(sales: DataFrame, ts: str = "time", **window) -> DataFrame:
    return daily(sales, ts, [F.sum("units").alias("units"), F.sum("price").alias("price"),
                             F.count("*").alias("n")], **window)


def scored(sales: DataFrame, dates: DataFrame, model: PipelineModel) -> DataFrame:
    """Sales with their date inputs and the model's prediction, row by row as they come."""
    return model.transform(with_dates(sales, dates))

"""Windowed aggregates. Each function takes a streaming or a batch table alike: the batch
form is the twin that gives the same rows for complete windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.fixed import FLIGHT_WINDOW
from tidewright.plans.flights import STATES


def _marked(df: DataFrame, ts: str, lateness: str) -> DataFrame:
    return df.withWatermark(ts, lateness) if df.isStreaming else df


def sliding(df: DataFrame, ts: str, aggs: Sequence[Column], by: Sequence[str] = (), length: str = FLIGHT_WINDOW,
            slide: str = "1 minute", lateness: str = "10 minutes") -> DataFrame:
    """Aggregates per sliding window and key, as rows (start, end, keys, aggregates).

    A row counts in length/slide windows; a slide of a few seconds multiplies the work.
    """
    w = _marked(df, ts, lateness).groupBy(F.window(ts, length, slide).alias("w"), *by).agg(*aggs)
    return w.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *w.columns[1:])


def delay_windows(placed: DataFrame, ts: str = "ts", by: Sequence[str] = ("origin",), **window) -> DataFrame:
    """Delay shares in percent per window, airport and direction; `placed` has region and status."""
    counts = [F.count("*").alias("flights"), *[F.count_if(F.col("status") == s).alias(s) for s in STATES]]
    w = sliding(placed, ts, counts, [*by, "region"], **window)
    return w.select("start", "end", *by, "region", "flights", *[
        F.round(F.col(s) / F.col("flights") * 100).cast("int").alias(s) for s in STATES])


def daily(df: DataFrame, ts: str, aggs: Sequence[Column], by: Sequence[str] = (),
          lateness: str = "10 minutes") -> DataFrame:
    """One row per finished day: a stream emits it once the watermark has passed midnight."""
    w = _marked(df, ts, lateness).groupBy(F.window(ts, "1 day").alias("w"), *by).agg(*aggs)
    return w.select(F.to_date("w.start").alias("day"), *w.columns[1:])


def hourly(df: DataFrame, ts: str, aggs: Sequence[Column], by: Sequence[str] = (),
           lateness: str = "1 hour") -> DataFrame:
    """Totals per hour, re-emitted as they grow when run in update mode."""
    w = _marked(df, ts, lateness).groupBy(F.window(ts, "1 hour").alias("w"), *by).agg(*aggs)
    return w.select(F.to_date("w.start").alias("day"), F.hour("w.start").alias("hour"), *w.columns[1:])

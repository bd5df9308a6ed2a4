"""Grouped and global aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.functions.columns import access_log, day_key


def word_rows(df: DataFrame, text: str = "text", lower: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """One row per word. Split, explode and filter run as generated code, unlike the
    array form `words`, whose lambda is interpreted."""
    c = F.lower(text) if lower else F.col(text)
    blanks = F.translate(c, "\r\n", "  ")
    return df.select(*keep, F.explode(F.split(blanks, " ")).alias("word")).filter(
        F.btrim("word", F.lit(" \t\n\f\r")) != "")


def word_counts(df: DataFrame, text: str = "text", lower: bool = False) -> DataFrame:
    """Occurrences of every word; counted map-side before the shuffle."""
    return word_rows(df, text, lower).groupBy("word").agg(F.count("*").alias("n"))


def log_traffic(lines: DataFrame, line: str = "value") -> DataFrame:
    """Hits and bytes per (ip, user, query); unreadable and anonymous lines share the null key."""
    parsed = lines.select(access_log(F.col(line)).alias("e")).select("e.*")
    return parsed.groupBy("ip", "user", "query").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes"))


def count_and_mean(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))


def means_by(df: DataFrame, by: str, measures: Sequence[str]) -> DataFrame:
    return df.groupBy(by).agg(*[F.avg(m).alias(f"avg_{m}") for m in measures])


def item_pages(df: DataFrame, key: str, item: str, span: int = 1000) -> DataFrame:
    """Distinct items of every key as sorted lists, cut into pages of a bounded size.

    A page holds the items of one stretch of `span` whole-numbered ids, so no list outgrows
    `span` and a key that owns a third of all rows is spread over many pages. The pages of
    a key together hold all its items.
    """
    pairs = df.select(key, item, F.floor(F.col(item) / span).alias("page"))
    return pairs.groupBy(key, "page").agg(F.sort_array(F.collect_set(item)).alias("items"))


def vector_sum(df: DataFrame, vector: str) -> DataFrame:
    """Element-wise sum of an array column as rows (pos, total): one vector per task is sent on, not one row per component."""
    added = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("v")).agg(
        Summarizer.sum(F.col("v")).alias("v"))
    return added.select(F.posexplode(vector_to_array("v")).alias("pos", "total"))


def share_of_max(df: DataFrame, value: str, name: str) -> DataFrame:
    """`value` divided by its maximum over the table, through a one-value subquery."""
    return df.withColumn(name, F.col(value) / df.select(F.max(value)).scalar())


def status_shares(df: DataFrame, by: Sequence[str], status: str,
                  states: Sequence[str]) -> DataFrame:
    """Rows (by, status, pct): the rounded percentage of every status in each group."""
    counts = df.groupBy(*by).agg(
        F.count("*").alias("_all"),
        *[F.count_if(F.col(status) == s).alias(s) for s in states])
    shares = counts.select(*by, *[
        F.round(F.col(s) / F.col("_all") * 100).cast("int").alias(s) for s in states])
    return shares.unpivot(list(by), list(states), "status", "pct")


def fraction(condition: Column) -> Column:
    """Share of rows for which the condition holds."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def root_mean_square(a: Column, b: Column) -> Column:
    return F.sqrt(F.avg(F.pow(a - b, 2)))


# ---- the day so far -------------------------------------------------------------------


def hourly_totals(df: DataFrame, ts: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Sum of `value` per day and hour."""
    return df.groupBy(*by, F.to_date(ts).alias("day"), F.hour(ts).alias("hour")).agg(
        F.sum(value).alias("total"), F.count("*").alias("n"))


def day_curve(hourly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """24 rows per day with the running total of the day; an empty hour keeps the last value.

    Hours after the last sale of a day stay 0, as they have not been reached yet. Input is
    the table of `hourly_totals`, one row per hour, and is read once: a day gathers its at
    most 24 hours in a map, and every window holds 24 rows.
    """
    keys = [*by, "day"]
    hours = F.map_from_entries(F.collect_list(F.struct("hour", F.col("total").cast("double"))))
    slots = (hourly.groupBy(*keys).agg(F.max("hour").alias("_last"), hours.alias("_hours"))
             .withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23)))))
    upto = Window.partitionBy(*keys).orderBy("hour").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    here = F.coalesce(F.try_element_at("_hours", F.col("hour")), F.lit(0.0))
    return slots.withColumn("_running", F.sum(here).over(upto)).select(
        *keys, "hour", F.when(F.col("hour") <= F.col("_last"), F.col("_running")).otherwise(0.0).alias("so_far"))


def last_run(daily: DataFrame, day: str, series: Sequence[str] = (), keep: int = 7) -> DataFrame:
    """For each series, the points of its latest unbroken run of days, at most `keep`.

    A gap of more than one day starts a new run. Input has one row per day and series.
    """
    ordered = Window.partitionBy(*series).orderBy(day)
    gap = F.datediff(F.col(day), F.lag(day).over(ordered))
    runs = (daily.withColumn("_new", F.when(gap == 1, 0).otherwise(1))
            .withColumn("run", F.sum("_new").over(ordered)).drop("_new"))
    latest = Window.partitionBy(*series).orderBy(F.desc(day))
    return (runs.withColumn("_newest", F.max("run").over(Window.partitionBy(*series)))
            .filter("run = _newest")
            .withColumn("back", F.row_number().over(latest))
            .filter(F.col("back") <= keep).drop("_newest"))


def daily_sales(df: DataFrame, ts: str, units: str, price: str) -> DataFrame:
    """Units and prices summed per day, keyed by date text."""
    return df.groupBy(day_key(F.col(ts)).alias("day")).agg(
        F.sum(units).alias("units"), F.sum(price).alias("price"))

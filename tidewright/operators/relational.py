"""Joins, set operations, top-k, sampling and indexing where Spark has no one-word answer."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.session import Scratch, settle

# ---- joins ----------------------------------------------------------------------------


def lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str],
           defaults: dict[str, object]) -> DataFrame:
    """Left join that fills the columns of `dim` with `defaults` where no row matches. A null that
    stands in a matching row stays.

    No broadcast hint: Spark broadcasts `dim` while its size is under
    `spark.sql.autoBroadcastJoinThreshold`, and shuffles (with skew splits) beyond it.
    """
    joined = df.join(dim.withColumn("_matched", F.lit(True)), on, "left")
    return joined.select(*[
        F.when(F.col("_matched"), F.col(c)).otherwise(F.lit(defaults[c])).alias(c) if c in defaults else F.col(c)
        for c in joined.columns if c != "_matched"])


def not_in(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of `df` whose key is absent from `other` (null never matches)."""
    return df.join(other.select(*on), list(on), "left_anti")


# ---- sets -----------------------------------------------------------------------------


def bag_subtract(df: DataFrame, other: DataFrame) -> DataFrame:
    """Rows of `df` that do not occur in `other`; repeated rows of `df` all stay.

    `subtract` would drop the repeats, `exceptAll` would cancel them one by one.
    Nulls compare equal, as in any set operation.
    """
    left, right = df.alias("l"), other.alias("r")
    same = reduce(lambda a, b: a & b,
                  [F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in df.columns])
    return left.join(right, same, "left_anti")


# ---- top-k ----------------------------------------------------------------------------


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows by `order`, for reports: every task keeps its best n and one task merges them, so n
    should be a number of rows that a reader looks at. For large n, filter a `dense_index`."""
    return df.orderBy(*order).limit(n)


def top_n_each(df: DataFrame, n: int, by: Sequence[str], *order: Column,
               rank: str = "rank", lanes: int = 32) -> DataFrame:
    """The first n rows of every group, numbered from 1. `order` should be unique within a group.

    Up to `spark.sql.optimizer.windowGroupLimitThreshold` rows, Spark itself drops what can't be among the
    first n before the shuffle. Beyond it, each group is first ranked in `lanes` parts, so a group of a third of
    all rows is sorted by many tasks and at most n rows of each part meet in one.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        parts = df.withColumn("_lane", F.pmod(F.xxhash64(*df.columns), F.lit(lanes)))
        inside = Window.partitionBy(*by, "_lane").orderBy(*order)
        df = parts.withColumn("_rank", F.row_number().over(inside)).filter(F.col("_rank") <= n).drop("_lane", "_rank")
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def rows_at_max(df: DataFrame, metric: str) -> DataFrame:
    """All rows that reach the maximum of `metric` (two scans, no sort)."""
    best = df.select(F.max(metric)).scalar()
    return df.filter(F.col(metric) == best)


# ---- running totals without a one-task window -----------------------------------------


def running_totals(df: DataFrame, order: Sequence[Column], totals: dict[str, Column],
                   slices: int | None = None, scratch: Scratch | None = None) -> DataFrame:
    """Cumulative sums over the whole table in the given order, computed in parallel.

    The table is range-partitioned by `order` and pinned by a checkpoint (range bounds are
    sampled, so they must not be drawn twice). Sums inside each slice are ordinary windows;
    each slice then adds the total of the slices before it. Order keys should be unique:
    aggregate first, which also removes hot keys. `scratch` removes the written table when it closes.
    """
    spark = df.sparkSession
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pinned = (scratch or Scratch(spark)).settle(df.repartitionByRange(n, *order).withColumn("_slice", F.spark_partition_id()))
    per_slice = pinned.groupBy("_slice").agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in totals.items()])
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice, so this ordered window is bounded by the slice count.
    offsets = per_slice.select("_slice", *[
        F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)).alias(f"_before_{k}") for k in totals])
    inside = (Window.partitionBy("_slice").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (pinned.join(offsets, "_slice")
            .select(*df.columns, *[
                (F.sum(v).over(inside) + F.col(f"_before_{k}")).alias(k) for k, v in totals.items()]))


def dense_index(df: DataFrame, *order: Column, name: str = "index") -> DataFrame:
    """Number the rows 0..n-1 in the given (unique) order, without gaps."""
    numbered = running_totals(df, order, {"_upto": F.lit(1)})
    return numbered.withColumn(name, F.col("_upto") - 1).drop("_upto")


# ---- sampling -------------------------------------------------------------------------


def key_split(df: DataFrame, key: Sequence[str], weights: Sequence[float],
              seed: int = 0) -> list[DataFrame]:
    """Disjoint parts that cover the table, drawn by a hash of the key.

    Unlike `randomSplit` the parts do not depend on partitioning, row order or retries.
    """
    total = float(sum(weights))
    place = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1_000_000)) / 1_000_000
    parts, low = [], 0.0
    for i, weight in enumerate(weights):
        high = 1.0 if i == len(weights) - 1 else low + weight / total
        parts.append(df.filter((place >= low) & (place < high)))
        low = high
    return parts


def take_sample(df: DataFrame, n: int, with_replacement: bool = False, seed: int = 0,
                key: Sequence[str] | None = None) -> DataFrame:
    """Exactly n sampled rows (all rows if there are fewer and none may repeat).

    Rows stand in the order of a hash of `key`; without one, of all columns and of the number of the row among its
    equals, so that equal rows are drawn apart. Without replacement: the first n. With replacement: n drawn
    positions joined to the numbered table; the draws are grouped first, so a position drawn often is joined once.
    Positions come from ranges, whatever n is; nothing is gathered in one task.
    """
    rows, names = df, list(key or df.columns)
    if key is None:
        rows = df.groupBy(*df.columns).agg(F.count("*").alias("_equal")).select(
            *df.columns, F.explode(F.sequence(F.lit(1), F.col("_equal").cast("int"))).alias("_same"))
        names = [*names, "_same"]
    numbered = dense_index(rows.withColumn("_mark", F.xxhash64(F.lit(seed), *names)), F.col("_mark"),
                           *map(F.col, names), name="_at").drop("_mark", "_same")
    if not with_replacement:
        return numbered.filter(F.col("_at") < n).drop("_at")
    size = numbered.count()
    if size == 0:
        return numbered.drop("_at")
    draws = (df.sparkSession.range(n)
             .select(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(size)).alias("_at")).groupBy("_at").count())
    return (numbered.join(draws, "_at")
            .select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("count"))).alias("_copy"))
            .drop("_copy"))

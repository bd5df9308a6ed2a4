"""Mixing sources to target weights by entropy balancing, in DataFrame operations only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.llm.common import word_count
from tidewright.session import Scratch

#: Rates are rounded to this part of a copy, so that their sums are whole numbers and the
#: same in any order.
UNIT = 1 << 20
OFFSETS = 16


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code point order, null last, weigh `weights`, repeating. They share the total
    size by weight; a target stops at `most` times its source's size, and what is left over is
    shared again by weight among the others. In order of most * size / weight the sources that
    stop are a prefix, so running sums over one row per source give the end state directly.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod(turn, F.lit(len(weights))))
    named = sizes.select("source", "source_size", weight.alias("w"),
                         (F.col("source_size") * most).alias("cap"))
    order = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = named.select("*", *[
        F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("w", "cap")], *[
        F.sum(c).over(everything).alias(f"{c}_all") for c in ("w", "source_size")])
    room = F.col("source_size_all") - F.col("cap_before")
    stopped = ranked.withColumn("stops", F.col("cap").cast("double") * (F.col("w_all") - F.col("w_before"))
                                <= room.cast("double") * F.col("w"))
    cap_sum = F.sum(F.when(F.col("stops"), F.col("cap")).otherwise(0)).over(everything)
    w_sum = F.sum(F.when(F.col("stops"), F.col("w")).otherwise(0)).over(everything)
    shared = (F.col("source_size_all") - cap_sum).cast("double") * F.col("w") / (F.col("w_all") - w_sum)
    return stopped.select("source", "source_size", F.when(F.col("stops"), F.col("cap").cast("double"))
                          .otherwise(shared).alias("target"))


def tilts(hist: DataFrame, goals: DataFrame, scratch: Scratch, most: int, rounds: int = 40,
          tolerance: float = 1e-7) -> DataFrame:
    """(source, tilt): the dual variable of every source, with rate = min(most, exp(tilt * size / mean)).

    These rates are the ones nearest to 1 in relative entropy over documents whose expected
    words meet the target and that no document exceeds. The dual is convex and splits by source;
    each round is one aggregate over the (source, size, n) counts for value and slope of all
    constraints at once, and one Newton step on their logarithm for each source. A step that
    leaves the interval known to hold the root is replaced by its middle.
    """
    usable = goals.filter("target > 0 AND source_size > 0")
    per = hist.filter("size > 0").groupBy("source").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.min("size").alias("least"))
    same = F.col("g.source").eqNullSafe(F.col("p.source"))
    steep = F.col("mean") / F.col("least")
    ratio = F.log(F.col("target") / F.col("source_size"))
    full = F.col("target") >= most * F.col("source_size")
    state = scratch.settle(usable.alias("g").join(per.alias("p"), same).select(
        "g.source", "target", "mean", full.alias("done"),
        F.when(full, F.lit(math.log(most)) * steep).otherwise(0.0).alias("tilt"),
        F.least(ratio * steep, F.lit(0.0)).alias("low"),
        F.when(ratio > 0, F.lit(math.log(most)) * steep).otherwise(0.0).alias("high")))
    for _ in range(rounds):
        z = F.col("size") / F.col("mean")
        rate = F.exp(F.least(F.col("tilt") * z, F.lit(math.log(most))))
        exact = lambda c: F.sum(c.cast("decimal(38,9)")).cast("double")  # noqa: E731  in any order the same
        words = F.col("size") * F.col("n") * rate
        open_ = state.filter("NOT done").alias("g").join(
            hist.filter("size > 0").alias("p"), same).select("g.*", "size", "n")
        sums = open_.groupBy(F.col("source").alias("of")).agg(
            exact(words).alias("value"),
            exact(F.when(F.col("tilt") * z < math.log(most), words * z).otherwise(0.0)).alias("slope"))
        off = F.log(F.col("value") / F.col("target"))
        low = F.when(off < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - off * F.col("value") / F.col("slope")
        step = F.when((newton > low) & (newton < high), newton).otherwise((low + high) / 2)
        near = F.abs(off) < tolerance
        moved = state.join(sums, state["source"].eqNullSafe(sums["of"]), "left").select(
            "source", "target", "mean", (F.col("done") | near).alias("done"),
            F.when(F.col("done") | near, F.col("tilt")).otherwise(step).alias("tilt"),
            F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"),
            F.when(F.col("done"), F.col("high")).otherwise(high).alias("high"))
        old, state = state, scratch.settle(moved)
        scratch.drop(old)
        if state.filter("NOT done").isEmpty():
            break
    return state.select("source", "tilt", "mean")


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3, key: str = "doc_id",
        source: str = "source", text: str = "text", size: Column | None = None) -> DataFrame:
    """Per row of `docs`: key, size (words), source, source_size, target, rate, copies, taken.

    Rates from `tilts` become whole copies by systematic rounding: rows of a source stand in
    order of size, and a row gets a copy for each whole number its running rate passes, so that
    rounding errors cancel between rows of like size. Of OFFSETS starting points each source
    takes the one that comes nearest to its target.
    The running rate is summed in ranges of (source, size, key), so a source with a third of all
    rows is spread over many tasks. All sums are of whole numbers: a rerun gives the same copies.

    Null text has size 0 and is never taken; a null source is a source; rows that repeat are
    rows of their own; an empty table gives an empty result. Other columns are not looked at.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    sized = scratch.settle(docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"),
        (word_count(text) if size is None else size).alias("size")))
    hist = scratch.settle(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    goals = scratch.settle(targets(hist.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most))
    tilt = tilts(hist, goals, scratch, most)
    rate = F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(math.log(most))))
    units = F.when(F.col("tilt").isNull() | (F.col("size") == 0), 0).otherwise(
        F.least(F.round(rate * UNIT).cast("long"), F.lit(most * UNIT)))
    # One rate for every (source, size); rows of one size differ in the order of their keys only.
    rates = scratch.settle(hist.alias("g").join(tilt.alias("p"), F.col("g.source").eqNullSafe(F.col("p.source")), "left")
                           .select("g.source", "size", "n", units.cast("long").alias("units")))
    # Sums before each (source, size): a window over sizes of a source, not over its rows.
    up = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    starts = rates.withColumn("start", F.coalesce(F.sum(F.col("units") * F.col("n")).over(up), F.lit(0)))
    placed = number_within(sized, scratch)
    both = (placed.alias("g").join(starts.alias("p"), F.col("g.source").eqNullSafe(F.col("p.source"))
                                   & (F.col("g.size") == F.col("p.size")))
            .select("g.key", "g.source", "g.size", "units",
                    (F.col("start") + F.col("rank") * F.col("units")).alias("before")))
    placed_units = scratch.settle(both)

    def copies(k: Column) -> Column:
        shift = k * (UNIT // OFFSETS)
        passed = lambda c: F.shiftright(c + shift, UNIT.bit_length() - 1)
        return passed(F.col("before") + F.col("units")) - passed(F.col("before"))

    tried = placed_units.groupBy("source").agg(*[
        F.sum(copies(F.lit(k)) * F.col("size")).alias(f"t{k}") for k in range(OFFSETS)])
    joined = goals.alias("g").join(tried.alias("p"), F.col("g.source").eqNullSafe(F.col("p.source")))
    off = lambda k: F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("off"), F.lit(k).alias("k"))
    best = scratch.settle(joined.select("g.source", "source_size", "target",
                                        F.least(*[off(k) for k in range(OFFSETS)])["k"].alias("k")))
    out = placed_units.alias("g").join(best.alias("p"), F.col("g.source").eqNullSafe(F.col("p.source"))).select(
        F.col("key").alias(key), "g.source", "size", "source_size", "target",
        (F.col("units") / UNIT).alias("rate"), copies(F.col("k")).alias("copies"),
        (copies(F.col("k")) * F.col("size")).cast("long").alias("taken"))
    scratch.keep(placed_units, best)
    scratch.drop(*[df for df, _ in list(scratch.tables.values())])
    return out


def number_within(sized: DataFrame, scratch: Scratch) -> DataFrame:
    """`sized` with `rank`: how many rows of the same (source, size) come before, by key.

    Sorted in ranges of (source, size, key) that are written once; each range counts from its own
    start and adds the rows of the same (source, size) in the ranges before it.
    """
    n = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").asc_nulls_last(), F.col("size").asc(), F.col("key").asc_nulls_last()]
    ranged = scratch.settle(sized.repartitionByRange(n, *order).withColumn("slice", F.spark_partition_id()))
    inside = Window.partitionBy("slice", "source", "size").orderBy(F.col("key").asc_nulls_last())
    ahead = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("slice", "source", "size").agg(F.count("*").alias("n")).withColumn(
        "skip", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    counted = ranged.withColumn("row", F.row_number().over(inside) - 1)
    same = ((F.col("g.slice") == F.col("p.slice")) & (F.col("g.size") == F.col("p.size"))
            & F.col("g.source").eqNullSafe(F.col("p.source")))
    return counted.alias("g").join(offsets.alias("p"), same).select(
        "g.key", "g.source", "g.size", (F.col("row") + F.col("skip")).alias("rank"))

"""Placement of rows on shards by a lookup table that is filled in turns."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.common import free_name, without

#: Slots of the table. Prime, so that every step length visits all slots.
SLOTS = 65_537


def filled_slots(shards: Sequence[str], slots: int = SLOTS, weights: Sequence[int] | None = None) -> list[int]:
    """Owner (position in `shards`) of every slot.

    Each shard prefers the slots in the order start, start + step, start + 2 step, ... modulo
    `slots`, with start and step drawn from its name alone. Shards take turns; in a turn a
    shard claims the first slot of its order that is still free (`weights` claims a turn).
    So shares differ by one turn at most, and when a shard leaves, few other slots change hands.
    The work depends on `slots` only, never on the rows placed.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names, one at least")
    if slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("slots must be a prime that is not below the number of shards")
    draws = [hashlib.md5(name.encode()).hexdigest() for name in shards]
    at = [int(d[:15], 16) % slots for d in draws]
    step = [int(d[15:30], 16) % (slots - 1) + 1 for d in draws]
    turns = [i for i in range(len(shards)) for _ in range((weights or [1] * len(shards))[i])]
    if not turns:
        raise ValueError("all weights are zero")
    owner, left = [-1] * slots, slots
    while left:
        for i in turns:
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            owner[at[i]] = i
            left -= 1
            if not left:
                break
    return owner


def lookup_table(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS,
                 weights: Sequence[int] | None = None) -> DataFrame:
    """(slot, shard), one row per slot."""
    owners = ",".join(map(str, filled_slots(shards, slots, weights)))
    names = F.array(*[F.lit(s) for s in shards])
    return (spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", "owner"))
            .select("slot", F.get(names, F.col("owner").cast("int")).alias("shard")))


def slot_of(key: str | Column, slots: int = SLOTS) -> Column:
    """Slot of a key, from the first 60 bits of the MD5 of its text; a null key counts as empty."""
    text = F.coalesce(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), F.lit(""))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def place(df: DataFrame, key: str | Column, shards: Sequence[str], slots: int = SLOTS,
          weights: Sequence[int] | None = None) -> DataFrame:
    """`df` with `slot` and `shard`: every row keeps its place whatever the other rows are.

    The table has `slots` rows whatever the data, so its broadcast is bounded and nothing of
    `df` is shuffled, however often a key repeats. Null keys go together with empty ones;
    equal keys share a shard; an empty table stays empty. Columns named slot or shard are replaced.
    """
    here = free_name(df, "_slot")
    table = lookup_table(df.sparkSession, shards, slots, weights).withColumnRenamed("slot", here)
    marked = df.withColumn(here, slot_of(key, slots))
    placed = without(marked, "slot", "shard").join(F.broadcast(table), here)
    return placed.withColumnRenamed(here, "slot")

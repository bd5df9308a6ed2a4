"""Per-key buffers that release their rows in chunks, decided batch by batch in column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidewright.fixed import RELEASE_AT
from tidewright.operators.relational import running_totals
from tidewright.session import Scratch, remove
from tidewright.streaming.run import start_batches

ORDER = ["airport", "carried", "at", "seq", "kind"]


def with_messages(flights: DataFrame, messages: DataFrame, airport: str = "origin", at: str = "ts",
                  order: str = "event_id") -> DataFrame:
    """One stream of flights and messages: (airport, kind, at, seq, row), row being null for messages.

    `messages` (airport, at, kind) has the kinds register and unregister.
    """
    data = flights.select(
        F.col(airport).cast("string").alias("airport"), F.lit("data").alias("kind"), F.col(at).alias("at"),
        F.col(order).cast("bigint").alias("seq"), F.struct(*flights.columns).alias("row"))
    notes = messages.select(F.col("airport").cast("string").alias("airport"), F.col("kind").alias("kind"), F.col("at").alias("at"),
                            F.lit(-1).cast("bigint").alias("seq"), F.lit(None).cast(data.schema["row"].dataType).alias("row"))
    return data.unionByName(notes)


class ChunkRelease:
    """Holds the rows of each airport. A registration releases what is held; while registered, every
    `release_at` rows are released together; after an unregistration rows are held again.

    A micro-batch is taken in the order of its rows (at, then messages before data, then seq), whatever
    way it was transferred. The running counts over this order come from `running_totals`, so an airport
    with a third of all flights is spread over many tasks. What is held, and for each airport whether it is
    registered and its next chunk, is a table with a version for each batch in `path`; a batch that comes again
    after a failure starts from the same version and overwrites its own results.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, release_at: int = RELEASE_AT):
        self.spark, self.path, self.release_at = spark, path, release_at
        self.rows = f"airport string, kind string, at timestamp, seq bigint, row struct<{schema}>"

    def place(self, number: int, part: str) -> str:
        return f"{self.path}/state/{number}/{part}"

    def before(self, number: int) -> tuple[DataFrame, DataFrame]:
        """(held rows, airports) as the batch before left them."""
        held, airports = self.rows, "airport string, is_open boolean, next_chunk bigint"
        if number == 0:
            return self.spark.createDataFrame([], held), self.spark.createDataFrame([], airports)
        return (self.spark.read.schema(held).parquet(self.place(number - 1, "held")),
                self.spark.read.schema(airports).parquet(self.place(number - 1, "airports")))

    def __call__(self, batch: DataFrame, number: int) -> None:
        with Scratch(self.spark) as scratch:
            self.decide(batch, number, scratch)

    def decide(self, batch: DataFrame, number: int, scratch: Scratch) -> None:
        held, airports = self.before(number)
        columns = ["airport", "kind", "at", "seq", "row"]
        rows = held.select(*columns, F.lit(0).alias("carried")).unionByName(batch.select(*columns, F.lit(1).alias("carried")))
        is_ = lambda kind: (F.col("kind") == kind).cast("long")
        counted = running_totals(rows, [F.col(c) for c in ORDER], {
            "block": is_("register"), "leaves": is_("unregister"), "upto": is_("data")}, scratch=scratch)
        # A block runs from one registration of an airport to the next; the first one goes on from the batch before.
        blocks = counted.groupBy("airport", "block").agg(
            F.min(F.col("upto") - is_("data")).alias("base"), F.max("upto").alias("end"), F.max(is_("register")).alias("opens"),
            F.min(F.when(F.col("kind") == "unregister", F.col("upto"))).alias("leaves_at"))
        n = F.lit(self.release_at)
        known = blocks.join(airports.withColumnRenamed("airport", "of"), F.col("airport") == F.col("of"), "left")
        opened = (F.col("opens") == 1) | F.coalesce("is_open", F.lit(False))
        w = Window.partitionBy("airport").orderBy("block")
        placed = known.withColumn("last", F.lead("block").over(w).isNull()).withColumn(
            "full", F.when(opened, F.floor((F.coalesce("leaves_at", "end") - F.col("base")) / n)).otherwise(0)).withColumn(
            "rest", (F.col("end") - F.col("base") - F.col("full") * n > 0) & ~F.col("last")).withColumn(
            "chunks", F.col("full") + F.col("rest").cast("long")).withColumn(
            "first", F.coalesce("next_chunk", F.lit(0)) + F.coalesce(
                F.sum("chunks").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        i = F.col("upto") - F.col("base") - 1
        sub = F.least(F.floor(i / n), F.col("full"))
        marks = placed.select(F.col("airport").alias("of"), F.col("block").alias("of_block"), "base", "full", "first", "last")
        decided = counted.filter("kind = 'data'").join(
            marks, (F.col("airport") == F.col("of")) & (F.col("block") == F.col("of_block"))).withColumn("sub", sub).select(
            *columns, (F.col("first") + F.col("sub")).alias("chunk"),
            F.when(F.col("sub") < F.col("full"), "full").when(~F.col("last"), "registered").alias("reason"))
        decided.filter("reason IS NOT NULL").select("airport", "chunk", "reason", "row.*").write.mode("overwrite").parquet(
            f"{self.path}/released/batch={number}")
        decided.filter("reason IS NULL").select(*columns).write.mode("overwrite").parquet(self.place(number, "held"))
        ends = placed.filter("last").select(
            "airport", (opened & F.col("leaves_at").isNull()).alias("is_open"), (F.col("first") + F.col("chunks")).alias("next_chunk"))
        quiet = airports.join(ends.select("airport"), "airport", "left_anti")
        ends.unionByName(quiet).write.mode("overwrite").parquet(self.place(number, "airports"))
        if number >= 2:
            remove(self.spark, f"{self.path}/state/{number - 2}")

    def released(self) -> DataFrame:
        """(airport, chunk, reason, flight columns, batch) of all released rows."""
        return self.spark.read.parquet(f"{self.path}/released")


def start_release(stream: DataFrame, path: str, checkpoint: str, release_at: int = RELEASE_AT,
                  interval: str | None = None) -> tuple[StreamingQuery, ChunkRelease]:
    """Run a stream made by `with_messages`; `released()` of the second result reads what has come out."""
    fields = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in stream.schema["row"].dataType.fields)
    release = ChunkRelease(stream.sparkSession, path, fields, release_at)
    return start_batches(stream, release, checkpoint, interval=interval), release

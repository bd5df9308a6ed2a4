"""Stream sources. The format is a parameter, so a job does not depend on where lines come from."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def topic_options(servers: str, topic: str, group: str | None = None) -> dict[str, str]:
    """Options of the `kafka` format. Needs the connector package on the classpath."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if group:
        options["kafka.group.id"] = group
    return options


def socket_options(host: str, port: int) -> dict[str, str]:
    """Options of the `socket` format, which cannot replay and so is for trials only."""
    return {"host": host, "port": str(port)}


def open_lines(spark: SparkSession, kind: str, options: Mapping[str, str]) -> DataFrame:
    """A stream of text lines (value) from `kafka`, `socket` or `text` files."""
    stream = spark.readStream.format(kind).options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def replay_lines(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """Replay a folder of text files as a stream, a few files per batch, oldest first."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)


def replay_table(spark: SparkSession, folder: str, schema: str | StructType, pattern: str = "*.parquet",
                 files_per_batch: int | None = None) -> DataFrame:
    """Replay parquet files of a folder as a stream of typed rows."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)

"""Random rows beside existing keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def normal_rows(spark: SparkSession, n: int, seed: int = 0, partitions: int | None = None) -> DataFrame:
    """n rows (id, x) of standard normal values, made where they are used."""
    return spark.range(0, n, numPartitions=partitions).withColumn("x", F.randn(seed))


def with_normal_vector(df: DataFrame, width: int, seed: int = 0, name: str = "vector") -> DataFrame:
    """Add an array of independent standard normal values to every row."""
    return df.withColumn(name, F.array(*[F.randn(seed + i) for i in range(width)]))


def normal_vectors(spark: SparkSession, n: int, width: int, seed: int = 0) -> DataFrame:
    return with_normal_vector(spark.range(n), width, seed)

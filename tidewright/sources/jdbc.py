"""JDBC tables. Any driver on the classpath works; none was reachable where this was tested."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, predicates: Sequence[str] | None = None,
               properties: Mapping[str, str] | None = None) -> DataFrame:
    """A table, or the rows of each predicate as one partition.

    Predicates should cover the rows wanted without overlap; filters put on the result
    are pushed into the database.
    """
    return spark.read.jdbc(url, table, predicates=list(predicates) if predicates else None,
                           properties=dict(properties or {}))


def key_ranges(column: str, low: int, high: int, parts: int) -> list[str]:
    """Predicates that cut a whole-number key into `parts` ranges, open at both ends."""
    step = max(1, -(-(high - low + 1) // parts))
    cuts = list(range(low + step, high + 1, step))
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]

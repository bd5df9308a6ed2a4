"""Table sinks and derived tables that are saved once and reused."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Typed save as parquet, replacing what was there."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def is_saved(spark: SparkSession, path: str) -> bool:
    """True when a finished write left its success marker at `path`."""
    try:
        spark.read.text(f"{path.rstrip('/')}/_SUCCESS")
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame],
                rebuild: bool = False) -> DataFrame:
    """The table saved at `path`; built and saved first if it is missing or `rebuild` is set.

    A write cut short leaves no success marker and is built again. A rebuild is written beside the good copy
    and takes its place when it is complete.
    """
    if not is_saved(spark, path):
        save_table(build(), path)
    elif rebuild:
        beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
        save_table(build(), beside)
        replace(spark, beside, path)
    return spark.read.parquet(path)


def replace(spark: SparkSession, new: str, old: str) -> None:
    """Put the folder `new` where `old` is, through the file system both are in."""
    new_path, old_path = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (new, old))
    store = new_path.getFileSystem(spark._jsc.hadoopConfiguration())
    store.delete(old_path, True)
    if not store.rename(new_path, old_path):
        raise OSError(f"{new} could not be renamed to {old}")


def save_to_database(df: DataFrame, url: str, table: str,
                     properties: Mapping[str, str] | None = None) -> str:
    """Write to a JDBC table; if it exists, replace its content. Returns the mode that took."""
    props = dict(properties or {})
    try:
        df.write.jdbc(url, table, mode="errorifexists", properties=props)
        return "errorifexists"
    except AnalysisException as e:
        if e.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS" and f"'{table}' already exists" not in str(e):
            raise
        df.write.jdbc(url, table, mode="overwrite", properties={**props, "truncate": "true"})
        return "overwrite"


def save_counted(df: DataFrame, path: str, **counters) -> dict:
    """Save as parquet and return named aggregates over what was saved.

    The aggregates read only their own columns of the new files. An `Observation` would
    gather them in the same pass, but once a session has used one, it can no longer score
    models that carry a training summary (the session stops being serialisable).
    """
    save_table(df, path)
    row = df.sparkSession.read.parquet(path).agg(*[c.alias(k) for k, c in counters.items()]).first()
    return row.asDict()


def side_effect_total(df: DataFrame, column: str) -> float:
    """Total of a column through an accumulator fed by executors.

    Kept for programs built on side effects. A retried task may count twice, so results
    that must be right should use an aggregate or `save_counted`.
    """
    total = df.sparkSession.sparkContext.accumulator(0.0)

    def add(rows):
        total.add(sum(float(r[0]) for r in rows if r[0] is not None))

    df.select(F.col(column)).foreachPartition(add)
    return total.value

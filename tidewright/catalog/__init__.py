"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewright.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SECTIONS = ("relational", "aggregates", "scalars", "storage", "graphs", "evaluation", "features",
            "patterns", "models", "streams", "jobs")


class Tables:
    """The parquet tables of one folder, by name: `t.orders`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of (spark, tables) under `name`, with its oracle if it has one."""

    def keep(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), Tables(spark, sf_dir))

        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def load() -> None:
    for section in SECTIONS:
        importlib.import_module(f"tidewright.catalog.{section}")

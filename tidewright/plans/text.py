"""Top words of a text, and traffic from access logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.operators.aggregates import log_traffic, word_counts
from tidewright.operators.relational import top_n
from tidewright.sources.files import read_lines


def top_words(texts: DataFrame, text: str = "text", n: int = 10, lower: bool = True) -> DataFrame:
    """The most frequent words; equal counts in alphabetical order."""
    return top_n(word_counts(texts, text, lower), n, F.desc("n"), F.asc("word"))


def top_words_of_files(spark: SparkSession, path: str, n: int = 10) -> DataFrame:
    return top_words(read_lines(spark, path), "value", n)


def web_log_report(spark: SparkSession, path: str) -> DataFrame:
    """(ip, user, query, n, bytes) over access-log files."""
    return log_traffic(read_lines(spark, path))

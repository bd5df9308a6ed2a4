"""Parsers for delimited text lines; all are column expressions over a `value` column."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.fixed import SALE_FIELDS, SALE_TYPE
from tidewright.functions.columns import date_of, instant_of, lenient_double, lenient_int


def read_survey(spark: SparkSession, path: str | list[str], texts: tuple[str, ...] = (),
                blank: str = "zero") -> DataFrame:
    """CSV whose columns come from its header line: whole numbers, but for the `texts`.

    Blank or unreadable numbers become 0, or null with `blank="null"`.
    """
    raw = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
           .csv(path))
    return raw.select(*[F.col(c) if c in texts else lenient_int(F.col(c), blank).alias(c)
                        for c in raw.columns])


def parse_sales(lines: DataFrame, line: str = "value") -> DataFrame:
    """Sales of positive price and units from pipe-separated records. Streams too."""
    part = F.split(F.trim(line), r"\|")

    def field(name):
        return F.get(part, SALE_FIELDS[name])

    rows = lines.select(
        field("product_id").alias("product_id"), field("store_id").alias("store_id"),
        date_of(field("date")).alias("date"), instant_of(field("date"), field("time")).alias("time"),
        lenient_double(field("units")).alias("units"), lenient_double(field("price")).alias("price"),
        field("type").alias("type"))
    return rows.filter((F.col("price") > 0) & (F.col("units") > 0) & (F.col("type") == SALE_TYPE))


def parse_ratings(lines: DataFrame, sep: str = "::", broken: str = "raise",
                  line: str = "value") -> DataFrame:
    """(user, item, rating, at) from separated records; `at` may be missing.

    A record with another number of fields fails the job, or with `broken="keep"` stays
    as a row of nulls with its text in `problem`.
    """
    part = F.split(F.col(line), sep.replace("|", r"\|"))
    good = F.size(part).isin(3, 4)
    if broken == "raise":
        ok = F.when(good, part).otherwise(
            F.raise_error(F.concat(F.lit("not a rating: "), F.col(line))))
    else:
        ok = F.when(good, part)
    fields = [F.get(ok, 0).try_cast("int").alias("user"), F.get(ok, 1).try_cast("int").alias("item"),
              F.get(ok, 2).try_cast("double").alias("rating"), F.get(ok, 3).try_cast("bigint").alias("at")]
    if broken == "keep":
        fields.append(F.when(~good, F.col(line)).alias("problem"))
    return lines.select(*fields)


def _numbers(text):
    return F.transform(F.split(F.trim(text), r"\s+"), lambda x: x.try_cast("double"))


def parse_vectors(lines: DataFrame, line: str = "value", *keep: str) -> DataFrame:
    """A `features` vector from space-separated numbers."""
    return lines.select(*keep, array_to_vector(_numbers(F.col(line))).alias("features"))


def parse_points(lines: DataFrame, line: str = "value", *keep: str) -> DataFrame:
    """(label, features) from `label,x1 x2 ...`; more commas separate features as well."""
    part = F.split(line, ",", 2)
    rest = F.translate(F.get(part, 1), ",", " ")
    return lines.select(*keep, F.get(part, 0).try_cast("double").alias("label"),
                        array_to_vector(_numbers(rest)).alias("features"))

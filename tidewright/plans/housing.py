"""Housing costs averaged per state, and the shares a map is coloured by."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.fixed import HOUSING_LOT_SIZES, HOUSING_MEASURES
from tidewright.operators.aggregates import means_by
from tidewright.sinks.tables import materialize
from tidewright.sources.delimited import read_survey


def averages(surveys: DataFrame, states: DataFrame) -> DataFrame:
    """Mean of every measure per state for the usual lot sizes, with the state's columns."""
    kept = surveys.filter(F.col("ACR").isin(*HOUSING_LOT_SIZES))
    means = means_by(kept, "ST", HOUSING_MEASURES)
    return means.select("ST", *[F.col(f"avg_{m}").alias(f"AVG_{m}") for m in HOUSING_MEASURES]).join(states, "ST")


def averages_from_files(spark: SparkSession, parts: list[str], states: DataFrame, saved: str,
                        rebuild: bool = False) -> DataFrame:
    """Averages over survey files, computed once and then read from `saved`."""

    def build():
        surveys = read_survey(spark, parts[0], texts=("RT",))
        for path in parts[1:]:
            surveys = surveys.unionByName(read_survey(spark, path, texts=("RT",)))
        return averages(surveys, states)

    return materialize(spark, saved, build, rebuild)


def map_shares(means: DataFrame) -> DataFrame:
    """Lot size, value and utility costs of each state as shares of the highest state; fuel
    and water per month. The highest values are single numbers found by a subquery."""
    costs = sum((F.col(f"AVG_{m}") for m in ("GASP", "FULP", "WATP")), F.col("AVG_ELEP"))
    table = means.withColumn("utilities", costs)
    top = {c: table.select(F.max(c)).scalar() for c in ("AVG_ACR", "AVG_VALP", "utilities")}
    return table.select(
        "ST", "NAME", (F.col("AVG_ACR") / top["AVG_ACR"]).alias("acres_share"),
        (F.col("AVG_VALP") / top["AVG_VALP"]).alias("value_share"),
        (F.col("utilities") / top["utilities"]).alias("utilities_share"),
        (F.col("AVG_FULP") / 12).alias("fuel_monthly"), (F.col("AVG_WATP") / 12).alias("water_monthly"))

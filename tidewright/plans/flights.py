"""Flight delays by direction and the day's schedule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.fixed import DELAY_LIMITS, FLIGHT_FIELDS, NON_AIRPORT_WORDS
from tidewright.functions.columns import (
    bearing, compass_region, delay_status, lenient_int, mentions_any, on_calendar_day,
)
from tidewright.operators.aggregates import status_shares
from tidewright.operators.relational import lookup

STATES = ("ontime", "delay_minor", "delay_major")


def parse_flights(lines: DataFrame, line: str = "value") -> DataFrame:
    """Flight records from comma-separated lines; a chunk may hold several lines.

    A delay that is no number counts as 0.
    """
    rows = lines.select(F.explode(F.split(line, "\n")).alias("_line")).filter("_line <> ''")
    parts = F.split("_line", ",")
    cols = {name: F.get(parts, at) for name, at in FLIGHT_FIELDS.items()}
    cols["take_off_delay_mins"] = lenient_int(cols["take_off_delay_mins"], blank="zero")
    return rows.select(*[c.alias(name) for name, c in cols.items()])


def us_airports(places: DataFrame, country: str) -> DataFrame:
    """Places of one country that are airports and have a code."""
    return places.filter((F.col("country") == country)
                         & ~mentions_any(F.col("name"), NON_AIRPORT_WORDS)
                         & (F.coalesce("code", F.lit("")) != ""))


def place(flights: DataFrame, airports: DataFrame,
          limits: Sequence[int] = DELAY_LIMITS) -> DataFrame:
    """Add region and status to flights (origin, destination, delay).

    Airports (code, lat, lon); an unknown airport lies at 0, 0. Works on streams as well.
    """
    for end in ("origin", "destination"):
        dim = airports.select(F.col("code").alias(end), F.col("lat").alias(f"{end}_lat"),
                              F.col("lon").alias(f"{end}_lon"))
        flights = lookup(flights, dim, end, {f"{end}_lat": 0.0, f"{end}_lon": 0.0})
    angle = bearing(F.col("origin_lat"), F.col("origin_lon"),
                    F.col("destination_lat"), F.col("destination_lon"))
    ends = [f"{e}_{x}" for e in ("origin", "destination") for x in ("lat", "lon")]
    return (flights.withColumn("region", compass_region(angle))
            .withColumn("status", delay_status(F.col("delay"), limits)).drop(*ends))


def delay_shares(placed: DataFrame, by: Sequence[str] = ("origin",)) -> DataFrame:
    """Three rows (status, pct) per region and group."""
    return status_shares(placed, [*by, "region"], "status", STATES)


def flights_of_day(schedule: DataFrame, date: str, month: int, day: int) -> DataFrame:
    return schedule.filter(on_calendar_day(F.col(date), month, day))


def carriers(schedule: DataFrame, origin) -> DataFrame:
    return schedule.filter(F.col("origin") == origin).select("carrier").distinct()


def departures(schedule: DataFrame, origin, carrier: str) -> DataFrame:
    spark = schedule.sparkSession
    return spark.sql("SELECT flight_num, destination FROM {s} WHERE origin = :o AND carrier = :c",
                     args={"o": origin, "c": carrier}, s=schedule)


def run_live(flights: DataFrame, messages: DataFrame, airports: DataFrame, path: str, **window) -> tuple[DataFrame, DataFrame]:
    """The flight job over two streams, run to the end of what is there: delay shares per window, airport and
    direction, and the placed flights that registered airports have been sent, chunk by chunk.

    flights: (ts, event_id, origin, destination, delay, ...); messages: (airport, at, kind).
    """
    from tidewright.streaming import buffers, run, windows

    placed = place(flights, airports)
    shares = windows.delay_windows(placed, **window)
    saving = run.start_files(shares, f"{path}/shares", f"{path}/shares-log")
    sending, release = buffers.start_release(
        buffers.with_messages(placed, messages), f"{path}/release", f"{path}/release-log")
    run.drain([saving, sending])
    return placed.sparkSession.read.schema(shares.schema).parquet(f"{path}/shares"), release.released()

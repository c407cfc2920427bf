"""The scalar stage: one narrow pass over the raw reports, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlens.functions import flight
from flightlens.session import require_utc
from flightlens.settings import RULES, Rules


def fill_geo_altitude(df: DataFrame) -> DataFrame:
    """Barometric altitude stands in for a missing geometric one, if the column exists."""
    if "geo_altitude" not in df.columns:
        return df
    return df.withColumn("geo_altitude", F.coalesce("geo_altitude", "baro_altitude"))


def with_position(df: DataFrame) -> DataFrame:
    """Reports without a position are left out; both tests reach the source."""
    return df.filter(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())


def enrich(df: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Fill, filter and derive all per-report columns.

    The chain stays one projection over the scan: the position test reaches the
    source as a pushed filter and unused columns are never read.
    """
    require_utc(df)
    located = with_position(fill_geo_altitude(df))
    timed = located.withColumns(
        {
            "event_time": flight.event_time(F.col("time_position")),
            "callsign": flight.clean_callsign(F.col("callsign"), rules),
        }
    ).withColumns(
        {
            "event_date": F.to_date("event_time"),
            "event_hour": F.hour("event_time"),
            "event_weekday": F.dayofweek("event_time"),
            "callsign_length": F.length("callsign"),
        }
    )
    velocity, baro = F.col("velocity"), F.col("baro_altitude")
    return timed.withColumns(
        {
            "lat_sector": flight.grid_cell(F.col("latitude")),
            "lon_sector": flight.grid_cell(F.col("longitude")),
            "velocity_kmh": flight.speed_kmh(velocity, rules),
            "is_anomaly": flight.anomaly_flag(velocity, baro, rules),
            "time_of_day": flight.time_of_day(F.col("event_hour"), rules),
            "flight_status": flight.flight_status(F.col("on_ground")),
            "velocity_category": flight.speed_class(velocity, rules),
        }
    )

"""Table schemas, non-null contracts and physical layouts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SPEED = T.DecimalType(10, 2)
PERCENT = T.DecimalType(5, 2)


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


# Column names, types and order of the raw and published tables.
RAW_FLIGHTS = _struct(
    ("fetch_time", T.TimestampType(), True),
    ("icao24", T.StringType(), True),
    ("callsign", T.StringType(), True),
    ("origin_country", T.StringType(), True),
    ("time_position", T.LongType(), True),
    ("last_contact", T.LongType(), True),
    ("longitude", T.DoubleType(), True),
    ("latitude", T.DoubleType(), True),
    ("baro_altitude", T.DoubleType(), True),
    ("on_ground", T.BooleanType(), True),
    ("velocity", T.DoubleType(), True),
    ("heading", T.DoubleType(), True),
    ("vertical_rate", T.DoubleType(), True),
    ("geo_altitude", T.DoubleType(), True),
    ("squawk", T.StringType(), True),
    ("spi", T.BooleanType(), True),
    ("position_source", T.IntegerType(), True),
)

# Ranks and counts are 64-bit: past 4.3 billion reports a 32-bit rank overflows.
ENRICHED_FLIGHTS = _struct(
    ("icao24", T.StringType(), False),
    ("callsign", T.StringType(), False),
    ("origin_country", T.StringType(), False),
    ("event_time", T.TimestampType(), False),
    ("event_date", T.DateType(), False),
    ("velocity_kmh", SPEED, True),
    ("baro_altitude", SPEED, True),
    ("geo_altitude", SPEED, True),
    ("rank_in_country", T.LongType(), True),
    ("speed_rank_global", T.LongType(), True),
    ("avg_speed_in_country", SPEED, True),
    ("max_speed_in_country", SPEED, True),
    ("min_speed_in_country", SPEED, True),
    ("is_anomaly", T.ShortType(), True),
    ("time_of_day", T.StringType(), False),
    ("flight_status", T.StringType(), False),
)

COUNTRY_STATS = _struct(
    ("origin_country", T.StringType(), False),
    ("total_aircraft", T.LongType(), True),
    ("avg_speed_kmh", SPEED, True),
    ("unique_flights", T.LongType(), True),
    ("anomaly_count", T.LongType(), True),
    ("global_rank", T.LongType(), True),
    ("percentage_of_total", PERCENT, True),
)

FLIGHTS_ANALYTICS = _struct(
    ("origin_country", T.StringType(), False),
    ("event_date", T.DateType(), False),
    ("time_of_day", T.StringType(), False),
    ("flight_status", T.StringType(), False),
    ("velocity_category", T.StringType(), False),
    ("flight_count", T.LongType(), True),
    ("avg_velocity_kmh", SPEED, True),
    ("avg_baro_altitude", SPEED, True),
    ("avg_geo_altitude", SPEED, True),
    ("anomaly_count", T.LongType(), True),
    ("unique_aircraft", T.LongType(), True),
    ("min_velocity_kmh", SPEED, True),
    ("max_velocity_kmh", SPEED, True),
    ("median_velocity_kmh", SPEED, True),
    ("anomaly_percentage", PERCENT, True),
)

# The row-level view of the older report: no country means, no speed class.
FLIGHTS_SLIM = T.StructType(
    [f for f in ENRICHED_FLIGHTS if not f.name.endswith("_speed_in_country")]
)

# Longest text the raw table takes.
TEXT_LIMITS = {"icao24": 10, "callsign": 20, "origin_country": 50, "squawk": 10}

ANALYTICS_KEYS = (
    "origin_country",
    "event_date",
    "time_of_day",
    "flight_status",
    "velocity_category",
)


@dataclass(frozen=True)
class Layout:
    """Name, schema and physical order of a published table."""

    name: str
    schema: T.StructType
    sort_by: tuple[str, ...]
    by_month: bool

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


ENRICHED_LAYOUT = Layout("enriched_flights", ENRICHED_FLIGHTS, ("event_date", "origin_country"), True)
COUNTRY_LAYOUT = Layout("country_stats", COUNTRY_STATS, ("origin_country",), False)
ANALYTICS_LAYOUT = Layout(
    "flights_analytics", FLIGHTS_ANALYTICS, ("event_date", "origin_country", "flight_status"), True
)
SLIM_LAYOUT = Layout("flights_slim", FLIGHTS_SLIM, ("event_date", "origin_country"), True)
LAYOUTS = {
    layout.name: layout
    for layout in (ENRICHED_LAYOUT, COUNTRY_LAYOUT, ANALYTICS_LAYOUT, SLIM_LAYOUT)
}

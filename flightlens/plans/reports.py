"""The three published reports and the older row-level view.

Each function takes the enriched reports of
:func:`flightlens.operators.enrich.enrich`.  The summaries start from there
directly; they need no ranks.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlens.functions import numeric
from flightlens.operators import summarise
from flightlens.operators.lookup import null_safe_join
from flightlens.operators.rank import rank_and_compare, rank_and_share
from flightlens.schema import (
    ANALYTICS_KEYS,
    COUNTRY_STATS,
    ENRICHED_FLIGHTS,
    FLIGHTS_ANALYTICS,
    FLIGHTS_SLIM,
)
from flightlens.session import materialise
from flightlens.settings import SCALING, Scaling
from flightlens.sources.raw import instant

COUNTRY_SPEEDS = ("avg_speed_in_country", "max_speed_in_country", "min_speed_in_country")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns, order and types of a published table.

    A value the type cannot hold becomes NULL here; publishing sends such rows
    to quarantine instead (see ``quality.range_checks``).
    """
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def _zero_if_missing(value: Column) -> Column:
    return F.coalesce(value, F.expr("0.00BD"))


def null_to_zero(df: DataFrame) -> DataFrame:
    """Missing speed and altitudes are published as zero."""
    return df.withColumns(
        {
            "velocity_kmh": _zero_if_missing(F.col("velocity_kmh")),
            "baro_altitude": _zero_if_missing(numeric.two_decimals(F.col("baro_altitude"))),
            "geo_altitude": _zero_if_missing(numeric.two_decimals(F.col("geo_altitude"))),
        }
    )


def ranked_flights(enriched: DataFrame, scaling: Scaling = SCALING) -> DataFrame:
    """Every report with its two speed ranks and its country's speed statistics."""
    return rank_and_compare(
        enriched,
        group="origin_country",
        metric="velocity_kmh",
        group_rank="rank_in_country",
        overall_rank="speed_rank_global",
        names=COUNTRY_SPEEDS,
        scaling=scaling,
    )


def enriched_flights(ranked: DataFrame) -> DataFrame:
    """The published row-level report, from :func:`ranked_flights`."""
    return conform(null_to_zero(ranked), ENRICHED_FLIGHTS)


def flights_slim(ranked: DataFrame) -> DataFrame:
    """The older, narrower row-level report, from :func:`ranked_flights`."""
    return conform(null_to_zero(ranked), FLIGHTS_SLIM)


def country_totals(enriched: DataFrame, approximate_distinct: bool = False) -> DataFrame:
    """One row per country.  Exact distinct counting shuffles on (country, callsign)
    first, so a country with a third of the rows is spread over many tasks."""
    return enriched.groupBy("origin_country").agg(
        summarise.row_count().alias("total_aircraft"),
        summarise.mean_speed().alias("avg_speed_kmh"),
        summarise.distinct("callsign", approximate_distinct).alias("unique_flights"),
        F.sum("is_anomaly").alias("anomaly_count"),
    )


def country_stats(
    enriched: DataFrame, approximate_distinct: bool = False, scaling: Scaling = SCALING
) -> DataFrame:
    """Counts, mean speed, rank and share per country, largest first."""
    return ranked_countries(*materialise(country_totals(enriched, approximate_distinct)), scaling)


def ranked_countries(totals: DataFrame, countries: int, scaling: Scaling = SCALING) -> DataFrame:
    """The published country table from written totals, one row for each of the ``countries``."""
    ranked = rank_and_share(
        totals, countries, "total_aircraft", "global_rank", "percentage_of_total", scaling
    )
    return conform(ranked, COUNTRY_STATS).orderBy(F.desc("total_aircraft"), "origin_country")


def load_stamped(summary: DataFrame, moment: datetime | None = None) -> DataFrame:
    """A summary with the time of its load on every row: one time for all of them."""
    return summary.withColumn("load_timestamp", F.current_timestamp() if moment is None else instant(moment))


def flights_analytics(
    enriched: DataFrame,
    median: str = "exact",
    approximate_distinct: bool = False,
    scaling: Scaling = SCALING,
) -> DataFrame:
    """Summary by country, date, time of day, status and speed class.

    ``median="exact"`` takes a second, narrow pass over six columns, planned
    from the group sizes of the first.  ``median="approx"`` keeps the percentile
    sketch, whose rank error is at most 1 in 10,000; with
    ``approximate_distinct`` the whole summary is then a single shuffle.
    """
    if median not in ("exact", "approx"):
        raise ValueError(f"median is 'exact' or 'approx', not {median!r}")
    aggregates = [
        summarise.row_count().alias("flight_count"),
        summarise.mean_speed().alias("avg_velocity_kmh"),
        summarise.mean_altitude("baro_altitude").alias("avg_baro_altitude"),
        summarise.mean_altitude("geo_altitude").alias("avg_geo_altitude"),
        F.sum("is_anomaly").alias("anomaly_count"),
        summarise.distinct("icao24", approximate_distinct).alias("unique_aircraft"),
        F.min("velocity_kmh").alias("min_velocity_kmh"),
        F.max("velocity_kmh").alias("max_velocity_kmh"),
    ]
    if median == "approx":
        aggregates.append(F.percentile_approx("velocity_kmh", 0.5).alias("median_velocity_kmh"))
    summary = enriched.groupBy(*ANALYTICS_KEYS).agg(*aggregates)
    if median == "exact":
        summary, _ = materialise(summary)
        medians = summarise.lower_median(
            enriched,
            ANALYTICS_KEYS,
            "velocity_kmh",
            "median_velocity_kmh",
            sizes=summary,
            count="flight_count",
            scaling=scaling,
        )
        summary = null_safe_join(summary, medians, ANALYTICS_KEYS, "left")
    summary = summary.withColumn(
        "anomaly_percentage", numeric.percent(F.col("anomaly_count"), F.col("flight_count"))
    )
    return conform(summary, FLIGHTS_ANALYTICS)

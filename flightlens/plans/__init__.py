"""The published reports, composed from the operators."""

from flightlens.plans.reports import (
    country_stats,
    enriched_flights,
    flights_analytics,
    flights_slim,
    ranked_flights,
)

__all__ = [
    "country_stats",
    "enriched_flights",
    "flights_analytics",
    "flights_slim",
    "ranked_flights",
]

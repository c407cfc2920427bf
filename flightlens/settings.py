"""Tunable rules.  The defaults are the values the reports are defined with."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class Rules:
    """Thresholds of the derived columns.

    Speed limits compare the raw ``velocity`` (metres per second); only the
    published speed is converted to km/h.
    """

    kmh_per_ms: Decimal = Decimal("3.6")
    medium_from: float = 300.0
    fast_from: float = 800.0
    anomaly_above_speed: float = 1200.0
    anomaly_below_altitude: float = 0.0
    morning_from: int = 6
    day_from: int = 12
    evening_from: int = 18
    missing_callsign: str = "Unknown"


@dataclass(frozen=True)
class Scaling:
    """Where a plan changes shape.  Results never depend on these numbers.

    one_task_rows
        A per-key table is ordered by a single task only when its counted size
        is at most this many rows.
    broadcast_rows
        A lookup is broadcast only when its counted size is at most this many
        rows; above it the salted shuffle join is used.
    hashed_rows
        The shuffle join hashes the lookup instead of sorting both sides while
        a partition of the lookup has at most this many rows.
    rows_per_salt
        A join key with this many rows or more is spread over several tasks.
    hot_keys
        The most keys to spread, which bounds their broadcast.  N rows have at
        most N / r keys of r rows, so where N is larger than ``hot_keys *
        rows_per_salt``, a key is spread from N / ``hot_keys`` rows on.
    """

    one_task_rows: int = 100_000
    broadcast_rows: int = 500_000
    hashed_rows: int = 250_000
    rows_per_salt: int = 1_000_000
    hot_keys: int = 500_000


RULES = Rules()
SCALING = Scaling()

# The poll payload and the raw table are defined with these.  The cap is
# what a load may be given; without one every record is loaded.
PAYLOAD_CAP = 1000
JDBC_BATCH_ROWS = 10_000
FIELD_POSITIONS = {
    "icao24": 0,
    "callsign": 1,
    "origin_country": 2,
    "time_position": 3,
    "last_contact": 4,
    "longitude": 5,
    "latitude": 6,
    "baro_altitude": 7,
    "on_ground": 8,
    "velocity": 9,
    "heading": 10,
    "vertical_rate": 11,
    "geo_altitude": 12,
    "squawk": 13,
    "spi": 14,
    "position_source": 15,
}

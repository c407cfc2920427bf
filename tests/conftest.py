from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from flightlens.schema import RAW_FLIGHTS  # noqa: E402
from flightlens.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "flightlens-tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__sql__maxMetadataStringLength="10000",
        spark__sql__debug__maxToStringFields="1000",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def reports(spark):
    """Builds raw reports from partial rows; what is left out has a plain default."""

    defaults = {
        "icao24": "abc123",
        "callsign": "AB1",
        "origin_country": "Here",
        "time_position": 1_700_000_000,
        "longitude": 1.0,
        "latitude": 2.0,
        "baro_altitude": 100.0,
        "on_ground": False,
        "velocity": 200.0,
        "geo_altitude": 110.0,
    }

    def build(*rows: dict):
        names = RAW_FLIGHTS.names
        return spark.createDataFrame(
            [tuple({**defaults, **row}.get(name) for name in names) for row in rows], RAW_FLIGHTS
        )

    return build

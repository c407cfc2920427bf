from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flightlens.functions import flight, numeric
from flightlens.operators.enrich import enrich
from flightlens.settings import Rules


def one(df, *names):
    row = enrich(df).select(*names).collect()
    assert len(row) == 1
    return tuple(row[0])


def test_missing_speed_and_altitude(reports):
    df = reports({"velocity": None, "baro_altitude": None})
    assert one(df, "velocity_kmh", "velocity_category", "is_anomaly") == (None, "fast", 0)


def test_negative_altitude_is_an_anomaly_even_without_speed(reports):
    assert one(reports({"velocity": None, "baro_altitude": -5.0}), "is_anomaly") == (1,)


@pytest.mark.parametrize(
    ("velocity", "expected"),
    [(299.99, "slow"), (300.0, "medium"), (799.99, "medium"), (800.0, "fast")],
)
def test_speed_class_limits(reports, velocity, expected):
    assert one(reports({"velocity": velocity}), "velocity_category") == (expected,)


@pytest.mark.parametrize(("velocity", "expected"), [(1200.0, 0), (1200.01, 1)])
def test_anomaly_limit(reports, velocity, expected):
    assert one(reports({"velocity": velocity}), "is_anomaly") == (expected,)


def test_anomaly_looks_at_the_barometric_altitude(reports):
    df = reports({"geo_altitude": None, "baro_altitude": -5.0})
    assert one(df, "geo_altitude", "is_anomaly") == (-5.0, 1)


def test_geo_altitude_is_filled(reports):
    assert one(reports({"geo_altitude": None}), "geo_altitude") == (100.0,)


def test_no_geo_altitude_column(reports):
    assert "geo_altitude" not in enrich(reports({}).drop("geo_altitude")).columns


def test_unknown_time(reports):
    names = ("event_time", "event_date", "event_hour", "time_of_day")
    assert one(reports({"time_position": None}), *names) == (None, None, None, "evening")


def test_time_beyond_the_calendar_is_unknown(reports):
    assert one(reports({"time_position": 10**17}), "event_time", "event_date") == (None, None)


def test_known_time(reports):
    text = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("text")
    row = enrich(reports({})).select(text, "event_date", "event_weekday", "time_of_day").first()
    assert tuple(row) == ("2023-11-14 22:13:20", date(2023, 11, 14), 3, "evening")


@pytest.mark.parametrize(
    ("hour", "expected"),
    [(0, "night"), (5, "night"), (6, "morning"), (11, "morning"), (12, "day"), (17, "day"), (18, "evening"), (23, "evening")],
)
def test_time_of_day(reports, hour, expected):
    midnight = 1_699_920_000
    df = reports({"time_position": midnight + hour * 3600})
    assert one(df, "event_hour", "time_of_day") == (hour, expected)


@pytest.mark.parametrize(("on_ground", "expected"), [(None, "flying"), (True, "grounded"), (False, "flying")])
def test_flight_status(reports, on_ground, expected):
    assert one(reports({"on_ground": on_ground}), "flight_status") == (expected,)


@pytest.mark.parametrize(
    ("raw", "expected"),
    [(None, ("Unknown", 7)), ("   ", ("", 0)), ("  AB ", ("AB", 2)), ("\tAB\t", ("\tAB\t", 4))],
)
def test_callsign(reports, raw, expected):
    assert one(reports({"callsign": raw}), "callsign", "callsign_length") == expected


def test_grid_cell_rounds_down(reports):
    assert one(reports({"latitude": -1.5, "longitude": 1.5}), "lat_sector", "lon_sector") == (-2, 1)


def test_reports_without_position_are_dropped(reports):
    df = reports({"latitude": None}, {"longitude": None}, {"icao24": "kept"})
    assert [r.icao24 for r in enrich(df).collect()] == ["kept"]


def test_thresholds_are_parameters(reports):
    rules = Rules(fast_from=150.0, medium_from=100.0, anomaly_above_speed=10.0, missing_callsign="-")
    row = enrich(reports({"callsign": None}), rules).first()
    assert (row.velocity_category, row.is_anomaly, row.callsign) == ("fast", 1, "-")


@pytest.mark.parametrize(
    ("velocity", "expected"),
    [
        (0.0125, "0.05"),  # 0.045 exactly
        (100.0, "360.00"),
        (-0.0125, "-0.05"),
        (240.04, "864.14"),
        (float("nan"), None),
        (float("inf"), None),
        (1e9, None),
    ],
)
def test_speed_rounds_half_up_in_decimals(spark, velocity, expected):
    df = spark.createDataFrame([(velocity,)], "v double").select(flight.speed_kmh(F.col("v")).alias("k"))
    assert df.first().k == (None if expected is None else Decimal(expected))


@pytest.mark.parametrize(
    ("values", "expected"),
    [
        ([1.01, 1.00], "1.01"),  # 1.005 exactly
        ([-1.01, -1.00], "-1.01"),
        ([0.1] * 3, "0.10"),
        ([None, 2.0], "2.00"),
        ([None], None),
    ],
)
def test_mean_is_exact(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    exact = numeric.summable(F.col("v"))
    mean = df.agg(numeric.mean(F.sum(exact), F.count(exact)).alias("m")).first().m
    assert mean == (None if expected is None else Decimal(expected))


def test_percent(spark):
    df = spark.createDataFrame([(1, 3), (1, 800), (0, 5), (5, 5), (0, 0)], "a bigint, b bigint")
    shares = [r[0] for r in df.select(numeric.percent(F.col("a"), F.col("b"))).collect()]
    assert shares == [Decimal("33.33"), Decimal("0.13"), Decimal("0.00"), Decimal("100.00"), None]


def test_other_time_zones_are_refused(spark, reports):
    df = reports({})
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            enrich(df)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

from __future__ import annotations

from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from flightlens import plans
from flightlens.operators import summarise
from flightlens.operators.enrich import enrich
from flightlens.plans.states import SKETCH_BITS, UNDATED, States
from flightlens.schema import RAW_FLIGHTS
from flightlens.session import materialise
from flightlens.settings import Scaling
from flightlens.sources.rawstore import RawStore

DAY = 86_400
JANUARY = 1_704_067_200  # 2024-01-01
MIDDLE = datetime(2024, 2, 10)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def year(reports):
    """Reports over three months; arrival follows the event by an hour."""
    built = reports(
        *[
            {
                "icao24": f"a{i % 7}",
                "callsign": ["", f"C{i % 5}", None][i % 3],
                "origin_country": ["Here", "There", None][i % 4 % 3],
                "time_position": JANUARY + i * DAY // 2 if i % 17 else None,
                "velocity": float(i % 40) * 30 if i % 13 else None,
                "baro_altitude": -5.0 if i % 11 == 0 else 100.0,
            }
            for i in range(180)
        ]
    )
    arrival = F.timestamp_seconds(F.coalesce("time_position", F.lit(JANUARY)) + 3600)
    return built.withColumn("fetch_time", arrival).select(*RAW_FLIGHTS.names)


@pytest.fixture
def stepped(spark, year, tmp_path):
    states = States(spark, f"{tmp_path}/states")
    assert states.update(year, cutoff=MIDDLE) == ["202401", "202402", UNDATED]
    assert states.update(year) == ["202402", "202403"]
    return states


def test_reports_equal_a_full_count(year, stepped):
    base = enrich(year)
    assert rows_of(stepped.country_stats()) == rows_of(plans.country_stats(base))
    assert rows_of(stepped.enriched_flights()) == rows_of(plans.enriched_flights(plans.ranked_flights(base)))
    sizes, _ = materialise(base.groupBy("origin_country").agg(summarise.row_count().alias("n")))
    medians = summarise.lower_median(base, ["origin_country"], "velocity_kmh", "m", sizes, "n")
    assert rows_of(stepped.medians()) == rows_of(medians)


def test_ranks_by_shuffled_joins(year, stepped):
    tiny = Scaling(one_task_rows=1, broadcast_rows=1, rows_per_salt=5)
    wanted = plans.enriched_flights(plans.ranked_flights(enrich(year)))
    assert rows_of(stepped.enriched_flights(tiny)) == rows_of(wanted)


def test_any_months_can_be_merged(year, stepped):
    months = ["202401", "202403"]
    base = enrich(year).filter("month(event_date) IN (1, 3)")
    assert rows_of(stepped.country_totals(months).select("origin_country", "total_aircraft", "unique_flights")) == rows_of(
        base.groupBy("origin_country").agg(F.count(F.lit(1)), F.count_distinct("callsign"))
    )
    middle = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY velocity_kmh)").cast("decimal(10,2)")
    assert rows_of(stepped.medians(months)) == rows_of(base.groupBy("origin_country").agg(middle))


def test_only_touched_months_are_written_and_read(spark, year, tmp_path):
    year.write.parquet(f"{tmp_path}/raw")
    raw = spark.read.schema(RAW_FLIGHTS).parquet(f"{tmp_path}/raw")
    states = States(spark, f"{tmp_path}/states")
    states.update(raw, cutoff=datetime(2024, 3, 10))
    before = states.versions()
    assert states.update(raw) == ["202403"]
    after = states.versions()
    assert {m for m in after if after[m] != before.get(m)} == {"202403"}
    # The report needs the states, and no raw row.
    files = states.country_totals().inputFiles() + states.enriched_flights().inputFiles()
    assert files and not any(f"{tmp_path}/raw" in f for f in files)


def test_an_update_that_dies_changes_nothing(spark, year, stepped, monkeypatch):
    before, wanted = stepped.versions(), rows_of(stepped.country_stats())

    def fails(*_, **__):
        raise OSError("disk full")

    later = year.withColumn("fetch_time", F.lit(datetime(2025, 1, 1, tzinfo=UTC)))
    with monkeypatch.context() as broken:
        broken.setattr(States, "_write", fails)
        with pytest.raises(OSError):
            stepped.update(year.unionByName(later))
    assert stepped.versions() == before and rows_of(stepped.country_stats()) == wanted
    stepped.update(year.unionByName(later))
    assert rows_of(stepped.country_stats()) == rows_of(plans.country_stats(enrich(year.unionByName(year))))


def test_nothing_new(year, stepped):
    assert stepped.update(year) == [] and len(stepped.log()) == 2


def test_a_store_is_followed_by_its_loads(spark, year, tmp_path):
    store, states = RawStore(spark, f"{tmp_path}/raw"), States(spark, f"{tmp_path}/states")
    # The second load is not newer than the first: what is new is told by the log.
    for number in (1, 0):
        store.add(year.filter(F.dayofmonth("fetch_time") % 2 == number), f"load-{number}")
        states.update(store)
    store.compact()
    assert states.update(store) == []
    assert rows_of(states.country_stats()) == rows_of(plans.country_stats(enrich(year)))
    store.add(year.limit(0), "nothing")
    assert states.update(store) == [] and states.log()[-1]["loads"] == ["nothing"]


def test_sketches_stay_within_their_bound(spark, reports, tmp_path):
    """Merged over months that share callsigns, empty ones included."""
    wanted = 30_000
    ids = spark.range(2 * wanted)
    base = reports({}).drop("callsign", "time_position").crossJoin(
        ids.select(
            F.when(F.col("id") == 0, "").otherwise(F.concat(F.lit("C"), (F.col("id") % wanted).cast("string"))).alias("callsign"),
            (JANUARY + F.when(F.col("id") < wanted, 0).otherwise(40 * DAY)).cast("bigint").alias("time_position"),
        )
    )
    states = States(spark, str(tmp_path))
    states.update(base.select(*RAW_FLIGHTS.names))
    exact = states.country_totals().first()["unique_flights"]
    error = 1.04 / 2 ** (SKETCH_BITS / 2)
    assert exact == wanted + 1
    assert abs(states.flight_estimates().first()["unique_flights"] / exact - 1) < 4 * error


def test_no_states_yet(spark, year, tmp_path):
    states = States(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        states.country_stats()
    assert states.update(year.limit(0)) == []
    assert not Path(tmp_path / "none").exists()


def test_sweep_removes_replaced_versions(year, stepped):
    kept, wanted = stepped.versions(), rows_of(stepped.country_stats())
    stepped.update(year, since=datetime(2024, 1, 1))
    assert not set(kept.values()) & set(stepped.versions().values())
    later = datetime.now(UTC) + timedelta(days=2)
    assert stepped.sweep(timedelta(days=1)) == []
    assert sorted(stepped.sweep(timedelta(days=1), later)) == sorted({f"version={v}" for v in kept.values()})
    assert rows_of(stepped.country_stats()) == wanted

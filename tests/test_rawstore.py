from __future__ import annotations

from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from flightlens.plans.refresh import refresh
from flightlens.schema import RAW_FLIGHTS
from flightlens.sources.rawstore import RawStore, read_raw

DAY = 86_400
JANUARY = 1_704_067_200  # 2024-01-01


@pytest.fixture
def store(spark, reports, tmp_path):
    """Four loads of a day each, every report an hour old when fetched, one without a time."""
    made = RawStore(spark, f"{tmp_path}/raw")
    for day in range(4):
        first = JANUARY + day * DAY
        rows = reports(*[{"time_position": first + i * 60} for i in range(10)], {"time_position": None})
        fetched = F.timestamp_seconds(F.coalesce("time_position", F.lit(first)) + 3600)
        made.add(rows.withColumn("fetch_time", fetched).select(*RAW_FLIGHTS.names), f"day-{day}", rejected=day)
    return made


def rows_of(df):
    return sorted(map(repr, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entries_describe_the_loads(store):
    entry = {e["load"]: e for e in store.log()}["day-1"]
    assert (entry["loaded"], entry["undated"], entry["rejected"]) == (11, 1, 1)
    assert (entry["event_from"], entry["event_to"]) == (JANUARY + DAY, JANUARY + DAY + 540)
    assert store.read().count() == 44


def test_a_snapshot_opens_the_partitions_it_needs(spark, store):
    cutoff = datetime(2024, 1, 2, 1, 3, tzinfo=UTC)
    early = store.read(cutoff)
    assert rows_of(early) == rows_of(store.read().filter(F.col("fetch_time") <= F.lit(cutoff))) and early.count() == 11 + 5
    plan = plan_of(early)
    assert "PartitionFilters: [isnotnull(fetch_day" in plan
    assert "day-1" in "".join(early.inputFiles()) and "day-2" not in "".join(early.inputFiles())
    assert read_raw(spark, store.path, cutoff).count() == early.count()


def test_event_times_choose_the_loads(store):
    near = store.read(events=[(JANUARY + DAY, JANUARY + DAY + 120)])
    assert near.count() == 2
    assert {Path(f).parts[-3] for f in near.inputFiles()} == {"load=day-1"}
    assert store.read(events=[(0, 5)]).count() == 0 and store.read(events=[]).count() == 0


def test_a_load_is_entered_once(store, reports):
    assert store.add(reports({}), "day-0")["loaded"] == 11
    assert len(store.log()) == 4 and store.read().count() == 44


def test_readers_do_not_see_a_load_without_entry(store, reports):
    reports({}).withColumn("fetch_day", F.lit("2024-01-01")).write.partitionBy("fetch_day").parquet(f"{store.path}/load=dead")
    assert store.read().count() == 44


def test_compaction_keeps_the_rows(spark, store):
    before, held = rows_of(store.read()), store.read()
    entry = store.compact()
    assert sorted(entry["replaces"]) == [f"day-{i}" for i in range(4)]
    assert entry["rejected"] == 6 and entry["loaded"] == 44
    assert rows_of(store.read()) == before
    assert [e["load"] for e in store.loads()] == [entry["load"]]
    # One file a day, and a reader that began before still finds its files.
    assert len(store.read().inputFiles()) == 4 and rows_of(held) == before
    assert store.compact() is None


def test_only_small_loads_are_joined(store, reports):
    store.add(reports(*[{}] * 30), "large")
    store.compact(small=20)
    assert "large" in {e["load"] for e in store.loads()} and store.read().count() == 74


def test_empty_loads(spark, reports, tmp_path):
    store = RawStore(spark, str(tmp_path))
    assert not store.exists() and store.read().count() == 0 and store.compact() is None
    store.add(reports({}).limit(0), "nothing")
    assert store.exists() and store.read().count() == 0
    assert read_raw(spark, str(tmp_path)).columns == RAW_FLIGHTS.names


def test_refresh_reads_a_store(spark, store, tmp_path):
    done = refresh(read_raw(spark, store.path), f"{tmp_path}/out")
    assert done.written["enriched_flights"] == 40 and done.quarantined["enriched_flights"] == 4


def test_sweep_removes_what_no_reader_needs(store, reports):
    reports({}).withColumn("fetch_day", F.lit("2024-01-01")).write.partitionBy("fetch_day").parquet(f"{store.path}/load=dead")
    entry, before = store.compact(), rows_of(store.read())
    later = datetime.now(UTC) + timedelta(days=2)
    assert store.sweep(timedelta(days=1)) == []
    assert sorted(store.sweep(timedelta(days=1), later)) == sorted([*(f"load=day-{i}" for i in range(4)), "load=dead"])
    assert rows_of(store.read()) == before
    assert {p.name for p in Path(store.path).glob("load=*")} == {f"load={entry['load']}"}


def test_a_view_is_there_before_and_after_loads(spark, reports, store, tmp_path):
    RawStore(spark, f"{tmp_path}/none").create_view("raw_test")
    assert spark.table("raw_test.raw_flights").columns == RAW_FLIGHTS.names and spark.table("raw_test.raw_flights").count() == 0
    store.create_view("raw_test")
    wanted = rows_of(store.read())
    assert rows_of(spark.table("raw_test.raw_flights")) == wanted
    store.compact()
    assert rows_of(spark.table("raw_test.raw_flights")) == wanted
    store.create_view("raw_test")
    assert rows_of(spark.table("raw_test.raw_flights")) == wanted
    spark.sql("DROP DATABASE raw_test CASCADE")

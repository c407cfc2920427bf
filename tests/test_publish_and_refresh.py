from __future__ import annotations

from datetime import UTC, date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from flightlens import plans
from flightlens.operators import quality
from flightlens.operators.dedupe import first_reports
from flightlens.operators.enrich import enrich
from flightlens.plans import refresh as refreshing
from flightlens.plans.refresh import published_path, quarantined_reports, refresh, refresh_months, sweep_runs
from flightlens.schema import (
    ANALYTICS_LAYOUT,
    COUNTRY_LAYOUT,
    ENRICHED_LAYOUT,
    LAYOUTS,
    RAW_FLIGHTS,
    TEXT_LIMITS,
)
from flightlens.session import scratch_path, shared_dir
from flightlens.sources import publish, raw

DAY = 86_400
JANUARY = 1_704_067_200  # 2024-01-01


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def year(reports):
    """Reports over three months; arrival follows the event by an hour."""
    built = reports(
        *[
            {
                "icao24": f"a{i % 7}",
                "callsign": f"C{i % 5}" if i % 6 else None,
                "origin_country": ["Here", "There", "Here"][i % 3],
                "time_position": JANUARY + i * DAY // 2 if i % 17 else None,
                "velocity": float(i % 40) * 30 if i % 13 else None,
            }
            for i in range(180)
        ]
    )
    arrival = F.timestamp_seconds(F.coalesce("time_position", F.lit(JANUARY)) + 3600)
    return built.withColumn("fetch_time", arrival).select(*RAW_FLIGHTS.names)


def test_refresh_twice_gives_the_same_tables(spark, year, tmp_path):
    out = str(tmp_path)
    first = refresh(year, out)
    tables = {n: rows_of(publish.read_published(spark, published_path(spark, out, n), LAYOUTS[n])) for n in first.written}
    second = refresh(year, out)
    again = {n: rows_of(publish.read_published(spark, published_path(spark, out, n), LAYOUTS[n])) for n in first.written}
    assert tables == again and first == second
    assert {n: len(rows) for n, rows in tables.items()} == first.written
    log = spark.read.parquet(f"{out}/refresh_log")
    assert log.count() == 2 * len(first.written) == 8


def test_refresh_accounts_for_every_report(year, tmp_path):
    done = refresh(year, str(tmp_path))
    undated = year.filter("time_position IS NULL").count()
    assert done.quarantined["enriched_flights"] == undated > 0
    assert done.written["enriched_flights"] + undated == year.count()
    assert done.written["country_stats"] == 2


def test_month_directories_and_pruning(spark, year, tmp_path):
    out = str(tmp_path)
    refresh(year, out)
    months = {p.name for p in Path(published_path(spark, out, "enriched_flights")).glob("event_month=*")}
    assert months == {"event_month=202401", "event_month=202402", "event_month=202403"}
    february = publish.read_published(
        spark, published_path(spark, out, "enriched_flights"), ENRICHED_LAYOUT, date(2024, 2, 10), date(2024, 2, 12)
    )
    assert {r.event_date for r in february.select("event_date").collect()} == {
        date(2024, 2, 10),
        date(2024, 2, 11),
        date(2024, 2, 12),
    }
    plan = february._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan


def test_cutoff_is_one_snapshot(spark, year, tmp_path):
    cutoff = datetime(2024, 2, 1)
    done = refresh(year, str(tmp_path), cutoff)
    early = year.filter(F.col("fetch_time") <= F.lit(cutoff.replace(tzinfo=UTC)))
    assert sum(t[k]["enriched_flights"] for t in [vars(done)] for k in t) == early.count()
    table = publish.read_published(spark, published_path(spark, str(tmp_path), "country_stats"), COUNTRY_LAYOUT)
    assert table.agg(F.sum("total_aircraft")).first()[0] == early.count()


def test_incremental_months_equal_a_full_refresh(spark, year, tmp_path):
    refresh_months(year, f"{tmp_path}/steps", since=datetime(1970, 1, 1), cutoff=datetime(2024, 2, 10))
    refresh_months(year, f"{tmp_path}/steps", since=datetime(2024, 2, 10))
    refresh(year, f"{tmp_path}/whole")
    steps, whole = (
        publish.read_published(spark, published_path(spark, f"{tmp_path}/{n}", "flights_analytics"), ANALYTICS_LAYOUT)
        for n in ("steps", "whole")
    )
    assert rows_of(steps) == rows_of(whole)


def test_incremental_leaves_other_months_alone(spark, year, tmp_path):
    out = str(tmp_path)
    refresh(year, out)
    folder = Path(published_path(spark, out, "flights_analytics"), "event_month=202401")
    before = {p.name: p.stat().st_mtime_ns for p in folder.iterdir()}
    done = refresh_months(year, out, since=datetime(2024, 3, 5))
    assert done.written["flights_analytics"] > 0
    assert {p.name: p.stat().st_mtime_ns for p in folder.iterdir()} == before


def test_an_earlier_cutoff_leaves_nothing_of_the_later_run(spark, year, tmp_path):
    out, cutoff = str(tmp_path / "both"), datetime(2024, 2, 1)
    refresh(year, out)
    refresh(year, out, cutoff)
    refresh(year, str(tmp_path / "fresh"), cutoff)
    for name, layout in LAYOUTS.items():
        tables = [publish.read_published(spark, published_path(spark, o, name), layout) for o in (out, str(tmp_path / "fresh"))]
        assert rows_of(tables[0]) == rows_of(tables[1])


def test_readers_keep_the_old_run_when_a_write_fails(spark, year, tmp_path, monkeypatch):
    out = str(tmp_path)
    refresh(year, out)
    path = published_path(spark, out, "country_stats")

    def fails(*_, **__):
        raise OSError("disk full")

    monkeypatch.setattr(refreshing, "_publish_summary", fails)
    with pytest.raises(OSError):
        refresh(year, out, datetime(2024, 2, 1))
    assert published_path(spark, out, "country_stats") == path


def test_quarantine_outlives_other_months(spark, year, tmp_path):
    out = str(tmp_path)
    refresh(year, out)
    path = published_path(spark, out, "quarantine/flights_analytics")
    before = rows_of(spark.read.parquet(path))
    assert refresh_months(year, out, since=datetime(2024, 3, 5)).quarantined == {"flights_analytics": 0}
    assert rows_of(spark.read.parquet(path)) == before and before


def test_the_source_is_read_for_one_write_only(spark, year, tmp_path):
    year.write.parquet(f"{tmp_path}/raw")
    raw_rows = spark.sparkContext.accumulator(0)

    def seen(row):
        raw_rows.add(1)
        return row["icao24"]

    counted = spark.read.parquet(f"{tmp_path}/raw")
    marked = counted.withColumn("icao24", F.udf(seen, "string").asNondeterministic()(F.struct("icao24")))
    refresh(marked.select(*RAW_FLIGHTS.names), f"{tmp_path}/out", dedupe=True)
    # Removing repeats reads the rows with and without a time apart; nothing reads them again.
    assert year.count() <= raw_rows.value <= 2 * year.count()


def test_nothing_new(year, tmp_path):
    assert refresh_months(year, str(tmp_path), since=datetime(2030, 1, 1)).written == {"flights_analytics": 0}


def test_empty_raw_table(spark, tmp_path):
    done = refresh(spark.createDataFrame([], RAW_FLIGHTS), str(tmp_path))
    assert set(done.written.values()) == {0}


def test_failure_leaves_the_job(year):
    with pytest.raises(Exception):
        refresh(year, "/proc/nowhere")


def test_dedupe_keeps_the_first_copy(year):
    later = year.withColumn("fetch_time", F.col("fetch_time") + F.expr("INTERVAL 1 HOUR"))
    once = first_reports(year.unionByName(later))
    undated = year.filter("time_position IS NULL").count()
    assert once.count() == year.count() + undated
    dated = "time_position IS NOT NULL"
    assert rows_of(once.filter(dated)) == rows_of(year.filter(dated))


def test_summaries_agree_with_each_other(year):
    base = enrich(year)
    country = {r.origin_country: r for r in plans.country_stats(base).collect()}
    analytics = plans.flights_analytics(base)
    sums = analytics.groupBy("origin_country").agg(
        F.sum("flight_count").alias("n"), F.sum("anomaly_count").alias("a")
    )
    for r in sums.collect():
        assert country[r.origin_country].total_aircraft == r.n
        assert country[r.origin_country].anomaly_count == r.a
    assert sum(r.total_aircraft for r in country.values()) == base.count()
    assert abs(float(sum(r.percentage_of_total for r in country.values())) - 100) < 0.02
    assert rows_of(analytics) == rows_of(plans.flights_analytics(base, median="approx"))


def test_equal_countries_share_a_rank(reports):
    df = reports({"origin_country": "A"}, {"origin_country": "B"}, {"origin_country": None})
    ranks = [r.global_rank for r in plans.country_stats(enrich(df)).collect()]
    assert ranks == [1, 1, 1]


def test_unpublishable_numbers_are_set_aside(reports):
    df = enrich(reports({"velocity": float("nan")}, {"baro_altitude": 1e12, "geo_altitude": 1.0}, {"icao24": None}, {}))
    found = sorted(tuple(r.reject_reasons) for r in quarantined_reports(df).collect())
    assert found == [("baro_altitude_out_of_range",), ("icao24_missing",), ("velocity_kmh_out_of_range",)]


def test_text_limits(spark):
    df = spark.createDataFrame([("X" * 11, "ok")], "icao24 string, callsign string")
    checks = quality.text_length_checks(df.columns)
    assert list(checks) == ["icao24_too_long", "callsign_too_long"] and len(TEXT_LIMITS) == 4
    assert quality.with_reasons(df, checks).first().reject_reasons == ["icao24_too_long"]


def test_counters_need_no_extra_pass(reports):
    checked = quality.with_reasons(reports({}, {"icao24": None}), {"missing": F.col("icao24").isNull()})
    observed_rows, observed = quality.observe_load(checked)
    observed_rows.write.format("noop").mode("overwrite").save()
    assert quality.observed_rows(observed) == 2
    assert quality.observed_rows(observed, "accepted_rows") == 1


def test_published_types(year):
    base = enrich(year)
    for df, layout in (
        (plans.enriched_flights(plans.ranked_flights(base)), ENRICHED_LAYOUT),
        (plans.country_stats(base), COUNTRY_LAYOUT),
        (plans.flights_analytics(base), ANALYTICS_LAYOUT),
        (plans.flights_slim(plans.ranked_flights(base)), LAYOUTS["flights_slim"]),
    ):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in layout.schema]


def test_catalog_tables(spark, year, tmp_path):
    publish.create_published_tables(spark, LAYOUTS, str(tmp_path))
    publish.create_published_tables(spark, LAYOUTS, str(tmp_path))
    summary = plans.flights_analytics(enrich(year)).filter("event_date IS NOT NULL")
    for _ in range(2):
        publish.publish_table(summary, "flights_analytics", ANALYTICS_LAYOUT)
    assert rows_of(spark.table("flights_analytics").drop("event_month")) == rows_of(summary)
    for name in LAYOUTS:
        spark.sql(f"DROP TABLE {name}")


def test_raw_append_and_read(spark, year, tmp_path):
    for _ in range(2):
        publish.append_parquet(year, f"{tmp_path}/raw")
    assert raw.read_parquet(spark, f"{tmp_path}/raw").count() == 2 * year.count()


def test_files_are_sorted(spark, year, tmp_path):
    publish.publish_parquet(
        plans.flights_analytics(enrich(year)).filter("event_date IS NOT NULL"), str(tmp_path), ANALYTICS_LAYOUT
    )
    files = list(tmp_path.glob("event_month=*/*.parquet"))
    assert files
    for file in files:
        keys = [tuple(r) for r in spark.read.parquet(str(file)).select(*ANALYTICS_LAYOUT.sort_by).collect()]
        assert keys == sorted(keys)


def test_database_options():
    options = raw.jdbc_options("jdbc:x:y", "raw_flights", "a.Driver", user="me")
    assert options == {"url": "jdbc:x:y", "dbtable": "raw_flights", "driver": "a.Driver", "user": "me"}
    parts = raw.partition_options("2024-01-01", "2024-02-01", 8)
    assert parts["partitionColumn"] == "fetch_time" and parts["numPartitions"] == "8"
    assert publish.jdbc_write_options(options, "append")["batchsize"] == "10000"
    assert "truncate" not in publish.jdbc_write_options(options, "append")
    assert publish.jdbc_write_options(options, "overwrite")["truncate"] == "true"


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/x-")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_sweep_keeps_the_newest_runs_and_running_ones(spark, year, tmp_path):
    out = str(tmp_path)
    runs = []
    for _ in range(3):
        refresh(year, out)
        runs.append(refreshing.published_root(spark, out).rpartition("/")[2])
    # A run at work has written something, and no entry.
    spark.range(1).write.parquet(f"{out}/run-working/part")
    later = datetime.now(UTC) + timedelta(days=2)
    assert sweep_runs(spark, out, keep=2, idle=timedelta(days=1)) == []
    assert sweep_runs(spark, out, keep=2, idle=timedelta(days=3), now=later) == []
    gone = sweep_runs(spark, out, keep=2, idle=timedelta(days=1), now=later)
    assert sorted(gone) == sorted([runs[0], "run-working"])
    assert rows_of(spark.read.parquet(published_path(spark, out, "country_stats")))
    assert {p.name for p in tmp_path.glob("run-*")} == set(runs[1:])
    # The newest run stays, whatever is asked for.
    assert sweep_runs(spark, out, keep=0, idle=timedelta(0), now=later) == [runs[1]]
    assert sweep_runs(spark, str(tmp_path / "none"), 1, timedelta(0)) == []


def test_quarantine_lies_by_month(spark, year, tmp_path):
    out = str(tmp_path)
    refresh(year, out)
    path = published_path(spark, out, "quarantine/flights_analytics")
    assert {p.name for p in Path(path).glob("event_month=*")} == {"event_month=undated"}


def test_tables_are_there_before_and_after_a_load(spark, year, tmp_path, monkeypatch):
    out, base = str(tmp_path), "flights_test"
    publish.create_views(spark, LAYOUTS, base)
    assert spark.table(f"{base}.country_stats").count() == 0
    assert spark.table(f"{base}.enriched_flights").columns == [*ENRICHED_LAYOUT.schema.names, "event_month"]
    refresh(year, out, datetime(2024, 2, 1), database=base)
    before = {n: rows_of(spark.table(f"{base}.{n}")) for n in LAYOUTS}
    assert all(before.values())

    def fails(*_, **__):
        raise OSError("disk full")

    with monkeypatch.context() as broken:
        # Three tables of the new run are in place when it dies.
        broken.setattr(refreshing, "_log", fails)
        with pytest.raises(OSError):
            refresh(year, out, database=base)
    assert {n: rows_of(spark.table(f"{base}.{n}")) for n in LAYOUTS} == before
    old = refreshing.published_root(spark, out).rpartition("/")[2]
    refresh(year, out, database=base)
    assert rows_of(spark.table(f"{base}.country_stats")) == rows_of(plans.country_stats(enrich(year)))
    publish.forget_runs(spark, base, [old])
    assert spark.table(f"{base}.country_stats").count() == 2
    assert not any(old.replace("-", "_") in r["tableName"] for r in spark.sql(f"SHOW TABLES IN {base}").collect())
    spark.sql(f"DROP DATABASE {base} CASCADE")


def test_numbers_left_out_of_means_are_counted(reports, tmp_path):
    rows = reports({}, {"baro_altitude": 1e12}, {"baro_altitude": float("nan")}, {"geo_altitude": float("-inf")}, {"baro_altitude": None})
    done = refresh(rows.withColumn("fetch_time", F.lit(datetime(2024, 1, 1, tzinfo=UTC))).select(*RAW_FLIGHTS.names), str(tmp_path))
    assert done.left_out == {"baro_altitude": 2, "geo_altitude": 1}


def test_a_load_stamp_is_one_time(year):
    stamped = plans.reports.load_stamped(plans.flights_analytics(enrich(year)))
    assert stamped.select("load_timestamp").distinct().count() == 1

from __future__ import annotations

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from flightlens import plans
from flightlens.operators.dedupe import first_reports_in_stream
from flightlens.operators.enrich import enrich
from flightlens.plans.refresh import published_path
from flightlens.schema import ANALYTICS_LAYOUT, RAW_FLIGHTS
from flightlens.sources.publish import read_published
from flightlens.sources.payloads import raw_from_payloads
from flightlens.sources.raw import read_parquet
from flightlens.sources.rawstore import RawStore, read_raw
from flightlens.streaming.landing import Totals, land_batch, land_payloads, refresh_arrivals

RECORD = ["abc123", "AB1", "Here", 1_704_067_200, 2, 3.5, 4.5, 5.5, True, 6.5, 7.5, 8.5, 9.5, "1200", False, 0]


def land(spark, root, **options):
    places = (f"{root}/{name}" for name in ("landed", "raw", "rejects", "checkpoints"))
    totals = land_payloads(spark, *places, **options).wait()
    return read_raw(spark, f"{root}/raw"), spark.read.parquet(f"{root}/rejects"), totals


def test_each_file_is_loaded_once(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "1.json").write_text(json.dumps({"states": [RECORD, RECORD, 7]}))
    (landed / "2.json").write_text("{bad")
    (landed / "3.json").write_text("")
    raw, rejects, totals = land(spark, tmp_path)
    assert (raw.count(), rejects.count()) == (2, 2)
    assert totals == Totals(loaded=2, rejected=1, unreadable=1)
    assert str(totals) == "2 of 3 records loaded, 1 rejected, 1 payloads unreadable"
    assert "{bad" in {r.record for r in rejects.collect()}
    raw, rejects, totals = land(spark, tmp_path)
    assert (raw.count(), rejects.count()) == (2, 2) and totals == Totals()
    (landed / "4.json").write_text(json.dumps({"states": [RECORD]}, indent=1))
    raw, _, totals = land(spark, tmp_path)
    assert raw.count() == 3 and totals.loaded == 1
    assert raw.schema.names == RAW_FLIGHTS.names
    assert raw.filter("fetch_time IS NULL").count() == 0


def test_one_payload_per_line_and_fixed_stamp(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    line = json.dumps({"states": [RECORD]})
    (landed / "1.txt").write_text("\n".join([line, "{bad", line]))
    stamp = datetime(2024, 1, 1, 5, tzinfo=UTC)
    raw, *_ = land(spark, tmp_path, one_per_line=True, fetch_time=stamp, files_per_batch=1)
    assert raw.count() == raw.filter(F.col("fetch_time") == F.lit(stamp)).count() == 2


def typed_batch(spark, tmp_path, *payloads):
    rows = spark.createDataFrame([(p, f"f{i}") for i, p in enumerate(payloads)], "value string, file_path string")
    return raw_from_payloads(rows, datetime(2024, 1, 1))


def test_a_batch_that_runs_twice_adds_nothing(spark, tmp_path):
    store, done = RawStore(spark, f"{tmp_path}/raw"), []
    land = land_batch(store, f"{tmp_path}/rejects", done.append, stream="s")
    batch = typed_batch(spark, tmp_path, json.dumps({"states": [RECORD, 7]}), "{bad")
    land(batch, 0)
    land(batch, 0)
    assert store.read().count() == 1 and spark.read.parquet(f"{tmp_path}/rejects").count() == 2
    assert done == [Totals(1, 1, 1)] and len(store.log()) == 1


def test_a_batch_that_died_is_replaced(spark, tmp_path, monkeypatch):
    store, done = RawStore(spark, f"{tmp_path}/raw"), []
    land = land_batch(store, f"{tmp_path}/rejects", done.append, stream="s")
    batch = typed_batch(spark, tmp_path, json.dumps({"states": [RECORD, RECORD, 7]}))
    with monkeypatch.context() as broken:
        # Rows are in place, the entry is not.
        broken.setattr(RawStore, "log_path", property(lambda self: "/proc/nowhere"))
        with pytest.raises(Exception):
            land(batch, 0)
    assert store.read().count() == 0 and not done
    land(batch, 0)
    assert store.read().count() == 2 and spark.read.parquet(f"{tmp_path}/rejects").count() == 1


def test_a_payload_is_parsed_once(spark, tmp_path):
    """Both tables of a batch are written from one scan of its payloads."""
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "1.json").write_text(json.dumps({"states": [RECORD, 7]}))
    parsed = spark.sparkContext.accumulator(0)

    def seen(text):
        parsed.add(1)
        return text

    rows = spark.read.text(str(landed), wholetext=True).withColumn("file_path", F.lit("f"))
    marked = rows.withColumn("value", F.udf(seen, "string").asNondeterministic()("value"))
    store = RawStore(spark, f"{tmp_path}/raw")
    land_batch(store, f"{tmp_path}/rejects", lambda _: None, stream="s")(raw_from_payloads(marked, datetime(2024, 1, 1)), 0)
    assert store.read().count() == 1 and parsed.value == 1


def test_repeats_are_left_out_across_batches_and_restarts(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    other = [*RECORD[:3], 1_704_067_201, *RECORD[4:]]
    undated = [*RECORD[:3], None, *RECORD[4:]]
    (landed / "1.txt").write_text("\n".join(json.dumps({"states": [RECORD, undated, 7]}) for _ in range(2)))
    raw, rejects, totals = land(spark, tmp_path, one_per_line=True, dedupe="2 days")
    # Records without a time, and bad ones, have no identity: none of them goes.
    assert (raw.count(), rejects.count()) == (3, 2) and totals == Totals(3, 2, 0)
    (landed / "2.txt").write_text(json.dumps({"states": [RECORD, other]}))
    raw, _, totals = land(spark, tmp_path, one_per_line=True, dedupe="2 days")
    assert totals.loaded == 1
    assert raw.where("time_position IS NOT NULL").count() == 2


def test_summary_follows_the_log_of_a_store(spark, reports, tmp_path):
    raw_path, out, checkpoint = (f"{tmp_path}/{n}" for n in ("raw", "out", "checkpoint"))
    store = RawStore(spark, raw_path)
    stamp = F.lit(datetime(2024, 1, 1, tzinfo=UTC))
    january, february = 1_704_067_200, 1_706_745_600
    for number, first in enumerate((january, february, january)):
        batch = reports(*[{"time_position": first + i * 3600, "velocity": i * 10.0} for i in range(5)])
        store.add(batch.withColumn("fetch_time", stamp), f"load-{number}")
        refresh_arrivals(spark, raw_path, out, checkpoint).awaitTermination()
    store.compact()
    refresh_arrivals(spark, raw_path, out, checkpoint).awaitTermination()
    got = read_published(spark, published_path(spark, out, "flights_analytics"), ANALYTICS_LAYOUT).drop("event_month")
    full = plans.flights_analytics(enrich(store.read()))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect()))
    assert got.agg(F.sum("flight_count")).first()[0] == 15


def test_summary_follows_the_raw_table(spark, reports, tmp_path):
    raw_path, out, checkpoint = (f"{tmp_path}/{n}" for n in ("raw", "out", "checkpoint"))
    stamp = F.lit(datetime(2024, 1, 1, tzinfo=UTC))
    january, february = 1_704_067_200, 1_706_745_600
    for first in (january, february, january):
        batch = reports(*[{"time_position": first + i * 3600, "velocity": i * 10.0} for i in range(5)])
        batch.withColumn("fetch_time", stamp).write.mode("append").parquet(raw_path)
        refresh_arrivals(spark, raw_path, out, checkpoint).awaitTermination()
    got = read_published(spark, published_path(spark, out, "flights_analytics"), ANALYTICS_LAYOUT).drop("event_month")
    full = plans.flights_analytics(enrich(read_parquet(spark, raw_path)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.collect()))
    assert got.agg(F.sum("flight_count")).first()[0] == 15


def test_repeated_reports_are_dropped_in_a_stream(spark, reports, tmp_path):
    stamp = F.lit(datetime(2024, 1, 1, tzinfo=UTC))
    same = {"icao24": "a", "time_position": 5}
    unknown = {"icao24": "b", "time_position": None}
    rows = reports(same, same, unknown, unknown, {"icao24": "c", "time_position": 5})
    rows.withColumn("fetch_time", stamp).write.parquet(f"{tmp_path}/raw")
    stream = first_reports_in_stream(spark.readStream.schema(RAW_FLIGHTS).parquet(f"{tmp_path}/raw"), "2 hours")
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted(r.icao24 for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b", "b", "c"]

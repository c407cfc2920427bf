"""Every operator as a named query over the test tables, with its oracle."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlens import plans
from flightlens.functions import numeric
from flightlens.operators import quality, summarise
from flightlens.operators.dedupe import first_reports
from flightlens.operators.enrich import enrich, fill_geo_altitude, with_position
from flightlens.operators.lookup import null_safe_join
from flightlens.operators.rank import group_stats, rank_and_share, rank_overall, rank_within
from flightlens.plans import refresh as refreshing
from flightlens.plans.observations import observations, payloads
from flightlens.plans.reports import COUNTRY_SPEEDS, country_totals, load_stamped, null_to_zero
from flightlens.plans.states import SKETCH_BITS, States
from flightlens.schema import (
    ANALYTICS_KEYS,
    ANALYTICS_LAYOUT,
    COUNTRY_LAYOUT,
    ENRICHED_LAYOUT,
    LAYOUTS,
    RAW_FLIGHTS,
)
from flightlens.session import materialise, scratch_path
from flightlens.settings import PAYLOAD_CAP
from flightlens.sources.payloads import (
    MALFORMED,
    accepted_rows,
    explode_states,
    parse_payloads,
    raw_from_payloads,
    rejected_rows,
)
from flightlens.sources.publish import append_parquet, publish_parquet, read_published
from flightlens.sources.raw import read_parquet
from flightlens.sources.rawstore import RawStore, read_raw
from flightlens.streaming.landing import Totals, land_payloads

Query = Callable[[SparkSession, str], DataFrame]

LOAD_TIME = datetime(2024, 2, 1)
_REPORT_ID = ("icao24", "last_contact", "squawk")


def comparable(df: DataFrame) -> DataFrame:
    """Types that two engines share: bigint, double, timestamp without zone."""

    def shared(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.ShortType, T.IntegerType)):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        return column

    return df.select(*[shared(f) for f in df.schema])


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(observations(spark, sf_dir))


def _columns(*names: str) -> Query:
    """Derived columns next to what identifies the report."""
    return lambda spark, sf_dir: _base(spark, sf_dir).select(*_REPORT_ID, *names)


def _by_keys(aggregates: Callable[[], list[Column]]) -> Query:
    """A five-key summary; columns are built once there is a session."""
    return lambda spark, sf_dir: _base(spark, sf_dir).groupBy(*ANALYTICS_KEYS).agg(*aggregates())


def _typed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from_payloads(payloads(spark, sf_dir), LOAD_TIME)


def scan_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    append_parquet(observations(spark, sf_dir), path)
    return read_parquet(spark, path)


def raw_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).agg(F.count(F.lit(1)).alias("raw_rows"))


def altitude_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = fill_geo_altitude(observations(spark, sf_dir))
    return filled.select(*_REPORT_ID, "baro_altitude", "geo_altitude")


def valid_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_position(observations(spark, sf_dir)).select(*_REPORT_ID, "longitude", "latitude")


def zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_to_zero(_base(spark, sf_dir)).select(
        *_REPORT_ID, "velocity_kmh", "baro_altitude", "geo_altitude"
    )


def conform_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published types with gaps kept: a plain narrowing, no zero filling."""
    base = _base(spark, sf_dir)
    return base.select(
        *_REPORT_ID,
        "velocity_kmh",
        numeric.two_decimals(F.col("baro_altitude")).alias("baro_altitude"),
        numeric.two_decimals(F.col("geo_altitude")).alias("geo_altitude"),
        F.col("is_anomaly").try_cast("smallint").alias("is_anomaly"),
    )


def agg_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _base(spark, sf_dir)
    sizes, _ = materialise(base.groupBy("origin_country").agg(summarise.row_count().alias("rows")))
    return summarise.lower_median(
        base, ["origin_country"], "velocity_kmh", "median_velocity_kmh", sizes, "rows"
    )


def _anomaly_counts() -> list[Column]:
    return [summarise.row_count().alias("flight_count"), F.sum("is_anomaly").alias("anomaly_count")]


def anomaly_percentage(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _by_keys(_anomaly_counts)(spark, sf_dir)
    share = numeric.percent(F.col("anomaly_count"), F.col("flight_count"))
    return counted.withColumn("anomaly_percentage", share)


def rank_in_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = rank_within(_base(spark, sf_dir), ["origin_country"], "velocity_kmh", "rank_in_country")
    return ranked.select(*_REPORT_ID, "origin_country", "velocity_kmh", "rank_in_country")


def top_in_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = rank_within(
        _base(spark, sf_dir), ["origin_country"], "velocity_kmh", "rank_in_country", top=10
    )
    return ranked.select(*_REPORT_ID, "origin_country", "velocity_kmh", "rank_in_country")


def speed_rank_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = rank_overall(_base(spark, sf_dir), "velocity_kmh", "speed_rank_global")
    return ranked.select(*_REPORT_ID, "velocity_kmh", "speed_rank_global")


def rank_by_altitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks by a number that is no short decimal."""
    ranked = rank_overall(_base(spark, sf_dir), "geo_altitude", "altitude_rank")
    return ranked.select(*_REPORT_ID, "geo_altitude", "altitude_rank")


def country_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = group_stats(_base(spark, sf_dir), ["origin_country"], "velocity_kmh", COUNTRY_SPEEDS)
    return compared.select(*_REPORT_ID, "origin_country", *COUNTRY_SPEEDS)


def _ranked_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = _base(spark, sf_dir).groupBy("origin_country").agg(
        summarise.row_count().alias("total_aircraft")
    )
    table, size = materialise(counted)
    return rank_and_share(table, size, "total_aircraft", "global_rank", "percentage_of_total")


def country_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked_countries(spark, sf_dir).select("origin_country", "total_aircraft", "global_rank")


def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked_countries(spark, sf_dir).select(
        "origin_country", "total_aircraft", "percentage_of_total"
    )


def enriched_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.enriched_flights(plans.ranked_flights(_base(spark, sf_dir)))


def flights_slim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.flights_slim(plans.ranked_flights(_base(spark, sf_dir)))


def country_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.country_stats(_base(spark, sf_dir))


def flights_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.flights_analytics(_base(spark, sf_dir))


def analytics_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary as one load would have stamped it."""
    return load_stamped(flights_analytics(spark, sf_dir), LOAD_TIME)


def left_out_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Altitudes that no mean can take, for the reports and the same ten billion times as high."""
    base = _base(spark, sf_dir)
    scaled = base.withColumns({c: F.col(c) * 1e10 for c in refreshing.AVERAGED})
    both = base.unionByName(scaled)
    return both.agg(*[F.count_if(numeric.left_out(F.col(c))).alias(c) for c in refreshing.AVERAGED])


def raw_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table by its name in a database, after loads and a compaction."""
    path = scratch_path(spark, "raw-view")
    store, name = RawStore(spark, path), f"raw_{path.rpartition('-')[2]}"
    store.create_view(name)
    raw = observations(spark, sf_dir)
    for part in range(2):
        store.add(raw.filter(F.pmod(F.col("last_contact"), F.lit(2)) == part), f"part-{part}")
    store.compact()
    store.create_view(name)
    return spark.table(f"{name}.raw_flights")


def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.count_by_reason(refreshing.quarantined_reports(_base(spark, sf_dir)))


def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing required values in the summary and in the row-level report."""
    base = _base(spark, sf_dir)
    summary = base.groupBy(*ANALYTICS_KEYS).agg(summarise.row_count().alias("flight_count"))
    found = [
        (ENRICHED_LAYOUT, base),
        (ANALYTICS_LAYOUT, summary),
        (COUNTRY_LAYOUT, country_totals(base)),
    ]
    counted = [
        quality.count_by_reason(quality.with_reasons(df, quality.contract_checks(layout))).withColumn(
            "table_name", F.lit(layout.name)
        )
        for layout, df in found
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


def text_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw texts of payload records against the length limits."""
    typed = _typed_payloads(spark, sf_dir).filter(F.col("payload_reason").isNull())
    return typed.agg(
        F.count(F.lit(1)).alias("records"),
        *[
            F.coalesce(F.sum(check.cast("int")), F.lit(0)).alias(name)
            for name, check in quality.text_length_checks().items()
        ],
    )


def payload_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_payloads(payloads(spark, sf_dir))
    return parsed.select("payload_id", "payload_status", F.size("states").alias("states"))


def ingest_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load with the usual cap takes; the rest goes to the rejects."""
    exploded = explode_states(parse_payloads(payloads(spark, sf_dir)), PAYLOAD_CAP)
    exploded = exploded.filter(F.col("payload_reason").isNull())
    return exploded.groupBy("payload_id").agg(
        F.count(F.lit(1)).alias("records"), F.max("position").alias("last_position")
    )


def ingest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted_rows(_typed_payloads(spark, sf_dir))


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = rejected_rows(_typed_payloads(spark, sf_dir))
    rejects = rejects.filter(~F.array_contains(quality.REASONS, MALFORMED))
    return rejects.select("position", F.concat_ws(",", quality.REASONS).alias("reasons"))


def ingest_payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that cannot be read, with their text."""
    unread = _typed_payloads(spark, sf_dir).filter(F.array_contains(quality.REASONS, MALFORMED))
    return unread.select("payload_id", (F.length("record") > 0).alias("text_kept"))


def ingest_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded of total: every record and unreadable payload is in one of the counts."""
    typed = _typed_payloads(spark, sf_dir)
    unread = F.array_contains(quality.REASONS, MALFORMED)
    good = F.size(quality.REASONS) == 0
    return typed.agg(
        F.count_if(~unread).alias("records"),
        F.count_if(good).alias("loaded"),
        F.count_if(~good & ~unread).alias("rejected"),
        F.count_if(unread).alias("unreadable_payloads"),
    )


def _land(spark: SparkSession, root: str, **options: object) -> Totals:
    """One run of the landing stream below ``root``."""
    places = (f"{root}/{name}" for name in ("landed", "raw", "rejects", "checkpoints"))
    return land_payloads(spark, *places, one_per_line=True, **options).wait()


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows through landed files and a file stream."""
    root = scratch_path(spark, "landing")
    payloads(spark, sf_dir).select("value").write.text(f"{root}/landed")
    _land(spark, root, fetch_time=LOAD_TIME)
    return read_raw(spark, f"{root}/raw")


def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded of total as the log of the raw table has it."""
    root = scratch_path(spark, "landing")
    payloads(spark, sf_dir).select("value").write.text(f"{root}/landed")
    _land(spark, root, fetch_time=LOAD_TIME)
    log = spark.read.parquet(RawStore(spark, f"{root}/raw").log_path)
    counts = [F.sum(c).alias(c) for c in ("loaded", "rejected")]
    return log.agg(F.sum(F.col("loaded") + F.col("rejected")).alias("records"), *counts, F.sum("unreadable").alias("unreadable_payloads"))


def stream_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two polls of the same reports; the second lands after a restart of the stream."""
    root = scratch_path(spark, "deduped")
    for hour in range(2):
        payloads(spark, sf_dir).select("value").write.mode("append").text(f"{root}/landed")
        _land(spark, root, fetch_time=LOAD_TIME + timedelta(hours=hour), dedupe="2 days")
    dated = read_raw(spark, f"{root}/raw").filter(F.col("time_position").isNotNull())
    return dated.select(*[c for c in RAW_FLIGHTS.names if c in ("fetch_time", "icao24", "time_position")])


def compacted_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four loads of the raw table, joined into one, as a reader of the log sees them."""
    store = RawStore(spark, scratch_path(spark, "raw-store"))
    raw = observations(spark, sf_dir)
    for part in range(4):
        store.add(raw.filter(F.pmod(F.col("last_contact"), F.lit(4)) == part), f"part-{part}")
    store.compact()
    return store.read()


def dedupe_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second poll repeats every report an hour later."""
    raw = observations(spark, sf_dir)
    again = raw.withColumn("fetch_time", F.col("fetch_time") + F.expr("INTERVAL 1 HOUR"))
    return first_reports(raw.unionByName(again))


def _published(name: str) -> Query:
    """A table as another job reads it after two identical refreshes."""

    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = scratch_path(spark, "published")
        raw = observations(spark, sf_dir)
        base = enrich(raw)
        if name == ENRICHED_LAYOUT.name:
            rows = refreshing.publishable(plans.ranked_flights(base))
        else:
            build = {"country_stats": plans.country_stats, "flights_analytics": plans.flights_analytics}
            checks = quality.contract_checks(LAYOUTS[name])
            rows = quality.accepted(quality.with_reasons(build[name](base), checks))
        for _ in range(2):
            publish_parquet(rows, out, LAYOUTS[name])
        return read_published(spark, out, LAYOUTS[name])

    return read


def month_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _published(ENRICHED_LAYOUT.name)(spark, sf_dir)
    return table.groupBy("event_month").agg(F.count(F.lit(1)).alias("rows"))


def incremental_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First half loaded and refreshed, second half added through touched months."""
    raw = observations(spark, sf_dir)
    middle = datetime(2024, 1, 16)
    out = scratch_path(spark, "incremental")
    refreshing.refresh_months(raw, out, since=datetime(1970, 1, 1), cutoff=middle)
    refreshing.refresh_months(raw, out, since=middle)
    path = refreshing.published_path(spark, out, ANALYTICS_LAYOUT.name)
    return read_published(spark, path, ANALYTICS_LAYOUT)


def _stored_states(spark: SparkSession, sf_dir: str) -> States:
    """States after two updates, the second with the reports of the second half only."""
    raw = observations(spark, sf_dir)
    states = States(spark, scratch_path(spark, "states"))
    states.update(raw, cutoff=datetime(2024, 1, 16))
    states.update(raw)
    return states


def incremental_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_states(spark, sf_dir).country_stats()


def incremental_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_states(spark, sf_dir).enriched_flights()


def merged_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_states(spark, sf_dir).medians()


def merged_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact numbers of flights, and whether the merged sketches come within four standard errors."""
    states = _stored_states(spark, sf_dir)
    exact = states.country_totals().select("origin_country", "unique_flights")
    near = states.flight_estimates().withColumnRenamed("unique_flights", "_near")
    off = F.abs(F.col("_near") - F.col("unique_flights")) / F.col("unique_flights")
    joined = null_safe_join(exact, near, ["origin_country"])
    return joined.withColumn("sketch_is_near", off <= 4 * 1.04 / 2 ** (SKETCH_BITS / 2)).drop("_near")


def _refreshed(dedupe: bool, cutoffs: tuple[datetime | None, ...]) -> Query:
    """The row-level table after full refreshes with these cutoffs, the last one counting."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = observations(spark, sf_dir)
        if dedupe:
            raw = raw.unionByName(raw.withColumn("fetch_time", F.col("fetch_time") + F.expr("INTERVAL 1 HOUR")))
        out = scratch_path(spark, "refreshed")
        for cutoff in cutoffs:
            refreshing.refresh(raw, out, cutoff, dedupe)
        return read_published(spark, refreshing.published_path(spark, out, ENRICHED_LAYOUT.name), ENRICHED_LAYOUT)

    return run


def created_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country table by its name in a database, after a refresh has made and filled it."""
    out = scratch_path(spark, "database")
    name = f"flights_{out.rpartition('-')[2]}"
    refreshing.refresh(observations(spark, sf_dir), out, database=name)
    return spark.table(f"{name}.country_stats")


def quarantine_after_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports set aside by a full refresh still are after a month was renewed."""
    raw = observations(spark, sf_dir)
    out = scratch_path(spark, "quarantine")
    refreshing.refresh(raw, out)
    refreshing.refresh_months(raw, out, since=datetime(2024, 1, 16))
    path = refreshing.published_path(spark, out, f"quarantine/{ANALYTICS_LAYOUT.name}")
    return spark.read.parquet(path).agg(F.coalesce(F.sum("flight_count"), F.lit(0)).alias("reports"))


_PLAIN: dict[str, Query] = {
    "scan_raw": scan_raw,
    "raw_row_count": raw_row_count,
    "payload_status": payload_status,
    "ingest_cap": ingest_cap,
    "ingest_rows": ingest_rows,
    "ingest_rejects": ingest_rejects,
    "ingest_payload_rejects": ingest_payload_rejects,
    "ingest_totals": ingest_totals,
    "text_limits": text_limits,
    "stream_landing": stream_landing,
    "stream_totals": stream_totals,
    "stream_deduped": stream_deduped,
    "compacted_raw": compacted_raw,
    "dedupe_reports": dedupe_reports,
    "altitude_fallback": altitude_fallback,
    "valid_positions": valid_positions,
    "event_time": _columns("event_time"),
    "event_calendar": _columns("event_date", "event_hour", "event_weekday"),
    "callsign_clean": _columns("callsign", "callsign_length"),
    "geo_sector": _columns("lat_sector", "lon_sector"),
    "velocity_kmh": _columns("velocity_kmh"),
    "is_anomaly": _columns("is_anomaly"),
    "time_of_day": _columns("time_of_day"),
    "flight_status": _columns("flight_status"),
    "velocity_category": _columns("velocity_category"),
    "enriched_base": _base,
    "null_to_zero": zeros,
    "conform_enriched": conform_enriched,
    "agg_count": _by_keys(lambda: [summarise.row_count().alias("flight_count")]),
    "agg_avg_speed": _by_keys(lambda: [summarise.mean_speed().alias("avg_velocity_kmh")]),
    "agg_avg_altitude": _by_keys(
        lambda: [
            summarise.mean_altitude(name).alias(f"avg_{name}")
            for name in ("baro_altitude", "geo_altitude")
        ]
    ),
    "agg_distinct": _by_keys(
        lambda: [
            summarise.distinct("icao24").alias("unique_aircraft"),
            summarise.distinct("callsign").alias("unique_flights"),
        ]
    ),
    "agg_anomaly": _by_keys(lambda: [F.sum("is_anomaly").alias("anomaly_count")]),
    "agg_minmax": _by_keys(
        lambda: [
            F.min("velocity_kmh").alias("min_velocity_kmh"),
            F.max("velocity_kmh").alias("max_velocity_kmh"),
        ]
    ),
    "agg_median": agg_median,
    "anomaly_percentage": anomaly_percentage,
    "rank_in_country": rank_in_country,
    "top_in_country": top_in_country,
    "speed_rank_global": speed_rank_global,
    "country_window_stats": country_window_stats,
    "country_rank": country_rank,
    "share_of_total": share_of_total,
    "enriched_flights": enriched_flights,
    "flights_slim": flights_slim,
    "country_stats": country_stats,
    "flights_analytics": flights_analytics,
    "analytics_stamped": analytics_stamped,
    "left_out_numbers": left_out_numbers,
    "raw_view": raw_view,
    "quarantine_counts": quarantine_counts,
    "contract_violations": contract_violations,
    "published_enriched": _published("enriched_flights"),
    "published_country": _published("country_stats"),
    "published_analytics": _published("flights_analytics"),
    "month_partitions": month_partitions,
    "incremental_analytics": incremental_analytics,
    "incremental_country": incremental_country,
    "incremental_ranks": incremental_ranks,
    "merged_median": merged_median,
    "merged_distinct": merged_distinct,
    "refresh_earlier_cutoff": _refreshed(False, (None, datetime(2024, 1, 16))),
    "refresh_deduped": _refreshed(True, (None,)),
    "created_tables": created_tables,
    "quarantine_after_months": quarantine_after_months,
    "rank_by_altitude": rank_by_altitude,
}


def queries() -> dict[str, Query]:
    """Each query, with result types both engines have."""

    def shared(query: Query) -> Query:
        return lambda spark, sf_dir: comparable(query(spark, sf_dir))

    return {name: shared(query) for name, query in _PLAIN.items()}

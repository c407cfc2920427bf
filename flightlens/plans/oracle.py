"""The same results as SQL for an independent engine (DuckDB).

Written from the definition of each report, not from the Spark plan: ranks and
group statistics are plain windows here, the median is a plain quantile.
"""

from __future__ import annotations

_NUMBERED = """numbered AS (
  SELECT event_id,
    date_trunc('hour', ts) AS fetch_time,
    format('{:06x}', user_id) AS icao24,
    CASE WHEN event_id % 7 = 0 THEN NULL
         WHEN event_id % 11 = 0 THEN '   '
         ELSE '  ' || upper(event_type) || CAST(user_id AS VARCHAR) || ' ' END AS callsign,
    n_name AS origin_country,
    CASE WHEN event_id % 97 <> 0 THEN CAST(floor(epoch(ts)) AS BIGINT) END AS time_position,
    CAST(floor(epoch(ts)) AS BIGINT) AS last_contact,
    CASE WHEN event_id % 13 <> 0 THEN CAST((event_id * 37) % 36000 - 18000 AS DOUBLE) / 100 END AS longitude,
    CASE WHEN event_id % 17 <> 0 THEN CAST((event_id * 53) % 18000 - 9000 AS DOUBLE) / 100 END AS latitude,
    CASE WHEN event_id % 19 <> 0 THEN value * 25 - 50 END AS baro_altitude,
    CASE WHEN event_id % 23 <> 0 THEN event_type = 'error' END AS on_ground,
    CASE WHEN event_id % 29 <> 0 THEN value * 4 END AS velocity,
    CAST(event_id % 360 AS DOUBLE) AS heading,
    CAST(event_id % 41 - 20 AS DOUBLE) / 2 AS vertical_rate,
    CASE WHEN event_id % 3 <> 0 THEN value * 26 END AS geo_altitude,
    lpad(CAST(event_id % 7778 AS VARCHAR), 4, '0') AS squawk,
    event_id % 101 = 0 AS spi,
    CAST(event_id % 4 AS BIGINT) AS position_source
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

_RAW_COLUMNS = (
    "fetch_time, icao24, callsign, origin_country, time_position, last_contact, longitude, latitude, "
    "baro_altitude, on_ground, velocity, heading, vertical_rate, geo_altitude, squawk, spi, position_source"
)

_BASE = (
    _NUMBERED
    + """,
located AS (
  SELECT * REPLACE (coalesce(geo_altitude, baro_altitude) AS geo_altitude),
    make_timestamp(time_position * 1000000) AS event_time
  FROM numbered WHERE longitude IS NOT NULL AND latitude IS NOT NULL),
base AS (
  SELECT * EXCLUDE (event_id, callsign),
    CASE WHEN callsign IS NULL THEN 'Unknown' ELSE trim(callsign, ' ') END AS callsign,
    CAST(event_time AS DATE) AS event_date,
    hour(event_time) AS event_hour,
    dayofweek(event_time) + 1 AS event_weekday,
    length(CASE WHEN callsign IS NULL THEN 'Unknown' ELSE trim(callsign, ' ') END) AS callsign_length,
    CAST(floor(latitude) AS BIGINT) AS lat_sector,
    CAST(floor(longitude) AS BIGINT) AS lon_sector,
    CAST(round(CAST(velocity AS DECIMAL(24,10)) * CAST(3.6 AS DECIMAL(2,1)), 2) AS DECIMAL(10,2)) AS velocity_kmh,
    CAST(CASE WHEN velocity > 1200 OR baro_altitude < 0 THEN 1 ELSE 0 END AS BIGINT) AS is_anomaly,
    CASE WHEN hour(event_time) < 6 THEN 'night' WHEN hour(event_time) < 12 THEN 'morning'
         WHEN hour(event_time) < 18 THEN 'day' ELSE 'evening' END AS time_of_day,
    CASE WHEN on_ground THEN 'grounded' ELSE 'flying' END AS flight_status,
    CASE WHEN velocity < 300 THEN 'slow' WHEN velocity < 800 THEN 'medium' ELSE 'fast' END AS velocity_category
  FROM located)"""
)

_ID = "icao24, last_contact, squawk"
_KEYS = "origin_country, event_date, time_of_day, flight_status, velocity_category"


def _mean_speed(column: str, over: str = "") -> str:
    """Half-up mean of two-decimal numbers in whole arithmetic."""
    total, rows = f"sum({column}){over}", f"count({column}){over}"
    return (
        f"CAST(sign({total}) * ((2 * CAST(abs({total}) * 100 AS HUGEINT) + {rows}) // (2 * {rows})) "
        f"AS DOUBLE) / 100"
    )


def _mean_altitude(column: str) -> str:
    """The same for numbers taken with six decimals."""
    total = f"sum(CAST(CAST({column} AS DECIMAL(18,6)) * 1000000 AS BIGINT))"
    rows = f"count({column})"
    return (
        f"CAST(sign({total}) * ((200 * abs({total}) + 1000000 * {rows}) // (2000000 * {rows})) "
        f"AS DOUBLE) / 100"
    )


def _percent(part: str, whole: str) -> str:
    part, whole = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)"
    return f"CAST((20000 * {part} + {whole}) // (2 * {whole}) AS DOUBLE) / 100"


def _fixed(column: str) -> str:
    return f"CAST(CAST({column} AS DECIMAL(10,2)) AS DOUBLE)"


_ROWS = "CAST(count(*) AS BIGINT)"
_ANOMALIES = "CAST(sum(is_anomaly) AS BIGINT)"

_RANKED = (
    _BASE
    + f""",
ranked AS (
  SELECT *,
    rank() OVER (PARTITION BY origin_country ORDER BY velocity_kmh DESC NULLS LAST) AS rank_in_country,
    rank() OVER (ORDER BY velocity_kmh DESC NULLS LAST) AS speed_rank_global,
    {_mean_speed("velocity_kmh", " OVER (PARTITION BY origin_country)")} AS avg_speed_in_country,
    CAST(max(velocity_kmh) OVER (PARTITION BY origin_country) AS DOUBLE) AS max_speed_in_country,
    CAST(min(velocity_kmh) OVER (PARTITION BY origin_country) AS DOUBLE) AS min_speed_in_country
  FROM base)"""
)

_PUBLISHED_NUMBERS = (
    "coalesce(CAST(velocity_kmh AS DOUBLE), 0) AS velocity_kmh, "
    f"coalesce({_fixed('baro_altitude')}, 0) AS baro_altitude, "
    f"coalesce({_fixed('geo_altitude')}, 0) AS geo_altitude"
)
_ENRICHED_COLUMNS = (
    f"icao24, callsign, origin_country, event_time, event_date, {_PUBLISHED_NUMBERS}, "
    "rank_in_country, speed_rank_global, avg_speed_in_country, max_speed_in_country, "
    "min_speed_in_country, is_anomaly, time_of_day, flight_status"
)
_SLIM_COLUMNS = (
    f"icao24, callsign, origin_country, event_time, event_date, {_PUBLISHED_NUMBERS}, "
    "rank_in_country, speed_rank_global, is_anomaly, time_of_day, flight_status"
)

_COUNTRIES = (
    _BASE
    + f""",
totals AS (
  SELECT origin_country, {_ROWS} AS total_aircraft,
    {_mean_speed("velocity_kmh")} AS avg_speed_kmh,
    CAST(count(DISTINCT callsign) AS BIGINT) AS unique_flights,
    {_ANOMALIES} AS anomaly_count
  FROM base GROUP BY origin_country),
countries AS (
  SELECT *, rank() OVER (ORDER BY total_aircraft DESC) AS global_rank,
    {_percent("total_aircraft", "sum(total_aircraft) OVER ()")} AS percentage_of_total
  FROM totals)"""
)

_ANALYTICS = (
    _BASE
    + f""",
analytics AS (
  SELECT {_KEYS}, {_ROWS} AS flight_count,
    {_mean_speed("velocity_kmh")} AS avg_velocity_kmh,
    {_mean_altitude("baro_altitude")} AS avg_baro_altitude,
    {_mean_altitude("geo_altitude")} AS avg_geo_altitude,
    {_ANOMALIES} AS anomaly_count,
    CAST(count(DISTINCT icao24) AS BIGINT) AS unique_aircraft,
    CAST(min(velocity_kmh) AS DOUBLE) AS min_velocity_kmh,
    CAST(max(velocity_kmh) AS DOUBLE) AS max_velocity_kmh,
    CAST(quantile_disc(velocity_kmh, 0.5) AS DOUBLE) AS median_velocity_kmh,
    {_percent("sum(is_anomaly)", "count(*)")} AS anomaly_percentage
  FROM base GROUP BY {_KEYS})"""
)

# A record's place in its payload, and the shapes the payload gives it.
_RECORDS = (
    _NUMBERED
    + """,
records AS (
  SELECT *, event_id // 1200 AS payload_id,
    row_number() OVER (PARTITION BY event_id // 1200 ORDER BY event_id) - 1 AS position
  FROM numbered),
loaded AS (SELECT * FROM records WHERE payload_id % 5 <> 4),
good AS (
  SELECT TIMESTAMP '2024-02-01 00:00:00' AS fetch_time, icao24, callsign, origin_country, time_position,
    last_contact, longitude, latitude,
    CASE WHEN event_id % 47 <> 0 THEN baro_altitude END AS baro_altitude,
    on_ground, velocity, heading, vertical_rate,
    CASE WHEN event_id % 43 <> 0 THEN geo_altitude END AS geo_altitude,
    CASE WHEN event_id % 43 <> 0 THEN squawk END AS squawk,
    CASE WHEN event_id % 43 <> 0 THEN spi END AS spi,
    CASE WHEN event_id % 43 <> 0 THEN CASE WHEN event_id % 31 = 0 THEN 1 ELSE position_source END END
      AS position_source
  FROM loaded WHERE event_id % 211 <> 0 AND event_id % 223 <> 0)"""
)


def _derived(columns: str) -> str:
    return f"WITH {_BASE} SELECT {_ID}, {columns} FROM base"


def _by_keys(columns: str) -> str:
    return f"WITH {_BASE} SELECT {_KEYS}, {columns} FROM base GROUP BY {_KEYS}"


_BASE_COLUMNS = "* REPLACE (CAST(velocity_kmh AS DOUBLE) AS velocity_kmh)"
_DATED = "event_time IS NOT NULL"
_INGESTED = f"WITH {_RECORDS} SELECT {_RAW_COLUMNS} FROM good"
_SHOWN_RANKS = f"{_ID}, origin_country, CAST(velocity_kmh AS DOUBLE) AS velocity_kmh, rank_in_country"

_SQL = {
    "scan_raw": f"WITH {_NUMBERED} SELECT {_RAW_COLUMNS} FROM numbered",
    "raw_row_count": f"WITH {_NUMBERED} SELECT {_ROWS} AS raw_rows FROM numbered",
    "payload_status": f"""WITH {_RECORDS} SELECT payload_id,
        CASE WHEN payload_id % 5 = 4 THEN 'malformed_json' ELSE 'ok' END AS payload_status,
        CASE WHEN payload_id % 5 <> 4 THEN {_ROWS} END AS states
        FROM records GROUP BY payload_id""",
    "ingest_cap": f"""WITH {_RECORDS} SELECT payload_id, {_ROWS} AS records,
        CAST(max(position) AS BIGINT) AS last_position FROM loaded WHERE position < 1000 GROUP BY payload_id""",
    "ingest_payload_rejects": f"""WITH {_RECORDS} SELECT DISTINCT payload_id, true AS text_kept
        FROM records WHERE payload_id % 5 = 4""",
    "ingest_totals": f"""WITH {_RECORDS} SELECT
        CAST(count(*) FILTER (WHERE payload_id % 5 <> 4) AS BIGINT) AS records,
        CAST(count(*) FILTER (WHERE payload_id % 5 <> 4 AND event_id % 211 <> 0 AND event_id % 223 <> 0) AS BIGINT) AS loaded,
        CAST(count(*) FILTER (WHERE payload_id % 5 <> 4 AND (event_id % 211 = 0 OR event_id % 223 = 0)) AS BIGINT) AS rejected,
        CAST(count(DISTINCT payload_id) FILTER (WHERE payload_id % 5 = 4) AS BIGINT) AS unreadable_payloads
        FROM records""",
    "ingest_rows": _INGESTED,
    "ingest_rejects": f"""WITH {_RECORDS} SELECT position,
        CASE WHEN event_id % 211 = 0 THEN 'not_a_list' ELSE 'callsign_too_long' END AS reasons
        FROM loaded WHERE event_id % 211 = 0 OR event_id % 223 = 0""",
    "text_limits": f"""WITH {_RECORDS} SELECT {_ROWS} AS records,
        CAST(0 AS BIGINT) AS icao24_too_long,
        CAST(count(*) FILTER (WHERE event_id % 223 = 0 AND event_id % 211 <> 0) AS BIGINT) AS callsign_too_long,
        CAST(count(*) FILTER (WHERE length(origin_country) > 50) AS BIGINT) AS origin_country_too_long,
        CAST(0 AS BIGINT) AS squawk_too_long FROM loaded""",
    "stream_landing": _INGESTED,
    "compacted_raw": f"WITH {_NUMBERED} SELECT {_RAW_COLUMNS} FROM numbered",
    "stream_deduped": f"""WITH {_RECORDS} SELECT DISTINCT fetch_time, icao24, time_position FROM good
        WHERE time_position IS NOT NULL""",
    "dedupe_reports": f"""WITH {_NUMBERED}, polled AS (
          SELECT {_RAW_COLUMNS} FROM numbered UNION ALL
          SELECT {_RAW_COLUMNS} FROM (SELECT * REPLACE (fetch_time + INTERVAL 1 HOUR AS fetch_time) FROM numbered)),
        ordered AS (
          SELECT *, row_number() OVER (PARTITION BY icao24, time_position ORDER BY
            fetch_time NULLS FIRST, callsign NULLS FIRST, origin_country NULLS FIRST, last_contact NULLS FIRST,
            longitude NULLS FIRST, latitude NULLS FIRST, baro_altitude NULLS FIRST, on_ground NULLS FIRST,
            velocity NULLS FIRST, heading NULLS FIRST, vertical_rate NULLS FIRST, geo_altitude NULLS FIRST,
            squawk NULLS FIRST, spi NULLS FIRST, position_source NULLS FIRST) AS copy FROM polled)
        SELECT {_RAW_COLUMNS} FROM ordered WHERE copy = 1 OR time_position IS NULL""",
    "altitude_fallback": f"""WITH {_NUMBERED} SELECT {_ID}, baro_altitude,
        coalesce(geo_altitude, baro_altitude) AS geo_altitude FROM numbered""",
    "valid_positions": f"""WITH {_NUMBERED} SELECT {_ID}, longitude, latitude FROM numbered
        WHERE longitude IS NOT NULL AND latitude IS NOT NULL""",
    "event_time": _derived("event_time"),
    "event_calendar": _derived("event_date, event_hour, event_weekday"),
    "callsign_clean": _derived("callsign, callsign_length"),
    "geo_sector": _derived("lat_sector, lon_sector"),
    "velocity_kmh": _derived("CAST(velocity_kmh AS DOUBLE) AS velocity_kmh"),
    "is_anomaly": _derived("is_anomaly"),
    "time_of_day": _derived("time_of_day"),
    "flight_status": _derived("flight_status"),
    "velocity_category": _derived("velocity_category"),
    "enriched_base": f"WITH {_BASE} SELECT {_BASE_COLUMNS} FROM base",
    "null_to_zero": _derived(_PUBLISHED_NUMBERS),
    "conform_enriched": _derived(
        f"CAST(velocity_kmh AS DOUBLE) AS velocity_kmh, {_fixed('baro_altitude')} AS baro_altitude, "
        f"{_fixed('geo_altitude')} AS geo_altitude, is_anomaly"
    ),
    "agg_count": _by_keys(f"{_ROWS} AS flight_count"),
    "agg_avg_speed": _by_keys(f"{_mean_speed('velocity_kmh')} AS avg_velocity_kmh"),
    "agg_avg_altitude": _by_keys(
        f"{_mean_altitude('baro_altitude')} AS avg_baro_altitude, "
        f"{_mean_altitude('geo_altitude')} AS avg_geo_altitude"
    ),
    "agg_distinct": _by_keys(
        "CAST(count(DISTINCT icao24) AS BIGINT) AS unique_aircraft, "
        "CAST(count(DISTINCT callsign) AS BIGINT) AS unique_flights"
    ),
    "agg_anomaly": _by_keys(f"{_ANOMALIES} AS anomaly_count"),
    "agg_minmax": _by_keys(
        "CAST(min(velocity_kmh) AS DOUBLE) AS min_velocity_kmh, "
        "CAST(max(velocity_kmh) AS DOUBLE) AS max_velocity_kmh"
    ),
    "agg_median": f"""WITH {_BASE} SELECT origin_country,
        CAST(quantile_disc(velocity_kmh, 0.5) AS DOUBLE) AS median_velocity_kmh
        FROM base GROUP BY origin_country""",
    "anomaly_percentage": _by_keys(
        f"{_ROWS} AS flight_count, {_ANOMALIES} AS anomaly_count, "
        f"{_percent('sum(is_anomaly)', 'count(*)')} AS anomaly_percentage"
    ),
    "rank_in_country": f"WITH {_RANKED} SELECT {_SHOWN_RANKS} FROM ranked",
    "top_in_country": f"WITH {_RANKED} SELECT {_SHOWN_RANKS} FROM ranked WHERE rank_in_country <= 10",
    "speed_rank_global": f"""WITH {_RANKED} SELECT {_ID}, CAST(velocity_kmh AS DOUBLE) AS velocity_kmh,
        speed_rank_global FROM ranked""",
    "country_window_stats": f"""WITH {_RANKED} SELECT {_ID}, origin_country, avg_speed_in_country,
        max_speed_in_country, min_speed_in_country FROM ranked""",
    "country_rank": f"WITH {_COUNTRIES} SELECT origin_country, total_aircraft, global_rank FROM countries",
    "share_of_total": f"""WITH {_COUNTRIES} SELECT origin_country, total_aircraft, percentage_of_total
        FROM countries""",
    "enriched_flights": f"WITH {_RANKED} SELECT {_ENRICHED_COLUMNS} FROM ranked",
    "flights_slim": f"WITH {_RANKED} SELECT {_SLIM_COLUMNS} FROM ranked",
    "country_stats": f"WITH {_COUNTRIES} SELECT * FROM countries",
    "flights_analytics": f"WITH {_ANALYTICS} SELECT * FROM analytics",
    "quarantine_counts": f"""WITH {_BASE} SELECT reason, {_ROWS} AS rejected_rows FROM (
        SELECT unnest(['event_time_missing', 'event_date_missing']) AS reason
        FROM base WHERE event_time IS NULL) GROUP BY reason""",
    "contract_violations": f"""WITH {_ANALYTICS}
        SELECT reason, {_ROWS} AS rejected_rows, 'enriched_flights' AS table_name FROM (
          SELECT unnest(['event_time_missing', 'event_date_missing']) AS reason
          FROM base WHERE event_time IS NULL) GROUP BY reason
        UNION ALL
        SELECT 'event_date_missing', {_ROWS}, 'flights_analytics' FROM analytics
        WHERE event_date IS NULL""",
    "published_enriched": f"""WITH {_RANKED} SELECT {_ENRICHED_COLUMNS},
        strftime(event_date, '%Y%m') AS event_month FROM ranked WHERE {_DATED}""",
    "published_country": f"WITH {_COUNTRIES} SELECT * FROM countries",
    "published_analytics": f"""WITH {_ANALYTICS} SELECT *, strftime(event_date, '%Y%m') AS event_month
        FROM analytics WHERE event_date IS NOT NULL""",
    "month_partitions": f"""WITH {_BASE} SELECT strftime(event_date, '%Y%m') AS event_month,
        {_ROWS} AS rows FROM base WHERE {_DATED} GROUP BY ALL""",
    "incremental_analytics": f"""WITH {_ANALYTICS} SELECT *, strftime(event_date, '%Y%m') AS event_month
        FROM analytics WHERE event_date IS NOT NULL""",
}

_TRILLION = "CAST(1000000000000 AS DOUBLE)"
_SQL |= {
    "raw_view": _SQL["scan_raw"],
    "analytics_stamped": f"""WITH {_ANALYTICS} SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS load_timestamp
        FROM analytics""",
    "left_out_numbers": f"""WITH {_BASE} SELECT
        CAST(count(*) FILTER (WHERE abs(baro_altitude * 1e10) >= {_TRILLION}) AS BIGINT) AS baro_altitude,
        CAST(count(*) FILTER (WHERE abs(geo_altitude * 1e10) >= {_TRILLION}) AS BIGINT) AS geo_altitude
        FROM base""",
}
_SQL["created_tables"] = _SQL["country_stats"]
# Stored states: the same reports as from all rows at once.
_SQL |= {
    "incremental_country": _SQL["country_stats"],
    "incremental_ranks": _SQL["enriched_flights"],
    "merged_median": _SQL["agg_median"],
    "merged_distinct": f"""WITH {_BASE} SELECT origin_country,
        CAST(count(DISTINCT callsign) AS BIGINT) AS unique_flights, true AS sketch_is_near
        FROM base GROUP BY origin_country""",
}
# One stream, two ways to count: the log of the raw table and the records themselves.
_SQL["stream_totals"] = _SQL["ingest_totals"]
_EARLY = _RANKED.replace("FROM numbered WHERE", "FROM numbered WHERE fetch_time <= TIMESTAMP '2024-01-16' AND")
_ONCE = f"numbered AS (SELECT 0 AS event_id, once.* FROM ({_SQL['dedupe_reports']}) AS once)" + _RANKED[len(_NUMBERED) :]
_MONTHLY = f"SELECT {_ENRICHED_COLUMNS}, strftime(event_date, '%Y%m') AS event_month FROM ranked WHERE {_DATED}"
_SQL |= {
    "refresh_earlier_cutoff": f"WITH {_EARLY} {_MONTHLY}",
    "refresh_deduped": f"WITH {_ONCE} {_MONTHLY}",
    "quarantine_after_months": f"WITH {_BASE} SELECT {_ROWS} AS reports FROM base WHERE event_date IS NULL",
    "rank_by_altitude": f"""WITH {_BASE} SELECT {_ID}, geo_altitude,
        rank() OVER (ORDER BY geo_altitude DESC NULLS LAST) AS altitude_rank FROM base""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)

"""One refresh: a snapshot of the raw reports to the three published tables.

A full refresh writes its tables to a folder of its own and appends one entry to
``refresh_log`` when all of them are in place; readers take the run of the newest
entry (:func:`published_path`).  A run that dies leaves readers where they were.
"""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flightlens.functions import numeric
from flightlens.functions.flight import event_month
from flightlens.operators import quality
from flightlens.operators.dedupe import first_reports
from flightlens.operators.enrich import enrich
from flightlens.plans import reports
from flightlens.schema import ANALYTICS_LAYOUT, COUNTRY_LAYOUT, ENRICHED_LAYOUT, LAYOUTS, SLIM_LAYOUT, Layout
from flightlens.session import materialise
from flightlens.settings import RULES, SCALING, Rules, Scaling
from flightlens.sources import folders
from flightlens.sources.publish import MONTH, create_views, publish_parquet, read_published, switch_views
from flightlens.sources.raw import instant, snapshot
from flightlens.sources.rawstore import EventRange, RawStore, within


MOST_RANGES = 240
#: The month that rows without a date are set aside under.
UNDATED = "undated"


#: Numbers that the summaries take the mean of.
AVERAGED = ("baro_altitude", "geo_altitude")


@dataclass(frozen=True)
class Published:
    """Rows written and rows kept aside, per table, and numbers that no mean could take, per column.

    Nothing is left out under a name that is no such column.
    """

    written: dict[str, int]
    quarantined: dict[str, int]
    left_out: Counter[str] = field(default_factory=lambda: Counter(dict.fromkeys(AVERAGED, 0)))


def observe_left_out(enriched: DataFrame) -> tuple[DataFrame, Observation]:
    """Count, on the pass that uses the reports, the numbers that their means leave out."""
    observation = Observation()
    counters = [F.count_if(numeric.left_out(F.col(c))).alias(c) for c in AVERAGED]
    return enriched.observe(observation, *counters), observation


def report_checks() -> dict[str, Column]:
    """Why an enriched report cannot be published at row level."""
    speed_lost = F.col("velocity").isNotNull() & F.col("velocity_kmh").isNull()
    checks = {**quality.contract_checks(ENRICHED_LAYOUT), "velocity_kmh_out_of_range": speed_lost}
    for name in ("baro_altitude", "geo_altitude"):
        lost = F.col(name).isNotNull() & numeric.two_decimals(F.col(name)).isNull()
        checks[f"{name}_out_of_range"] = lost
    return checks


def publishable(ranked: DataFrame) -> DataFrame:
    """The row-level report without the rows of :func:`quarantined_reports`."""
    return reports.enriched_flights(quality.accepted(quality.with_reasons(ranked, report_checks())))


def quarantined_reports(enriched: DataFrame) -> DataFrame:
    """Reports that break the contract of the row-level table, with reasons.

    They still count in the summaries, which do not need the missing values.
    """
    return quality.rejected(quality.with_reasons(enriched, report_checks()))


LOG = "table_name string, written_rows bigint, quarantined_rows bigint, cutoff timestamp, run string, finished timestamp"


def published_root(spark: SparkSession, out: str) -> str | None:
    """The folder of the newest finished run, or None before the first."""
    out = out.rstrip("/")
    try:
        log = spark.read.schema(LOG).parquet(f"{out}/refresh_log")
    except AnalysisException:  # no run has finished yet
        return None
    newest = log.orderBy(F.desc("finished"), F.desc("run")).select("run").first()
    return f"{out}/{newest['run']}" if newest else None


def sweep_runs(spark: SparkSession, out: str, keep: int, idle: timedelta, now: datetime | None = None) -> list[str]:
    """Remove all but the newest ``keep`` finished runs, and runs that died, once at rest for ``idle``.

    A running refresh has no entry yet, but it writes; the newest run always stays.
    """
    out = out.rstrip("/")
    try:
        log = spark.read.schema(LOG).parquet(f"{out}/refresh_log")
    except AnalysisException:  # no run has finished yet
        kept = set()
    else:
        runs = log.groupBy("run").agg(F.max("finished").alias("finished"))
        newest = runs.orderBy(F.desc("finished"), F.desc("run")).limit(max(1, keep))
        kept = {r["run"] for r in newest.collect()}
    return folders.sweep(spark, out, "run-", kept, idle, now)


def published_path(spark: SparkSession, out: str, table: str) -> str:
    """Where a table of the newest finished run lies."""
    root = published_root(spark, out)
    if root is None:
        raise FileNotFoundError(f"no refresh has finished in {out}")
    return f"{root}/{table}"


def refresh(
    raw: DataFrame,
    out: str,
    cutoff: datetime | None = None,
    dedupe: bool = False,
    rules: Rules = RULES,
    scaling: Scaling = SCALING,
    database: str | None = None,
) -> Published:
    """Recompute and publish all tables from the reports up to ``cutoff``.

    The derived reports are written once, so the source is scanned once (a
    database in one state), repeats are removed once, and every table is built
    on the same rows.  Whatever cutoff an earlier run had, the tables hold the
    rows of this one only.  Any failure leaves as an exception.

    With a ``database`` the tables are there under their names before anything is loaded,
    as views; they turn to the new run last of all.
    """
    out = out.rstrip("/")
    spark = raw.sparkSession
    if database:
        create_views(spark, LAYOUTS, database)
    root = f"{out}/run-{uuid.uuid4().hex}"
    kept = snapshot(raw, cutoff)
    seen, observation = observe_left_out(enrich(first_reports(kept) if dedupe else kept, rules))
    base, _ = materialise(seen)
    found = quality.observed_values(observation)
    left_out = Counter({c: found.get(c) or 0 for c in AVERAGED})
    written: dict[str, int] = {}
    aside: dict[str, int] = {}

    ranked = reports.ranked_flights(base, scaling)
    publish_parquet(publishable(ranked), f"{root}/{ENRICHED_LAYOUT.name}", ENRICHED_LAYOUT)
    rows = read_published(spark, f"{root}/{ENRICHED_LAYOUT.name}", ENRICHED_LAYOUT)
    written[ENRICHED_LAYOUT.name] = rows.count()
    aside[ENRICHED_LAYOUT.name] = _set_aside(quarantined_reports(base), root, ENRICHED_LAYOUT)
    # The older, narrower view has the same rows.
    slim = rows.select(*SLIM_LAYOUT.schema.names)
    publish_parquet(slim, f"{root}/{SLIM_LAYOUT.name}", SLIM_LAYOUT)
    written[SLIM_LAYOUT.name] = written[ENRICHED_LAYOUT.name]
    aside[SLIM_LAYOUT.name] = aside[ENRICHED_LAYOUT.name]

    for layout, summary in (
        (COUNTRY_LAYOUT, reports.country_stats(base, scaling=scaling)),
        (ANALYTICS_LAYOUT, reports.flights_analytics(base, scaling=scaling)),
    ):
        written[layout.name], aside[layout.name] = _publish_summary(summary, root, layout)

    _log(spark, out, root.rpartition("/")[2], cutoff, written, aside)
    if database:
        switch_views(spark, LAYOUTS, database, root)
    return Published(written, aside, left_out)


def refresh_months(
    raw: DataFrame,
    out: str,
    since: datetime,
    cutoff: datetime | None = None,
    rules: Rules = RULES,
    scaling: Scaling = SCALING,
) -> Published:
    """Recompute the analytics summary for the months that new reports fall in.

    New means arrived after ``since``.  Ranks and country totals depend on every
    report, so only :func:`refresh` renews those tables.
    """
    kept = snapshot(raw, cutoff)
    arrived = enrich(kept.filter(F.col("fetch_time") > instant(since)), rules)
    return publish_months(kept, arrived, out.rstrip("/"), rules, scaling)


def publish_months(
    raw: DataFrame | RawStore, arrived: DataFrame, out: str, rules: Rules, scaling: Scaling
) -> Published:
    """Recompute the months that the enriched reports ``arrived`` fall in.

    They replace those months in the newest finished run; before the first run
    they make one of their own.  Of a raw store only the loads with reports of these
    months are opened.
    """
    spark = arrived.sparkSession
    month = event_month(F.col("event_date"))
    touched = arrived.filter(F.col("event_date").isNotNull()).select(
        F.trunc("event_date", "month").alias("first_day"), month.alias("month")
    )
    months, size = materialise(touched.distinct())
    if size == 0:
        return Published({ANALYTICS_LAYOUT.name: 0}, {ANALYTICS_LAYOUT.name: 0})
    ranges = month_ranges(months, size)
    near = raw.read(events=ranges) if isinstance(raw, RawStore) else raw.filter(within(ranges))
    base = enrich(near, rules).withColumn("month", month)
    base = base.join(F.broadcast(months) if size <= scaling.broadcast_rows else months, "month", "left_semi")
    base, _ = materialise(base.drop("month"))
    summary = reports.flights_analytics(base, scaling=scaling)
    root = published_root(spark, out)
    first = root is None
    root = root or f"{out}/run-{uuid.uuid4().hex}"
    done, aside = _publish_summary(summary, root, ANALYTICS_LAYOUT, months)
    if first:
        _log(spark, out, root.rpartition("/")[2], None, {ANALYTICS_LAYOUT.name: done}, {ANALYTICS_LAYOUT.name: aside})
    return Published({ANALYTICS_LAYOUT.name: done}, {ANALYTICS_LAYOUT.name: aside})


def month_ranges(months: DataFrame, size: int) -> list[EventRange]:
    """``time_position`` of the touched months, as ranges a scan can prune by.

    One range per run of neighbouring months; their outer days if they are very many.
    """
    if size > MOST_RANGES:
        outer = months.agg(F.min("first_day").alias("a"), F.max("first_day").alias("b")).first()
        days = [(outer["a"], outer["b"])]
    else:
        days = []
        for row in months.orderBy("first_day").collect():
            day = row["first_day"]
            if days and (days[-1][1] + timedelta(days=31)).replace(day=1) == day:
                days[-1] = (days[-1][0], day)
            else:
                days.append((day, day))
    ranges = []
    for first, last in days:
        begin = int(datetime(first.year, first.month, 1, tzinfo=UTC).timestamp())
        end = int(datetime(last.year, last.month, 1, tzinfo=UTC).timestamp()) + 31 * 86_400
        ranges.append((begin, end))
    return ranges


def _publish_summary(
    summary: DataFrame, root: str, layout: Layout, months: DataFrame | None = None
) -> tuple[int, int]:
    table, size = materialise(summary)
    checked = quality.with_reasons(table, quality.contract_checks(layout))
    publish_parquet(quality.accepted(checked), f"{root}/{layout.name}", layout)
    aside = _set_aside(quality.rejected(checked), root, layout, months)
    return size - aside, aside


def _set_aside(rows: DataFrame, root: str, layout: Layout, months: DataFrame | None = None) -> int:
    """Write the rejected rows; with ``months`` those of other months stay.

    They lie by month, rows without a date in a month of their own, and a month is replaced
    when the job commits: one that dies leaves the rows that were there.
    """
    path = f"{root}/quarantine/{layout.name}"
    fresh, count = materialise(rows)
    if layout.by_month:
        fresh = fresh.withColumn(MONTH, F.coalesce(event_month(F.col("event_date")), F.lit(UNDATED)))
        writer = fresh.write.mode("overwrite").partitionBy(MONTH)
        if months is not None:
            _clear_months(rows.sparkSession, path, fresh, months)
            writer = writer.option("partitionOverwriteMode", "dynamic")
        writer.parquet(path)
    else:
        fresh.write.mode("overwrite").parquet(path)
    return count


def _clear_months(spark: SparkSession, path: str, fresh: DataFrame, months: DataFrame) -> None:
    """Remove the set-aside rows of renewed months that have none any more."""
    renewed = {f"{MONTH}={r['month']}" for r in months.select("month").collect()}
    still = {f"{MONTH}={r[MONTH]}" for r in fresh.select(MONTH).distinct().collect()}
    for name in set(folders.children(spark, path)) & (renewed - still):
        folders.remove(spark, f"{path}/{name}")


def _log(
    spark: SparkSession,
    out: str,
    run: str,
    cutoff: datetime | None,
    written: dict[str, int],
    aside: dict[str, int],
) -> None:
    """Appended in one file, last of all: from then on readers see the run."""
    finished = datetime.now(UTC)
    entries = [(name, written[name], aside[name], cutoff, run, finished) for name in written]
    spark.createDataFrame(entries, LOG).coalesce(1).write.mode("append").parquet(f"{out}/refresh_log")

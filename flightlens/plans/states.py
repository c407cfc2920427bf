"""Reports kept current from stored states, month by month.

A state is what a month adds to a report that depends on all history: its derived
reports, how many of them hold each (country, speed), its (country, callsign) pairs
and a sketch of those.  States of months are merged by key, so

* the country table needs no history of raw reports,
* ranks are running totals over the merged counts, looked up by the stored reports,
* the exact median and the sketched number of flights come from any set of months.

An update reads the raw reports of the touched months only and writes their states to a
version of its own.  Its entry in the log comes last; a reader takes the newest version of
every month, so an update that died changes nothing, and one that runs again replaces it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import UTC, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from flightlens.functions import numeric
from flightlens.functions.flight import event_month
from flightlens.operators import summarise
from flightlens.operators.enrich import enrich
from flightlens.operators.lookup import ROWS, KeyCounts, null_safe_join
from flightlens.operators.rank import rank_and_compare
from flightlens.plans import reports
from flightlens.plans.refresh import UNDATED, month_ranges
from flightlens.session import materialise
from flightlens.settings import RULES, SCALING, Rules, Scaling
from flightlens.sources import folders
from flightlens.sources.publish import MONTH
from flightlens.sources.raw import instant, snapshot
from flightlens.sources.rawstore import RawStore, within

#: Registers of a sketch, as a power of two: a relative standard error of 1.04 / sqrt(2^12), 1.6 %.
SKETCH_BITS = 12

LOG = "version string, months array<string>, loads array<string>, cutoff timestamp, finished timestamp"


class States:
    """Stored states below ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def log(self) -> list[Row]:
        """Entries in the order of their updates: one per update, and small."""
        try:
            entries = self.spark.read.schema(LOG).parquet(f"{self.root}/_log").collect()
        except AnalysisException:  # no update has finished yet
            return []
        return sorted(entries, key=lambda e: (e["finished"], e["version"]))

    def versions(self) -> dict[str, str]:
        """The newest version of every month."""
        return {month: e["version"] for e in self.log() for month in e["months"]}

    def table(self, name: str, months: Sequence[str] | None = None) -> DataFrame:
        """One of ``reports``, ``speeds``, ``callsigns`` and ``sketches``, for all or some months."""
        found = {m: v for m, v in self.versions().items() if months is None or m in months}
        if not found:
            raise FileNotFoundError(f"no states of these months in {self.root}")
        paths = [f"{self.root}/version={v}/{name}/{MONTH}={m}" for m, v in sorted(found.items())]
        return self.spark.read.parquet(*paths)

    def update(
        self, raw: DataFrame | RawStore, since: datetime | None = None, cutoff: datetime | None = None, rules: Rules = RULES
    ) -> list[str]:
        """Renew the months that new reports fall in; the months, oldest first.

        Of a raw store the loads that no update has seen are new.  Of other tables
        those that arrived after ``since``, by default the cutoff of the last update.
        """
        loads: list[str] = []
        if isinstance(raw, RawStore):
            seen = {name for e in self.log() for name in e["loads"]}
            # Compaction changes no rows.
            loads = [e["load"] for e in raw.log() if not e["replaces"] and e["load"] not in seen]
            arrived = raw.read(names=loads)
        else:
            raw = snapshot(raw, cutoff)
            last = max((e["cutoff"] for e in self.log() if e["cutoff"]), default=None)
            since = since or (last and last.astimezone(UTC))
            arrived = raw if since is None else raw.filter(F.col("fetch_time") > instant(since))
        fresh = enrich(arrived, rules)
        dated = F.col("event_date").isNotNull()
        touched, size = materialise(
            fresh.select(
                F.trunc("event_date", "month").alias("first_day"),
                F.when(dated, event_month(F.col("event_date"))).otherwise(UNDATED).alias(MONTH),
            ).distinct()
        )
        if not size and not loads:
            return []
        months = sorted(r[MONTH] for r in touched.select(MONTH).collect())
        version = uuid.uuid4().hex
        if months:
            self._write(raw, touched, size, f"{self.root}/version={version}", rules)
        if not isinstance(raw, RawStore) and cutoff is None:
            cutoff = arrived.agg(F.max("fetch_time")).first()[0]
            cutoff = cutoff and cutoff.astimezone(UTC)
        elif cutoff is not None and cutoff.tzinfo is None:
            cutoff = cutoff.replace(tzinfo=UTC)
        entry = Row(version=version, months=months, loads=loads, cutoff=cutoff, finished=datetime.now(UTC))
        # One file, last of all: from then on readers see the version.
        self.spark.createDataFrame([entry], LOG).coalesce(1).write.mode("append").parquet(f"{self.root}/_log")
        return months

    def sweep(self, idle: timedelta, now: datetime | None = None) -> list[str]:
        """Remove versions that hold no newest month, and those that died, once at rest for ``idle``."""
        kept = {f"version={v}" for v in self.versions().values()}
        return folders.sweep(self.spark, self.root, "version=", kept, idle, now)

    def _write(self, raw: DataFrame | RawStore, touched: DataFrame, size: int, path: str, rules: Rules) -> None:
        known = touched.filter(F.col("first_day").isNotNull())
        undated = not touched.filter(F.col("first_day").isNull()).isEmpty()
        ranges = month_ranges(known, size)
        near = raw.read(events=ranges, undated=undated) if isinstance(raw, RawStore) else raw.filter(within(ranges, undated))
        base = enrich(near, rules)
        month = F.coalesce(event_month(F.col("event_date")), F.lit(UNDATED))
        # The ranges end a little after the last month.
        base = base.withColumn(MONTH, month).join(F.broadcast(touched.select(MONTH)), MONTH, "left_semi")

        def write(df: DataFrame, name: str) -> None:
            kept = df.withColumn("_month", F.col(MONTH)).hint("rebalance", "_month")
            kept.withColumnRenamed(MONTH, "month").withColumnRenamed("_month", MONTH).write.partitionBy(MONTH).parquet(f"{path}/{name}")

        write(base, "reports")
        # The other states are counted from the reports just written.
        base = self.spark.read.parquet(f"{path}/reports").withColumn(MONTH, F.col("month"))
        write(
            base.groupBy(MONTH, "origin_country", "velocity_kmh").agg(
                F.count(F.lit(1)).alias(ROWS), F.sum("is_anomaly").alias("anomalies")
            ),
            "speeds",
        )
        pairs = base.select(MONTH, "origin_country", "callsign").distinct()
        write(pairs, "callsigns")
        # Sketches leave out empty texts, so they take a hash.
        sketch = F.hll_sketch_agg(F.xxhash64("callsign"), F.lit(SKETCH_BITS)).alias("callsign_sketch")
        write(base.groupBy(MONTH, "origin_country").agg(sketch), "sketches")

    def counts(self, months: Sequence[str] | None = None) -> KeyCounts:
        """Rows per country and speed over all months, in the form the ranks take."""
        keys = ("origin_country", "velocity_kmh")
        merged = self.table("speeds", months).groupBy(*keys).agg(F.sum(ROWS).alias(ROWS))
        table, size = materialise(merged)
        return KeyCounts(table, keys, size)

    def country_totals(self, months: Sequence[str] | None = None) -> DataFrame:
        """What :func:`reports.country_totals` counts, from the states."""
        rows, speed = F.col(ROWS), F.col("velocity_kmh")
        known = F.when(speed.isNotNull(), rows)
        totals = self.table("speeds", months).groupBy("origin_country").agg(
            F.sum(rows).alias("total_aircraft"),
            numeric.mean(F.sum(speed * known), F.coalesce(F.sum(known), F.lit(0))).alias("avg_speed_kmh"),
            F.sum("anomalies").alias("anomaly_count"),
        )
        flights = self.table("callsigns", months).groupBy("origin_country").agg(
            F.count_distinct("callsign").alias("unique_flights")
        )
        return null_safe_join(totals, flights, ["origin_country"])

    def country_stats(self, scaling: Scaling = SCALING) -> DataFrame:
        """The published country table; equal to one counted from all raw reports."""
        return reports.ranked_countries(*materialise(self.country_totals()), scaling)

    def enriched_flights(self, scaling: Scaling = SCALING) -> DataFrame:
        """The published row-level table: stored reports with ranks from the merged counts."""
        ranked = rank_and_compare(
            self.table("reports"),
            group="origin_country",
            metric="velocity_kmh",
            group_rank="rank_in_country",
            overall_rank="speed_rank_global",
            names=reports.COUNTRY_SPEEDS,
            scaling=scaling,
            counts=self.counts(),
        )
        return reports.enriched_flights(ranked)

    def medians(self, months: Sequence[str] | None = None) -> DataFrame:
        """(origin_country, median_velocity_kmh), exact."""
        merged = self.counts(months).table
        return summarise.median_from_counts(merged, ["origin_country"], "velocity_kmh", "median_velocity_kmh")

    def flight_estimates(self, months: Sequence[str] | None = None) -> DataFrame:
        """(origin_country, unique_flights) estimated from the merged sketches alone."""
        merged = F.hll_sketch_estimate(F.hll_union_agg("callsign_sketch"))
        return self.table("sketches", months).groupBy("origin_country").agg(merged.alias("unique_flights"))

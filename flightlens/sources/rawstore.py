"""The raw table as loads under a log.

    <path>/load=<name>/fetch_day=<day>/   the rows of one load
    <path>/_log/                          one entry per load that is in place

Readers follow the log.  A load that died before its entry does not exist for them,
writing a load again replaces it, and one that has an entry is not written again.
Compaction writes the rows of many small loads as one load, whose entry takes theirs
out; their files stay for the readers that are at work.  The entries carry the range
of arrival and event times, so a reader opens only the loads that can matter.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import UTC, datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlens.operators.quality import observed_values
from flightlens.schema import RAW_FLIGHTS
from flightlens.sources import folders
from flightlens.sources.publish import ddl
from flightlens.sources.raw import instant, read_parquet, snapshot

DAY = "fetch_day"
STORED = T.StructType([*RAW_FLIGHTS, T.StructField(DAY, T.DateType())])
LOG = (
    "load string, replaces array<string>, loaded bigint, rejected bigint, unreadable bigint, undated bigint, "
    "fetched_from timestamp, fetched_to timestamp, event_from bigint, event_to bigint, finished timestamp"
)

#: Loads with fewer rows are joined into larger ones.
SMALL_LOAD = 5_000_000

EventRange = tuple[int, int]


def within(ranges: Sequence[EventRange], undated: bool = False) -> Column:
    """``time_position`` in one of the ranges [begin, end), or missing where ``undated`` are wanted."""
    position = F.col("time_position")
    missing = [position.isNull()] if undated else []
    return reduce(or_, [*missing, *[(position >= begin) & (position < end) for begin, end in ranges]], F.lit(False))


def _utc(moment: datetime) -> datetime:
    return moment if moment.tzinfo else moment.replace(tzinfo=UTC)


class RawStore:
    """A raw table at ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    @property
    def log_path(self) -> str:
        return f"{self.path}/_log"

    def log(self) -> list[Row]:
        """All entries, one per load: few, and small."""
        try:
            return self.spark.read.schema(LOG).parquet(self.log_path).collect()
        except AnalysisException:  # no load has finished yet
            return []

    def exists(self) -> bool:
        return bool(self.log())

    def loads(self) -> list[Row]:
        """Entries of the loads that no other has replaced."""
        entries = self.log()
        gone = {name for e in entries for name in e["replaces"]}
        return [e for e in entries if e["load"] not in gone]

    def read(
        self,
        cutoff: datetime | None = None,
        events: Sequence[EventRange] | None = None,
        names: Sequence[str] | None = None,
        undated: bool = False,
    ) -> DataFrame:
        """Raw reports: all, those that had arrived by ``cutoff``, those of event times (and
        ``undated`` ones with them), or those of some loads."""

        def matters(entry: Row) -> bool:
            if names is not None and entry["load"] not in names:
                return False
            if cutoff is not None and (entry["fetched_from"] is None or entry["fetched_from"].astimezone(UTC) > _utc(cutoff)):
                return False
            if events is None:
                return True
            if undated and entry["undated"]:
                return True
            return any(entry["event_from"] is not None and entry["event_from"] < b and entry["event_to"] >= a for a, b in events)

        # Loads named by a caller may have been replaced since: their files are still there.
        entries = self.log() if names is not None else self.loads()
        chosen = [f"{self.path}/load={e['load']}" for e in entries if e["loaded"] and matters(e)]
        if not chosen:
            return self.spark.createDataFrame([], RAW_FLIGHTS)
        rows = self.spark.read.schema(STORED).option("basePath", self.path).parquet(*chosen)
        if cutoff is not None:
            rows = rows.filter((F.col(DAY) <= F.lit(_utc(cutoff).date())) & (F.col("fetch_time") <= instant(cutoff)))
        if events is not None:
            rows = rows.filter(within(events, undated))
        return rows.select(*RAW_FLIGHTS.names)

    def add(
        self, rows: DataFrame, load: str, rejected: int = 0, unreadable: int = 0, replaces: Sequence[str] = ()
    ) -> Row:
        """Write a load unless the log has it, and enter it.  Repeating a load adds nothing."""
        known = [e for e in self.log() if e["load"] == load]
        if known:
            return known[0]
        observation = Observation()
        position = F.col("time_position")
        seen = rows.select(*RAW_FLIGHTS.names).observe(
            observation,
            F.count(F.lit(1)).alias("loaded"),
            F.count_if(position.isNull()).alias("undated"),
            F.min(F.unix_micros("fetch_time")).alias("fetched_from"),
            F.max(F.unix_micros("fetch_time")).alias("fetched_to"),
            F.min(position).alias("event_from"),
            F.max(position).alias("event_to"),
        )
        # The rebalance hint makes files of a useful size out of many small tasks.
        dated = seen.withColumn(DAY, F.to_date("fetch_time")).hint("rebalance", DAY)
        dated.write.mode("overwrite").partitionBy(DAY).parquet(f"{self.path}/load={load}")
        found = observed_values(observation)
        entry = Row(
            load=load,
            replaces=list(replaces),
            loaded=found.get("loaded") or 0,
            rejected=rejected,
            unreadable=unreadable,
            undated=found.get("undated") or 0,
            fetched_from=_moment(found.get("fetched_from")),
            fetched_to=_moment(found.get("fetched_to")),
            event_from=found.get("event_from"),
            event_to=found.get("event_to"),
            finished=datetime.now(UTC),
        )
        # One file, last of all: from then on readers see the load.
        self.spark.createDataFrame([entry], LOG).coalesce(1).write.mode("append").parquet(self.log_path)
        return entry

    def compact(self, small: int = SMALL_LOAD) -> Row | None:
        """Join the loads of fewer than ``small`` rows into one, if there are several."""
        few = [e for e in self.loads() if e["loaded"] < small]
        if len(few) < 2:
            return None
        names = [e["load"] for e in few]
        counts = {c: sum(e[c] for e in few) for c in ("rejected", "unreadable")}
        return self.add(self.read(names=names), f"compact-{uuid.uuid4().hex}", replaces=names, **counts)

    def create_view(self, database: str, name: str = "raw_flights") -> None:
        """The table under a name of a database: there before anything is loaded, and turned to
        the loads of the log whenever it is called again."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        columns = ", ".join(f"`{c}`" for c in RAW_FLIGHTS.names)
        live = [e["load"] for e in self.loads() if e["loaded"]]
        if not live:
            empty = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in RAW_FLIGHTS)
            self.spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {empty} WHERE false")
            return
        files = f"{database}.{name}__loads"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {files} ({ddl(RAW_FLIGHTS)}, {DAY} date, `load` string) "
            f"USING parquet PARTITIONED BY (`load`, {DAY}) LOCATION '{self.path}'"
        )
        self.spark.sql(f"ALTER TABLE {files} RECOVER PARTITIONS")
        wanted = ", ".join(f"'{load}'" for load in live)
        self.spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT {columns} FROM {files} WHERE `load` IN ({wanted})")

    def sweep(self, idle: timedelta, now: datetime | None = None) -> list[str]:
        """Remove the files of loads that compaction replaced, and of those that died, once
        they are at rest for ``idle``: longer than any reader or load takes."""
        kept = {f"load={e['load']}" for e in self.loads()}
        return folders.sweep(self.spark, self.path, "load=", kept, idle, now)


def _moment(micros: int | None) -> datetime | None:
    return None if micros is None else datetime.fromtimestamp(micros / 1_000_000, UTC)


def read_raw(spark: SparkSession, path: str, cutoff: datetime | None = None) -> DataFrame:
    """Raw reports of a store, or of a plain Parquet folder where there is no log."""
    store = RawStore(spark, path)
    return store.read(cutoff) if store.exists() else snapshot(read_parquet(spark, path), cutoff)

"""Landed payload files to the raw table, and new raw rows to the summary."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flightlens.operators import quality
from flightlens.operators.dedupe import first_records_in_stream
from flightlens.operators.enrich import enrich
from flightlens.plans.refresh import publish_months
from flightlens.schema import RAW_FLIGHTS
from flightlens.settings import RULES, SCALING, Rules, Scaling
from flightlens.sources.payloads import MALFORMED, accepted_rows, raw_from_payloads, rejected_rows
from flightlens.sources.raw import instant, read_parquet
from flightlens.sources.rawstore import LOG, RawStore

def payload_stream(
    spark: SparkSession, path: str, one_per_line: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """New payload files as they land, each read once."""
    reader = spark.readStream.format("text").option("wholetext", not one_per_line)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(
        "value", "_metadata.file_path", "_metadata.file_modification_time"
    )


@dataclass(frozen=True)
class Totals:
    """What a run has landed: every record and every unreadable payload is in one of the counts."""

    loaded: int = 0
    rejected: int = 0
    unreadable: int = 0

    @property
    def records(self) -> int:
        return self.loaded + self.rejected

    def __str__(self) -> str:
        return (
            f"{self.loaded} of {self.records} records loaded, {self.rejected} rejected, "
            f"{self.unreadable} payloads unreadable"
        )


@dataclass
class Landing:
    """A running load."""

    query: StreamingQuery
    store: RawStore
    batches: list[Totals] = field(default_factory=list)

    def wait(self) -> Totals:
        """When all is loaded; a failure of the stream is raised here."""
        self.query.awaitTermination()
        columns = ("loaded", "rejected", "unreadable")
        return Totals(**{c: sum(getattr(b, c) for b in self.batches) for c in columns})


def land_payloads(
    spark: SparkSession,
    landed: str,
    raw: str,
    rejects: str,
    checkpoints: str,
    fetch_time: datetime | None = None,
    one_per_line: bool = False,
    files_per_batch: int | None = None,
    cap: int | None = None,
    dedupe: str | None = None,
) -> Landing:
    """Load everything that has landed since the last run, then stop.

    One stream parses each payload once.  A batch is one load of the raw store and one
    folder of ``rejects``, both named by the stream and the batch number: a batch that
    runs again after a failure replaces what it left, and one that was entered into the
    log adds nothing.  Without ``fetch_time`` a row is stamped with the time its
    file was written.  With ``dedupe``, a time such as ``"2 days"``, a good report that
    landed within that time before is left out.
    """
    stamp = F.col("file_modification_time") if fetch_time is None else instant(fetch_time)
    typed = raw_from_payloads(payload_stream(spark, landed, one_per_line, files_per_batch), stamp, cap)
    if dedupe:
        typed = first_records_in_stream(typed, dedupe, F.size(quality.REASONS) == 0)
    store = RawStore(spark, raw)
    batches: list[Totals] = []
    query = (
        typed.writeStream.foreachBatch(land_batch(store, rejects.rstrip("/"), batches.append))
        .option("checkpointLocation", f"{checkpoints.rstrip('/')}/landing")
        .trigger(availableNow=True)
        .start()
    )
    return Landing(query, store, batches)


def land_batch(
    store: RawStore, rejects: str, done: Callable[[Totals], None], stream: str | None = None
) -> Callable[[DataFrame, int], None]:
    """Write the typed records of a batch: bad ones to ``rejects``, good ones as a load."""

    def land(batch: DataFrame, number: int) -> None:
        # The id of the query is kept in its checkpoint, so a restart has the same.
        name = stream or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        load = f"batch-{name}-{number}"
        if any(e["load"] == load for e in store.log()):
            return
        # Both writes take the records of one parse; what a lost executor held is parsed again.
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            observation = Observation()
            unread = F.array_contains(quality.REASONS, MALFORMED)
            bad = rejected_rows(batch).observe(
                observation, F.count(F.lit(1)).alias("rows"), F.count_if(unread).alias("unreadable")
            )
            bad.write.mode("overwrite").parquet(f"{rejects}/load={load}")
            found = quality.observed_values(observation)
            unreadable = found.get("unreadable") or 0
            rejected = (found.get("rows") or 0) - unreadable
            entry = store.add(accepted_rows(batch), load, rejected, unreadable)
        finally:
            batch.unpersist()
        done(Totals(entry["loaded"], rejected, unreadable))

    return land


def refresh_arrivals(
    spark: SparkSession,
    raw: str,
    out: str,
    checkpoint: str,
    rules: Rules = RULES,
    scaling: Scaling = SCALING,
) -> StreamingQuery:
    """Keep the analytics summary current with the raw table.

    Each batch recomputes the months its rows fall in from the whole raw table
    and overwrites them, so a batch that runs twice leaves the same rows.  A raw store
    is followed by its log, a plain folder by its files.
    """
    store = RawStore(spark, raw)
    if store.exists():
        source = spark.readStream.schema(LOG).parquet(store.log_path)
    else:
        source = spark.readStream.schema(RAW_FLIGHTS).parquet(raw)

    def renew(batch: DataFrame, _: int) -> None:
        rows, whole = batch, None
        if store.exists():
            # Compaction changes no rows.
            new = [e["load"] for e in batch.where(F.size("replaces") == 0).select("load").collect()]
            rows, whole = store.read(names=new), store
        whole = whole or read_parquet(spark, raw)
        publish_months(whole, enrich(rows, rules), out.rstrip("/"), rules, scaling)

    return (
        source.writeStream.foreachBatch(renew)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

"""Session defaults and the two things every plan needs from a session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00"}

DEFAULTS = {
    # Hours and dates are defined in UTC, whatever the host's zone is.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Files of a few hundred MB when publishing with the rebalance hint.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str = "flightlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`DEFAULTS`; keyword options use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(df: DataFrame) -> None:
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in _UTC_NAMES:
        raise ValueError(
            f"spark.sql.session.timeZone is {zone!r}: calendar columns are defined in UTC, "
            "build the session with flightlens.session.build_session or pin_utc"
        )


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares between its machines.

    Read from ``spark.checkpoint.dir``.  Only a local session without that
    setting gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    named = tempfile.mkdtemp(prefix="flightlens-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> tuple[DataFrame, int]:
    """Write a result once to the shared folder, cut its lineage and count its rows.

    Used for per-key tables that several later steps read, so that the rows
    behind them are scanned once and the size of the table is known before a
    plan depends on it.  A lost executor costs nothing, and later steps read only
    the columns they use.  The folder is left to whoever cleans the shared one.
    """
    path = scratch_path(df.sparkSession, "keys")
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    # The number of rows stands in the files' footers.
    return written, written.count()

"""Folders of the shared store: what lies in them, and removing what nobody needs."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    """File system and path object behind a path, whatever store it is in."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, in order; none where it does not exist."""
    store, place = _store(spark, path)
    if not store.exists(place):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(place) if s.isDirectory())


def last_change(spark: SparkSession, path: str) -> datetime:
    """When something below a folder was written last."""
    store, place = _store(spark, path)
    latest = store.getFileStatus(place).getModificationTime()
    files = store.listFiles(place, True)
    while files.hasNext():
        latest = max(latest, files.next().getModificationTime())
    return datetime.fromtimestamp(latest / 1000, UTC)


def remove(spark: SparkSession, path: str) -> None:
    store, place = _store(spark, path)
    store.delete(place, True)


def unused(
    spark: SparkSession, root: str, prefix: str, kept: set[str], idle: timedelta, now: datetime | None = None
) -> list[str]:
    """Folders of ``root`` named ``prefix``... that are not ``kept`` and at rest for ``idle``.

    A job at work writes again and again, so its folder is not at rest.
    """
    now = now or datetime.now(UTC)
    found = [n for n in children(spark, root) if n.startswith(prefix) and n not in kept]
    return [n for n in found if now - last_change(spark, f"{root}/{n}") >= idle]


def sweep(
    spark: SparkSession, root: str, prefix: str, kept: set[str], idle: timedelta, now: datetime | None = None
) -> list[str]:
    """Remove the :func:`unused` folders; their names."""
    gone = unused(spark, root, prefix, kept, idle, now)
    for name in gone:
        remove(spark, f"{root}/{name}")
    return gone

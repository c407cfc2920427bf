"""Raw reports from Parquet or from a database."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlens.schema import RAW_FLIGHTS


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Raw reports with a fixed schema, so no file is opened to infer one."""
    return spark.read.schema(RAW_FLIGHTS).parquet(path)


def jdbc_options(
    url: str,
    table: str,
    driver: str,
    user: str | None = None,
    password: str | None = None,
    **more: str,
) -> dict[str, str]:
    """Connection options; credentials come from the caller and are never kept here."""
    given = {"url": url, "dbtable": table, "driver": driver, "user": user, "password": password}
    return {k: v for k, v in {**given, **more}.items() if v is not None}


def partition_options(
    lower: object, upper: object, partitions: int, column: str = "fetch_time"
) -> dict[str, str]:
    """Split a database scan into ``partitions`` range queries.

    ``fetch_time`` is set by the loader, so it is never NULL, and a poll has a
    bounded number of rows: its ranges stay even.
    """
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(
    spark: SparkSession, options: Mapping[str, str], partitioning: Mapping[str, str] | None = None
) -> DataFrame:
    """Raw reports from a database; filters and column choice are pushed to it.

    Without ``partitioning`` the whole table is one query on one task, which
    only suits small tables.
    """
    return spark.read.format("jdbc").options(**options, **(partitioning or {})).load()


def column_bounds(
    spark: SparkSession, options: Mapping[str, str], column: str = "fetch_time"
) -> tuple[object, object]:
    """Smallest and largest value of a column, found by the database: one row is fetched."""
    table = options["dbtable"]
    query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    rest = {k: v for k, v in options.items() if k != "dbtable"}
    row = spark.read.format("jdbc").options(**rest).option("query", query).load().first()
    return row["lo"], row["hi"]


def instant(moment: datetime) -> Column:
    """A literal time; one without a zone is UTC, whatever the host's zone."""
    return F.lit(moment if moment.tzinfo else moment.replace(tzinfo=UTC))


def snapshot(raw: DataFrame, cutoff: datetime | None) -> DataFrame:
    """Reports that had arrived by ``cutoff``: the same rows for every report built on it."""
    return raw if cutoff is None else raw.filter(F.col("fetch_time") <= instant(cutoff))

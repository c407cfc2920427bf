"""Writing published tables so that a repeated run leaves the same rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlens.functions.flight import event_month
from flightlens.schema import Layout
from flightlens.settings import JDBC_BATCH_ROWS

MONTH = "event_month"


def laid_out(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows grouped into files the way the table is read.

    The rebalance hint brings a month together and lets adaptive execution
    split it again where it is too large for one task, so a month with a third
    of all rows does not become one task or one file.  Sorting inside each file
    gives tight row-group statistics on the leading columns.
    """
    if not layout.by_month:
        return df.hint("rebalance").sortWithinPartitions(*layout.sort_by)
    dated = df.withColumn(MONTH, event_month(F.col("event_date")))
    return dated.hint("rebalance", MONTH).sortWithinPartitions(MONTH, *layout.sort_by)


def publish_parquet(df: DataFrame, path: str, layout: Layout) -> None:
    """Replace the table, or the months of it that ``df`` covers.

    Month tables use dynamic partition overwrite: new files are staged and take
    the place of the covered months when the job commits, so neither a failed
    nor a repeated run loses or doubles rows.
    """
    writer = laid_out(df, layout).write.mode("overwrite")
    if layout.by_month:
        writer = writer.partitionBy(MONTH).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def publish_table(df: DataFrame, table: str, layout: Layout) -> None:
    """The same for a catalog table made by :func:`create_table`."""
    writer = laid_out(df, layout).write.mode("overwrite")
    if layout.by_month:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.insertInto(table)


def append_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def jdbc_write_options(
    options: Mapping[str, str], mode: str, batch_rows: int = JDBC_BATCH_ROWS
) -> dict[str, str]:
    """Overwriting empties the table and keeps its definition."""
    extra = {"truncate": "true"} if mode == "overwrite" else {}
    return {**options, "batchsize": str(batch_rows), **extra}


def publish_jdbc(
    df: DataFrame,
    options: Mapping[str, str],
    mode: str = "overwrite",
    batch_rows: int = JDBC_BATCH_ROWS,
    connections: int | None = None,
) -> None:
    """Write to a database.  ``append`` doubles rows when repeated; the default does not.

    ``connections`` bounds the number of tasks that write at once.
    """
    out = df if connections is None else df.coalesce(connections)
    out.write.format("jdbc").options(**jdbc_write_options(options, mode, batch_rows)).mode(mode).save()


def ddl(schema: T.StructType) -> str:
    return ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
    )


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, by_month: bool = False, path: str | None = None
) -> None:
    """Create a Parquet table unless it exists."""
    columns = ddl(schema) + (f", `{MONTH}` string" if by_month else "")
    parts = f" PARTITIONED BY ({MONTH})" if by_month else ""
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}{place}")


def create_published_tables(
    spark: SparkSession, layouts: Mapping[str, Layout], root: str | None = None, database: str = "default"
) -> None:
    for layout in layouts.values():
        path = f"{root.rstrip('/')}/{layout.name}" if root else None
        create_table(spark, f"{database}.{layout.name}", layout.schema, layout.by_month, path)


def create_views(spark: SparkSession, layouts: Mapping[str, Layout], database: str) -> None:
    """An empty view of the right columns for every table that the database does not have."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for layout in layouts.values():
        columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in layout.schema)
        month = f", CAST(NULL AS string) AS {MONTH}" if layout.by_month else ""
        spark.sql(f"CREATE VIEW IF NOT EXISTS {database}.{layout.name} AS SELECT {columns}{month} WHERE false")


def switch_views(spark: SparkSession, layouts: Mapping[str, Layout], database: str, root: str) -> None:
    """Turn the views to the tables below ``root``, after all of these are known to the catalog.

    A table of an earlier run stays for the readers at work; :func:`forget_runs` drops it.
    """
    run = root.rstrip("/").rpartition("/")[2].replace("-", "_")
    for layout in layouts.values():
        table = f"{database}.{layout.name}__{run}"
        create_table(spark, table, layout.schema, layout.by_month, f"{root}/{layout.name}")
        if layout.by_month:
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    for layout in layouts.values():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{layout.name} AS SELECT * FROM {database}.{layout.name}__{run}")


def forget_runs(spark: SparkSession, database: str, runs: Sequence[str]) -> None:
    """Drop the catalog's tables of runs whose folders were removed; the views are not touched."""
    gone = {run.replace("-", "_") for run in runs}
    for row in spark.sql(f"SHOW TABLES IN {database}").collect():
        if row["tableName"].rpartition("__")[2] in gone:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{row['tableName']}")


def read_published(
    spark: SparkSession,
    path: str,
    layout: Layout,
    first_day: date | None = None,
    last_day: date | None = None,
) -> DataFrame:
    """A published table, optionally for a range of days.

    The days are also turned into a range of months, so only the directories of
    those months are listed and read.
    """
    schema = T.StructType(list(layout.schema))
    if layout.by_month:
        schema = schema.add(MONTH, T.StringType())
    df = spark.read.schema(schema).parquet(path)
    if not layout.by_month:
        return df
    if first_day is not None:
        df = df.filter((F.col(MONTH) >= first_day.strftime("%Y%m")) & (F.col("event_date") >= first_day))
    if last_day is not None:
        df = df.filter((F.col(MONTH) <= last_day.strftime("%Y%m")) & (F.col("event_date") <= last_day))
    return df

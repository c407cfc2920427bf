"""What the operators share: tables in the shared folder, folds, model fitting."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlens.session import scratch_path


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Rows per Arrow batch: long texts then need little memory in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def work_table(df: DataFrame, label: str) -> DataFrame:
    """Write once to the folder all machines share and read it back.

    Cuts the lineage: a lost executor costs nothing, and several readers do not
    repeat the work behind the table.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def held_out(doc_id: Column, folds: int) -> Column:
    """True for the rows no model may learn from: remainder 0, and null ids."""
    return F.coalesce(fold(doc_id, folds) == 0, F.lit(True))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, target: Column, rows: int, max_bytes: int
) -> DataFrame:
    """(text, target) of at most ``rows`` labelled documents, chosen by a hash of the id.

    The sample is drawn from the label table, which has no texts, so the join
    broadcasts at most ``rows`` narrow rows.  Repeated labels of a document are
    reduced to the largest.  Documents over ``max_bytes`` are left out of
    *fitting* only: the sample is then bounded in bytes as well.
    """
    wanted = labels.select(F.col("doc_id").alias("_id"), target.alias("target")).where(
        F.col("_id").isNotNull() & F.col("target").isNotNull()
    )
    picked = (
        wanted.groupBy("_id")
        .agg(F.max("target").alias("target"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(rows)
    )
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    texts = docs.select(F.col("doc_id").alias("_doc"), text.alias("text"))
    texts = texts.where(F.octet_length("text") <= max_bytes)
    joined = texts.join(F.broadcast(picked), texts["_doc"] == picked["_id"])
    # Repeated rows of a document count once.
    return joined.groupBy("_id").agg(F.min("text").alias("text"), F.first("target").alias("target"))


def fit_in_one_task(sample: DataFrame, fit: Callable[[pa.Table], bytes]) -> bytes:
    """Run ``fit`` over a bounded sample in one task and fetch the model it returns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        table = pa.Table.from_batches(rows) if rows else None
        yield pa.RecordBatch.from_pydict({"model": pa.array([fit(table)], pa.binary())})

    fitted = sample.repartition(1).mapInArrow(run, "model binary").first()
    # A plan known to be empty runs no task at all.
    return bytes(fitted["model"]) if fitted else fit(None)

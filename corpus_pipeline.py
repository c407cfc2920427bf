"""A corpus pipeline: grade, identify the language, thin near-copies, pack.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; its result is written as Parquet and read again as the docs of the next.
The stages before packing return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlens.llm import bpe, langid, packing, quality, simhash
from flightlens.llm.common import work_table

#: Documents whose probability of the best grade is lower are rejected.
QUALITY_AT_LEAST = 0.5
#: Documents of which no language holds this share of the positions are rejected, and those without letters.
LANGUAGE_AT_LEAST = 0.4


def grade(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: fitted on the rated documents, rejects likely junk."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.select(docs, quality.train(docs, labels, F.col("quality")), QUALITY_AT_LEAST)


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: rejects texts without letters and those of no clear language."""
    return langid.accept(docs, langid.train(docs), at_least=LANGUAGE_AT_LEAST)


def thin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: the smallest doc_id of each group stays."""
    return simhash.representatives(docs, shingle=3, radius=2)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Retrieval packing into windows of 1024 tokens."""
    vocabulary, pattern = bpe.public_vocabulary()
    return packing.pack(docs, vocabulary, pattern, window=1024).drop("ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", grade),
    ("language", identify),
    ("near_duplicates", thin),
    ("packing", pack),
]

#: The stages learn models and pack greedily, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from flightlens.llm import queries, simhash
from tests.llm.test_simhash import brute_fingerprint, brute_roots

SF = "/root/testdata/sf0.001"


def test_stages_work_on_what_was_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = corpus_pipeline.grade(spark, docs, SF)
    ids = {r["doc_id"] for r in kept.collect()}
    assert kept.columns == columns and len(ids) < before
    good = [i for i, q in labels.items() if q]
    assert sum(i in ids for i in good) >= 0.97 * len(good)
    thinned = corpus_pipeline.thin(spark, kept, SF)
    rows = kept.select("doc_id", "text").collect()
    root = brute_roots([brute_fingerprint(r["text"]) for r in rows], 2)
    smallest = {}
    for r, c in zip(rows, root):
        smallest[c] = min(smallest.get(c, r["doc_id"]), r["doc_id"])
    assert thinned.columns == columns
    assert sorted(r["doc_id"] for r in thinned.collect()) == sorted(smallest.values())


def test_run_packs_the_survivors(spark):
    packed = queries.pipeline(spark, SF)
    totals = packed.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n")).collect()
    assert totals and all(r["n"] == r["doc_tokens"] for r in totals)
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "packing"]
    assert {r["doc_id"] for r in totals} <= {r["doc_id"] for r in simhash.representatives(spark.read.parquet(f"{SF}/documents.parquet")).collect()} | {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_odd_rows_and_clashing_columns(spark):
    """Nulls, empty and long texts, repeated rows and odd column names pass through all stages."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = docs.where("lang = 'en'").limit(20)
    first = good.first()
    odd = [(None, first["text"], "en", "s", 1), (9_000_001, None, None, None, None), (9_000_002, "", "en", "", 0),
           (9_000_003, first["text"] * 40, "en", "s", 1), (9_000_003, first["text"] * 40, "en", "s", 1)]
    mixed = good.unionByName(spark.createDataFrame(odd, docs.schema)).selectExpr("*", "'x' AS _fp", "1 AS ids", "2 AS score", "3 AS row")
    kept = mixed
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == mixed.columns, name
    assert kept.where("doc_id = 9000003").count() <= 1
    packed = corpus_pipeline.pack(spark, kept, SF)
    assert packed.where("start = 0").count() == kept.count()

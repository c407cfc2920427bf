"""The operators as named queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlens.llm import bpe, divergence, langid, licenses, maxent, neighbours, packing, phrases, pivots, quality, repeats, simhash, sql, toxicity
from flightlens.llm.common import held_out, small_batches

#: Every query against every row, without an index.
OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: CAST(q.e[i] AS HUGEINT) * v.e[i])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e)
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary, pattern = bpe.public_vocabulary()
    ids = bpe.encode(_table(spark, sf_dir, "documents"), vocabulary, pattern)
    text = bpe.decode_column(F.col("ids"), vocabulary, pattern)
    return ids.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(text, 256).alias("decoded_sha256"),
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    counts = [F.col(c).cast("bigint").alias(c) for c in ("shared", "unit_size", "template_size")]
    return found.select("doc_id", "license", "unit", *counts, "dice")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted without the documents whose crc32 remainder by 5 is 0."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    small_batches(spark)
    model = quality.train(docs, labels.where(~held_out(F.col("doc_id"), 5)), F.col("quality"))
    graded = docs.select(
        "doc_id",
        held_out(F.col("doc_id"), 5).alias("held_out"),
        quality.grade_column(F.col("text"), model).alias("grade"),
    )
    selected = (F.col("grade.tail_probability") >= 0.5).cast("int").alias("selected")
    return graded.select("doc_id", "held_out", "grade.expected_grade", "grade.tail_probability", selected)


def op5_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out(F.col("doc_id"), 10)
    found = maxent.score(_table(spark, sf_dir, "documents"), ~out)
    return found.select(
        "doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(_table(spark, sf_dir, "documents"), *bpe.public_vocabulary(), window=1024)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    small_batches(spark)
    model = toxicity.train(docs, labels.where(~held_out(F.col("doc_id"), 5)), F.col("toxic"))
    scored = docs.select(
        "doc_id",
        held_out(F.col("doc_id"), 5).alias("held_out"),
        toxicity.score_column(F.col("text"), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    small_batches(spark)
    model = langid.train(docs.where(~held_out(F.col("doc_id"), 5)))
    found = docs.select(
        "doc_id",
        held_out(F.col("doc_id"), 5).alias("held_out"),
        langid.language_column(F.col("text"), model).alias("found"),
    )
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").where(pivots.usable(F.col("embedding")))
    vectors = rows.select(F.col("vec_id").alias("id"), pivots.whole_numbers(F.col("embedding"), 1024).alias("vector"))
    return pivots.search(vectors, vectors.where(F.col("id") % 100 == 0), k=10, whole=True)


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return neighbours.search(vectors, vectors.where(F.col("id") % 20 == 0), k=20)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"), longest=3, least=10, percent=50, first=2000)


def op12_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = repeats.without_repeats(_table(spark, sf_dir, "documents"), span=50)
    taken = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return made.select(
        "doc_id",
        "n_bytes",
        taken.alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"), least_docs=3, first=200)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {
        "pipeline": pipeline,
        "op1_bpe": op1_bpe,
        "op2_licenses": op2_licenses,
        "op3_simhash": op3_simhash,
        "op4_quality": op4_quality,
        "op5_maxent": op5_maxent,
        "op6_packing": op6_packing,
        "op7_toxicity": op7_toxicity,
        "op8_language": op8_language,
        "op9_exact_topk": op9_exact_topk,
        "op10_neighbours": op10_neighbours,
        "op11_phrases": op11_phrases,
        "op12_repeats": op12_repeats,
        "op13_divergence": op13_divergence,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_licenses": licenses.oracle(), "op9_exact_topk": OP9_SQL, "op11_phrases": sql.OP11, "op12_repeats": sql.OP12, "op13_divergence": sql.OP13}

"""Trained text models: gradients, held-out accuracy and edge cases."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightlens.llm import common, langid, quality, queries, toxicity

SF = "/root/testdata/sf0.01"
EDGES = [(1, None), (2, ""), (3, " \n1 2"), (4, "word " * 300_000), (None, "text"), (4, "again"), (4, "again")]


@pytest.fixture(scope="module")
def edges(spark):
    docs = spark.createDataFrame(EDGES, "doc_id bigint, text string")
    return docs.selectExpr("*", "cast(null AS string) AS lang", "1 AS score", "2 AS expected_grade", "3 AS _id")


def auc(score, truth):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable")
    up = truth > 0
    return (rank[up].sum() - up.sum() * (up.sum() - 1) / 2) / (up.sum() * (~up).sum())


def test_fold_is_the_remainder_of_the_text_crc(spark):
    ids = spark.range(200).withColumnRenamed("id", "doc_id")
    for r in ids.select("doc_id", common.held_out(F.col("doc_id"), 5).alias("out")).collect():
        assert r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_cumulative_link_slopes():
    rng = np.random.default_rng(1)
    score, target, cuts = rng.normal(size=30), rng.integers(0, 4, 30), np.array([-1.0, 0.2, 1.5])

    def loss(score, cuts):
        edges = np.concatenate(([-np.inf], cuts, [np.inf]))
        return -np.log(quality._sigmoid(edges[target + 1] - score) - quality._sigmoid(edges[target] - score)).sum()

    by_score, by_cut = quality._slopes(score, target, cuts)
    for i in range(30):
        step = np.eye(30)[i] * 1e-6
        assert by_score[i] == pytest.approx((loss(score + step, cuts) - loss(score - step, cuts)) / 2e-6, abs=1e-5)
    for i in range(3):
        step = np.eye(3)[i] * 1e-6
        assert by_cut[i] == pytest.approx((loss(score, cuts + step) - loss(score, cuts - step)) / 2e-6, abs=1e-5)


def test_graded_ratings_are_learned_in_order(spark):
    rng = np.random.default_rng(2)
    rows, ratings = [], []
    for i in range(600):
        grade = int(rng.integers(0, 4))
        words = [("good" if rng.random() < (grade + 0.5) / 4 else "bad") + str(rng.integers(20)) for _ in range(60)]
        rows.append((i, " ".join(words)))
        ratings.append((i, grade))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(ratings, "doc_id bigint, rating int").where("doc_id % 3 > 0")
    model = quality.train(docs, labels, F.col("rating"))
    assert (np.diff(model.thresholds) > 0).all() and model.grades.tolist() == [0, 1, 2, 3]
    made = docs.select("doc_id", quality.grade_column(F.col("text"), model, wanted=2).alias("g")).where("doc_id % 3 = 0")
    found = [(dict(ratings)[r["doc_id"]], r["g"]["expected_grade"], r["g"]["tail_probability"]) for r in made.collect()]
    truth, expected, tail = (np.array(c, float) for c in zip(*found))
    assert np.corrcoef(truth, expected)[0, 1] > 0.85
    assert auc(tail, (truth >= 2).astype(int)) > 0.95


def test_quality_on_held_out_documents(spark):
    rows = queries.op4_quality(spark, SF).collect()
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    test = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    good = np.array([truth[r["doc_id"]] for r in test])
    assert auc(np.array([r["tail_probability"] for r in test]), good) > 0.95
    assert np.mean([r["selected"] for r, g in zip(test, good) if g]) > 0.97


def test_quality_edge_cases(spark, edges):
    labels = spark.createDataFrame([(1, 0), (4, 1), (4, None), (9, 1), (None, 1)], "doc_id bigint, quality int")
    model = quality.train(edges, labels, F.col("quality"))
    kept = quality.select(edges, model, at_least=0.0)
    assert kept.columns == edges.columns and kept.count() == len(EDGES)
    unrated = quality.train(edges, labels.limit(0), F.col("quality"))
    assert quality.select(edges, unrated, 0.5).count() == len(EDGES)
    assert quality.select(edges.limit(0), model).count() == 0
    single = quality.train(edges, labels.where("doc_id = 1"), F.col("quality"))
    grades = edges.select(quality.grade_column(F.col("text"), single)["expected_grade"].alias("g")).collect()
    assert {r["g"] for r in grades} == {0.0}


def test_noisy_or_equals_the_product():
    model = toxicity.Model(-1.0, {h: 0.5 for h in toxicity.word_hashes(b"horrible")})
    text = "A horrible day. Nice! horrible horrible; fine\n\n"
    scorer = toxicity.Scorer(model)
    p = 1 / (1 + np.exp(-scorer.sentence_scores(toxicity.sentences(text.encode()))))
    assert len(p) == 3 and p[0] == p[2] > p[1]
    assert scorer.score(text.encode()) == pytest.approx(1 - np.prod(1 - p))


def test_toxic_words_are_blamed_and_located(spark):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(500):
        said = [" ".join(f"w{rng.integers(300)}" for _ in range(8)) for _ in range(6)]
        toxic = int(rng.random() < 0.3)
        if toxic:
            said[rng.integers(6)] += f" vile{rng.integers(30)}x"
        rows.append((i, ". ".join(said) + "."))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int").where("doc_id % 2 = 0")
    model = toxicity.train(docs, known, F.col("toxic"))
    scores = dict(docs.select("doc_id", toxicity.score_column(F.col("text"), model)).collect())
    odd = [i for i in scores if i % 2]
    assert auc(np.array([scores[i] for i in odd]), np.array([dict(labels)[i] for i in odd])) > 0.97
    spans = toxicity.offending_sentences(docs, model).collect()
    texts = dict(rows)
    assert np.mean(["vile" in s["sentence"] for s in spans]) > 0.95
    assert all(texts[s["doc_id"]][s["start"] : s["end"]].strip() == s["sentence"] for s in spans)


def test_toxicity_on_held_out_documents(spark):
    rows = queries.op7_toxicity(spark, SF).collect()
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    test = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    bad = np.array([truth[r["doc_id"]] for r in test])
    assert auc(np.array([r["score"] for r in test]), bad) > 0.9
    assert np.mean([r["predicted"] for r, b in zip(test, bad) if not b]) < 0.05


def test_toxicity_edge_cases(spark, edges):
    labels = spark.createDataFrame([(1, 0), (4, 1), (4, None), (None, 1)], "doc_id bigint, toxic int")
    for known in (labels, labels.limit(0), labels.where("toxic = 1")):
        model = toxicity.train(edges, known, F.col("toxic"))
        scores = [r[0] for r in edges.select(toxicity.score_column(F.col("text"), model)).collect()]
        assert len(scores) == len(EDGES) and all(0 <= s <= 1 for s in scores)
        toxicity.offending_sentences(edges, model).collect()
    assert edges.limit(0).select(toxicity.score_column(F.col("text"), model)).count() == 0


def test_slopes_through_time():
    rng = np.random.default_rng(4)
    w = {k: v.astype("f8") for k, v in langid.new_weights(3, hidden=3).items()}
    windows = rng.integers(0, 256, (5, 9)).astype(np.uint8)
    valid, target = rng.random((5, 9)) < 0.8, rng.integers(0, 3, 5)
    _, grad = langid.slopes(w, windows, valid, target)
    used = [(k, i) for k in w for i in np.argwhere(np.abs(grad[k]) > 1e-4)[:25]]
    assert len(used) > 60
    for k, i in used:
        i, step, found = tuple(i), 1e-3, []
        for sign in (1, -1):
            moved = {n: v.copy() for n, v in w.items()}
            moved[k][i] += sign * step
            found.append(langid.slopes(moved, windows, valid, target)[0])
        assert grad[k][i] == pytest.approx((found[0] - found[1]) / (2 * step), rel=0.03, abs=3e-4)


def test_language_on_held_out_documents(spark):
    rows = queries.op8_language(spark, SF).collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    test = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and len(test) > 100
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in test]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_positions_and_edges(spark, edges):
    docs = spark.createDataFrame([(i, t * 30, l) for i, (t, l) in enumerate([("abc abd ", "x"), ("uvw uvx ", "y")] * 20)],
                                 "doc_id bigint, text string, lang string")
    model = langid.train(docs, steps=60)
    mixed = spark.createDataFrame([(1, "abc abd " * 32 + "uvw uvx " * 32)], "doc_id bigint, text string")
    spans = sorted((r["start"], r["end"], r["lang"]) for r in langid.language_spans(mixed, model).collect())
    assert spans[0][0] == 0 and spans[-1][1] == 512 and {s[2] for s in spans} == {"x", "y"}
    assert sum(b - a for a, b, l in spans if (l == "x") == (a < 256)) > 480
    found = {r["t"]: r["f"] for r in edges.select(F.col("text").alias("t"), langid.language_column(F.col("text"), model).alias("f")).collect()}
    assert [langid.has_letters(t) for t in ("²", "½ ①", "_1", "é", "日", "x²")] == [False, False, False, True, True, True]
    for text in (None, "", " \n1 2"):
        assert found[text]["lang_pred"] == "und" and found[text]["score"] == 0
    assert found["text"]["lang_pred"] in ("x", "y")
    assert langid.accept(edges, model).columns == edges.columns
    untaught = langid.train(edges)
    assert langid.accept(edges, untaught).count() == 0
    assert {r[0] for r in edges.select(langid.language_column(F.col("text"), untaught)["lang_pred"]).collect()} == {"und"}
    assert langid.language_spans(edges.limit(0), model).count() == 0

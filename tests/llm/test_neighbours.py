from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightlens.llm import neighbours, queries


def brute(rows, asked, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    found = {}
    for q, v in {i: v for i, v in rows if i in asked}.items():
        s = x @ np.asarray(v, np.float64)
        keep = ids != q
        order = np.lexsort((ids[keep], -s[keep]))[:k]
        found[q] = ids[keep][order].tolist()
    return found


def recall(found, wanted):
    got = {}
    for r in found:
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    return np.mean([len(got.get(q, set()) & set(w)) / max(1, len(w)) for q, w in wanted.items()])


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found = queries.op10_neighbours(spark, sf).collect()
    wanted = brute(rows, {i for i, _ in rows if i % 20 == 0}, 20)
    assert recall(found, wanted) >= 0.95
    vectors = dict(rows)
    for r in found:
        exact = float(np.dot(np.array(vectors[r["query_id"]], np.float64), np.array(vectors[r["vec_id"]], np.float64)))
        assert r["score"] == pytest.approx(exact, abs=1e-12) and r["query_id"] != r["vec_id"]
    for q in wanted:
        mine = sorted((r["rank"], -r["score"], r["vec_id"]) for r in found if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1)) and len(mine) == 20
        assert sorted(m[1:] for m in mine) == [m[1:] for m in mine]


def test_recall_with_clusters_lengths_and_copies(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 12)) + rng.normal(size=(12, 12))[rng.integers(0, 12, 1500)] * 2
    x[500:900] = x[500]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "id bigint, vector array<double>")
    found = neighbours.search(vectors, vectors.where(F.col("id") % 20 == 0), 10).collect()
    assert recall(found, brute(rows, {i for i, _ in rows if i % 20 == 0}, 10)) >= 0.9


def test_recall_beside_one_very_long_vector(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[7] *= 1000
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors = spark.createDataFrame(rows, "id bigint, vector array<double>")
    found = neighbours.search(vectors, vectors.where(F.col("id") % 20 == 0), 20).collect()
    wanted = brute(rows, {i for i, _ in rows if i % 20 == 0}, 20)
    assert recall(found, wanted) >= 0.9
    first = {r["query_id"]: r["vec_id"] for r in found if r["rank"] == 1}
    assert {q for q, w in wanted.items() if w[0] == 7} == {q for q, v in first.items() if v == 7}


def test_edge_cases(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, float("nan")]), (2, None), (3, [1.0, None]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0]),
            (5, [0.0, 0.0]), (6, [1.0, 0.0]), (6, [1.0, 0.0]), (7, [1.0, 2.0, 3.0]), (8, [-1.0, 0.0]), (9, [])]
    vectors = spark.createDataFrame(rows, "id bigint, vector array<double>").selectExpr("*", "1 AS node", "2 AS score")
    found = sorted(map(tuple, neighbours.search(vectors, vectors.where("id IN (0, 5, 6, 7)"), 3).collect()))
    assert found == [(0, 1, 6, 1.0), (0, 2, 8, -1.0), (6, 1, 0, 1.0), (6, 2, 8, -1.0)]
    assert neighbours.search(vectors.limit(0), vectors, 3).count() == 0
    assert neighbours.search(vectors, vectors.limit(0), 3).count() == 0

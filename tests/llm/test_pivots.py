from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from flightlens.llm import pivots, queries


def brute(rows, asked, k):
    found = []
    for q, v in {i: v for i, v in rows if i in asked}.items():
        scored = sorted(((-float(np.dot(v, x)), i) for i, x in rows if i != q))[:k]
        found += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(found)


@pytest.mark.parametrize("shape", ["sphere", "clusters", "copies"])
def test_search_equals_brute_force(spark, shape, monkeypatch):
    monkeypatch.setattr(pivots, "CELL_ROWS", 16)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 6))
    if shape == "clusters":
        x = x * 0.05 + rng.normal(size=(9, 6))[rng.integers(0, 9, 900)] * rng.uniform(0, 9, (900, 1))
    if shape == "copies":
        x[:400] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(np.floor(x * 100))]
    vectors = spark.createDataFrame(rows, "id bigint, vector array<double>")
    asked = vectors.where(F.col("id") % 7 == 0)
    found = sorted(map(tuple, pivots.search(vectors, asked, 5, pivots=6, annuli=4).collect()))
    assert found == brute(rows, {i for i, _ in rows if i % 7 == 0}, 5)


def test_annuli_are_left_out(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 4)) * 50
    x = np.floor(centres[rng.integers(0, 8, 2000)] + rng.normal(size=(2000, 4)))
    x = np.floor(x / np.linalg.norm(x, axis=1)[:, None] * 1000)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vector array<double>")
    index = pivots.build(vectors)
    asked = vectors.where("id < 40").select(F.col("id").alias("query_id"), "vector", F.lit(950_000.0).alias("bound"))
    opened = pivots._open_cells(index, asked, False, 5).count()
    assert opened < 0.5 * 40 * len(index.annuli)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    found = sorted(map(tuple, queries.op9_exact_topk(spark, sf).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert sorted(con.execute(f"SELECT query_id, rank, vec_id, score FROM ({queries.OP9_SQL})").fetchall()) == found


def test_edge_cases(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, float("nan")]), (2, None), (3, [1.0, None]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0]),
            (5, [0.0, 0.0]), (6, [1.0, 0.0]), (6, [1.0, 0.0]), (7, [1.0, 2.0, 3.0]), (8, [-1.0, 0.0]), (9, [])]
    vectors = spark.createDataFrame(rows, "id bigint, vector array<double>").selectExpr("*", "1 AS score", "2 AS rank")
    found = sorted(map(tuple, pivots.search(vectors, vectors.where("id IN (0, 5, 6, 7)"), 10).collect()))
    good = [(0, (1, 0)), (5, (0, 0)), (6, (1, 0)), (6, (1, 0)), (8, (-1, 0))]
    assert found == sorted([*brute(good, {0, 5, 6}, 10), *brute([(7, (1, 2, 3))], {7}, 10)])
    assert pivots.search(vectors.limit(0), vectors, 10).count() == 0
    assert pivots.search(vectors, vectors.limit(0), 10).count() == 0


def test_large_components_and_two_lengths(spark):
    """Inner products far past 2^53, and past the doubles between."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.integers(-(2**27), 2**27, 24 if i % 3 else 7).tolist()) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(30)]
    vectors = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in rows], "id bigint, vector array<double>")
    found = sorted(map(tuple, pivots.search(vectors, vectors.where("id % 10 = 0"), 8, pivots=5, annuli=3, whole=True).collect()))
    wanted = []
    for q, v in rows:
        if q % 10 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in rows if i != q and len(x) == len(v))[:8]
            wanted += [(q, n + 1, i, -score) for n, (score, i) in enumerate(scored)]
    assert found == sorted(wanted) and max(abs(r[3]) for r in found) > 2**55

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightlens.llm import maxent, queries


def brute_base(rows):
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(w for t in train for w in maxent.words((t or "").encode()))
    total, distinct = counts.total(), len(counts)
    for i, t in rows:
        tokens = maxent.words((t or "").encode())
        base = sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
        yield i, len(tokens), sum(counts[w] > 0 for w in tokens), total, base


def test_base_equals_brute_force_and_the_model_is_better(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = {r["doc_id"]: r for r in queries.op5_maxent(spark, sf).collect()}
    assert len(rows) == len(docs)
    for i, tokens, known, total, base in brute_base(docs):
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 10 == 0)
    out = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_small_head_gives_the_same_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    train = F.col("doc_id") % 3 > 0
    whole = {r["doc_id"]: r for r in maxent.score(docs, train, rounds=1).collect()}
    small = {r["doc_id"]: r for r in maxent.score(docs, train, rounds=2, head_size=50).collect()}
    for i, r in whole.items():
        assert small[i]["base_score"] == pytest.approx(r["base_score"], rel=1e-9)
        assert small[i]["n_known"] == r["n_known"]


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    tokens = [b"the", b"", *(f"word{i}".encode() for i in range(80))]
    n = np.sort(rng.integers(1, 500, len(tokens)))[::-1].astype(float)
    tail = {f"rare{i}".encode(): 1 for i in range(30)}
    kind = maxent.spelling_classes(tokens, n)
    mass = np.bincount(kind, n + 0.1, maxent.CLASSES)
    tail_total = 30 + 0.1 * 31
    head = maxent.Head(dict(zip(tokens, range(len(tokens)))), kind, np.log10(n + 0.1) - np.log10(mass[kind]), np.log10(n + 0.1),
                       int(n.sum()) + 30, len(tokens) + 30, tail_total)
    weights = rng.normal(0, 0.3, (maxent._FEATURES * maxent.ROWS + 1, maxent.CLASSES)).astype(np.float32)
    used = np.bincount(kind, minlength=maxent.CLASSES) > 0
    used[maxent.TAIL_CLASS] = True
    weights[-1, ~used] = -50
    context = b"the word3 rare1 word5 "
    before = list(maxent.score_texts([context.strip()], head, weights))[0]
    total = 0.0
    for token in [t for t in tokens if t] + list(tail) + [b"unseen"]:
        # The text's own end token is left out of both sums.
        n_tokens, _, _, score, rest = list(maxent.score_texts([context + token], head, weights))[0]
        ids = maxent.token_ids(maxent.words(context + token), head.place)
        both, targets = maxent.joined([ids], len(tokens) + maxent.TAIL_IDS)
        found = maxent.class_scores(weights, maxent.feature_rows(both, targets))
        log = found - np.log(np.exp(found).sum(1, keepdims=True))
        kinds = maxent.token_kinds(head)[ids]
        at = n_tokens - 2
        p = np.exp(log[at, kinds[at]])
        p *= 10 ** head.log_share[ids[at]] if ids[at] < len(tokens) else (tail.get(token, 0) + 0.1) / tail_total
        total += p
    end = np.exp(log[at, head.kind[1]]) * 10 ** head.log_share[1]
    assert total + end == pytest.approx(1, abs=2e-3) and before[0] == 5


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "A b"), (3, "a B"), (None, "a"), (4, "long text " * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS score", "2 AS n", "3 AS token")
    for train in (F.col("doc_id") < 4, F.lit(False), F.lit(None).cast("boolean")):
        found = maxent.score(docs, train).collect()
        assert len(found) == len(rows) and all(np.isfinite(r["score"]) for r in found)
    assert {r["n_tokens"] for r in found if r["doc_id"] in (1, 2)} == {1}
    assert maxent.score(docs.limit(0), F.lit(True)).count() == 0

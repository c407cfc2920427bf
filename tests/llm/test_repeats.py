from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from flightlens.llm import queries, repeats


def brute(rows, span):
    """Removed stretches of each row, from all windows of all rows."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    for i, text in texts:
        for at in range(len(text) - span + 1) if i is not None else ():
            w = text[at : at + span]
            least[w] = min(least.get(w, i), i)
    found = []
    for i, text in texts:
        gone = bytearray(len(text))
        for at in range(len(text) - span + 1) if i is not None else ():
            if least[text[at : at + span]] < i:
                gone[at : at + span] = b"\x01" * span
        edges = [p for p in range(len(text) + 1) if (p > 0 and gone[p - 1]) != (p < len(text) and gone[p])]
        kept = bytes(c for c, g in zip(text, gone) if not g)
        found.append((i, len(text), tuple(zip(edges[::2], edges[1::2])), kept))
    return Counter(found)


def cut(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS id", "2 AS block", "3 AS removed")
    made = repeats.without_repeats(docs.repartition(3), **options).collect()
    return Counter((r["doc_id"], r["n_bytes"], tuple((s["start"], s["end"]) for s in r["removed"]), bytes(r["kept"])) for r in made)


@pytest.fixture
def small_blocks(monkeypatch):
    """Many blocks and slices, so that suffixes of one block meet those of others."""
    monkeypatch.setattr(repeats, "BLOCK", 600)
    monkeypatch.setattr(repeats, "SLICE", 250)


def made_rows(seed, alphabet="ab é.", docs=60):
    rng = np.random.default_rng(seed)
    said = ["".join(rng.choice(list(alphabet), rng.integers(5, 160))) for _ in range(25)]
    rows = []
    for i in range(docs):
        parts = [said[rng.integers(25)][: rng.integers(1, 200)] for _ in range(rng.integers(0, 6))]
        own = ["".join(rng.choice(list("cdefgh "), rng.integers(0, 40))) for _ in parts]
        rows.append((int(rng.integers(0, 2 * docs)), "".join(a + b for a, b in zip(parts, own))))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed, small_blocks):
    rows = made_rows(seed) + [(None, "x" * 80), (7, None), (8, "")]
    wanted = brute(rows, 50)
    assert cut(spark, rows) == wanted
    assert sum(len(r[2]) for r in wanted) > 20


def test_many_buckets_and_ties(spark, small_blocks):
    """Copies stand among the splitters several times and are compared across buckets."""
    passage = "one passage that a third of all documents share, word by word, to the end of it"
    rows = made_rows(9, docs=40) + [(1000 + i, f"{i} " + passage * (i % 3) + f" {i * 7}") for i in range(60)]
    rows += [(2000 + i, passage) for i in range(40)]
    assert cut(spark, rows, bucket_bytes=200) == brute(rows, 50)


def test_little_entropy(spark, small_blocks):
    rows = [(1, "a" * 49), (2, "a" * 50), (3, "a" * 3000), (3, "a" * 70), (4, "ab" * 900), (5, "b" + "a" * 51 + "b"), (6, "ba" * 30)]
    assert cut(spark, rows) == brute(rows, 50)


@pytest.mark.parametrize("span", [1, 7, 64])
def test_other_spans(spark, small_blocks, span):
    rows = made_rows(4, docs=25)
    assert cut(spark, rows, span=span) == brute(rows, span)


def test_a_long_text_and_copies(spark):
    rng = np.random.default_rng(3)
    long = "".join(rng.choice(list("abcdefgh "), 3_000_000))
    rows = [(5, long), (9, long), (2, long[1_000_000:1_000_100])]
    got = {r["doc_id"]: r for r in repeats.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[9]["kept"] == b"" and got[2]["kept"] == rows[2][1].encode()
    assert [(s["start"], s["end"]) for s in got[5]["removed"]] == [(1_000_000, 1_000_100)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert repeats.without_repeats(docs).collect() == []


def test_query_on_the_test_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    wanted = Counter((i, n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()) for i, n, spans, kept in brute(rows, 50))
    got = Counter(tuple(r) for r in queries.op12_repeats(spark, sf).collect())
    assert got == wanted and any(r[2] for r in got)

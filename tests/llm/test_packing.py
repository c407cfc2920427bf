from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flightlens.llm import bpe, packing, queries


def check(rows, texts, window):
    """Every id of every document in one piece, sequences gapless and within the window."""
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    wanted = sorted((repr(i), np.array([*encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for i, t in texts)
    documents, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        documents[(r["doc_id"], r["doc_tokens"])].append((r["start"], r["length"], r["ids"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    rebuilt = []
    for (i, tokens), parts in documents.items():
        copies = sum(1 for s, _, _ in parts if s == 0)
        if copies == 1:
            at, data = 0, b""
            for start, length, ids in sorted(parts):
                assert start == at and length == len(ids) // 4 > 0
                at, data = at + length, data + bytes(ids)
            assert at == tokens
            rebuilt.append((repr(i), data))
        else:
            assert sum(n for _, n, _ in parts) == tokens * copies
            rebuilt += [w for w in wanted if w[0] == repr(i) and len(w[1]) == 4 * tokens]
    assert sorted(rebuilt) == wanted
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    lengths = [sum(n for _, n in p) for p in sequences.values()]
    return sum(lengths) / (window * len(lengths))


def test_documents_are_packed_whole(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(docs, *bpe.public_vocabulary(), shard_rows=64).collect()
    assert check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 1024) > 0.97


def test_query_has_the_digests(spark):
    sf = "/root/testdata/sf0.001"
    rows = queries.op6_packing(spark, sf).collect()
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode
    ids = {r["doc_id"]: [*encode(r["text"], add_special_tokens=False).ids, 0] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])


def test_scores_are_bm25():
    rng = np.random.default_rng(1)
    ids = [rng.integers(0, 30, rng.integers(5, 40)) for _ in range(25)]
    df = np.array([sum(t in set(p.tolist()) for p in ids) for t in range(30)])
    idf = np.log1p((25 - df + 0.5) / (df + 0.5)).astype(np.float32)
    mean = np.mean([len(p) for p in ids])
    shard = packing.Shard(ids, idf, mean)
    for seed in (0, 7):
        for place, p in enumerate(ids):
            if place == seed:
                continue
            wanted = 0.0
            for t in set(ids[seed].tolist()):
                tf = int((p == t).sum())
                wanted += idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(p) / mean))
            assert shard.scores(seed)[place] == pytest.approx(wanted, rel=1e-4)


def test_counts_cover_all_pieces(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    cut = packing.pieces(docs, *bpe.public_vocabulary())
    rest = cut.where("length < 1024")
    idf, mean = packing.idf_table(rest, 50257)
    ids = [np.frombuffer(r["ids16"], "<u2") for r in rest.collect()]
    assert mean == pytest.approx(np.mean([len(i) for i in ids]))
    df = np.zeros(50257)
    for i in ids:
        df[np.unique(i)] += 1
    assert np.allclose(idf, np.log1p((len(ids) - df + 0.5) / (df + 0.5)), rtol=1e-5)


def test_neighbours_share_windows():
    rng = np.random.default_rng(2)
    topics = [rng.integers(100 * t, 100 * t + 40, (20, 25)) for t in range(5)]
    ids = [p for pair in zip(*topics) for p in pair]
    windows, left = packing.fill_windows(ids, np.ones(600, np.float32), 25.0, 100, last=True)
    assert not left
    pure = [len({ids[i][0] // 100 for i, _, _ in w}) == 1 for w in windows]
    assert np.mean(pure) > 0.9


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, "long words " * 20_000), (5, "same " * 1023), (6, "same " * 1024)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS row", "2 AS ids", "3 AS length")
    check(packing.pack(docs, *bpe.public_vocabulary(), shard_rows=3).collect(), rows, 1024)
    assert packing.pack(docs.limit(0), *bpe.public_vocabulary()).count() == 0


def test_a_term_that_repeats_in_a_piece_counts_once(spark):
    pieces = [np.array(p, "<u2").tobytes() for p in ([3, 3, 5, 3], [5, 5], [7])]
    idf, mean = packing.idf_table(spark.createDataFrame([(p,) for p in pieces], "ids16 binary"), 10)
    df = np.zeros(10)
    df[[3, 5, 7]] = 1, 2, 1
    assert np.allclose(idf, np.log1p((3 - df + 0.5) / (df + 0.5))) and mean == 7 / 3

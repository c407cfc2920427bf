from __future__ import annotations

import time

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flightlens.llm import bpe

PARTS = [" ", "  ", "\n", "\t", " ", " ", "\x85", "'s", "'S", "'ll", "'", "a", "B", "é", "ß", "中",
         "1", "٣", "²", "\U0001f389", "é", "<|endoftext|>", "<|endoftext", "|>", "_", "the ", "word", "\x00"]


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(*bpe.public_vocabulary())


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def want(reference, text):
    return reference.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_library_on_its_vocabulary(codec, reference):
    for token in reference.get_vocab():
        text = codec.decode([reference.token_to_id(token)]).decode("utf-8", "replace")
        assert codec.encode(text.encode()) == want(reference, text)


def test_ids_equal_the_library_on_odd_texts(codec, reference):
    rng = random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14)))
        assert codec.encode(text.encode()) == want(reference, text), repr(text)


def test_mended_joins_are_exact_for_any_cut(codec, reference):
    rng = random.Random(2)
    for _ in range(3000):
        data = "".join(rng.choice(PARTS) for _ in range(rng.randint(2, 40))).encode()
        places = [p for p in range(1, len(data)) if data[p] & 0xC0 != 0x80]
        cuts = sorted(rng.sample(places, min(len(places), rng.randint(1, 6))))
        ids, bounds = [], [0, *cuts, len(data)]
        for a, b in zip(bounds, bounds[1:]):
            more = codec.encode(data[a:b])
            if a:
                bpe.append_chunk(codec, data, ids, a, b, more)
            else:
                ids = more
        assert ids == want(reference, data.decode()), data


def test_cuts_follow_content():
    rng = np.random.default_rng(3)
    passage = rng.integers(97, 123, 20_000).astype(np.uint8).tobytes()
    one, two = b"x" * 777 + passage, b"other " * 300 + passage
    first = {d for d, _ in bpe.chunks(one)}
    second = {d for d, _ in bpe.chunks(two)}
    assert len(first & second) >= 0.8 * len(first)
    assert b"".join(c for _, c in bpe.chunks(one)) == one
    lengths = [len(c) for _, c in bpe.chunks(b"a" * 100_000)]
    assert max(lengths) <= bpe.LONGEST_CHUNK
    umlauts = ("é" * 50_000).encode()
    assert all(c.decode() for _, c in bpe.chunks(umlauts))
    assert rng.integers(2) in (0, 1) and list(bpe.chunks(b"")) == [(bpe.xxhash.xxh128_digest(b""), b"")]


@pytest.mark.parametrize("bits", [6, 20])
def test_documents_equal_the_library(spark, reference, bits):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    vocabulary, pattern = bpe.public_vocabulary()
    made = bpe.encode(docs, vocabulary, pattern, sketch_bits=bits)
    made = made.withColumn("text", bpe.decode_column(made["ids"], vocabulary, pattern))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = made.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert np.frombuffer(r["ids"], "<u4").tolist() == want(reference, texts[r["doc_id"]])
        assert bytes(r["text"]).decode() == texts[r["doc_id"]]


def test_edge_cases(spark, reference):
    passage = "Some shared passage, number one. " * 200
    rows = [(1, None), (2, ""), (3, passage), (3, passage), (None, "x" + passage), (4, "a" * 30_000),
            (5, "a<|endoftext|>b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS ids", "1 AS key")
    vocabulary, pattern = bpe.public_vocabulary()
    made = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in bpe.encode(docs, vocabulary, pattern).collect()]
    order = lambda rows: sorted(rows, key=repr)
    assert order(made) == order([(i, want(reference, t or "")) for i, t in rows])
    assert bpe.encode(docs.limit(0), vocabulary, pattern).count() == 0


def test_time_is_in_proportion_to_the_text():
    """All chunks known: eight times the text takes nowhere near sixty-four times as long."""
    codec = bpe.Codec(*bpe.public_vocabulary())
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(4000)]
    took = []
    for size in (12_000, 96_000):
        text = " ".join(rng.choice(words, size)).encode()
        known = {d: codec.encode(c) for d, c in bpe.chunks(text)}
        began = time.process_time()
        ids = bpe.encode_from_chunks(codec, text, known)
        took.append(time.process_time() - began)
        assert ids == codec.encode(text)
    assert took[1] < 24 * took[0] + 0.5


def test_a_long_text_that_occurs_twice(spark):
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(4000)]
    long = " ".join(rng.choice(words, 900_000))
    assert len(long) > 5_000_000
    docs = spark.createDataFrame([(1, long), (2, long), (3, "short")], "doc_id bigint, text string")
    rows = {r["doc_id"]: bytes(r["ids"]) for r in bpe.encode(docs, *bpe.public_vocabulary()).collect()}
    wanted = np.array(bpe.Codec(*bpe.public_vocabulary()).encode(long.encode()), "<u4").tobytes()
    assert rows[1] == rows[2] == wanted and len(rows) == 3

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from flightlens.llm import phrases
from flightlens.llm.multikey import equal_partitions


def brute(rows, longest, least, percent, first):
    lower = {c: c + 32 for c in range(65, 91)}
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    frequent = {k: n for k, n in counts.items() if n >= least}
    held = set()
    for (lang, w), n in frequent.items():
        for size in range(2, len(w)):
            for i in range(len(w) - size + 1):
                if 100 * n >= percent * counts[lang, w[i : i + size]]:
                    held.add((lang, w[i : i + size]))
    found = {}
    for (lang, w), a in frequent.items():
        if len(w) < 2 or (lang, w) in held:
            continue
        cuts = [(1_000_000 * a * a // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), a, counts[lang, w[:k]], counts[lang, w[k:]]))
    return sorted(
        (lang, i + 1, p.decode(), a, l, r, totals[lang], -s)
        for lang, rows in found.items()
        for i, (s, _, p, a, l, r) in enumerate(sorted(rows)[:first])
    )


def mined(spark, rows, **options):
    docs = spark.createDataFrame(rows, "text string, lang string").selectExpr("*", "1 AS doc_id", "'x' AS phrase", "2 AS n", "3 AS rank")
    return sorted(tuple(r) for r in phrases.collocations(docs, **options).collect())


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(40)] + ["É", "é", "THE", "the", "a b", "x\x00y"]
    share = np.arange(len(words), 0, -1) ** 2.0
    rows = []
    for i in range(120):
        picked = rng.choice(words, 60, p=share / share.sum())
        marks = rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\x0b"], 60, p=[0.8, 0.04, 0.04, 0.04, 0.04, 0.02, 0.02])
        rows.append(("".join(w + m for w, m in zip(picked, marks)), ["en", "fr", None, "d\ne"][i % 4]))
    return rows + [(None, "en"), ("", "en"), ("...", "zz"), ("New York City " * 50, "en")] + rows[:7]


@pytest.mark.parametrize("options", [(3, 10, 50, 2000), (2, 3, 50, 20), (4, 3, 80, 50), (3, 1, 100, 10_000)])
def test_equals_brute_force(spark, corpus, options):
    got = mined(spark, corpus, **dict(zip(("longest", "least", "percent", "first"), options)))
    assert got == brute(corpus, *options) and got


def test_hot_leading_words_are_shared_out(spark, corpus):
    """With tiny buckets, words and pairs are routed by two and three words."""
    got = mined(spark, corpus, longest=3, least=4, in_bucket=50)
    assert got == brute(corpus, 3, 4, 50, 2000) and got


def test_one_word_makes_all_rows(spark):
    rows = [("same " * 20_000, "en"), ("same same", "en"), ("other words", None)] * 3
    assert mined(spark, rows, in_bucket=500) == brute(rows, 3, 10, 50, 2000)


def test_no_words(spark):
    assert mined(spark, [(None, None), ("", "en"), (" .\n", "en")]) == []
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert phrases.collocations(empty).collect() == []


def test_a_long_text(spark):
    rows = [("alpha beta gamma, " * 300_000, "en")]
    assert mined(spark, rows) == brute(rows, 3, 10, 50, 2000)


def test_partitions_count_every_prefix():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 6, (3, 4000))
    weights = rng.integers(1, 4, 4000)
    wanted = Counter()
    for row, n in zip(keys.T.tolist(), weights.tolist()):
        for size in (1, 2, 3):
            wanted[tuple(row[:size])] += n
    found = {}
    for part in equal_partitions(keys, weights, np.array([1, 30, 60])):
        for start, depth, n in zip(part.starts, part.depth, part.weights):
            found[tuple(keys[:depth, part.items[start]].tolist())] = n
    assert found == {k: n for k, n in wanted.items() if n >= (1, 30, 60)[len(k) - 1]}

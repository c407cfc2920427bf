from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from flightlens.llm import divergence


def brute(rows, least_docs, first):
    lower = {c: c + 32 for c in range(65, 91)}
    groups, counts, docs = set(), Counter(), Counter()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        said = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(lower))
        for term in said:
            counts[lang, source, term] += 1
        for term in set(said):
            docs[lang, term] += 1
    kept = defaultdict(list)
    for (lang, term), n in docs.items():
        if n >= least_docs:
            kept[lang].append(term)
    n = {(lang, s): sum(counts[lang, s, t] for t in kept[lang]) for lang, s in groups}
    found = []

    def p(count, total, lang):
        return 1 + 10**9 * (count + 1) // (total + len(kept[lang]))

    def f(a, b):
        return (a - b) * (a - b) // b

    for lang, s in groups:
        mine = {t: p(counts[lang, s, t], n[lang, s], lang) for t in kept[lang]}
        pairs = []
        for other in (o for g, o in groups if g == lang and o != s):
            pairs.append((-sum(f(mine[t], p(counts[lang, other, t], n[lang, other], lang)) for t in mine), other.encode(), other))
        whole = sum(v for (g, _), v in n.items() if g == lang)
        terms = []
        for t in mine:
            q = p(sum(counts[lang, o, t] for g, o in groups if g == lang), whole, lang)
            if counts[lang, s, t] and mine[t] > q:
                terms.append((-f(mine[t], q), t.encode(), t))
        for part, listed in (("pair", sorted(pairs)), ("term", sorted(terms)[:first])):
            found += [(lang, s, part, item, -value, i + 1) for i, (value, _, item) in enumerate(listed)]
    return sorted(found)


def audited(spark, rows, **options):
    docs = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 AS doc_id", "2 AS value", "3 AS n")
    return sorted(tuple(r) for r in divergence.audit(docs.repartition(3), **options).collect())


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(6)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)] + ["Été", "été", "ß", "日本", "x1y"]
    rows = []
    for i in range(150):
        source = int(rng.integers(0, 9))
        share = 1.0 / (1 + (np.arange(len(words)) * (source + 3)) % 97)
        said = rng.choice(words, rng.integers(0, 60), p=share / share.sum())
        rows.append((" ".join(said), ["en", "fr", None][i % 3], [None, "", *"abcdefg"][source]))
    return rows + [(None, "en", "none"), ("1 2 3", "de", "x"), ("rare words", "de", "y"), (None, None, None)] + rows[:5]


@pytest.mark.parametrize("options", [(3, 200), (1, 4), (40, 3)])
def test_equals_brute_force(spark, corpus, options):
    got = audited(spark, corpus, least_docs=options[0], first=options[1])
    assert got == brute(corpus, *options) and got


def test_many_buckets(spark, corpus):
    assert audited(spark, corpus, bucket_bytes=700) == brute(corpus, 3, 200)


def test_squares_of_sources(spark, corpus, monkeypatch):
    """More sources than a square has sides, sums handed on early, few nodes at a time."""
    monkeypatch.setattr(divergence, "SIDE", 4)
    monkeypatch.setattr(divergence, "HELD", 5)
    monkeypatch.setattr(divergence, "TOGETHER", 7)
    assert audited(spark, corpus, bucket_bytes=4000) == brute(corpus, 3, 200)


def test_hot_source_and_long_text(spark):
    rows = [("alpha beta " * 200_000, "en", "hot")] * 3 + [("alpha gamma", "en", s) for s in "abc"]
    assert audited(spark, rows) == brute(rows, 3, 200)


def test_nothing_to_compare(spark):
    assert audited(spark, [(None, None, None)]) == []
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string")
    assert divergence.audit(empty).collect() == []


def test_large_counts_stay_exact():
    counts = np.array([0, 10**9, 10**13, 8 * 10**17], np.int64)
    made = divergence.probabilities(counts, 9 * 10**17)
    assert made.tolist() == [1 + 10**9 * (c + 1) // (9 * 10**17) for c in counts.tolist()]


@pytest.mark.parametrize("shape", [(1, 1), (1, 9), (9, 1), (3, 40), (33, 5)])
def test_sums_equal_the_plain_ones(shape):
    rng = np.random.default_rng(shape[0])
    counts = rng.integers(0, 5, shape) * (rng.random(shape) < 0.2)
    n = counts.sum(1) + shape[1] + 3
    p = divergence.probabilities(counts, n[:, None])
    zero = divergence.probabilities(np.zeros(len(n), np.int64), n)
    wanted = np.array([[divergence.divergences(a, b).sum() for b in p] for a in p])
    there, _ = divergence.pair_sums(counts, counts, p, p, zero, zero, True)
    assert (there == wanted).all()
    k = max(1, shape[0] // 2)
    if k < shape[0]:
        there, back = divergence.pair_sums(counts[:k], counts[k:], p[:k], p[k:], zero[:k], zero[k:], False)
        assert (there == wanted[:k, k:]).all() and (back.T == wanted[k:, :k]).all()


def test_empty_quadrants_are_priced_at_once():
    counts = np.zeros((8, 64), np.int64)
    counts[2, 5] = 1
    tree = divergence.Quadtree(counts, 8)
    nodes = [(level, len(a)) for level, a, *_ in tree.pairs(tree, True)]
    assert sum(n for _, n in nodes) < 200  # of 36 * 64 pairs of cells

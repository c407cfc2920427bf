"""The columns of the trained operators against plain loops over the formulas they are defined with."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightlens.llm import langid, quality, toxicity

TEXTS = [None, "", "One two. Two three!", "vile words here. Fine ones there", "Élan ² 12 aa aa aa", "x " * 700, "日本語 text\nmore"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")


def logistic(x):
    return 1 / (1 + math.exp(-x))


def columns(docs, made):
    return {r["doc_id"]: r["m"] for r in docs.select("doc_id", made.alias("m")).collect()}


def shape(word):
    kinds = "".join("A" if 65 <= b <= 90 else "a" if 97 <= b <= 122 or b >= 128 else "0" if 48 <= b <= 57 else chr(b) for b in word)
    return re.sub(r"(.)\1+", r"\1", kinds).encode("latin-1")


def test_grades(docs):
    rng = np.random.default_rng(1)
    bits = quality.HASH_BITS
    model = quality.Model(rng.normal(size=1 << bits).astype("f4"), np.array([-1.0, 0.5, 2.0]), np.array([0.0, 1.0, 3.0, 4.0]))
    got = columns(docs, quality.grade_column(F.col("text"), model, wanted=3.0))
    for i, text in enumerate(TEXTS):
        words = (text or "").encode().split()
        total = max(1, len(words))
        found = Counter()
        for name, n in (Counter(words) + Counter(b"\0" + shape(w) for w in words)).items():
            found[zlib.crc32(name) % (1 << bits)] += math.sqrt(n / total)
        found[zlib.crc32(b"\1again") % (1 << bits)] += sum(a == b for a, b in zip(words, words[1:])) / total
        found[zlib.crc32(b"\1spare%d" % int((1 - len(set(words)) / total) * 10)) % (1 << bits)] += 0.5
        score = sum(float(model.weights[k]) * v for k, v in found.items())
        above = [logistic(score - c) for c in model.thresholds]
        share = [a - b for a, b in zip([1, *above], [*above, 0])]
        assert got[i]["expected_grade"] == pytest.approx(sum(g * p for g, p in zip(model.grades, share)), abs=1e-5)
        assert got[i]["tail_probability"] == pytest.approx(share[2] + share[3], abs=1e-5)


def test_toxicity(docs):
    weights = {h: w for word, w in ((b"vile", 3.0), (b"words", -0.5), (b"two", 0.7)) for h in toxicity.word_hashes(word)[:1]}
    weights[zlib.crc32(b"^fine"[:5])] = -1.0
    weights[zlib.crc32(b"^ther")] = 0.4
    got = columns(docs, toxicity.score_column(F.col("text"), toxicity.Model(-2.0, weights)))
    for i, text in enumerate(TEXTS):
        spared = 1.0
        said = [s for s in re.split(r"[.!?\n\r]", text or "") if re.search(r"[a-z0-9\x80-\U0010ffff]", s.lower())] or [""]
        for sentence in said:
            clean = re.sub(rb"[^a-z0-9\x80-\xff]", b" ", re.sub(rb"[A-Z]", lambda m: m.group().lower(), sentence.encode()))
            score = -2.0
            for word in set(clean.split()):
                score += weights.get(zlib.crc32(word), 0.0)
                score += sum(weights.get(zlib.crc32(b"^" + word[:k]), 0.0) for k in toxicity.STEMS if len(word) > k)
            spared *= 1 - logistic(score)
        assert got[i] == pytest.approx(1 - spared, abs=1e-9)


def test_language(docs):
    w = langid.new_weights(3, hidden=4, seed=5)
    got = columns(docs, langid.language_column(F.col("text"), langid.dumps(w, ["x", "y", "z"])))
    h = 4

    def one_way(way, data):
        state, made = np.zeros(h), []
        for byte in data:
            given, kept = w["inputs"][way][byte].astype(float), state @ w["state"][way].astype(float)
            update, reset = (np.array([logistic(v) for v in given[s] + kept[s]]) for s in (slice(0, h), slice(h, 2 * h)))
            candidate = np.tanh(given[2 * h :] + reset * kept[2 * h :])
            state = (1 - update) * candidate + update * state
            made.append(state)
        return made

    for i, text in enumerate(TEXTS):
        if not any(c.isalpha() for c in text or ""):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        data, pooled = text.encode(), np.zeros(3)
        for at in range(0, len(data), langid.WINDOW):
            part = data[at : at + langid.WINDOW]
            # The last window is filled with zero bytes, which the way back reads first.
            filled = part + b"\0" * (langid.WINDOW - len(part))
            ahead, back = one_way(0, filled), one_way(1, filled[::-1])[::-1]
            for t in range(len(part)):
                x = np.concatenate([ahead[t], back[t]]) @ w["out"] + w["bias"]
                pooled += np.exp(x - x.max()) / np.exp(x - x.max()).sum()
        pooled /= len(data)
        assert got[i]["lang_pred"] == "xyz"[int(pooled.argmax())]
        assert got[i]["score"] == pytest.approx(pooled.max(), abs=1e-4)

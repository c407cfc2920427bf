"""Quality grades by ordinal cumulative-link regression on hashed text.

One set of weights is shared by all grades; ordered thresholds cut the score
w.x into grades: P(grade <= k) = sigmoid(threshold_k - w.x).  From that come the
expected grade and the probability of a grade of at least ``wanted``, by which
documents are selected.

Features of a whole text: its words and the shapes of its words (letter case,
digits and signs kept as classes), hashed to ``2**HASH_BITS`` places, each family
scaled to length one, and how often a word repeats the one before it or any
earlier one.  The model is fitted on a bounded sample of rated
documents (``rows`` of at most ``max_bytes``); scoring is one narrow pass.

Nulls and edge cases: a null or empty text has no features and is scored by the
thresholds alone; null ratings and ratings of unknown documents are ignored; of
repeated ratings the largest counts.  Without any rating the expected grade is
null and the tail probability 1, so that nothing is rejected.  With a single
grade it is that grade.  Rows and columns stay as they are.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlens.llm.common import fit_in_one_task, labelled_sample, small_batches

HASH_BITS = 18
MOST_GRADES = 64
SAMPLE_ROWS = 8_192
SAMPLE_BYTES = 200_000
_SHAPE = bytes(
    b if b <= 32 else 65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b
    for b in range(256)
)
_RUN = re.compile(rb"(.)\1+")


@dataclass(frozen=True)
class Model:
    """Hashed weights, and the grades with the thresholds between them."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: np.ndarray

    def dumps(self) -> bytes:
        parts = [self.grades.astype("<f8"), self.thresholds.astype("<f8"), self.weights.astype("<f4")]
        return len(self.grades).to_bytes(4, "little") + b"".join(p.tobytes() for p in parts)

    @staticmethod
    def loads(data: bytes) -> Model:
        n = int.from_bytes(data[:4], "little")
        cuts = max(0, n - 1)
        numbers = np.frombuffer(data, "<f8", n + cuts, 4)
        weights = np.frombuffer(data, "<f4", offset=4 + 8 * (n + cuts))
        return Model(weights, numbers[n:], numbers[:n])


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of a text."""
    text = text or b""
    listed = text.split()
    words = Counter(listed)
    shapes: Counter[bytes] = Counter()
    for shape, n in Counter(text.translate(_SHAPE).split()).items():
        shapes[b"\0" + _RUN.sub(rb"\1", shape)] += n
    mask = (1 << HASH_BITS) - 1
    crc = zlib.crc32
    places = np.array([crc(w) & mask for family in (words, shapes) for w in family], np.int64)
    total = max(1, len(listed))
    values = np.sqrt(np.array([*words.values(), *shapes.values()], np.float64) / total)
    again = sum(map(eq, listed, islice(listed, 1, None))) / total
    spare = 1 - len(words) / total
    extra = [(b"\1again", again), (b"\1spare%d" % (spare * 10), 0.5)]
    places = np.append(places, [crc(name) & mask for name, _ in extra])
    return places, np.append(values, [value for _, value in extra])


def fit(
    texts: list[bytes], ratings: np.ndarray, epochs: int = 15, rate: float = 0.05, decay: float = 1e-4, batch: int = 64
) -> Model:
    """Maximum likelihood by Adam; deterministic for the same sample."""
    grades = np.unique(ratings)
    if len(grades) > MOST_GRADES:
        raise ValueError(f"more than {MOST_GRADES} grades: bin the ratings first")
    size = 1 << HASH_BITS
    if len(grades) < 2:
        return Model(np.zeros(size), np.zeros(0), grades)
    target = np.searchsorted(grades, ratings)
    found = [features(t) for t in texts]
    share = np.clip(np.cumsum(np.bincount(target))[:-1] / len(target), 1e-3, 1 - 1e-3)
    first = np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(first), 1e-3))
    # One vector: weights, the lowest threshold, logs of the gaps above it.
    values = np.concatenate((np.zeros(size), first[:1], gaps))
    mean, square = np.zeros_like(values), np.zeros_like(values)
    rng, step = np.random.default_rng(7), 0
    for _ in range(epochs):
        order = rng.permutation(len(found))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            row = np.repeat(np.arange(len(some)), [len(found[i][0]) for i in some])
            place = np.concatenate([found[i][0] for i in some])
            value = np.concatenate([found[i][1] for i in some])
            score = np.bincount(row, values[place] * value, len(some))
            by_score, by_cut = _slopes(score, target[some], _cuts(values[size:]))
            slope = np.empty_like(values)
            slope[:size] = np.bincount(place, by_score[row] * value, size) / len(some) + decay * values[:size]
            above = np.cumsum(by_cut[::-1])[::-1] / len(some)
            slope[size] = above[0]
            slope[size + 1 :] = above[1:] * np.exp(values[size + 1 :])
            step += 1
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope * slope - square)
            values -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    return Model(values[:size], _cuts(values[size:]), grades)


def _cuts(free: np.ndarray) -> np.ndarray:
    return free[0] + np.concatenate(([0.0], np.cumsum(np.exp(free[1:]))))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _slopes(score: np.ndarray, target: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of minus the log likelihood by score (per row) and by threshold (summed)."""
    edges = np.concatenate(([-np.inf], cuts, [np.inf]))
    upper, lower = _sigmoid(edges[target + 1] - score), _sigmoid(edges[target] - score)
    inside = np.maximum(upper - lower, 1e-12)
    by_cut = np.zeros(len(cuts) + 2)
    np.add.at(by_cut, target + 1, -upper * (1 - upper) / inside)
    np.add.at(by_cut, target, lower * (1 - lower) / inside)
    return 1 - upper - lower, by_cut[1:-1]


def train(docs: DataFrame, labels: DataFrame, rating: Column, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on at most ``rows`` rated documents of at most ``max_bytes`` each."""

    def run(sample: pa.Table | None) -> bytes:
        if sample is None:
            return fit([], np.zeros(0)).dumps()
        sample = sample.sort_by("_id")
        return fit(sample["text"].to_pylist(), sample["target"].to_numpy()).dumps()

    sample = labelled_sample(docs, labels, rating.cast("double"), rows, max_bytes)
    return Model.loads(fit_in_one_task(sample, run))


def grade_column(text: Column, model: Model, wanted: float | None = None) -> Column:
    """Struct of expected_grade and tail_probability (grade of at least ``wanted``, by default the best)."""
    grades, cuts = model.grades, model.thresholds
    rank = len(grades) - 1 if wanted is None else int(np.searchsorted(grades, wanted))

    @F.pandas_udf("expected_grade double, tail_probability double")
    def graded(texts: pd.Series) -> pd.DataFrame:
        if not len(grades):
            return pd.DataFrame({"expected_grade": [None] * len(texts), "tail_probability": [1.0] * len(texts)})
        score = np.empty(len(texts))
        for i, t in enumerate(texts):
            place, value = features(t)
            score[i] = model.weights[place] @ value
        above = _sigmoid(score[:, None] - cuts[None, :])  # P(grade above cut k)
        expected = grades[0] + above @ np.diff(grades)
        tail = above[:, rank - 1] if 0 < rank <= len(cuts) else np.full(len(texts), float(rank <= 0))
        return pd.DataFrame({"expected_grade": expected, "tail_probability": tail})

    return graded(text.cast("binary"))


def select(docs: DataFrame, model: Model, at_least: float = 0.5, wanted: float | None = None) -> DataFrame:
    """The documents whose tail probability is at least ``at_least``; columns as they are."""
    small_batches(docs.sparkSession)
    return docs.where(grade_column(F.col("text"), model, wanted)["tail_probability"] >= at_least)

"""Toxicity by multiple-instance learning: documents are labelled, sentences judged.

A sentence has the probability sigmoid(bias + sum of the weights of its distinct
words); a document is toxic unless none of its sentences is (noisy-or):
p = 1 - prod(1 - p_s).  Weights are learned from document labels through that
formula, so the blame settles on the words that toxic documents share, and the
fitted sentence scores locate the offending sentences.

Words and word beginnings are hashed to 32 bits; only those of ``MIN_DOCUMENTS``
or more fitting documents get a weight, so the model is bounded by the sample and
a rare word never inherits the weight of another.  The sample is bounded (``rows`` documents
of at most ``max_bytes``); scoring reads whole texts in one narrow pass.

Nulls and edge cases: a null or empty text, or one without any word, is one
sentence without words.  Null labels are ignored; of repeated labels the largest
counts.  Without labels of both kinds every score is the share of toxic labels
(0 without any).  Repeated rows stay; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlens.llm.common import fit_in_one_task, labelled_sample, small_batches

MIN_DOCUMENTS = 5
SAMPLE_ROWS = 8_192
SAMPLE_BYTES = 200_000
#: Lengths in bytes of the word beginnings that count; inflected forms share them.
STEMS = (4, 5, 6)
_CACHED_WORDS = 200_000
#: Letters and digits stay (lower case), sentence ends become line feeds, the rest blanks.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b >= 128 else 10 if b in b".!?\n\r" else 32
    for b in range(256)
)
_ENDS = re.compile(rb"[^.!?\n\r]+[.!?]*")


@dataclass(frozen=True)
class Model:
    """Weights by word hash."""

    bias: float
    weights: dict[int, float]

    def dumps(self) -> bytes:
        keys = np.array(list(self.weights), "<u4")
        return np.float64(self.bias).tobytes() + keys.tobytes() + np.array(list(self.weights.values()), "<f8").tobytes()

    @staticmethod
    def loads(data: bytes) -> Model:
        n = (len(data) - 8) // 12
        keys, values = np.frombuffer(data, "<u4", n, 8), np.frombuffer(data, "<f8", n, 8 + 4 * n)
        return Model(float(np.frombuffer(data, "<f8", 1)[0]), dict(zip(keys.tolist(), values.tolist(), strict=True)))



class Scorer:
    """Scores with a model; remembers the weights of some words."""

    def __init__(self, model: Model) -> None:
        self._bias, self._weights = model.bias, model.weights
        self._known: dict[bytes, float] = {}

    def _weight(self, word: bytes) -> float:
        if len(self._known) >= _CACHED_WORDS:
            self._known.clear()
        found = self._known[word] = sum(self._weights.get(h, 0.0) for h in word_hashes(word))
        return found

    def sentence_scores(self, sentences: list[bytes]) -> np.ndarray:
        """The sum of bias and weights of each sentence, before the sigmoid."""
        known, weight = self._known.get, self._weight
        sums = []
        for s in sentences:
            total = 0.0
            for word in set(s.split()):
                w = known(word)
                total += weight(word) if w is None else w
            sums.append(total)
        return np.array(sums, np.float64) + self._bias

    def score(self, text: bytes | None) -> float:
        """Probability that a document is toxic."""
        spared = np.logaddexp(0, self.sentence_scores(sentences(text))).sum()
        return float(-np.expm1(-spared))


def word_hashes(word: bytes) -> list[int]:
    """A word and its beginnings, 32 bits each."""
    return [zlib.crc32(word), *(zlib.crc32(b"^" + word[:k]) for k in STEMS if len(word) > k)]


def sentences(text: bytes | None) -> list[bytes]:
    """Cleaned sentences with words; one empty sentence if there is none."""
    return [s for s in (text or b"").translate(_TABLE).split(b"\n") if s.strip()] or [b""]


def fit(texts: list[bytes], toxic: np.ndarray, steps: int = 200, rate: float = 0.2, prior: float = 0.16) -> Model:
    """Most likely weights of the document labels under noisy-or, by Adam over the sample.

    ``prior`` is the precision that all weights have before any document is seen, so
    it weighs less the more documents there are.
    """
    share = float(np.mean(toxic)) if len(toxic) else 0.0
    if share in (0.0, 1.0):
        return Model(float(np.log((share + 1e-9) / (1 - share + 1e-9))), {})
    hashes, owner, lengths = array("I"), [], []
    for t in texts:
        split = [[h for w in set(s.split()) for h in word_hashes(w)] for s in sentences(t)]
        lengths.append(len(split))
        for words in split:
            owner.append(len(words))
            hashes.extend(words)
    decay = prior / len(texts)
    sentence = np.repeat(np.arange(len(owner)), owner)
    document = np.repeat(np.arange(len(texts)), lengths)
    words, place = np.unique(np.frombuffer(hashes, np.uint32), return_inverse=True)
    once = np.unique(document[sentence] * len(words) + place)
    common = np.bincount(once % len(words), minlength=len(words)) >= MIN_DOCUMENTS
    kept = common[place]
    number = np.cumsum(common) - 1
    place, sentence = number[place[kept]], sentence[kept]
    values = np.zeros(int(common.sum()) + 1)
    values[-1] = -np.log(np.mean(lengths) / share)
    mean, square = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, steps + 1):
        score = np.bincount(sentence, values[place], len(owner)) + values[-1]
        p = 0.5 * np.tanh(0.5 * score) + 0.5
        spared = np.bincount(document, np.logaddexp(0, score), len(texts))
        odds = np.exp(-spared) / -np.expm1(-np.maximum(spared, 1e-12))  # (1 - p) / p of the document
        blame = p * np.where(toxic > 0, -odds, 1.0)[document] / len(texts)
        slope = np.append(np.bincount(place, blame[sentence], len(values) - 1), blame.sum())
        slope[:-1] += decay * values[:-1]
        mean += 0.1 * (slope - mean)
        square += 0.01 * (slope * slope - square)
        values -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-5)
    return Model(float(values[-1]), dict(zip(words[common].tolist(), values[:-1].tolist(), strict=True)))


def train(docs: DataFrame, labels: DataFrame, toxic: Column, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on at most ``rows`` labelled documents of at most ``max_bytes`` each."""

    def run(sample: pa.Table | None) -> bytes:
        if sample is None:
            return fit([], np.zeros(0)).dumps()
        sample = sample.sort_by("_id")
        return fit(sample["text"].to_pylist(), sample["target"].to_numpy()).dumps()

    return Model.loads(fit_in_one_task(labelled_sample(docs, labels, toxic.cast("int"), rows, max_bytes), run))


def score_column(text: Column, model: Model) -> Column:
    """Probability that a document is toxic."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return scored(text.cast("binary"))


def offending_sentences(docs: DataFrame, model: Model, at_least: float = 0.5) -> DataFrame:
    """(doc_id, start, end, sentence, score): byte spans of the sentences at or over a score."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            rows = []
            for i, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                spans = [m.span() for m in _ENDS.finditer(text or b"")]
                scores = scorer.sentence_scores([text[a:b].translate(_TABLE) for a, b in spans])
                for (a, b), s in zip(spans, scores, strict=True):
                    p = float(0.5 * np.tanh(0.5 * s) + 0.5)
                    if p >= at_least:
                        rows.append((i, a, b, text[a:b].decode("utf-8", "replace").strip(), p))
            kinds = (batch["doc_id"].type, pa.int64(), pa.int64(), pa.string(), pa.float64())
            names = ("doc_id", "start", "end", "sentence", "score")
            columns = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names)
            )

    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(locate, f"doc_id {kind}, start bigint, end bigint, sentence string, score double")

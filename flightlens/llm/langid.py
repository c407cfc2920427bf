"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are read as UTF-8 bytes in windows of ``WINDOW`` bytes.  One recurrent
layer runs over a window from each side; every position gets a distribution over
the languages from both states; a document's distribution is the mean over all
positions of all its windows.  The network is trained in numpy by
backpropagation through time on windows of a bounded sample of labelled
documents; whole texts are scored in one narrow pass, many windows at a time.

Nulls and edge cases: a null text, or one without a letter, is ``und`` with
score 0.  Null languages teach nothing; of repeated labels of a document the
largest counts.  Without any labelled text every prediction is ``und`` with score
0; with a single language it is that language.  Ties go to the first language in
order.  Rows and columns stay as they are.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlens.llm.common import fit_in_one_task, labelled_sample, small_batches

WINDOW = 128
HIDDEN = 8
SAMPLE_ROWS = 4_096
SAMPLE_BYTES = 200_000
MOST_LANGUAGES = 256
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")
_AT_ONCE = 2_048

Weights = dict[str, np.ndarray]


def has_letters(text: str) -> bool:
    """Whether there is a letter: superscripts, fractions and circled digits are none."""
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def new_weights(languages: int, hidden: int = HIDDEN, seed: int = 11) -> Weights:
    """``inputs``: per direction and byte the input to update, reset and candidate; ``state``:
    the recurrent matrix; ``out``, ``bias``: from both states to languages."""
    rng = np.random.default_rng(seed)
    return {
        "inputs": rng.normal(0, 0.3, (2, 256, 3 * hidden)).astype("f4"),
        "state": rng.normal(0, 1 / np.sqrt(hidden), (2, hidden, 3 * hidden)).astype("f4"),
        "out": rng.normal(0, 0.3, (2 * hidden, languages)).astype("f4"),
        "bias": np.zeros(languages, "f4"),
    }


def _step(w: Weights, bytes_: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of both directions: bytes (2, n) and states (2, n, h)."""
    h = state.shape[2]
    given = np.stack([w["inputs"][0][bytes_[0]], w["inputs"][1][bytes_[1]]])
    kept = state @ w["state"]
    # sigmoid(x) = tanh(x / 2) / 2 + 1 / 2, for both gates at once
    gates = np.tanh((given[:, :, : 2 * h] + kept[:, :, : 2 * h]) * np.float32(0.5))
    gates = gates * np.float32(0.5) + np.float32(0.5)
    update, reset = gates[:, :, :h], gates[:, :, h:]
    candidate = np.tanh(given[:, :, 2 * h :] + reset * kept[:, :, 2 * h :])
    return candidate + update * (state - candidate), update, reset, candidate, kept[:, :, 2 * h :]


def states(w: Weights, windows: np.ndarray, trace: list | None = None) -> np.ndarray:
    """(steps, n, 2h): at each position the states of both directions. Windows: (n, steps) bytes."""
    n, steps = windows.shape
    h = w["state"].shape[1]
    by_step = np.ascontiguousarray(windows.T)
    out = np.empty((steps, n, 2 * h), "f4")
    state = np.zeros((2, n, h), "f4")
    for t in range(steps):
        seen = np.stack([by_step[t], by_step[steps - 1 - t]])
        before = state
        state, *inner = _step(w, seen, state)
        out[t, :, :h] = state[0]
        out[steps - 1 - t, :, h:] = state[1]
        if trace is not None:
            trace.append((seen, before, *inner))
    return out


def position_scores(w: Weights, windows: np.ndarray) -> np.ndarray:
    """(n, steps, languages): the distribution at every position."""
    return _softmax(states(w, windows) @ w["out"] + w["bias"]).transpose(1, 0, 2)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=-1, keepdims=True))
    return x / x.sum(axis=-1, keepdims=True)


def slopes(w: Weights, windows: np.ndarray, valid: np.ndarray, target: np.ndarray) -> tuple[float, Weights]:
    """Mean loss over valid positions and its slopes, by backpropagation through time."""
    trace: list = []
    top = states(w, windows, trace)
    steps, n, both = top.shape
    h = both // 2
    p = _softmax(top @ w["out"] + w["bias"])
    weight = (valid.T / max(1, valid.sum())).astype("f4")
    picked = np.take_along_axis(p, np.broadcast_to(target[None, :, None], (steps, n, 1)), 2)[:, :, 0]
    loss = float(-(np.log(np.maximum(picked, 1e-9)) * weight).sum())
    error = p * weight[:, :, None]
    np.put_along_axis(error, np.broadcast_to(target[None, :, None], (steps, n, 1)), (picked - 1)[:, :, None] * weight[:, :, None], 2)
    by_state = error @ w["out"].T
    grad = {
        "out": np.tensordot(top, error, ([0, 1], [0, 1])),
        "bias": error.sum((0, 1)),
        "state": np.zeros_like(w["state"]),
        "inputs": np.zeros_like(w["inputs"]),
    }
    back = np.zeros((2, n, h), "f4")
    turned = w["state"].transpose(0, 2, 1)
    for t in reversed(range(steps)):
        seen, before, update, reset, candidate, kept = trace[t]
        back = back + np.stack([by_state[t, :, :h], by_state[steps - 1 - t, :, h:]])
        d_candidate = back * (1 - update) * (1 - candidate * candidate)
        d_update = back * (before - candidate) * update * (1 - update)
        d_reset = d_candidate * kept * reset * (1 - reset)
        given = np.concatenate([d_update, d_reset, d_candidate], axis=2)
        inner = np.concatenate([d_update, d_reset, d_candidate * reset], axis=2)
        grad["state"] += before.transpose(0, 2, 1) @ inner
        for way in range(2):
            np.add.at(grad["inputs"][way], seen[way], given[way])
        back = back * update + inner @ turned
    return loss, grad


def cut_windows(text: bytes, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(windows, valid bytes per window) over a whole text; the last is filled with zero bytes."""
    rows = -(-len(text) // window)
    filled = np.zeros(rows * window, np.uint8)
    filled[: len(text)] = np.frombuffer(text, np.uint8)
    sizes = np.full(rows, window)
    if rows:
        sizes[-1] = len(text) - (rows - 1) * window
    return filled.reshape(rows, window), sizes


def fit(
    texts: list[bytes], languages: list[str], hidden: int = HIDDEN, steps: int = 300, batch: int = 256, rate: float = 0.01
) -> tuple[Weights, list[str]]:
    """Train on up to four windows of each text; deterministic for the same sample."""
    known = sorted(set(languages))
    if len(known) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    w = new_weights(max(1, len(known)), hidden)
    if len(known) < 2:
        return w, known
    rng = np.random.default_rng(5)
    rows, sizes, targets = [], [], []
    for text, language in zip(texts, languages, strict=True):
        windows, size = cut_windows(text)
        for i in rng.permutation(len(windows))[:4]:
            rows.append(windows[i])
            sizes.append(size[i])
            targets.append(known.index(language))
    if not rows:
        return w, known
    windows, target = np.stack(rows), np.array(targets)
    valid = np.arange(WINDOW)[None, :] < np.array(sizes)[:, None]
    by_language = [np.flatnonzero(target == k) for k in range(len(known))]
    by_language = [b for b in by_language if len(b)]
    mean = {k: np.zeros_like(v) for k, v in w.items()}
    square = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, steps + 1):
        # Half of a batch follows the sample, half has all languages alike.
        even = [rng.choice(b, max(1, batch // 2 // len(by_language))) for b in by_language]
        some = np.concatenate([rng.integers(0, len(target), batch // 2), *even])
        _, grad = slopes(w, windows[some], valid[some], target[some])
        size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        for k, g in grad.items():
            g = g * np.float32(min(1.0, 1.0 / (size + 1e-9)))
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.01 * (g * g - square[k])
            pace = rate * min(1.0, 2 - 2 * step / steps)
            w[k] -= (pace * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7)).astype("f4")
    return w, known


def dumps(w: Weights, languages: list[str]) -> bytes:
    out = io.BytesIO()
    np.savez(out, languages=np.array(languages, dtype="U"), **w)
    return out.getvalue()


class Identifier:
    """Distributions of whole texts with trained weights."""

    def __init__(self, model: bytes) -> None:
        with np.load(io.BytesIO(model)) as stored:
            self.languages = stored["languages"].tolist()
            self._w = {k: stored[k] for k in stored.files if k != "languages"}

    def document_scores(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages): the mean over all positions; zeros for an empty text."""
        total = np.zeros((len(texts), max(1, len(self.languages))))
        cut = [cut_windows(t) for t in texts]
        windows = np.concatenate([c[0] for c in cut]) if cut else np.zeros((0, WINDOW), np.uint8)
        sizes = np.concatenate([c[1] for c in cut]) if cut else np.zeros(0, int)
        owner = np.repeat(np.arange(len(texts)), [len(c[0]) for c in cut])
        for at in range(0, len(windows), _AT_ONCE):
            part = slice(at, at + _AT_ONCE)
            p = position_scores(self._w, windows[part])
            p *= (np.arange(WINDOW)[None, :] < sizes[part, None])[:, :, None]
            np.add.at(total, owner[part], p.sum(1))
        return total / np.maximum(1, [len(t) for t in texts])[:, None]

    def predict(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        """(language, its probability) per text."""
        has_letter = [bool(t) and has_letters(t.decode("utf-8", "replace")) for t in texts]
        pooled = self.document_scores([t if ok else b"" for t, ok in zip(texts, has_letter, strict=True)])
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        best = pooled.argmax(1)
        named = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, has_letter, strict=True)]
        return named, np.where(has_letter, np.minimum(1.0, pooled.max(1)), 0.0)

    def spans(self, text: bytes) -> list[tuple[int, int, str]]:
        """Runs of positions with the same label: (start, end, language) in bytes."""
        windows, _ = cut_windows(text)
        if not len(windows) or not self.languages:
            return []
        label = position_scores(self._w, windows).argmax(2).reshape(-1)[: len(text)]
        bounds = [0, *(np.flatnonzero(np.diff(label)) + 1).tolist(), len(text)]
        return [(a, b, self.languages[label[a]]) for a, b in zip(bounds, bounds[1:], strict=False)]


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES, steps: int = 300) -> bytes:
    """Fit on at most ``rows`` documents with a language, of at most ``max_bytes`` each."""

    def run(sample: pa.Table | None) -> bytes:
        if sample is None:
            return dumps(*fit([], []))
        sample = sample.sort_by("_id")
        return dumps(*fit(sample["text"].to_pylist(), sample["target"].to_pylist(), steps=steps))

    return fit_in_one_task(labelled_sample(docs, docs, F.col("lang"), rows, max_bytes), run)


def language_column(text: Column, model: bytes) -> Column:
    """Struct of lang_pred and score."""

    @F.pandas_udf("lang_pred string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        identifier = Identifier(model)
        for texts in batches:
            lang, score = identifier.predict(list(texts))
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    return predicted(text.cast("binary"))


def language_spans(docs: DataFrame, model: bytes) -> DataFrame:
    """(doc_id, start, end, lang): the labels of all positions, as runs in bytes."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(model)
        for batch in batches:
            for i, text in zip(batch["doc_id"], batch["text"].to_pylist(), strict=True):
                found = identifier.spans(text or b"")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i.as_py()] * len(found), batch["doc_id"].type),
                        pa.array([f[0] for f in found], pa.int64()),
                        pa.array([f[1] for f in found], pa.int64()),
                        pa.array([f[2] for f in found], pa.string()),
                    ],
                    names=["doc_id", "start", "end", "lang"],
                )

    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(label, f"doc_id {kind}, start bigint, end bigint, lang string")


def accept(docs: DataFrame, model: bytes, languages: list[str] | None = None, at_least: float = 0.0) -> DataFrame:
    """The documents in one of ``languages`` (by default any learned one) with a score of at least ``at_least``."""
    small_batches(docs.sparkSession)
    found = language_column(F.col("text"), model)
    wanted = languages if languages is not None else Identifier(model).languages
    return docs.where(found["lang_pred"].isin(wanted) & (found["score"] >= at_least)) if wanted else docs.limit(0)

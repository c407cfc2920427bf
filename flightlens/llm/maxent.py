"""A hashed maximum-entropy language model with class-factored softmax.

P(token | before) = P(class | before) * P(token | class).  The class softmax is a
maximum-entropy model of hashed features of the tokens before: the last token,
the last two together, and the tokens two, three and four places back (skips).
Within a class a softmax over biases gives the smoothed share of each token.

1. Tokens are counted over all training texts (pre-aggregated per task).
2. The ``HEAD`` most frequent tokens, a bounded table, get classes: the most
   frequent ones a class each, the others by their spelling; all remaining
   tokens, unseen ones included, share one class.
3. ``ROUNDS`` rounds train the class softmax.  In each every task takes gradient
   steps over its part of that round's share of the texts, and the changes are
   averaged, feature by feature, weighted by how often a task met the feature.
   Every training text is used in one round.
4. Texts are scored in numpy batches.  Tokens outside the head get their counts
   by a join; none of them is frequent, so no key of that join is hot.

The unigram base, log10((c + SMOOTH) / (N + SMOOTH (V + 1))), is computed beside it.

Nulls and edge cases: a null or empty text is its end token alone.  Rows with
``train`` null or false are scored, not learned from.  Repeated rows count each.
Without training texts counts are zero and the model is uniform.  Columns other
than doc_id, text and the given condition are not read; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlens.llm.common import small_batches, work_table

END = b""
SMOOTH = 0.1
HEAD = 1 << 17
OWN_CLASS = 8
CLASSES = 32
TAIL_CLASS = CLASSES - 1
TAIL_IDS = 1 << 12
ROWS = 1 << 13
ROUNDS = 3
REACH = 4
_FEATURES = 5
_BLOCK_ROWS = 256
_STEP = 8_192
_FLUSH = 200_000


def words(text: bytes | None) -> list[bytes]:
    """ASCII lower-case words, then the end token."""
    found = (text or b"").lower().split()
    found.append(END)
    return found


@dataclass
class Head:
    """The frequent tokens: place, class and share within the class of each."""

    place: dict[bytes, int]
    kind: np.ndarray
    log_share: np.ndarray
    log_base: np.ndarray
    tokens: int
    distinct: int
    tail_total: float

    @property
    def log_total(self) -> float:
        return float(np.log10(self.tokens + SMOOTH * (self.distinct + 1)))


def spelling_classes(tokens: list[bytes], counts: np.ndarray) -> np.ndarray:
    """A class per token, most frequent first: own classes, then k-means on letter trigrams."""
    kind = np.full(len(tokens), OWN_CLASS)
    own = min(OWN_CLASS, len(tokens))
    kind[:own] = np.arange(own)
    rest = tokens[own:]
    if not rest:
        return kind
    x = np.zeros((len(rest), 256), np.float32)
    for i, token in enumerate(rest):
        marked = b"^" + token + b"$"
        for n in (1, 2, 3):
            for at in range(len(marked) - n + 1):
                x[i, zlib.crc32(marked[at : at + n]) & 255] += 1.0
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    weight = np.sqrt(counts[own:]).astype(np.float32)
    groups = min(TAIL_CLASS - OWN_CLASS, len(rest))
    centres = x[np.linspace(0, len(rest) - 1, groups).astype(int)]
    for _ in range(12):
        near = (x @ centres.T).argmax(1)
        for g in range(groups):
            mine = near == g
            if mine.any():
                mean = weight[mine] @ x[mine]
                centres[g] = mean / max(1e-9, float(np.linalg.norm(mean)))
    kind[own:] = OWN_CLASS + near
    return kind


def count_tokens(texts: DataFrame) -> DataFrame:
    """(token, n) over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def flushed() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pydict(
                {"token": pa.array(found.keys(), pa.binary()), "n": pa.array(found.values(), pa.int64())}
            )
            found.clear()
            return made

        for batch in batches:
            for text in batch["text"].to_pylist():
                found.update(words(text))
            if len(found) > _FLUSH:
                yield flushed()
        yield flushed()

    made = texts.select("text").mapInArrow(count, "token binary, n bigint")
    return work_table(made.groupBy("token").agg(F.sum("n").alias("n")), "maxent-counts")


def head_of(counts: DataFrame, size: int = HEAD) -> Head:
    """The bounded table of frequent tokens with their classes."""
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = counts.orderBy(F.desc("n"), "token").limit(size).toArrow()
    tokens = [bytes(t) for t in top["token"].to_pylist()]
    n = top["n"].to_numpy().astype(np.float64)
    kind = spelling_classes(tokens, n)
    mass = np.bincount(kind, n + SMOOTH, CLASSES) if len(n) else np.zeros(CLASSES)
    tail_total = totals["n"] - n.sum() + SMOOTH * (totals["v"] - len(n) + 1)
    log = np.log10(n + SMOOTH)
    return Head(
        dict(zip(tokens, range(len(tokens)), strict=True)), kind, log - np.log10(mass[kind]), log,
        int(totals["n"]), int(totals["v"]), float(tail_total),
    )


def token_ids(tokens: list[bytes], place: dict[bytes, int]) -> np.ndarray:
    """Places in the head; other tokens share ``TAIL_IDS`` numbers after it by hash."""
    size, crc = len(place), zlib.crc32
    get = place.get
    return np.array([i if (i := get(t)) is not None else size + crc(t) % TAIL_IDS for t in tokens], np.int64)


def feature_rows(ids: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """(features, targets) rows of the weights; ``ids`` has REACH fill numbers before each text."""
    before = [ids[targets - d].astype(np.uint64) for d in range(1, REACH + 1)]
    keys = [before[0], before[0] * np.uint64(1_000_003) + before[1], *before[1:]]
    rows = np.empty((_FEATURES, len(targets)), np.int64)
    for f, key in enumerate(keys):
        mixed = (key + np.uint64(f + 1)) * np.uint64(0x9E3779B97F4A7C15)
        rows[f] = (mixed >> np.uint64(64 - 13)).astype(np.int64) + f * ROWS
    return rows


def joined(texts: list[np.ndarray], fill: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array with REACH fill numbers before each, and the places of their tokens."""
    pad = np.full(REACH, fill)
    ids = np.concatenate([part for text in texts for part in (pad, text)])
    inside = np.ones(len(ids), bool)
    at = 0
    for text in texts:
        inside[at : at + REACH] = False
        at += REACH + len(text)
    return ids, np.flatnonzero(inside)


def class_scores(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(targets, classes) sums of the weights of all features, largest 0."""
    score = weights[rows[0]]
    for row in rows[1:]:
        score += weights.take(row, axis=0)
    score += weights[-1]
    score -= score.max(1, keepdims=True)
    return score


def local_steps(weights: np.ndarray, texts: Iterator[np.ndarray], kinds: np.ndarray, fill: int, rate: float) -> np.ndarray:
    """Gradient steps over texts, changing ``weights``; returns how often each row was met."""
    met = np.zeros(len(weights), np.float32)
    square = np.full(weights.shape, 1.0, np.float32)
    held: list[np.ndarray] = []

    def steps() -> None:
        ids, targets = joined(held, fill)
        for at in range(0, len(targets), _STEP):
            some = targets[at : at + _STEP]
            rows = feature_rows(ids, some)
            slope = class_scores(weights, rows)
            np.exp(slope, out=slope)
            slope /= slope.sum(1, keepdims=True)
            slope[np.arange(len(some)), kinds[ids[some]]] -= 1.0
            for f, row in enumerate(rows):
                order = np.argsort((row - f * ROWS).astype(np.uint16), kind="stable")
                sorted_ = row[order]
                first = np.flatnonzero(np.diff(sorted_, prepend=-1))
                used = sorted_[first]
                total = np.add.reduceat(slope.take(order, axis=0), first, axis=0)
                seen = square[used] + total * total
                square[used] = seen
                np.sqrt(seen, out=seen)
                total *= rate
                total /= seen
                weights[used] -= total
                met[used] += np.diff(np.append(first, len(row)))
            total = slope.sum(0)
            square[-1] += total * total
            weights[-1] -= rate * total / np.sqrt(square[-1])
            met[-1] += len(some)

    size = 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= 8 * _STEP:
            steps()
            held, size = [], 0
    if held:
        steps()
    return met


def token_kinds(head: Head) -> np.ndarray:
    """The class of every token number."""
    return np.concatenate([head.kind, np.full(TAIL_IDS + 1, TAIL_CLASS)])


def train_round(texts: DataFrame, head: Head, weights: np.ndarray, rate: float = 0.3) -> np.ndarray:
    """One round over ``texts``: local gradient steps, then a weighted mean of their changes."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((head.place, token_kinds(head), weights))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, kinds, start = shared.value
        own = start.copy()
        fill = len(place) + TAIL_IDS
        ids = (token_ids(words(t), place) for b in batches for t in b["text"].to_pylist())
        met = local_steps(own, ids, kinds, fill, rate)
        change = (own - start) * met[:, None]
        cuts = [c for c in range(0, len(own), _BLOCK_ROWS) if met[c : c + _BLOCK_ROWS].any()]
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array(cuts, pa.int64()),
                "change": pa.array([change[c : c + _BLOCK_ROWS].tobytes() for c in cuts], pa.binary()),
                "met": pa.array([met[c : c + _BLOCK_ROWS].tobytes() for c in cuts], pa.binary()),
            }
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for block, change, met in zip(*(batch[c].to_pylist() for c in ("block", "change", "met")), strict=True):
                parts = [np.frombuffer(change, np.float32).astype(np.float64), np.frombuffer(met, np.float32).astype(np.float64)]
                if block in totals:
                    totals[block] = [a + b for a, b in zip(totals[block], parts, strict=True)]
                else:
                    totals[block] = parts
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array(totals.keys(), pa.int64()),
                "change": pa.array([v[0].tobytes() for v in totals.values()], pa.binary()),
                "met": pa.array([v[1].tobytes() for v in totals.values()], pa.binary()),
            }
        )

    schema = "block bigint, change binary, met binary"
    summed = texts.select("text").mapInArrow(local, schema).repartition("block").mapInArrow(add, schema)
    moved = weights.copy()
    for row in summed.toLocalIterator():
        met = np.frombuffer(row["met"])
        change = np.frombuffer(row["change"]).reshape(len(met), -1) / np.maximum(met, 1.0)[:, None]
        moved[row["block"] : row["block"] + len(met)] += change.astype(np.float32)
    return moved


def score_texts(texts: list[bytes], head: Head, weights: np.ndarray) -> Iterator[tuple[int, int, float, float, list[bytes]]]:
    """Per text: tokens, tokens of the head, its log10 base and model sums without the tail's
    counts, and the tokens of the tail."""
    kinds, size = token_kinds(head), len(head.place)
    fill = size + TAIL_IDS
    told = [words(t) for t in texts]
    numbers = [token_ids(w, head.place) for w in told]
    ids, targets = joined(numbers, fill)
    model = np.empty(len(targets))
    for at in range(0, len(targets), _STEP):
        some = targets[at : at + _STEP]
        found = class_scores(weights, feature_rows(ids, some))
        chosen = found[np.arange(len(some)), kinds[ids[some]]]
        model[at : at + _STEP] = chosen - np.log(np.exp(found, out=found).sum(1))
    model /= np.log(10)
    at = 0
    for listed, number in zip(told, numbers, strict=True):
        mine = model[at : at + len(number)]
        at += len(number)
        inside = number < size
        known = number[inside]
        outside = len(number) - len(known)
        base = float(head.log_base[known].sum()) - len(number) * head.log_total
        score = float(mine.sum() + head.log_share[known].sum()) - outside * float(np.log10(head.tail_total))
        tail = [t for t, here in zip(listed, inside, strict=True) if not here] if outside else []
        yield len(number), len(known), base, score, tail


def score(docs: DataFrame, train: Column, rounds: int = ROUNDS, head_size: int = HEAD) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score), one row per document."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    learned = texts.where("train")
    counts = count_tokens(learned)
    head = head_of(counts, head_size)
    weights = np.zeros((_FEATURES * ROWS + 1, CLASSES), np.float32)
    # Which round a text serves in depends on its content alone.
    turn = F.pmod(F.xxhash64(F.coalesce("text", F.lit(b"")), "doc_id"), F.lit(rounds))
    for at in range(rounds):
        weights = train_round(learned.where(turn == at), head, weights)
    shared = spark.sparkContext.broadcast((head, weights))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, weights = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = zip(*score_texts(batch["text"].to_pylist(), head, weights), strict=True)
            types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["train"], *(pa.array(c, t) for c, t in zip(rows, types, strict=True))],
                names=["doc_id", "train", "n_tokens", "n_known", "base_score", "score", "tail"],
            )

    schema = f"doc_id {kind}, train boolean, n_tokens bigint, n_known bigint, base_score double, score double, tail array<binary>"
    # The number is written with its row: two scans of the table may be split in different ways.
    made = texts.mapInArrow(scored, schema).withColumn("_row", F.monotonically_increasing_id())
    made = work_table(made, "maxent-scores")
    found = made.select("_row", F.explode("tail").alias("token")).join(counts, "token", "left")
    added = found.groupBy("_row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTH))).alias("_log"), F.count("n").alias("_known")
    )
    log, known = F.coalesce("_log", F.lit(0.0)), F.coalesce("_known", F.lit(0))
    return made.join(added, "_row", "left").select(
        "doc_id", "train", "n_tokens", (F.col("n_known") + known).alias("n_known"),
        F.lit(head.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base_score") + log).alias("base_score"), (F.col("score") + log).alias("score"),
    )

"""Packing into training windows by lexical retrieval.

1. Texts are encoded once; every document ends with ``END``.  Whole windows of a
   long document are sequences of their own; what is left of it is a piece.
2. Document frequencies of the pieces' terms (token ids) and their mean length
   are counted over all pieces; the vocabulary bounds the table.
3. Pieces are ordered by their two most telling terms and dealt out by range, so
   related pieces stand together and a term that many share is spread.  Each
   stretch of ``SHARD_ROWS`` pieces is a shard with its own BM25 inverted index.
4. In a shard the longest unused piece is a seed.  The index returns its unused
   neighbours; the best that fits is taken, and if none of the first ones fits
   the best is cut, which fills the window.  What a shard cannot fill goes on to
   the next shard of the task, so at most one window per task has padding.

Nulls and edge cases: a null or empty text is one piece holding ``END`` only;
repeated rows are packed each; a null ``doc_id`` is kept.  Columns other than
doc_id and text are not read.  An empty table gives an empty result.  Every id of
every document lies in exactly one piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlens.llm.bpe import Codec
from flightlens.llm.common import small_batches, work_table

WINDOW = 1024
END = 0
SHARD_ROWS = 1_024
FIRST = 16
K1, B = 1.2, 0.75


def pieces(docs: DataFrame, vocabulary: str, pattern: str, window: int = WINDOW) -> DataFrame:
    """(row, doc_id, start, length, doc_tokens, ids16): documents in order, cut at whole windows.

    ``ids16`` has 16 bits per id, or 32 for a vocabulary that needs them.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary, pattern)
        wide = _wide(len(codec.lengths))
        for batch in batches:
            rows = []
            for place, text in enumerate(batch["text"].to_pylist()):
                ids = np.array([*codec.encode(text), END], wide)
                for start in range(0, len(ids), window):
                    part = ids[start : start + window]
                    rows.append((place, start, len(part), len(ids), part.tobytes()))
            place, start, length, tokens, data = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(place, pa.int64())),
                    *(pa.array(c, pa.int64()) for c in (start, length, tokens)),
                    pa.array(data, pa.binary()),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "ids16"],
            )

    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    schema = f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, ids16 binary"
    made = texts.mapInArrow(cut, schema)
    return work_table(made.select(F.monotonically_increasing_id().alias("row"), "*"), "packing-pieces")


def _wide(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def idf_table(rest: DataFrame, vocabulary: int) -> tuple[np.ndarray, float]:
    """BM25 weights of all terms and the mean length, over all pieces that are packed."""
    wide = _wide(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows, tokens = np.zeros(vocabulary, np.int64), 0, 0
        for batch in batches:
            for data in batch["ids16"].to_pylist():
                ids = np.frombuffer(data, wide)
                found[ids] += 1  # once for an id that repeats: numpy does not add up equal places
                rows, tokens = rows + 1, tokens + len(ids)
        term = np.flatnonzero(found)
        term, n = np.concatenate((term, [-1, -2])), np.concatenate((found[term], [rows, tokens]))
        yield pa.RecordBatch.from_pydict({"term": term, "n": n})

    counted = rest.select("ids16").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    table = counted.toPandas()
    known = dict(zip(table["term"].tolist(), table["n"].tolist(), strict=True))
    rows, tokens = known.pop(-1, 0), known.pop(-2, 0)
    df = np.zeros(vocabulary)
    df[list(known)] = list(known.values())
    return np.log1p((rows - df + 0.5) / (df + 0.5)).astype(np.float32), tokens / max(1, rows)


class Shard:
    """BM25 inverted index over the pieces of a shard.

    Each term that two or more pieces share has a list with its weight in every
    piece; the lists are rows of one matrix, so a query adds up rows.  A term of
    one piece only can lead to no neighbour and has no list.
    """

    def __init__(self, ids: list[np.ndarray], idf: np.ndarray, mean: float) -> None:
        counted = [np.unique(piece, return_counts=True) for piece in ids]
        sizes = [len(term) for term, _ in counted]
        term, tf = (np.concatenate(c) for c in zip(*counted, strict=True))
        place = np.repeat(np.arange(len(ids)), sizes)
        known, row, shared = np.unique(term, return_inverse=True, return_counts=True)
        length = np.array([len(p) for p in ids], np.float32)[place]
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
        kept = shared >= 2
        number = np.cumsum(kept) - 1
        met = kept[row]
        self._lists = np.zeros((int(kept.sum()), len(ids)), np.float32)
        self._lists[number[row[met]], place[met]] = weight[met]
        ends = np.cumsum(np.bincount(place[met], minlength=len(ids)))[:-1]
        self._rows = np.split(number[row[met]], ends)

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every other piece for the terms of one of them."""
        return self._lists.take(self._rows[seed], axis=0).sum(axis=0)


def fill_windows(
    ids: list[np.ndarray], idf: np.ndarray, mean: float, window: int, last: bool
) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Windows as lists of (piece, from, to), and the parts that are left for the next shard."""
    shard = Shard(ids, idf, mean)
    sizes = np.array([len(p) for p in ids])
    begin = np.zeros(len(ids), np.int64)  # what is used of a piece stands before this place
    unused = np.ones(len(ids), bool)
    order = np.lexsort((np.arange(len(ids)), -sizes))
    windows = []
    for seed in order:
        if not unused[seed]:
            continue
        unused[seed] = False
        parts, free = [(int(seed), int(begin[seed]), int(sizes[seed]))], window - int(sizes[seed] - begin[seed])
        score = shard.scores(seed) if free else None
        while free and unused.any():
            score[~unused] = -1.0
            most = min(FIRST, int(unused.sum()))
            near = np.argpartition(-score, most - 1)[:most]
            near = near[np.lexsort((near, -score[near]))]
            left = sizes[near] - begin[near]
            fits = np.flatnonzero(left <= free)
            one = int(near[fits[0]] if len(fits) else near[0])
            take = min(free, int(sizes[one] - begin[one]))
            parts.append((one, int(begin[one]), int(begin[one]) + take))
            begin[one] += take
            unused[one] = begin[one] < sizes[one]
            free -= take
        if free and not last:
            return windows, parts
        windows.append(parts)
    return windows, []


def pack(docs: DataFrame, vocabulary: str, pattern: str, window: int = WINDOW, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids) per piece.

    ``ids`` are little-endian unsigned 32-bit numbers.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    known = len(Codec(vocabulary, pattern).lengths)
    wide = _wide(known)
    cut = pieces(docs, vocabulary, pattern, window)
    rest = cut.where(F.col("length") < window)
    idf, mean = idf_table(rest, known)
    shared = spark.sparkContext.broadcast(idf)

    @F.pandas_udf("one int, two int")
    def telling(values: pd.Series) -> pd.DataFrame:
        idf, found = shared.value, np.zeros((len(values), 2), np.int32)
        for i, data in enumerate(values):
            term, n = np.unique(np.frombuffer(data, wide), return_counts=True)
            weight = n * idf[term]
            for place in range(min(2, len(term))):
                best = weight.argmax()
                found[i, place], weight[best] = term[best], -np.inf
        return pd.DataFrame(found, columns=["one", "two"])

    shards = max(1, -(-rest.count() // shard_rows))
    # Written once: dealing by range reads its keys twice, for the ranges and for the rows.
    keyed = work_table(rest.withColumn("_key", telling("ids16")), "packing-keys")
    order = [F.col("_key.one"), F.col("_key.two"), F.col("row")]
    dealt = keyed.repartitionByRange(shards, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, number = shared.value, TaskContext.get().partitionId() << 32
        carried: list[tuple] = []
        held: list[tuple] = []

        def filled(rows: list[tuple], last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number, carried
            ids = [np.frombuffer(r[3], wide) for r in rows]
            windows, left = fill_windows(ids, idf, mean, window, last)
            carried = [(rows[i][0], rows[i][1] + a, rows[i][2], ids[i][a:b].tobytes()) for i, a, b in left]
            out = []
            for parts in windows:
                offset = 0
                for i, a, b in parts:
                    data = ids[i][a:b].astype("<u4").tobytes()
                    out.append((rows[i][0], rows[i][1] + a, b - a, rows[i][2], 2 * number + 1, offset, data))
                    offset += b - a
                number += 1
            columns = zip(*out, strict=True) if out else [()] * 7
            types = (doc_type, *[pa.int64()] * 5, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        doc_type = None
        for batch in batches:
            doc_type = batch["doc_id"].type
            held += zip(*(batch[c].to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids16")), strict=True)
            while len(held) >= shard_rows:
                now, held = [*carried, *held[:shard_rows]], held[shard_rows:]
                yield from filled(now, last=False)
        if carried or held:
            yield from filled([*carried, *held], last=True)

    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    schema = f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    packed = dealt.select("doc_id", "start", "doc_tokens", "ids16").mapInArrow(run, schema)
    whole = cut.where(F.col("length") == window).select(
        "doc_id", "start", "length", "doc_tokens", (2 * F.col("row")).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"), _widened(F.col("ids16"), wide).alias("ids"),
    )
    return whole.unionByName(packed)


def _widened(ids: Column, wide: str) -> Column:
    @F.pandas_udf("binary")
    def widen(values: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(v, wide).astype("<u4").tobytes() for v in values], dtype=object)

    return widen(ids)

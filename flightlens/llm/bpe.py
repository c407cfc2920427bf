"""Byte-pair encoding and decoding with reuse of content-defined chunks.

A rolling hash cuts every text where its content says so, so passages that
documents share give the same chunks wherever they stand.

1. One pass counts chunk hashes into a sketch of fixed size (one bit per slot:
   "seen more than once").
2. Chunks the sketch marks are reduced to one row each (128-bit hash) and
   encoded once, into a table in the shared folder.
3. Texts without a marked chunk are encoded where they are read.  Distinct texts
   with marked chunks meet the ids of those chunks, encode only the rest, and
   mend every join: the text around it is encoded again, from a place before it
   to a place behind it at which the pieces of the pre-tokenizer must end in any
   context, until both ends agree with token ends of the chunks.

The sketch never decides a result: a slot shared by accident, or a full sketch,
sends more chunks through step 2, and the ids are the same.

Nulls and edge cases: a null text is empty (no ids); a null ``doc_id`` is kept;
repeated rows stay, each with its ids; texts of any length are encoded whole.
Columns other than doc_id and text are not read.  An empty table gives an empty
result.  Special tokens that stand in a text are encoded as such, as the
vocabulary file asks.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlens.llm.common import small_batches, work_table

WINDOW = 32
MEAN_CHUNK = 1024
LONGEST_CHUNK = 16 * 1024
SKETCH_BITS = 26
_BLOCK = 1 << 20
_HARD_END = re.compile(rb"[!-~](?=[ \n])")


class Codec:
    """Encoder and decoder of a byte-level BPE vocabulary file (JSON).

    The file's vocabulary is used as merge ranks, which gives the same ids; the
    tests compare both over all tokens and all code points.
    """

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        splitter = spec["pre_tokenizer"]
        if splitter["type"] != "ByteLevel" or splitter["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("only byte-level vocabularies without prefix space or normalizer")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(re.search(r"\s", t) for t in special):
            raise ValueError("special tokens with white space are not supported")
        of_char = _byte_of_char()
        ranks = {
            bytes(of_char[c] for c in token): rank
            for token, rank in spec["model"]["vocab"].items()
            if token not in special
        }
        self._encoding = tiktoken.Encoding(
            "file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special
        )
        size = max([*ranks.values(), *special.values()]) + 1
        self.lengths = [0] * size
        for token, rank in [*ranks.items(), *((t.encode(), i) for t, i in special.items())]:
            self.lengths[rank] = len(token)
        self._special = special

    def encode(self, data: bytes) -> list[int]:
        text = data.decode("utf-8", "replace")
        if not self._special:
            return self._encoding.encode_ordinary(text)
        return self._encoding.encode(text, allowed_special="all")

    def decode(self, ids: list[int]) -> bytes:
        return self._encoding.decode_bytes(ids)


def _byte_of_char() -> dict[str, int]:
    """Printable stand-ins of bytes in byte-level vocabulary files."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def public_vocabulary() -> tuple[str, str]:
    """(file, splitting pattern) of the installed 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """Polynomial hash of the last ``WINDOW`` bytes at each place, by doubling."""
    factor, span = 0x9E3779B1, 1
    hashes = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(0x85EBCA6B)
    while span < WINDOW:
        longer = hashes.copy()
        longer[span:] += hashes[:-span] * np.uint32(factor)
        hashes, factor, span = longer, factor * factor % 2**32, 2 * span
    return hashes


def cut_points(text: bytes) -> list[int]:
    """Where chunks start, 0 first; always at the start of a character."""
    size = len(text)
    if size <= WINDOW:
        return [0]
    data = np.frombuffer(text, np.uint8)
    found = []
    limit = np.uint32(2**32 // MEAN_CHUNK)
    for at in range(0, size, _BLOCK):
        first = max(0, at - WINDOW + 1)
        block = data[first : at + _BLOCK]
        mixed = rolling_hash(block) * np.uint32(0xC2B2AE35)
        ends = np.flatnonzero(mixed < limit) + first
        found.append(ends[ends >= max(at, WINDOW - 1)] + 1)
    cuts = np.concatenate(found)
    cuts = cuts[cuts < size]
    cuts = cuts[(data[cuts] & 0xC0) != 0x80].tolist()
    bounds, last = [0], 0
    for cut in [*cuts, size]:
        while cut - last > LONGEST_CHUNK:
            last += LONGEST_CHUNK
            while last < cut and text[last] & 0xC0 == 0x80:
                last += 1
            if last < cut:
                bounds.append(last)
        if cut < size and cut > last:
            bounds.append(cut)
            last = cut
    return bounds


def chunks(text: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(128-bit hash, chunk) over a whole text."""
    starts = cut_points(text)
    for a, b in zip(starts, [*starts[1:], len(text)], strict=True):
        yield xxhash.xxh128_digest(text[a:b]), text[a:b]


def _slot(digest: bytes, bits: int) -> int:
    return int.from_bytes(digest[:8], "little") >> (64 - bits)


def _boundary_before(text: bytes, end: int) -> int:
    """Last place before ``end`` where a piece ends in any context, or 0."""
    while (at := max(text.rfind(b" ", 1, end), text.rfind(b"\n", 1, end))) > 0:
        if 0x21 <= text[at - 1] <= 0x7E:
            return at
        end = at
    return 0


def _boundary_after(text: bytes, start: int, end: int) -> int:
    """First such place in text[start:end] with both its sides inside, or ``end``."""
    hit = _HARD_END.search(text, start, end)
    return hit.end() if hit else end


def _tokens_up_to(ids: list[int], lengths: list[int], size: int) -> int | None:
    """How many ids cover exactly ``size`` bytes from the front."""
    k = 0
    while size > 0 and k < len(ids):
        size -= lengths[ids[k]]
        k += 1
    return k if size == 0 else None


def _tokens_back_to(ids: list[int], lengths: list[int], size: int) -> int | None:
    """How many ids are left when exactly ``size`` bytes are cut off the end."""
    k = len(ids)
    while size > 0 and k:
        k -= 1
        size -= lengths[ids[k]]
    return k if size == 0 else None


def append_chunk(
    codec: Codec, text: bytes, ids: list[int], start: int, end: int, more: list[int]
) -> None:
    """Turn the ids of text[:start] into those of text[:end], with those of text[start:end].

    The window around the join grows on either side until its first and last
    bytes are token ends of what is known.  Only the ids from the window on are
    touched, so a text takes time in proportion to its length.
    """
    left, right = _boundary_before(text, start), _boundary_after(text, start, end)
    while True:
        keep = _tokens_back_to(ids, codec.lengths, start - left)
        skip = _tokens_up_to(more, codec.lengths, right - start)
        if keep is not None and skip is not None:
            del ids[keep:]
            ids.extend(codec.encode(text[left:right]))
            ids.extend(more[skip:])
            return
        if keep is None:
            left = _boundary_before(text, left)
        if skip is None:
            right = _boundary_after(text, right, end)


def encode_from_chunks(codec: Codec, text: bytes, known: dict[bytes, list[int]]) -> list[int]:
    """The ids of a text of which some chunks are encoded already."""
    parts: list[list] = []
    at = 0
    for digest, chunk in chunks(text):
        ids = known.get(digest)
        if ids is None and parts and parts[-1][2] is None:
            parts[-1][1] += len(chunk)
        else:
            parts.append([at, at + len(chunk), ids])
        at += len(chunk)
    out: list[int] = []
    for start, end, ids in parts:
        ids = codec.encode(text[start:end]) if ids is None else ids
        if start:
            append_chunk(codec, text, out, start, end, ids)
        else:
            out = list(ids)
    return out


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")
    )


def repeated_slots(docs: DataFrame, bits: int = SKETCH_BITS) -> np.ndarray:
    """2**bits bits: 1 where chunks fell more than once over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = [_slot(d, bits) for t in batch["text"].to_pylist() for d, _ in chunks(t)]
            slot, n = np.unique(np.array(slots, np.int64), return_counts=True)
            yield pa.RecordBatch.from_pydict({"slot": slot, "n": n.astype(np.int64)})

    counted = _texts(docs).select("text").mapInArrow(count, "slot bigint, n bigint")
    repeated = counted.groupBy("slot").agg(F.sum("n").alias("n")).where("n > 1")
    words = repeated.groupBy(F.expr("slot div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits")
    )
    found = words.toArrow()
    sketch = np.zeros(max(1, 2**bits // 64), np.uint64)
    at = found["word"].to_numpy()
    sketch[at] = found["bits"].to_numpy().view(np.uint64)
    return sketch


def _marked(sketch: np.ndarray, digest: bytes, bits: int) -> bool:
    slot = _slot(digest, bits)
    return bool(int(sketch[slot >> 6]) >> (slot & 63) & 1)


def encode(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    sketch_bits: int = SKETCH_BITS,
) -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit numbers, one row per input row."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = _texts(docs)
    shared = spark.sparkContext.broadcast(repeated_slots(docs, sketch_bits))

    def marked_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        for batch in batches:
            found = {
                d: c for t in batch["text"].to_pylist() for d, c in chunks(t)
                if _marked(sketch, d, sketch_bits)
            }
            yield pa.RecordBatch.from_pydict(
                {"hash": pa.array(found.keys(), pa.binary()), "chunk": pa.array(found.values(), pa.binary())}
            )

    def encode_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(vocabulary, pattern)
        for batch in batches:
            ids = [np.array(codec.encode(c), "<u4").tobytes() for c in batch["chunk"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"hash": batch["hash"], "ids": pa.array(ids, pa.binary())})

    once = texts.select("text").mapInArrow(marked_chunks, "hash binary, chunk binary")
    encoded = work_table(
        once.dropDuplicates(["hash"]).mapInArrow(encode_chunks, "hash binary, ids binary"), "bpe-chunks"
    )

    def in_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, codec = shared.value, Codec(vocabulary, pattern)
        for batch in batches:
            rows = [
                (i, np.array(codec.encode(t), "<u4").tobytes())
                for i, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True)
                if not any(_marked(sketch, d, sketch_bits) for d, _ in chunks(t))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], batch["doc_id"].type), pa.array([r[1] for r in rows], pa.binary())],
                names=["doc_id", "ids"],
            )

    def with_marked(column: str):
        """Rows of the texts with marked chunks: their ids, themselves once, or their chunks."""

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sketch = shared.value
            for batch in batches:
                keys, values, seen = [], [], set()
                for i, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                    key = xxhash.xxh128_digest(t)
                    if key in seen and column != "doc_id":
                        continue
                    marked = {d for d, _ in chunks(t) if _marked(sketch, d, sketch_bits)}
                    if not marked:
                        continue
                    seen.add(key)
                    here = {"doc_id": [i], "text": [t], "hash": marked}[column]
                    keys += [key] * len(here)
                    values += here
                kind = batch["doc_id"].type if column == "doc_id" else pa.binary()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(values, kind)], names=["key", column]
                )

        kind = docs.schema["doc_id"].dataType.simpleString() if column == "doc_id" else "binary"
        return texts.mapInArrow(rows, f"key binary, {column} {kind}")

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, last, ids = Codec(vocabulary, pattern), None, b""
        for batch in batches:
            made = []
            columns = [batch[c].to_pylist() for c in ("key", "text", "known")]
            for key, text, known in zip(*columns, strict=True):
                if key != last:  # rows of a text stand together
                    have = {k["hash"]: np.frombuffer(k["ids"], "<u4").tolist() for k in known}
                    last, ids = key, np.array(encode_from_chunks(codec, text, have), "<u4").tobytes()
                made.append(ids)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(made, pa.binary())], names=["doc_id", "ids"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary"
    known = (
        with_marked("hash")
        .distinct()
        .join(encoded, "hash")
        .groupBy("key")
        .agg(F.collect_list(F.struct("hash", "ids")).alias("known"))
    )
    once_each = with_marked("text").dropDuplicates(["key"])
    joined = with_marked("doc_id").join(once_each, "key").join(known, "key")
    return texts.mapInArrow(in_place, schema).unionByName(joined.mapInArrow(assemble, schema))


def decode_column(ids: Column, vocabulary: str, pattern: str) -> Column:
    """The bytes that ids (little-endian unsigned 32-bit) stand for; null for null."""
    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(vocabulary, pattern)
        for values in batches:
            yield pd.Series(
                [None if v is None else codec.decode(np.frombuffer(v, "<u4").tolist()) for v in values],
                dtype=object,
            )

    return decoded(ids)

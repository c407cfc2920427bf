"""Words of many texts at once, as numbers into a table of distinct words."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are cut into words together.
TOGETHER = 4 << 20

_BYTES, _PLACES = (np.random.default_rng(i).integers(0, 1 << 63, n, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1) for i, n in ((1, 256), (2, 64)))
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def byte_class(pattern: str) -> np.ndarray:
    """The 256 bytes as a mask: True for those in ``pattern``."""
    mask = np.zeros(256, bool)
    mask[list(pattern.encode("latin-1"))] = True
    return mask


@dataclass(frozen=True)
class Words:
    """``ids[i]`` is the number of word i in ``table``; ``text[i]`` the place of its text;
    words of one ``piece`` have no breaking byte between them."""

    table: pa.Array
    ids: np.ndarray
    text: np.ndarray
    piece: np.ndarray


def cut_words(texts: Sequence[bytes], inside: np.ndarray, breaks: np.ndarray) -> Words:
    """All maximal runs of ``inside`` bytes, with A-Z lower-cased.

    A line feed stands between the texts: it must be no ``inside`` byte, and in ``breaks``.
    """
    data = np.frombuffer(b"\n".join(texts).translate(_LOWER), np.uint8)
    mask = inside[data]
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if len(mask) and mask[0]:
        edge = np.concatenate(([0], edge))
    if len(edge) % 2:
        edge = np.concatenate((edge, [len(mask)]))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    letters = pa.py_buffer(data[mask].tobytes())
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), letters])
    coded = words.dictionary_encode()
    first = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    stops = np.flatnonzero(breaks[data])
    return Words(
        coded.dictionary,
        coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        np.searchsorted(first, starts, "right") - 1,
        np.searchsorted(stops, starts),
    )


def hashes(table: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word (a binary array), the same in every task."""
    offsets = np.frombuffer(table.buffers()[1], np.int32)[table.offset : table.offset + len(table) + 1].astype(np.int64)
    if not len(table):
        return np.zeros(0, np.uint64)
    letters = np.frombuffer(table.buffers()[2] or b"", np.uint8)[: offsets[-1]]
    sizes = np.diff(offsets)
    place = np.arange(len(letters)) - np.repeat(offsets[:-1], sizes)[: len(letters)]
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[letters] * _PLACES[place & 63])))
    return mixed(sums[offsets[1:]] - sums[offsets[:-1]], sizes.astype(np.uint64))


def mixed(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """A hash of two hashes."""
    with np.errstate(over="ignore"):
        h = (one * np.uint64(0x9E3779B97F4A7C15)) ^ (two + np.uint64(0x7F4A7C15F39CC060))
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def gathered(batches: Iterator[pa.RecordBatch], text: str, most: int = TOGETHER) -> Iterator[list[dict]]:
    """Rows of the batches in lists of about ``most`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        for row in batch.to_pylist():
            held.append(row)
            size += len(row[text]) + 1
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def packed_words(values: list[bytes]) -> tuple[bytes, bytes]:
    """Words as one run of bytes and their lengths."""
    return b"".join(values), np.array([len(v) for v in values], "<i4").tobytes()


def unpacked_words(letters: list[bytes], lengths: list[bytes]) -> pa.Array:
    """The words of several packed runs, one after the other."""
    sizes = np.frombuffer(b"".join(lengths), "<i4")
    offsets = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    buffers = [None, pa.py_buffer(offsets.astype("<i8").tobytes()), pa.py_buffer(b"".join(letters))]
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), buffers)

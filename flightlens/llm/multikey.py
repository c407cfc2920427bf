"""Multikey three-way quicksort of pointers, breadth first.

A pointer stands for a sequence of whole numbers, given as columns: ``keys[d]``
holds the number at depth ``d`` of every sequence.  A partition is split around
a pivot into the pointers below, at and above it at the partition's depth; the
equal part goes on one depth further, the others stay at theirs.  All open
partitions of a round are split together, so a round is a few passes of numpy
over the pointers still open, however many partitions there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Equal:
    """Equal partitions of one round: sequences that agree on ``depth`` numbers.

    Partition ``i`` has ``sizes[i]`` pointers, which stand one partition after the
    other in ``items``, and the weight ``weights[i]``.
    """

    depth: np.ndarray
    items: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes


def equal_partitions(
    keys: np.ndarray, weights: np.ndarray, least: np.ndarray, ended: int | None = None
) -> Iterator[Equal]:
    """Every equal partition at every depth whose weight is at least ``least[depth - 1]``.

    ``keys`` has a row per depth.  A partition below its least weight is abandoned:
    nothing inside it can be heavier.  ``ended`` is the number that marks the end
    of a sequence; partitions of ended sequences are not reported.
    """
    most, rows = keys.shape
    flat = np.ascontiguousarray(keys).reshape(-1)
    items, sizes, depth = np.arange(rows), np.array([rows]), np.zeros(1, np.int64)
    random = np.random.default_rng(len(items))
    while len(items):
        number = np.repeat(np.arange(len(sizes)), sizes)
        key = flat[depth[number] * rows + items]
        starts = np.cumsum(sizes) - sizes
        three = [key[starts + (random.random(len(sizes)) * sizes).astype(np.int64)] for _ in range(3)]
        pivot = np.sort(three, axis=0)[1]
        at = pivot[number]
        parts = []
        for name, part in (("below", key < at), ("equal", key == at), ("above", key > at)):
            inside = items[part]
            size = np.bincount(number[part], minlength=len(sizes))
            some = size > 0
            here, level, size = pivot[some], depth[some], size[some]
            weight = np.add.reduceat(weights[inside], np.cumsum(size) - size) if len(size) else size
            kept = weight >= least[level]
            if name == "equal" and ended is not None:
                kept &= here != ended
            inside, size = inside[np.repeat(kept, size)], size[kept]
            level, weight = level[kept], weight[kept]
            if name == "equal":
                level = level + 1
                if len(size):
                    yield Equal(level, inside, size, weight)
                deeper = level < most
                inside, size, level = inside[np.repeat(deeper, size)], size[deeper], level[deeper]
            parts.append((inside, size, level))
        items, sizes, depth = (np.concatenate(column) for column in zip(*parts, strict=True))

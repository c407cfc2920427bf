"""SimHash near-duplicates by bit-sliced comparison.

Every text gets a fingerprint of 64 bits; two fingerprints are linked when they
differ in at most ``radius`` bits; documents fall into the connected classes of
these links.

1. Fingerprints are made in one narrow pass and written once.
2. Distinct fingerprints (pre-aggregated before the shuffle, so a text copied a
   million times is one row) are cut into ``radius + 2`` bands.  Two
   fingerprints within the radius agree on at least two bands, so each pair
   meets under at least one of the band pairs.
3. Rows that agree on a band pair are compared *bit-sliced*: plane k holds bit k
   of 64 differences per machine word, and a carry-save counter adds the planes
   to 64 distances at once.  A block is abandoned when all its distances are
   past the radius.  Only a spanning set of links leaves a group.
4. Classes come from label propagation with pointer jumping; each round is
   written to the shared folder.

Nulls and edge cases: a null or wordless text has fingerprint zero, linked like
any other.  A null ``doc_id`` keeps its row; a class takes its smallest non-null
id and is null only if it has none.  Repeated rows stay.  Other columns of the
input are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlens.llm.common import small_batches, work_table

BITS = 64
_ROWS_AT_ONCE = 1 << 16
_SMALL_RUN = 24
_SPLIT_RUN = 1 << 12


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of one text, as an unsigned number."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    shingle = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _ROWS_AT_ONCE):
        part = hashes[at : at + _ROWS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """Fingerprints as signed 64-bit numbers."""

    @F.pandas_udf("bigint")
    def prints(texts: pd.Series) -> pd.Series:
        made = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
        return pd.Series(made.view(np.int64))

    return prints(text.cast("binary"))


def bands(count: int) -> list[tuple[int, int]]:
    """(first bit, width) of ``count`` bands that cover all bits."""
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def within_radius(planes: Iterator[np.ndarray], radius: int, lanes: np.ndarray) -> np.ndarray:
    """Lanes whose distance is at most ``radius``, one bit per lane.

    ``planes`` yields, per bit position, the words that hold that bit of each
    lane's difference; ``lanes`` marks the lanes that count.
    """
    digits = [np.zeros_like(lanes) for _ in range((radius + 1).bit_length())]
    over = np.zeros_like(lanes)
    alive = lanes
    for k, plane in enumerate(planes):
        carry = plane
        for i, digit in enumerate(digits):
            digits[i], carry = digit ^ carry, digit & carry
        over |= carry
        if k % 6 == 5 or k == BITS - 1:
            alive = lanes & ~(over | _above(digits, radius))
            if not alive.any():
                break
    return alive


def _above(digits: list[np.ndarray], radius: int) -> np.ndarray:
    """Bit-sliced ``count > radius``, from the highest digit down."""
    more, equal = np.zeros_like(digits[0]), ~np.zeros_like(digits[0])
    for i in reversed(range(len(digits))):
        if radius >> i & 1:
            equal = equal & digits[i]
        else:
            more = more | equal & digits[i]
            equal = equal & ~digits[i]
    return more


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(64, words): bit k of every value, 64 values per word."""
    padded = np.zeros(-(-len(values) // 64) * 64, "<u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(bits, axis=0, bitorder="little").T.copy().view("<u8")


def _lanes(count: int) -> np.ndarray:
    mask = np.zeros(-(-count // 64) * 64, bool)
    mask[:count] = True
    return np.packbits(mask, bitorder="little").view("<u8")


def _set_lanes(words: np.ndarray) -> np.ndarray:
    return np.unpackbits(words.view(np.uint8), bitorder="little").view(bool)


def _roots(size: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index linked to each index."""
    root = np.arange(size)
    for left, right in pairs:
        while True:
            low = np.minimum(root[left], root[right])
            high = np.maximum(root[left], root[right])
            open_ = low != high
            if not open_.any():
                break
            np.minimum.at(root, high[open_], low[open_])
            while (root[root] != root).any():
                root = root[root]
    return root


def _block_pairs(values: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a run within the radius, a few rows against all lanes at a time."""
    planes, lanes = bit_planes(values), _lanes(len(values))
    rows = max(1, (1 << 15) // len(lanes))
    for at in range(0, len(values), rows):
        some = values[at : at + rows]
        flips = [
            np.where((some >> np.uint64(k)) & np.uint64(1), np.uint64(2**64 - 1), np.uint64(0))
            for k in range(BITS)
        ]
        near = within_radius(
            (planes[k][None, :] ^ flips[k][:, None] for k in range(BITS)),
            radius,
            np.repeat(lanes[None, :], len(some), axis=0),
        )
        row, word = np.nonzero(near)
        if len(row):
            hit = _set_lanes(near[row, word]).reshape(-1, 64)
            which, lane = np.nonzero(hit)
            yield at + row[which], word[which] * 64 + lane


def _run_links(values: np.ndarray, radius: int, rest: list[tuple[int, int]]) -> np.ndarray:
    """Roots within one run of distinct values that agree on some bits.

    A run over ``_SPLIT_RUN`` is cut once more by bands of the bits in ``rest``,
    again with two of at least ``radius + 2`` bands equal, so a large run does not
    cost the square of its size.  For radius 2 a part then differs in 16 bits only.
    """
    if len(values) <= _SPLIT_RUN or len(rest) < 2:
        return _roots(len(values), _block_pairs(values, radius))

    def parts() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for chosen in combinations(rest, 2):
            order, starts, stops = _runs(_keys(values, chosen), values)
            for a, b in zip(starts, stops, strict=True):
                members = order[a:b]
                root = _run_links(values[members], radius, [])
                moved = root != np.arange(len(root))
                if moved.any():
                    yield members[moved], members[root[moved]]

    return _roots(len(values), parts())


def _narrower(free: list[tuple[int, int]], radius: int) -> list[tuple[int, int]]:
    """The free bits cut into ``radius + 2`` bands again, if they are wide enough."""
    halves = [p for a, w in free if w > 1 for p in ((a, w // 2), (a + w // 2, w - w // 2))]
    return halves if len(halves) >= radius + 2 else []


def _keys(values: np.ndarray, chosen: tuple[tuple[int, int], ...]) -> np.ndarray:
    mask = 0
    for first, width in chosen:
        mask |= ((1 << width) - 1) << first
    return values & np.uint64(mask)


def _runs(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (key, value), and the bounds of runs of two or more equal keys."""
    order = np.lexsort((values, keys))
    change = np.flatnonzero(np.diff(keys[order]) != 0) + 1
    starts = np.concatenate(([0], change))
    stops = np.concatenate((change, [len(keys)]))
    long = stops - starts > 1
    return order, starts[long], stops[long]


def _small_run_pairs(
    values: np.ndarray, starts: np.ndarray, stops: np.ndarray, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of many short runs at once: rows against the rows s places further."""
    end = np.repeat(stops, stops - starts)
    at = np.concatenate([np.arange(a, b) for a, b in zip(starts, stops, strict=True)])
    for shift in range(1, int((stops - starts).max())):
        left = at[at + shift < end]
        for cut in range(0, len(left), _ROWS_AT_ONCE):
            a = left[cut : cut + _ROWS_AT_ONCE]
            planes = bit_planes(values[a] ^ values[a + shift])
            near = within_radius(iter(planes), radius, _lanes(len(a)))
            hit = a[_set_lanes(near)[: len(a)]]
            if len(hit):
                yield hit, hit + shift


def links_of(keys: np.ndarray, prints: np.ndarray, chosen: tuple, radius: int) -> np.ndarray:
    """(fingerprint, smaller linked fingerprint) rows, a spanning set of each run.

    ``keys`` are equal where fingerprints agree on the bands ``chosen``; rows
    come sorted by key, whole runs only.
    """
    order, starts, stops = _runs(keys, prints)
    values = prints[order]
    if not len(starts):
        return np.empty((0, 2), np.uint64)
    size = stops - starts
    short = size <= _SMALL_RUN
    found = []
    if short.any():
        pairs = _small_run_pairs(values, starts[short], stops[short], radius)
        root = _roots(len(values), pairs)
        moved = np.flatnonzero(root != np.arange(len(root)))
        found.append(np.stack([values[moved], values[root[moved]]], axis=1))
    free = [b for b in bands(radius + 2) if b not in chosen]
    for a, b in zip(starts[~short], stops[~short], strict=True):
        root = _run_links(values[a:b], radius, _narrower(free, radius))
        moved = np.flatnonzero(root != np.arange(len(root)))
        found.append(np.stack([values[a:b][moved], values[a:b][root[moved]]], axis=1))
    return np.concatenate(found)


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): links between distinct fingerprints that span their classes.

    ``prints`` has one distinct fingerprint per row in column ``fp``.
    """
    chosen = list(combinations(bands(radius + 2), 2))
    masks = [_mask(c) for c in chosen]
    keyed = prints.select(
        "fp",
        F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "key"),
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            table, key, fp = (np.concatenate(c) for c in zip(*rows, strict=True))
            for t in np.unique(table):
                mine = table == t
                pairs = links_of(
                    key[mine].view(np.uint64), fp[mine].view(np.uint64), chosen[t], radius
                ).view(np.int64)
                yield pa.RecordBatch.from_pydict({"a": pairs[:, 0].copy(), "b": pairs[:, 1].copy()})

        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            rows = tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("t", "key", "fp"))
            held.append(rows)
            if sum(len(r[0]) for r in held) < _ROWS_AT_ONCE:
                continue
            # The last run may go on in the next batch.
            table, key, fp = (np.concatenate(c) for c in zip(*held, strict=True))
            last = (table == table[-1]) & (key == key[-1])
            cut = int(np.argmax(last))
            if cut:
                yield from made([(table[:cut], key[:cut], fp[:cut])])
            held = [(table[cut:], key[cut:], fp[cut:])]
        if held:
            yield from made(held)

    dealt = keyed.repartition("t", "key").sortWithinPartitions("t", "key")
    return dealt.select("t", "key", "fp").mapInArrow(compare, "a bigint, b bigint").distinct()


def _mask(chosen: tuple[tuple[int, int], ...]) -> int:
    mask = 0
    for first, width in chosen:
        mask |= ((1 << width) - 1) << first
    return mask - (1 << 64) if mask >> 63 else mask


def classes(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected class of ``edges`` (a, b)."""
    both = work_table(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
        "simhash-links",
    )
    label = work_table(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")),
        "simhash-labels",
    )
    while True:
        seen = both.join(label.withColumnRenamed("node", "b"), "b")
        lowest = seen.groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        better = label.join(lowest, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root")
        )
        better = work_table(better, "simhash-labels")
        above = better.select(F.col("node").alias("root"), F.col("root").alias("top"))
        jumped = better.join(above, "root", "left").select(
            "node", "old", F.least(F.col("root"), F.coalesce("top", "root")).alias("root")
        )
        jumped = work_table(jumped, "simhash-labels")
        label = jumped.select("node", "root")
        if jumped.where(F.col("old") != F.col("root")).isEmpty():
            return label


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: doc_id, fp (signed), component_id, component_fp.

    ``component_fp`` names the class even where ids are null.
    """
    small_batches(docs.sparkSession)
    prints = work_table(
        docs.select("doc_id", fingerprint_column(F.col("text"), shingle).alias("fp")), "simhash"
    )
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    root = classes(links(distinct, radius)).select(F.col("node").alias("fp"), "root")
    rooted = work_table(
        distinct.join(root, "fp", "left").select(
            "fp", "first_id", F.coalesce("root", "fp").alias("component_fp")
        ),
        "simhash-roots",
    )
    ids = rooted.groupBy("component_fp").agg(F.min("first_id").alias("component_id"))
    return prints.join(rooted.join(ids, "component_fp").drop("first_id"), "fp")


def representatives(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """The documents with one row of each class left: the one with its smallest id.

    All columns stay.  A class without any id keeps one of its rows.
    """
    small_batches(docs.sparkSession)
    found = near_duplicates(docs, shingle, radius)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("_kept_id"), F.col("fp").alias("_kept_fp"), "component_fp"
    )
    kept = kept.groupBy("component_fp").agg(F.min(F.struct("_kept_id", "_kept_fp")).alias("_kept"))
    kept = kept.select("_kept.*")
    # A name that no column of the documents has.
    fp = "_" * (1 + max((len(c) for c in docs.columns), default=0)) + "fp"
    own = docs.withColumn(fp, fingerprint_column(F.col("text"), shingle))
    same = own["doc_id"].eqNullSafe(kept["_kept_id"]) & (own[fp] == kept["_kept_fp"])
    chosen = own.join(kept, same, "left_semi")
    return chosen.dropDuplicates(["doc_id", fp]).select(*docs.columns)


def hex_digits(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")

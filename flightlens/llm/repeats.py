"""Removal of passages that a document with a smaller id has too, by a sorted suffix table.

Every byte covered by a ``span``-byte string that also starts in a document with a
smaller ``doc_id`` is removed.

1. Texts are dealt into blocks, written once.  In a block every window of ``span``
   bytes belongs to an anchor: the smallest of its hashed substrings of ``core`` bytes.
   Neighbouring windows of one anchor are a run.  Equal windows have equal cores.
2. Only hashes of cores move, to learn which cores stand in two documents; the others
   can repeat nothing.
3. What is left are the suffixes that begin with a shared core, with the bytes before it
   that its run has.  Splitters sampled from the texts range-partition them by their
   leading bytes, the core.  A bucket sorts its runs by :func:`multikey.equal_partitions`,
   eight bytes a step, and compares the documents of equal ones; where runs of one core
   differ, their windows are sorted as well.  A core that stands among the splitters
   several times is hot: its windows are dealt one by one over as many buckets, equal
   ones of a block as one row.
4. Every block gets its repeated windows back and cuts its documents.

Equality is decided on the bytes; hashes of 128 bits join equal runs of one block.

Nulls and edge cases: a null text is empty.  A document without id is in no order with
others: nothing is removed from it or because of it.  Rows that share an id do not
count as smaller than each other.  Texts shorter than ``span`` and an empty table lose
nothing.  A text longer than a block is a block of its own, worked on in slices.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlens.llm.common import small_batches, work_table
from flightlens.llm.multikey import equal_partitions

SPAN = 50
#: Bytes of a block, and of text per bucket of the two exchanges.
BLOCK = 2 << 20
IN_ROUTE, IN_BUCKET = 16 << 20, 8 << 20
#: Windows that are worked on together: their places fit 16 bits, their arrays a cache.
SLICE = (1 << 16) - 256
#: Sampled strings per splitter.
SAMPLED = 32

_ONE, _TWO = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_BYTES = np.random.default_rng(7).integers(1, 1 << 63, 256).astype(np.uint64)
_SHORT = _BYTES.astype(np.uint32)
_BITS16, _BITS32 = np.uint32(16), np.uint64(32)
#: Windows that a bucket sorts together, in groups of one core.
SORTED = 1 << 18


def core_bytes(span: int) -> int:
    """Bytes of a core: fewer make longer runs but more chance agreement; a run has at most 64 windows."""
    return max(1, span * 18 // 50, span - 63)


def _squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(data, asbytes=True)


def _expand(data: bytes) -> bytes:
    return pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def _stirred(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 32-bit hash of the ``size`` bytes from every place on, by doubling."""
    h, power, factor = _SHORT[data], 1, _ONE & 0xFFFFFFFF
    made, length = None, 0
    while True:
        if size & power:
            if made is None:
                made = h
            else:
                rest = h[length:]
                made = made[: len(rest)] * np.uint32(factor) + rest
            length += power
        if power * 2 > size:
            return (made ^ (made >> np.uint32(15))) * np.uint32(0x846CA68B)
        h = h[:-power] * np.uint32(factor) + h[power:]
        factor, power = factor * factor & 0xFFFFFFFF, power * 2


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    length = 1
    while 2 * length <= width:
        values = np.minimum(values[:-length], values[length:])
        length *= 2
    return np.minimum(values[: len(values) - (width - length)], values[width - length :]) if length < width else values


@functools.cache
def _powers(factor: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a factor and of its inverse."""
    up = np.cumprod(np.full(size, factor, np.uint64))
    return up, np.cumprod(np.full(size + 1, pow(factor, -1, 1 << 64), np.uint64))


def _span_hashes(data: np.ndarray, factor: int, *spans: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """Hashes of each ``data[start : start + length]``, for several columns of starts and
    lengths; in every column the starts ascend."""
    made = [np.zeros(len(start), np.uint64) for start, _ in spans]
    longest = max((int(length.max()) for _, length in spans if len(length)), default=0)
    for low in range(0, len(data), SLICE):
        sums, end = None, low + SLICE + longest
        for out, (start, length) in zip(made, spans, strict=True):
            a, b = np.searchsorted(start, (low, low + SLICE))
            if a == b:
                continue
            if sums is None:
                here = _BYTES[data[low:end]]
                up, down = _powers(factor, SLICE + longest)
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(here * up[: len(here)])))
            begin, size = start[a:b] - low, length[a:b]
            out[a:b] = _stirred((sums[begin + size] - sums[begin]) * down[begin] + size.astype(np.uint64))
    return made


def _mixed(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return _stirred(one ^ (two * np.uint64(_TWO)))


def _numbered(sorted_by: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, starts, number): rows in an order that brings equal ones together, where each distinct
    row begins in it, and the number of every row's distinct row.

    Rows that differ but are ``sorted_by`` the same may make several groups of equal rows.
    """
    order = np.argsort(sorted_by, kind="stable")
    if not len(order):
        return order, order, order
    new = np.zeros(len(order), bool)
    new[0] = True
    for column in columns or (sorted_by,):
        values = column[order]
        new[1:] |= values[1:] != values[:-1]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), number


def _stretches(values: np.ndarray) -> list[tuple[int, int]]:
    """From where to where equal values stand next to each other."""
    if not len(values):
        return []
    cuts = (np.flatnonzero(values[1:] != values[:-1]) + 1).tolist()
    return list(zip([0, *cuts], [*cuts, len(values)], strict=True))


class Block:
    """The runs of some documents, their groups of equal ones and their distinct cores."""

    def __init__(self, row: dict, span: int) -> None:
        self.span, self.core = span, core_bytes(span)
        self.text = _expand(row["text"])
        self.data = np.frombuffer(self.text, np.uint8)
        self.sizes = np.array(row["sizes"], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.ids = np.array(row["ids"], np.int64)
        found = [self._runs(low, min(low + SLICE, len(self.data))) for low in range(0, len(self.data), SLICE)]
        empty = [np.zeros(0, np.int64)] * 3
        self.start, self.windows, self.anchor = (np.concatenate(c) for c in zip(empty, *found, strict=True))
        self.id = self.ids[np.searchsorted(self.ends, self.start, "right")]
        core = self.anchor, np.full(len(self.anchor), self.core)
        run = self.start, self.windows + span - 1
        hashed, one = _span_hashes(self.data, _ONE, core, run)
        (two,) = _span_hashes(self.data, _TWO, run)
        order, firsts, number = _numbered(hashed)
        self.cores = hashed[order][firsts]
        low, high = (_by_part(how, self.id[order], firsts) for how in (np.minimum, np.maximum))
        #: Whether two documents of the block have the core.
        self.several = low != high
        order, firsts, self.group = _numbered(_mixed(_mixed(hashed, one), two), hashed, one, two)
        self.least = _by_part(np.minimum, self.id[order], firsts)
        #: A run of each group in its smallest document.
        order = np.lexsort((self.id, self.group))
        self.shown = order[np.searchsorted(self.group[order], np.arange(len(firsts)))]
        self.core_of = number[self.shown]

    def _runs(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of the windows that start in a slice: first window, number of windows, place of the core."""
        data = self.data[low : high + self.span - 1]
        if len(data) < self.span:
            return (np.zeros(0, np.int64),) * 3
        core = _gram_hashes(data, self.core)
        # Of equal hashes the first place counts, which depends on the bytes of the window alone.
        place = np.arange(len(core), dtype=np.uint32)
        least = _sliding_least((core >> _BITS16 << _BITS16) | place, self.span - self.core + 1)
        anchor = (least & np.uint32(0xFFFF)).astype(np.int32)
        new = np.concatenate(([True], anchor[1:] != anchor[:-1]))
        # A window lies in one document.
        inside = np.ones(len(anchor), bool)
        for end in (self.ends[(self.ends > low) & (self.ends < low + len(data))] - low).tolist():
            inside[max(0, end - self.span + 1) : end] = False
            new[end : end + 1] = True
        first = np.flatnonzero(new & inside)
        outside = np.flatnonzero(np.concatenate((~inside, [True])))
        following = np.append(first[1:], len(anchor))
        stops = np.minimum(following, outside[np.searchsorted(outside, first)])
        return first + low, stops - first, anchor[first].astype(np.int64) + low


def _by_part(how: np.ufunc, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return how.reduceat(values, starts) if len(starts) else values[:0]


@dataclass(frozen=True)
class Singles:
    """Windows of hot cores, one by one: ``number`` numbers equal ones, ``least`` is the smallest
    document of a number, ``shown`` a window of that document."""

    start: np.ndarray
    id: np.ndarray
    number: np.ndarray
    least: np.ndarray
    shown: np.ndarray
    hash: np.ndarray


def singles(block: Block, groups: np.ndarray) -> Singles:
    """The windows of these groups of runs, in the smallest document of each group."""
    wanted = np.zeros(len(block.least), bool)
    wanted[groups] = True
    mine = np.flatnonzero((block.id == block.least[block.group]) & wanted[block.group])
    parts = block.windows[mine]
    start = np.repeat(block.start[mine], parts) + np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    ids, length = np.repeat(block.id[mine], parts), np.full(len(start), block.span)
    (one,), (two,) = (_span_hashes(block.data, factor, (start, length)) for factor in (_ONE, _TWO))
    _, firsts, number = _numbered(_mixed(one, two), one, two)
    order = np.lexsort((ids, number))
    shown = order[np.searchsorted(number[order], np.arange(len(firsts)))]
    return Singles(start, ids, number, ids[shown], shown, one[shown])


@dataclass(frozen=True)
class Ranges:
    """Buckets of suffixes by their leading bytes: one per range between the cuts, and as many
    for a cut itself as it was sampled times, where that is more than once."""

    cuts: np.ndarray
    copies: np.ndarray

    def place(self, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bucket of every suffix, and the number of buckets that share its leading bytes."""
        bucket = np.searchsorted(self.cuts, lead, "right")
        if not len(self.cuts):
            return bucket, np.ones(len(lead), np.int64)
        at = np.maximum(bucket - 1, 0)
        copies = np.where(self.cuts[at] == lead, self.copies[at], 1)
        later = len(self.cuts) + 1 + np.cumsum(self.copies) - self.copies
        return np.where(copies > 1, later[at], bucket), copies


def candidates(block: Block, shared: np.ndarray, ranges: Ranges) -> tuple[np.ndarray, np.ndarray, np.ndarray, Singles]:
    """Groups of runs with a shared core that go as a whole, with their buckets, and the
    windows of hot cores with theirs."""
    groups = np.flatnonzero(shared[block.core_of]) if len(block.core_of) else np.zeros(0, np.int64)
    bucket, copies = ranges.place(_strings(block.data, block.anchor[block.shown[groups]], block.core))
    hot = copies > 1
    single = singles(block, groups[hot])
    # A window's bucket among those of its core.
    base = dict(zip(block.start[block.shown[groups[hot]]].tolist(), zip(bucket[hot].tolist(), copies[hot].tolist(), strict=True), strict=True))
    run = np.searchsorted(block.start, single.start[single.shown], "right") - 1
    of_group = block.start[block.shown[block.group[run]]]
    at = [base[s] for s in of_group.tolist()]
    dealt = np.array([b + int(h) % c for (b, c), h in zip(at, single.hash.tolist(), strict=True)], np.int64)
    return groups[~hot], bucket[~hot], dealt, single


def _strings(data: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, f"S{size}")
    found = np.lib.stride_tricks.sliding_window_view(data, size)[starts]
    return np.ascontiguousarray(found).view(f"S{size}").reshape(-1)


def _block_table(docs: DataFrame) -> DataFrame:
    """(block, ids, sizes, text): documents in blocks, written with their numbers."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0

        def made() -> pa.RecordBatch:
            row = {"block": number, "ids": ids, "sizes": [len(t) for t in texts], "text": _squeeze(b"".join(texts))}
            return pa.RecordBatch.from_pylist([row], schema)

        schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("text", pa.binary())])
        for batch in batches:
            for one, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if texts and size + len(text) > BLOCK:
                    yield made()
                    ids, texts, size, number = [], [], 0, number + 1
                ids.append(one)
                texts.append(text)
                size += len(text)
        if texts:
            yield made()

    blocks = docs.mapInArrow(gather, "block bigint, ids array<bigint>, sizes array<bigint>, text binary")
    return work_table(blocks, "repeat-blocks")


def _with_replies(blocks: DataFrame, **replies: DataFrame) -> DataFrame:
    """Each block with its replies, as many as a block has parts."""
    for name, rows in replies.items():
        reply = [c for c in rows.columns if c != "block"]
        listed = rows.groupBy("block").agg(F.collect_list(F.struct(*reply)).alias(name))
        blocks = blocks.join(listed, "block", "left")
    return blocks


def _shared_cores(blocks: DataFrame, span: int, routes: int) -> DataFrame:
    """(block, part, data): a bit per core of a block, set if two documents have the core."""
    # The lower bytes of a hash, which part the cores of a route.
    kept = 5

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, span)
                # Cores ascend, and so do their routes.
                route = ((block.cores >> _BITS32) * np.uint64(routes) >> _BITS32).astype(np.int64)
                out = []
                for a, b in _stretches(route):
                    short = block.cores[a:b].view(np.uint8).reshape(-1, 8)[:, :kept].tobytes()
                    out.append((int(route[a]), row["block"], short, np.packbits(block.several[a:b]).tobytes()))
                columns = zip(*out, strict=True) if out else [()] * 4
                kinds = pa.int32(), pa.int64(), pa.binary(), pa.binary()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "block", "cores", "several"]
                )

    def meet(table: pa.Table) -> pa.Table:
        parts = table.to_pydict()
        sizes = [len(c) // kept for c in parts["cores"]]
        short = np.frombuffer(b"".join(parts["cores"]), np.uint8).reshape(-1, kept)
        core = np.pad(short, ((0, 0), (0, 8 - kept))).view("<u8").reshape(-1)
        several = np.concatenate([np.unpackbits(np.frombuffer(s, np.uint8), count=n) for s, n in zip(parts["several"], sizes, strict=True)])
        block = np.repeat(parts["block"], sizes)
        order, firsts, number = _numbered(core)
        low, high = (_by_part(how, block[order], firsts) for how in (np.minimum, np.maximum))
        shared = (_by_part(np.maximum, several[order], firsts).astype(bool) | (low != high))[number]
        ends = np.cumsum(sizes)
        data = [np.packbits(shared[e - n : e]).tobytes() for e, n in zip(ends, sizes, strict=True)]
        # The number of bits stands in front.
        data = [n.to_bytes(4, "little") + d for n, d in zip(sizes, data, strict=True)]
        return pa.table({"block": table["block"], "part": table["part"], "data": pa.array(data, pa.binary())})

    told = blocks.mapInArrow(tell, "part int, block bigint, cores binary, several binary")
    return work_table(told.groupBy("part").applyInArrow(meet, "block bigint, part int, data binary"), "repeat-cores")


def _shared(row: dict) -> np.ndarray:
    parts = sorted(row["cores"] or [], key=lambda r: r["part"])
    bits = [np.unpackbits(np.frombuffer(r["data"], np.uint8)[4:], count=int.from_bytes(r["data"][:4], "little")) for r in parts]
    return np.concatenate([np.zeros(0, np.uint8), *bits]).astype(bool)


def _ranges(docs: DataFrame, span: int, buckets: int) -> Ranges:
    """Cuts between suffixes, from the cores of a sample: one window of a share of the documents."""
    wanted = buckets * SAMPLED
    long = docs.where(F.octet_length("text") >= span)
    share = min(1.0, wanted / max(1, long.count()))
    drawn = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    place = F.pmod(F.xxhash64("id", F.lit("place")), (F.octet_length("text") - span + 1).cast("bigint")) + 1
    picked = long.where(drawn < math.ceil(share * (1 << 20))).select(F.substring("text", place.cast("int"), F.lit(span)).alias("s"))
    text = b"".join(bytes(r["s"]) for r in picked.limit(4 * wanted).collect())
    size = len(text) // span
    block = Block({"text": _squeeze(text), "sizes": [span] * size, "ids": list(range(size))}, span)
    ranked = np.sort(_strings(block.data, block.anchor, block.core))
    cuts, copies = np.unique(ranked[:: max(1, len(ranked) // buckets)][1:], return_counts=True)
    return Ranges(cuts.astype(f"S{block.core}"), copies)


def _rows(letters: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Strings as columns of whole numbers in their order, eight bytes each."""
    wide = -(-int(length.max()) // 8) * 8
    room = np.zeros((len(starts), wide), np.uint8)
    mask = np.arange(wide) < length[:, None]
    room[mask] = letters[np.repeat(starts - np.cumsum(length) + length, length) + np.arange(length.sum())]
    return room.view(">u8").T.astype(np.uint64)


def _smallest(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every row the smallest id of the rows with its keys, and a row that has it."""
    smallest, shown = ids.copy(), np.arange(len(ids))
    for part in equal_partitions(keys, np.ones(len(ids), np.int64), np.full(len(keys), 2)):
        whole = part.depth == len(keys)
        if whole.any():
            items = part.items[np.repeat(whole, part.sizes)]
            sizes = part.sizes[whole]
            number = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((ids[items], number))
            first = items[order[np.cumsum(sizes) - sizes]]
            smallest[items], shown[items] = ids[first][number], first[number]
    return smallest, shown


def repeated_windows(text: bytes, length: np.ndarray, core: np.ndarray, ids: np.ndarray, span: int) -> np.ndarray:
    """A mask of the windows of every run that a run of a smaller document has too.

    The runs stand one after the other in ``text``; ``core`` is the place of the core in each.
    """
    letters, starts = np.frombuffer(text, np.uint8), np.cumsum(length) - length
    windows = length - span + 1
    keys = np.vstack((_rows(letters, starts, length), core.astype(np.uint64), length.astype(np.uint64)))
    smallest, shown = _smallest(keys, ids)
    full = (np.uint64(1) << (windows - 1).astype(np.uint64) << np.uint64(1)) - np.uint64(1)
    mask = np.where(ids > smallest, full, np.uint64(0))
    # Where the runs of a core differ, one of each is compared window by window.
    differ = np.flatnonzero(shown == np.arange(len(ids)))
    size = core_bytes(span)
    cores = _rows(letters, (starts + core)[differ], np.full(len(differ), size))
    key = functools.reduce(_mixed, cores)
    order, firsts, _ = _numbered(key)
    sizes = np.diff(np.append(firsts, len(order)))
    several = np.repeat(sizes > 1, sizes)
    differ, group = differ[order][several], np.repeat(np.arange(len(sizes)), sizes)[several]
    upto = np.cumsum(windows[differ])
    begin = 0
    while begin < len(differ):
        # Whole groups of about SORTED windows.
        last = min(len(differ) - 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + SORTED)))
        end = int(np.searchsorted(group, group[last], "right"))
        mine = differ[begin:end]
        row = np.repeat(mine, windows[mine])
        step = np.arange(len(row)) - np.repeat(np.cumsum(windows[mine]) - windows[mine], windows[mine])
        found = _rows(letters, starts[row] + step, np.full(len(row), span))
        least, _ = _smallest(found, ids[row])
        again = ids[row] > least
        np.bitwise_or.at(mask, row[again], np.uint64(1) << step[again].astype(np.uint64))
        begin = end
    # Other rows of the same run and document have the same windows.
    return np.where(ids > smallest, mask, mask[shown])


def _repeated(blocks: DataFrame, span: int, ranges: Ranges) -> DataFrame:
    """(block, part, single, data): masks of the windows of groups of runs, or numbers of single
    windows, that a smaller document of another block has too."""
    shared = blocks.sparkSession.sparkContext.broadcast(ranges)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, span)
                groups, bucket, dealt, single = candidates(block, _shared(row), shared.value)
                run = block.shown[groups]
                start, length = block.start[run], block.windows[run] + span - 1
                every = (
                    (False, bucket, groups, start, length, block.anchor[run] - start, block.least[groups]),
                    (True, dealt, np.arange(len(dealt)), single.start[single.shown], *[np.full(len(dealt), span)] * 2, single.least),
                )
                out = []
                for alone, to, numbers, first, size, core, ids in every:
                    order = np.argsort(to, kind="stable")
                    for a, b in _stretches(to[order]):
                        mine = order[a:b]
                        letters = b"".join(block.text[s : s + n] for s, n in zip(first[mine].tolist(), size[mine].tolist(), strict=True))
                        short = size[mine].astype("<u2").tobytes() + core[mine].astype("<u2").tobytes()
                        out.append((int(to[mine[0]]), row["block"], alone, numbers[mine].astype("<i4").tobytes(), ids[mine].astype("<i8").tobytes(), _squeeze(short + letters)))
                columns = zip(*out, strict=True) if out else [()] * 6
                kinds = pa.int32(), pa.int64(), pa.bool_(), *[pa.binary()] * 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["part", "block", "single", "numbers", "ids", "letters"],
                )

    def sort(table: pa.Table) -> pa.Table:
        parts = table.to_pydict()
        sizes = [len(g) // 4 for g in parts["numbers"]]
        number = np.frombuffer(b"".join(parts["numbers"]), "<i4")
        ids = np.frombuffer(b"".join(parts["ids"]), "<i8")
        plain = [_expand(x) for x in parts["letters"]]
        length, core = (
            np.concatenate([np.frombuffer(x[2 * k * n : 2 * (k + 1) * n], "<u2") for x, n in zip(plain, sizes, strict=True)]).astype(np.int64)
            for k in (0, 1)
        )
        text = b"".join(x[4 * n :] for x, n in zip(plain, sizes, strict=True))
        if parts["single"][0]:
            keys = _rows(np.frombuffer(text, np.uint8), np.cumsum(length) - length, length)
            mask = (ids > _smallest(keys, ids)[0]).astype(np.uint64)
        else:
            mask = repeated_windows(text, length, core, ids, span)
        columns: dict[str, list] = {"block": [], "part": [], "single": [], "data": []}
        ends = np.cumsum(sizes)
        for i, (end, n) in enumerate(zip(ends.tolist(), sizes, strict=True)):
            found = np.flatnonzero(mask[end - n : end]) + end - n
            if len(found):
                columns["block"].append(parts["block"][i])
                columns["part"].append(parts["part"][i])
                columns["single"].append(parts["single"][i])
                columns["data"].append(_squeeze(number[found].astype("<i4").tobytes() + mask[found].astype("<u8").tobytes()))
        kinds = {"block": pa.int64(), "part": pa.int32(), "single": pa.bool_(), "data": pa.binary()}
        return pa.table({name: pa.array(values, kinds[name]) for name, values in columns.items()})

    dealt = blocks.mapInArrow(deal, "part int, block bigint, single boolean, numbers binary, ids binary, letters binary")
    return work_table(dealt.groupBy("part").applyInArrow(sort, "block bigint, part int, single boolean, data binary"), "repeat-found")


def _gone(block: Block, row: dict, ranges: Ranges) -> np.ndarray:
    """A mask of the bytes of a block that go."""
    masks, again = np.zeros(len(block.least), np.uint64), np.zeros(0, bool)
    single = None
    for reply in row["found"] or []:
        data = _expand(reply["data"])
        n = len(data) // 12
        number = np.frombuffer(data[: 4 * n], "<i4")
        if not reply["single"]:
            masks[number] = np.frombuffer(data[4 * n :], "<u8")
            continue
        if single is None:
            *_, single = candidates(block, _shared(row), ranges)
            again = np.zeros(len(single.least), bool)
        again[number] = True
    if single is None:
        *_, single = candidates(block, _shared(row), ranges)
        again = np.zeros(len(single.least), bool)
    # What a smaller document of the same block has goes without a reply.
    whole = np.flatnonzero(block.id > block.least[block.group])
    part = np.flatnonzero((block.id == block.least[block.group]) & (masks[block.group] > 0))
    step = np.arange(64, dtype=np.uint64)
    run, bit = np.nonzero((masks[block.group[part]][:, None] >> step) & np.uint64(1))
    alone = single.start[(single.id > single.least[single.number]) | again[single.number]] if len(single.number) else single.start
    begin = np.concatenate((block.start[whole], block.start[part][run] + bit, alone))
    size = np.concatenate((block.windows[whole] + block.span - 1, np.full(len(run) + len(alone), block.span)))
    room = len(block.data) + 1
    depth = np.bincount(begin, minlength=room) - np.bincount(begin + size, minlength=room)
    return np.cumsum(depth[:-1]) > 0


def without_repeats(docs: DataFrame, span: int = SPAN, bucket_bytes: int = IN_BUCKET) -> DataFrame:
    """(doc_id, n_bytes, removed, kept): the removed stretches [start, end) of every text in
    bytes, and the bytes that are left."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    plain = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    known = plain.where(F.col("id").isNotNull()).withColumn("id", F.col("id").cast("bigint"))
    small_batches(spark, 128)
    blocks = _block_table(known)
    size = known.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    ranges = _ranges(known, span, max(1, -(-size // bucket_bytes)))
    # A block is one large row.
    small_batches(spark, 2)
    cores = _shared_cores(blocks, span, max(1, -(-size // IN_ROUTE)))
    found = _repeated(_with_replies(blocks, cores=cores), span, ranges)
    shared = spark.sparkContext.broadcast(ranges)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("removed", stretch), ("kept", pa.binary())])
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, span)
                gone = _gone(block, row, shared.value)
                out = []
                for one, n, stop in zip(block.ids.tolist(), block.sizes.tolist(), block.ends.tolist(), strict=True):
                    mask = gone[stop - n : stop]
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0])))).tolist()
                    kept = block.data[stop - n : stop][~mask].tobytes() if edge else block.text[stop - n : stop]
                    out.append({"id": one, "n_bytes": n, "removed": [{"start": a, "end": b} for a, b in zip(edge[::2], edge[1::2], strict=True)], "kept": kept})
                yield pa.RecordBatch.from_pylist(out, schema)

    stretches = "array<struct<start: bigint, end: bigint>>"
    made = _with_replies(blocks, cores=cores, found=found).mapInArrow(
        cut, f"id bigint, n_bytes bigint, removed {stretches}, kept binary"
    )
    nameless = plain.where(F.col("id").isNull()).select(
        F.lit(None).cast("bigint").alias("id"),
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.array().cast(stretches).alias("removed"),
        F.col("text").alias("kept"),
    )
    return made.unionByName(nameless).select(F.col("id").cast(kind).alias("doc_id"), "n_bytes", "removed", "kept")

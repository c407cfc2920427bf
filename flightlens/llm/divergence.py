"""Divergence between the sources of a language, over a k-squared tree of the count matrix.

1. Every task counts its (language, source, term) occurrences and documents, and routes
   the counts by term, so that a bucket has whole columns of the count matrix.  The
   number of buckets grows with the texts.
2. A bucket drops the rare terms and writes one block of columns per language; sizes
   of groups and languages are sums over the blocks.
3. A block becomes a quadtree over (source, term): a quadrant is cut into halves of its
   rows and its columns until it is one cell.  All pairs of sources are traversed
   together: where both quadrants of a pair are empty, all their cells have the same
   value and are priced at once; only pairs with a count in either are followed.
4. Sums of the blocks are added up by pair; the best terms of a block are enough for
   the best of all.

All numbers are whole; the sums of a pair fit 64 bits since the probabilities of a
source add up to little more than ``SCALE``.

Nulls and edge cases: a null text, language or source is empty text; repeated rows count
each; doc_id is not read.  A group without terms has its pairs all the same, and a
language without frequent terms has pairs of value 0 and no term rows.  An empty table
gives no rows; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightlens.llm.common import small_batches, work_table
from flightlens.llm.words import byte_class, cut_words, gathered, hashes, mixed, packed_words, unpacked_words
from flightlens.operators.lookup import ROWS, KeyCounts, join_lookup
from flightlens.session import materialise

SCALE = 1_000_000_000
#: Bytes of text per bucket of terms.
IN_BUCKET = 32 << 20
#: Sources on a side of a square of pairs, nodes followed together, and pair sums a task holds.
SIDE, TOGETHER, HELD = 1024, 1 << 20, 1 << 22

_LETTERS = byte_class("".join(chr(c) for c in range(256) if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128))


def probabilities(counts: np.ndarray, totals: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), exact for any count."""
    if counts.size and int(counts.max()) >= (1 << 62) // SCALE:
        counts, totals = counts.astype(object), np.asarray(totals).astype(object)
    return (1 + SCALE * (counts + 1) // totals).astype(np.int64)


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _sums(place: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Exact sums of values below 2^60 by place."""
    low, high = values & ((1 << 30) - 1), values >> 30
    parts = [np.bincount(place, weights=v, minlength=size).astype(np.int64) for v in (low, high)]
    return parts[0] + (parts[1] << 30)


class Quadtree:
    """Which quadrants of a count matrix hold anything, from the whole matrix down to its cells."""

    def __init__(self, counts: np.ndarray, rows: int) -> None:
        rows, columns = (1 << max(0, n - 1).bit_length() for n in (rows, counts.shape[1]))
        level = np.zeros((rows, columns), bool)
        level[: counts.shape[0], : counts.shape[1]] = counts > 0
        levels = [level]
        while level.size > 1:
            # A longer side is halved alone until both are the same.
            tall, wide = (1 if rows < columns else 2), (1 if columns < rows else 2)
            rows, columns = rows // tall, columns // wide
            level = level.reshape(rows, tall, columns, wide).any(axis=(1, 3))
            levels.append(level)
        self.levels = levels[::-1]

    def pairs(self, other: Quadtree, same: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, bool]]:
        """(level, rows of this tree, rows of the other, columns, empty) of the nodes reached.

        Empty nodes come from any level and are not followed; others are cells.
        With ``same`` the trees are one, and of two orders of a pair one is reached.
        """
        todo = [(0, *[np.zeros(1, np.int64)] * 3)]
        last = len(self.levels) - 1
        while todo:
            level, a, b, c = todo.pop()
            filled = self.levels[level][a, c] | other.levels[level][b, c]
            yield level, a[~filled], b[~filled], c[~filled], True
            a, b, c = a[filled], b[filled], c[filled]
            if level == last:
                yield level, a, b, c, False
                continue
            below = self.levels[level + 1].shape
            tall, wide = below[0] // self.levels[level].shape[0], below[1] // self.levels[level].shape[1]
            parts = [(i, j, k) for i in range(tall) for j in range(tall) for k in range(wide)]
            a, b, c = (np.concatenate([n * step + p[which] for p in parts]) for which, (n, step) in enumerate(((a, tall), (b, tall), (c, wide))))
            if same:
                a, b, c = (n[a <= b] for n in (a, b, c))
            for low in range(0, len(a), TOGETHER):
                todo.append((level + 1, *(n[low : low + TOGETHER] for n in (a, b, c))))


def pair_sums(one: np.ndarray, two: np.ndarray, p_one: np.ndarray, p_two: np.ndarray, zero_one: np.ndarray, zero_two: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all columns for each row of ``one`` against each of ``two``, and the other way round.

    ``one`` and ``two`` are counts, ``p_`` their probabilities, ``zero_`` those of a count of 0.
    """
    left, right = (Quadtree(counts, max(one.shape[0], two.shape[0])) for counts in (one, two))
    there = np.zeros((one.shape[0], two.shape[0]), np.int64)
    back = there.copy()
    empty = np.zeros((left.levels[-1].shape[0], right.levels[-1].shape[0]), np.int64)
    for level, a, b, c, nothing in left.pairs(right, same):
        if not len(a):
            continue
        rows, columns = left.levels[level].shape
        if nothing:
            # Columns of the quadrants that are no padding.
            wide = left.levels[-1].shape[1] // columns
            size = np.clip(one.shape[1] - c * wide, 0, wide)
            found = np.bincount(a * rows + b, weights=size, minlength=rows * rows).astype(np.int64).reshape(rows, rows)
            if same:
                found = found + np.triu(found, 1).T
            tall = empty.shape[0] // rows
            empty += np.repeat(np.repeat(found, tall, 0), tall, 1)
            continue
        inside = (a < one.shape[0]) & (b < two.shape[0])
        a, b, c = a[inside], b[inside], c[inside]
        p, q = p_one[a, c], p_two[b, c]
        place, size = a * two.shape[0] + b, there.size
        ahead = _sums(place, divergences(p, q), size).reshape(there.shape)
        behind = _sums(place, divergences(q, p), size).reshape(there.shape)
        there += ahead
        back += behind
        if same:
            there += np.triu(behind, 1).T
            back += np.triu(ahead, 1).T
    empty = empty[: one.shape[0], : two.shape[0]]
    there += empty * divergences(zero_one[:, None], zero_two[None, :])
    back += empty * divergences(zero_two[None, :], zero_one[:, None])
    return there, back


def _named(docs: DataFrame) -> DataFrame:
    """(text, lang, source) without nulls."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return docs.select(text.alias("text"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])


def count_blocks(texts: DataFrame, least_docs: int, buckets: int) -> DataFrame:
    """(lang, letters, lengths, sources, totals, terms, term, source, count): columns of the count
    matrix of a language: its frequent terms, the groups with a count, and the cells."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches, "text"):
            found = cut_words([r["text"] for r in rows], _LETTERS, ~_LETTERS)
            number = len(found.table)
            if not number:
                continue
            names = sorted({(r["lang"], r["source"]) for r in rows})
            langs = sorted({lang for lang, _ in names})
            group_of = {name: i for i, name in enumerate(names)}
            lang_of = np.array([langs.index(lang) for lang, _ in names])
            group = np.array([group_of[r["lang"], r["source"]] for r in rows])
            # One cell per text and word, then one per group and word.
            cell, times = np.unique(found.text * number + found.ids, return_counts=True)
            at, back = np.unique(group[cell // number] * number + cell % number, return_inverse=True)
            count, docs = np.bincount(back, weights=times).astype(np.int64), np.bincount(back)
            group, word = at // number, at % number
            lang = lang_of[group]
            plain = hashes(found.table)
            of_lang = hashes(pa.array([name.encode() for name in langs], pa.binary()))
            bucket = (mixed(of_lang[lang], plain[word]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            ends = np.flatnonzero(np.diff(np.concatenate((bucket[order], [-1])))) + 1
            table, out, begin = found.table.to_pylist(), [], 0
            for end in ends.tolist():
                mine = order[begin:end]
                used, local = np.unique(lang[mine] * number + word[mine], return_inverse=True)
                terms = [langs[i // number].encode() + b"\n" + table[i % number] for i in used.tolist()]
                cells = [c.astype("<i4").tobytes() for c in (local, group[mine], count[mine], docs[mine])]
                out.append((int(bucket[mine[0]]), *packed_words(terms), [n for n, _ in names], [n for _, n in names], *cells))
                begin = end
            kinds = pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string()), *[pa.binary()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=routed_names)

    def meet(table: pa.Table) -> pa.Table:
        parts = table.to_pydict()
        joined = unpacked_words(parts["letters"], parts["lengths"]).dictionary_encode()
        code = joined.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        names = sorted({n for langs, sources in zip(parts["langs"], parts["sources"], strict=True) for n in zip(langs, sources, strict=True)})
        group_of = {name: i for i, name in enumerate(names)}
        firsts = np.cumsum([0, *[len(x) // 4 for x in parts["lengths"]]])
        term, group = [], []
        for i, (langs, sources) in enumerate(zip(parts["langs"], parts["sources"], strict=True)):
            here = np.array([group_of[n] for n in zip(langs, sources, strict=True)])
            term.append(code[firsts[i] + np.frombuffer(parts["term"][i], "<i4")])
            group.append(here[np.frombuffer(parts["group"][i], "<i4")])
        term, group = np.concatenate(term), np.concatenate(group)
        count, docs = (np.frombuffer(b"".join(parts[c]), "<i4").astype(np.int64) for c in ("count", "docs"))
        at, back = np.unique(term * len(names) + group, return_inverse=True)
        order = np.argsort(back, kind="stable")
        starts = np.searchsorted(back[order], np.arange(len(at)))
        count, docs = np.add.reduceat(count[order], starts), np.add.reduceat(docs[order], starts)
        term, group = at // len(names), at % len(names)
        often = np.bincount(term, weights=docs, minlength=len(joined.dictionary)) >= least_docs
        kept = often[term]
        term, group, count = term[kept], group[kept], count[kept]
        lang_of = np.array([lang for lang, _ in names], object)
        out = []
        for lang in sorted(set(lang_of[group].tolist())):
            mine = lang_of[group] == lang
            used, local = np.unique(term[mine], return_inverse=True)
            terms = [w.rpartition(b"\n")[2] for w in joined.dictionary.take(pa.array(used)).to_pylist()]
            there, row = np.unique(group[mine], return_inverse=True)
            totals = np.bincount(row, weights=count[mine]).astype(np.int64)
            cells = local.astype("<i4").tobytes(), row.astype("<i4").tobytes(), count[mine].astype("<i8").tobytes()
            out.append((lang, *packed_words(terms), [names[g][1] for g in there.tolist()], totals.tolist(), len(used), *cells))
        kinds = pa.string(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.int64(), *[pa.binary()] * 3
        columns = zip(*out, strict=True) if out else [()] * len(kinds)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=block_names)

    routed_names = ["bucket", "letters", "lengths", "langs", "sources", "term", "group", "count", "docs"]
    block_names = ["lang", "letters", "lengths", "sources", "totals", "terms", "term", "source", "count"]
    routed = texts.mapInArrow(
        route, "bucket int, letters binary, lengths binary, langs array<string>, sources array<string>, term binary, `group` binary, count binary, docs binary"
    )
    blocks = routed.groupBy("bucket").applyInArrow(
        meet, "lang string, letters binary, lengths binary, sources array<string>, totals array<bigint>, terms bigint, term binary, source binary, count binary"
    )
    return work_table(blocks, "divergence-blocks")


def _best(value: np.ndarray, words: list[bytes], first: int) -> list[int]:
    """Places of the largest values, ties to the smaller word, as far as ``first``."""
    if len(value) > first:
        bound = np.partition(value, len(value) - first)[len(value) - first]
        places = np.flatnonzero(value >= bound).tolist()
    else:
        places = range(len(value))
    return sorted(places, key=lambda i: (-value[i], words[i]))[:first]


def audit(docs: DataFrame, least_docs: int = 3, first: int = 200, bucket_bytes: int = IN_BUCKET) -> DataFrame:
    """(lang, source, part, item, value, rank): the divergence of every source from the other sources
    of its language (part ``pair``), and the terms that set it apart (part ``term``, ``first`` of them)."""
    small_batches(docs.sparkSession, 256)
    texts = _named(docs)
    groups, size = materialise(texts.groupBy("lang", "source").agg(F.sum(F.octet_length("text").cast("bigint")).alias("bytes")))
    whole = groups.agg(F.sum("bytes")).first()[0] or 0
    blocks = count_blocks(texts, least_docs, max(1, -(-whole // bucket_bytes)))

    cells = blocks.select("lang", F.explode(F.arrays_zip("sources", "totals")).alias("one"))
    counted = cells.groupBy("lang", F.col("one.sources").alias("source")).agg(F.sum("one.totals").alias("n"))
    sized = groups.select("lang", "source").join(counted, ["lang", "source"], "left").na.fill(0, ["n"])
    terms = blocks.groupBy("lang").agg(F.sum("terms").alias("v"), F.count(F.lit(1)).alias(ROWS))
    # The larger sources first: their rows are the fullest.
    listed = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "source")))
    by_lang, _ = materialise(terms.join(sized.groupBy("lang").agg(listed.alias("all")), "lang"))
    known = by_lang.select("lang", "v", F.col("all.source").alias("all_sources"), F.transform("all.less", lambda n: -n).alias("all_n"))
    # A language has one row, but as many numbers as sources: those are what is counted.
    wide = join_lookup(blocks, known, KeyCounts(by_lang.select("lang", ROWS), ("lang",), size))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def rows(part: str, lang: str, source: list, item: list, value: list) -> pa.RecordBatch:
            n = len(source)
            columns = [lang] * n, source, [part] * n, item, value
            kinds = *[pa.string()] * 4, pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "source", "part", "item", "value"])

        def sums() -> Iterator[pa.RecordBatch]:
            for (lang, *_), (one, two, total) in held.items():
                source, item = np.repeat(np.array(one, object), len(two)), np.tile(np.array(two, object), len(one))
                yield rows("pair", lang, source.tolist(), item.tolist(), total.reshape(-1).tolist())
            held.clear()

        for batch in batches:
            for row in batch.to_pylist():
                lang, v, sources = row["lang"], row["v"], row["all_sources"]
                words = unpacked_words([row["letters"]], [row["lengths"]]).to_pylist()
                number = {name: i for i, name in enumerate(sources)}
                of_group = np.array([number[s] for s in row["sources"]])[np.frombuffer(row["source"], "<i4")]
                term, count = np.frombuffer(row["term"], "<i4"), np.frombuffer(row["count"], "<i8")
                n = np.array(row["all_n"], np.int64)
                # Columns that the same sources fill stand together.
                filled = np.bincount(term, minlength=len(words))
                lowest = np.full(len(words), len(sources))
                np.minimum.at(lowest, term, of_group)
                column = np.empty(len(words), np.int64)
                column[np.lexsort((lowest, -filled))] = np.arange(len(words))
                zero = probabilities(np.zeros(len(n), np.int64), n + v)

                squares = range(0, len(sources), SIDE)
                matrices = {}
                for low in squares:
                    inside = (of_group >= low) & (of_group < low + SIDE)
                    counts = np.zeros((min(SIDE, len(sources) - low), len(words)), np.int64)
                    counts[of_group[inside] - low, column[term[inside]]] = count[inside]
                    matrices[low] = counts
                for i in squares:
                    for j in range(i, len(sources), SIDE):
                        sides = []
                        for low in (i, j):
                            counts = matrices[low]
                            sides.append((counts, probabilities(counts, (n[low : low + SIDE] + v)[:, None]), zero[low : low + SIDE], sources[low : low + SIDE]))
                        (c1, p1, z1, s1), (c2, p2, z2, s2) = sides
                        there, back = pair_sums(c1, c2, p1, p2, z1, z2, i == j)
                        for key, one, two, total in (((lang, i, j), s1, s2, there), ((lang, j, i), s2, s1, back.T))[: 1 if i == j else 2]:
                            before = held.get(key)
                            held[key] = [one, two, total if before is None else before[2] + total]
                        if sum(h[2].size for h in held.values()) > HELD:
                            yield from sums()

                together = np.bincount(term, weights=count, minlength=len(words)).astype(np.int64)
                q = probabilities(together, int(n.sum()) + v)[term]
                p = probabilities(count, n[of_group] + v)
                value = divergences(p, q)
                order = np.argsort(of_group, kind="stable")
                order = order[(p > q)[order]]
                begin = np.searchsorted(of_group[order], np.arange(len(sources) + 1))
                for i, name in enumerate(sources):
                    mine = order[begin[i] : begin[i + 1]]
                    said = [words[t] for t in term[mine].tolist()]
                    best = _best(value[mine], said, first)
                    if best:
                        yield rows("term", lang, [name] * len(best), [said[b].decode() for b in best], [int(value[mine[b]]) for b in best])
        yield from sums()

    small_batches(docs.sparkSession, 8)
    found = work_table(wide.mapInArrow(compare, "lang string, source string, part string, item string, value bigint"), "divergence-found")
    summed = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    mates = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(mates, "lang").where(F.col("source") != F.col("item"))
    pairs = pairs.join(summed, ["lang", "source", "item"], "left").na.fill(0, ["value"])
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(best).alias("rank")
    shown = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", ranked)
    apart = found.where("part = 'term'").select("lang", "source", "part", "item", "value", ranked)
    return shown.unionByName(apart.where(F.col("rank") <= first))

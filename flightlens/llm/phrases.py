"""Phrase collocation mining by multikey quicksort of suffixes.

1. A suffix is a word occurrence with the words after it in its piece, cut at
   ``longest`` words.  Equal suffixes of a task are counted before anything moves.
2. Suffixes are routed by their leading words: all suffixes under one leading word
   meet in one bucket.  The number of buckets grows with the words of the corpus.
   A leading word with more suffixes than a bucket should have is routed by two
   words, and a pair with more by three; the parts of its count are added up.
3. A bucket is sorted by :func:`multikey.equal_partitions` to the greatest depth:
   the weight of an equal partition is the count of its phrase, and a partition
   that is too light is abandoned, since no phrase inside it can be frequent.
4. Cuts, the phrases inside longer ones and the ranking are joins and windows over
   the frequent phrases alone.  Lookups are broadcast behind a counted size, and
   salted above it.

Nulls and edge cases: a null text is empty, a null language ``und``; repeated rows
count each; a null ``doc_id`` is of no matter (only text and language are read, and
the columns of the result do not depend on others).  Texts without words and an empty
table give no rows; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlens.llm.common import small_batches, work_table
from flightlens.llm.multikey import equal_partitions
from flightlens.llm.words import (
    byte_class,
    cut_words,
    gathered,
    hashes,
    mixed,
    packed_words,
    unpacked_words,
)
from flightlens.operators.lookup import KeyCounts, count_keys, join_lookup
from flightlens.session import materialise
from flightlens.settings import Scaling

# Bytes that end a piece, and bytes between words.
BREAKS = ".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = "\x20\x09"

#: Suffixes a bucket should have, and slots that leading words are counted in.
IN_BUCKET = 1_000_000
SLOTS = 1 << 16
#: A task reports the slots that hold at least this share of its own suffixes.
REPORTED = 1 / 8192
#: Frequent phrases that a lookup may broadcast.
LOOKUP = Scaling(broadcast_rows=100_000)

_BREAKS = byte_class(BREAKS)
_INSIDE = ~(_BREAKS | byte_class(BLANKS))


class Suffixes:
    """The suffixes of some texts, one per word occurrence."""

    def __init__(self, rows: list[dict], longest: int) -> None:
        found = cut_words([r["text"] for r in rows], _INSIDE, _BREAKS)
        self._langs, lang = np.unique([r["lang"] for r in rows], return_inverse=True)
        self._lang, self._plain, self._ids, self._longest = lang[found.text], found.table, found.ids, longest
        # Whether the word so many places on is in the same piece.
        self._same = [found.piece[depth:] == found.piece[:-depth] for depth in range(1, longest)]
        self._hash = hashes(found.table)
        of_lang = hashes(pa.array([name.encode() for name in self._langs.tolist()], pa.binary()))
        self.lead_hash = mixed(of_lang[self._lang], self._hash[found.ids])

    def per_lang(self) -> dict[str, int]:
        return dict(zip(self._langs.tolist(), np.bincount(self._lang, minlength=len(self._langs)).tolist(), strict=True))

    def lead_hashes(self) -> Iterator[np.ndarray]:
        """Hashes of the first word, the first two and so on, of the suffixes that are longer."""
        made = self.lead_hash
        yield made
        for depth in range(1, self._longest - 1):
            made = mixed(made[:-1], self._hash[self._ids[depth:]]) if depth < len(self._ids) else made[:0]
            yield made[self._same[depth - 1]]

    def counted(self) -> tuple[np.ndarray, np.ndarray, list[bytes], list[np.ndarray]]:
        """Distinct suffixes (the word at every depth, 0 past the end), their counts, the words
        that the numbers stand for, and hashes of the leading words.

        The leading word carries the language, so that one table serves all.
        """
        number = len(self._plain)
        leads, first = np.unique(self._lang * number + self._ids, return_inverse=True)
        columns = [first + 1]
        for depth, same in enumerate(self._same, 1):
            column = np.zeros(len(first), np.int64)
            column[: len(same)] = np.where(same, self._ids[depth:] + 1 + len(leads), 0)
            columns.append(column)
        words, code = np.array(columns), columns[-1]
        for column in columns[-2::-1]:
            _, at, code, count = np.unique((column << 32) | code, return_index=True, return_inverse=True, return_counts=True)
        if len(columns) == 1:
            _, at, count = np.unique(code, return_index=True, return_counts=True)
        words = words[:, at]
        made = [self.lead_hash[at]]
        known = np.concatenate((np.zeros(1 + len(leads), np.uint64), self._hash))
        for column in words[1:]:
            made.append(mixed(made[-1], known[column]))
        plain, prefix = self._plain.to_pylist(), [name.encode() + b"\n" for name in self._langs.tolist()]
        table = [b"", *[prefix[one // number] + plain[one % number] for one in leads.tolist()], *plain]
        return words, count, table, made


def lead_counts(texts: DataFrame, longest: int) -> DataFrame:
    """(depth, lang, slot, n): words per language (depth 0), and suffixes per slot of
    their leading ``depth`` words, without the slots of little weight."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, per_lang = np.zeros((longest - 1, SLOTS), np.int64), {}
        for rows in gathered(batches, "text"):
            made = Suffixes(rows, longest)
            for name, n in made.per_lang().items():
                per_lang[name] = per_lang.get(name, 0) + n
            for depth, code in zip(range(longest - 1), made.lead_hashes(), strict=False):
                slots[depth] += np.bincount((code % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
        depth, slot = np.nonzero(slots > REPORTED * max(1, slots[:1].sum()))
        yield pa.RecordBatch.from_pydict(
            {
                "depth": pa.array([0] * len(per_lang) + (depth + 1).tolist(), pa.int32()),
                "lang": pa.array([*per_lang, *[None] * len(slot)], pa.string()),
                "slot": pa.array([0] * len(per_lang) + slot.tolist(), pa.int32()),
                "n": pa.array([*per_lang.values(), *slots[depth, slot].tolist()], pa.int64()),
            }
        )

    found = texts.mapInArrow(count, "depth int, lang string, slot int, n bigint")
    return found.groupBy("depth", "lang", "slot").agg(F.sum("n").alias("n"))


def phrase_counts(docs: DataFrame, longest: int, least: int, in_bucket: int = IN_BUCKET) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, size, n) of every frequent phrase of 1 to ``longest`` words, (lang, n) of all words)."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = docs.select(text.alias("text"), lang.alias("lang"))
    leads = work_table(lead_counts(texts, longest), "phrase-leads")
    totals = leads.where("depth = 0").select("lang", "n")
    whole = totals.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-whole // in_bucket))
    # At most two slots per bucket and depth are this heavy.
    heavy = leads.where((F.col("depth") > 0) & (F.col("n") > in_bucket // 2)).collect()
    parts = np.ones((longest, SLOTS), np.int64)
    for row in heavy:
        parts[row["depth"] - 1, row["slot"]] = -(-row["n"] // (in_bucket // 2))
    split = docs.sparkSession.sparkContext.broadcast(parts)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches, "text"):
            words, count, table, code = Suffixes(rows, longest).counted()
            if not len(count):
                continue
            # How many leading words are shared out over several buckets.
            level = np.zeros(len(count), np.int64)
            by = code[0] % np.uint64(SLOTS)
            for depth in range(1, longest):
                share = split.value[depth - 1, (code[depth - 1] % np.uint64(SLOTS)).astype(np.int64)]
                spread = (level == depth - 1) & (share > 1)
                level[spread] = depth
                by = np.where(spread, mixed(code[depth - 1], code[depth] % share.astype(np.uint64)), by)
            bucket = (mixed(by, by) % np.uint64(buckets)).astype(np.int64)
            place = bucket * longest + level
            order = np.argsort(place, kind="stable")
            ends = np.flatnonzero(np.diff(np.concatenate((place[order], [-1])))) + 1
            out, begin = [], 0
            for end in ends.tolist():
                taken = order[begin:end]
                used, local = np.unique(words[:, taken], return_inverse=True)
                letters, lengths = packed_words([table[i] for i in used.tolist()])
                local = local.reshape(longest, -1).astype("<i4")
                out.append((int(bucket[taken[0]]), int(level[taken[0]]), letters, lengths, local.tobytes(), count[taken].astype("<i4").tobytes()))
                begin = end
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), *[pa.binary()] * 4), strict=True)],
                names=["bucket", "level", "letters", "lengths", "words", "counts"],
            )

    def sort(table: pa.Table) -> pa.Table:
        parts = table.to_pydict()
        joined = unpacked_words(parts["letters"], parts["lengths"]).dictionary_encode()
        code = joined.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        word = joined.dictionary.to_pylist()
        ended = word.index(b"") if b"" in word else -1
        first = np.cumsum([0, *[len(x) // 4 for x in parts["lengths"]]])
        blocks = [first[i] + np.frombuffer(x, "<i4").reshape(longest, -1) for i, x in enumerate(parts["words"])]
        keys = code[np.concatenate(blocks, axis=1)]
        weights = np.frombuffer(b"".join(parts["counts"]), "<i4").astype(np.int64)
        levels = np.repeat(parts["level"], [b.shape[1] for b in blocks])
        columns: dict[str, list] = {"lang": [], "phrase": [], "size": [], "n": []}
        for level in np.unique(levels).tolist():
            mine = np.flatnonzero(levels == level)
            # What is shared out over buckets is counted in parts, which may be light.
            bound = np.array([1] * level + [least] * (longest - level))
            for part in equal_partitions(keys[:, mine], weights[mine], bound, ended):
                one = mine[part.items[part.starts]]
                for size, row, n in zip(part.depth.tolist(), keys[:, one].T.tolist(), part.weights.tolist(), strict=True):
                    lang, _, lead = word[row[0]].rpartition(b"\n")
                    columns["lang"].append(lang)
                    columns["phrase"].append(b" ".join([lead, *[word[w] for w in row[1:size]]]))
                    columns["size"].append(size)
                    columns["n"].append(n)
        kinds = {"lang": pa.binary(), "phrase": pa.binary(), "size": pa.int32(), "n": pa.int64()}
        made = pa.table({name: pa.array(values, kinds[name]) for name, values in columns.items()})
        return made.cast(pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("n", pa.int64())]))

    routed = texts.mapInArrow(route, "bucket int, level int, letters binary, lengths binary, words binary, counts binary")
    counted = routed.groupBy("bucket").applyInArrow(sort, "lang string, phrase string, size int, n bigint")
    summed = counted.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
    return work_table(summed.where(F.col("n") >= least), "phrase-counts"), totals


def _joined(words: Column, start: int | Column, length: int | Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored(counts: DataFrame, millionths: int = 1_000_000, scaling: Scaling = LOOKUP) -> DataFrame:
    """(lang, phrase, size, a, l, r, score): the lowest-scoring cut of every frequent phrase of two words or more."""
    words = F.split("phrase", " ")
    wanted = counts.where("size >= 2").withColumnRenamed("n", "a")
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    cuts, _ = materialise(
        wanted.select("*", cut.alias("k")).select(
            "*",
            _joined(words, F.lit(1), F.col("k")).alias("first"),
            _joined(words, F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
        )
    )
    for part, name in (("first", "l"), ("rest", "r")):
        lookup = counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
        keys = count_keys(cuts, ["lang", part])
        used = lookup.join(keys.table, ["lang", part], "left_semi")
        cuts = join_lookup(cuts, used, KeyCounts(keys.table, ("lang", part), keys.size), scaling)
    a, l, r = (F.col(c).cast("decimal(38,0)") for c in ("a", "l", "r"))
    score = F.call_function("div", a * a * F.lit(millionths).cast("decimal(7,0)"), l * r)
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("_low")
    return cuts.groupBy("lang", "phrase", "size", "a").agg(lowest).select(
        "lang", "phrase", "size", "a", "_low.l", "_low.r", "_low.score"
    )


def absorbed(counts: DataFrame, percent: int = 50) -> DataFrame:
    """(lang, phrase) of the frequent phrases that a longer one holds too often."""
    words = F.split("phrase", " ")
    spans = F.explode(
        F.flatten(
            F.transform(
                F.sequence(F.lit(2), F.col("size") - 1),
                lambda size: F.transform(
                    F.sequence(F.lit(1), F.col("size") - size + 1), lambda start: _joined(words, start, size)
                ),
            )
        )
    )
    longer = counts.where("size >= 3").select("lang", spans.alias("phrase"), "n")
    most = longer.groupBy("lang", "phrase").agg(F.max("n").alias("_longer"))
    met = counts.where("size >= 2").join(most, ["lang", "phrase"])
    return met.where(F.col("_longer") * 100 >= F.col("n") * percent).select("lang", "phrase")


def collocations(
    docs: DataFrame, longest: int = 3, least: int = 10, percent: int = 50, first: int = 2000, in_bucket: int = IN_BUCKET
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of every language.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its lowest-scoring cut, ``n`` all words.
    """
    small_batches(docs.sparkSession, 256)
    counts, totals = phrase_counts(docs, longest, least, in_bucket)
    free = scored(counts).join(absorbed(counts, percent), ["lang", "phrase"], "left_anti")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = free.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= first)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )

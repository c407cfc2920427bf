"""Approximate nearest neighbours: a graph by NN-descent, queries by greedy search.

Nodes are the distinct vectors; of equal vectors the k + 1 smallest ids are kept,
which is all a query for k neighbours can return.

Graph: vectors in the order of random hyperplane codes give first neighbours;
then every node brings its neighbours (and some of those that name it) together,
pairs of them are compared, and each node keeps its ``DEGREE`` best.  A round is
joins and one grouping by node, of at most DEGREE + REVERSE + 1 rows, so a node
that many others name is no hot group.  Nodes are compared on a sphere (one added
component), where nearness and inner product agree.  Direction, length and added
component are held apart, so a few very long vectors take no digits from the others.

Search: a query keeps a beam of its best nodes, starts at a bounded set of entry
nodes (half of them the longest vectors, which are few vectors' near neighbours)
and at its own vector if that is indexed, and expands the best nodes it has
not expanded, until all of its beam is.  The nodes of the beam are scored again
exactly, in double precision on the original vectors.

Nulls and edge cases: rows with a null id, a null, empty or zero vector, or null
or non-finite components take no part, nor do vectors of another length than the
commonest one (the largest of equals).  Ties go to the smaller id.  A query never
returns its own id; a row repeated with the same id and vector counts once, the
same id with several vectors is several candidates, and as a query takes the
smallest of them.  With fewer candidates than k all found are returned.  Other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlens.llm.common import work_table
from flightlens.llm.pivots import usable

DEGREE = 30
REVERSE = 20
ORDERS = 4
GROUP = 48
ROUNDS = 8
BEAM = 64
WIDTH = 16
ENTRIES = 64
_PAIRS_AT_ONCE = 256
_RESULT = "query_id bigint, rank int, vec_id bigint, score double"
_EDGES = "node bigint, near bigint, score double"


def _packed(vector: Column, kind: str) -> Column:
    """Vectors as bytes of a numpy type."""

    @F.pandas_udf("binary")
    def pack(vectors: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(v, np.float64).astype(kind).tobytes() for v in vectors], dtype=object)

    return pack(vector)


def _on_sphere(vector: Column, top: float) -> Column:
    """Length and added component (doubles, in units of the largest length), then the direction (floats), as bytes."""

    @F.pandas_udf("binary")
    def pack(vectors: pd.Series) -> pd.Series:
        made = []
        for v in vectors:
            v = np.asarray(v, np.float64)
            square = v @ v
            length = np.sqrt(square)
            lift = np.sqrt(max(0.0, 1.0 - square / top))
            made.append(np.array([length / np.sqrt(top), lift]).tobytes() + (v / length).astype("<f4").tobytes())
        return pd.Series(made, dtype=object)

    return pack(vector)


def _from_sphere(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, added components and directions of packed nodes."""
    raw = np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)
    ends = np.ascontiguousarray(raw[:, :16]).view("<f8")
    return ends[:, 0], ends[:, 1], np.ascontiguousarray(raw[:, 16:]).view("<f4")


def _unpacked(values: list[bytes], kind: str) -> np.ndarray:
    return np.stack([np.frombuffer(v, kind) for v in values]).astype(np.float32)


def distinct_nodes(vectors: DataFrame, k: int) -> DataFrame:
    """(node, ids, vector, packed) of the distinct vectors."""
    squared = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    kept = vectors.where(F.col("id").isNotNull() & usable(F.col("vector"))).select(
        F.col("id").cast("bigint").alias("id"), F.transform("vector", lambda x: x.cast("double")).alias("vector")
    )
    kept = kept.where(squared > 0)
    lengths = kept.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("rows"), F.max(squared).alias("top"))
    chosen = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    size, top = (chosen["n"], float(chosen["top"])) if chosen else (0, 1.0)
    first = F.dense_rank().over(Window.partitionBy("vector").orderBy("id"))
    few = kept.where(F.size("vector") == size).withColumn("_place", first).where(F.col("_place") <= k + 1)
    nodes = few.groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    nodes = nodes.select(F.col("ids")[0].alias("node"), "ids", "vector")
    # One id may stand for several vectors: the node number tells them apart.
    copies = F.row_number().over(Window.partitionBy("node").orderBy("vector"))
    nodes = nodes.withColumn("_copy", copies)
    number = F.when(F.col("_copy") == 1, F.col("node")).otherwise(F.xxhash64("node", "vector"))
    nodes = nodes.select(number.alias("node"), "ids", "vector", _on_sphere(F.col("vector"), top).alias("packed"))
    return work_table(nodes, "ann-nodes")


def _best_of_groups(members: list[np.ndarray], packed: list[list[bytes]], bounds: list[np.ndarray] | None, most: int) -> pd.DataFrame:
    """For each member of each group its ``most`` best others above its bound."""
    size = max(len(m) for m in members)
    ids = np.full((len(members), size), -1, np.int64)
    wide = (len(packed[0][0]) - 16) // 4
    x = np.zeros((len(members), size, wide), np.float32)
    length, lift = np.zeros((2, len(members), size))
    least = np.full((len(members), size), np.inf)
    for i, m in enumerate(members):
        ids[i, : len(m)] = m
        length[i, : len(m)], lift[i, : len(m)], x[i, : len(m)] = _from_sphere(packed[i])
        least[i, : len(m)] = -np.inf if bounds is None else bounds[i]
    # Minus the squared distance; the difference of two added components is small against them.
    cosine = (x @ x.transpose(0, 2, 1)).astype(np.float64)
    a, b = length[:, :, None], length[:, None, :]
    score = -((a - b) ** 2 + (lift[:, :, None] - lift[:, None, :]) ** 2 + 2 * a * b * np.maximum(0.0, 1 - cosine))
    there = np.arange(size)[None, :] < np.array([len(m) for m in members])[:, None]
    score[~np.broadcast_to(there[:, None, :], score.shape)] = -np.inf
    score[:, np.arange(size), np.arange(size)] = -np.inf
    if size > most:
        kth = np.partition(score, size - most, axis=2)[:, :, size - most]
        wanted = (score >= kth[:, :, None]) & (score > least[:, :, None])
    else:
        wanted = score > least[:, :, None]
    g, a, b = np.nonzero(wanted & (score > -np.inf))
    return pd.DataFrame({"node": ids[g, a], "near": ids[g, b], "score": score[g, a, b]})


def _best_edges(edges: DataFrame, degree: int) -> DataFrame:
    once = edges.groupBy("node", "near").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "near"))
    return once.withColumn("_place", place).where(F.col("_place") <= degree).drop("_place")


def first_graph(nodes: DataFrame, orders: int = ORDERS, group: int = GROUP, degree: int = DEGREE) -> DataFrame:
    """Neighbours within short stretches of the vectors sorted by hyperplane codes.

    Equal codes are ordered by a projection, so a range never holds one key only.
    """

    def coded(seed: int) -> Column:
        @F.pandas_udf("code bigint, along double")
        def code(packed: pd.Series) -> pd.DataFrame:
            if not len(packed):
                return pd.DataFrame({"code": [], "along": []})
            length, _, x = _from_sphere(list(packed))
            planes = np.random.default_rng(seed).normal(size=(x.shape[1], 25)).astype(np.float32)
            side = x @ planes
            bits = (side[:, :24] > 0).astype(np.int64) @ (1 << np.arange(24)[::-1])
            return pd.DataFrame({"code": bits, "along": side[:, 24] * length})

        return code("packed")

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            ids, packed = rows["node"].to_numpy(), list(rows["packed"])
            for at in range(0, len(ids), group * 16):
                cuts = range(at, min(at + group * 16, len(ids)), group)
                yield _best_of_groups([ids[c : c + group] for c in cuts], [packed[c : c + group] for c in cuts], None, degree)

    found = None
    for seed in range(orders):
        keyed = nodes.select("node", "packed", coded(seed).alias("key")).select("node", "packed", "key.*")
        dealt = keyed.repartitionByRange("code", "along", "node").sortWithinPartitions("code", "along", "node")
        part = dealt.select("node", "packed").mapInPandas(stretches, _EDGES)
        found = part if found is None else found.unionByName(part)
    return work_table(_best_edges(found, degree), "ann-graph")


def descend(graph: DataFrame, nodes: DataFrame, turn: int, degree: int = DEGREE, reverse: int = REVERSE) -> DataFrame:
    """One round: neighbours of one node are compared with each other."""
    back = graph.select(F.col("near").alias("at"), F.col("node").alias("member"))
    place = F.row_number().over(Window.partitionBy("at").orderBy(F.xxhash64("at", "member", F.lit(turn))))
    back = back.withColumn("_place", place).where(F.col("_place") <= reverse).drop("_place")
    ahead = graph.select(F.col("node").alias("at"), F.col("near").alias("member"))
    own = nodes.select(F.col("node").alias("at"), F.col("node").alias("member"))
    met = ahead.unionByName(back).unionByName(own).distinct()
    full = F.when(F.count(F.lit(1)) == degree, F.min("score"))
    bound = graph.groupBy("node").agg(full.alias("bound"))
    known = nodes.select("node", "packed").join(bound, "node", "left").withColumnRenamed("node", "member")
    groups = met.join(known, "member").groupBy("at").agg(
        F.collect_list(F.struct("member", "packed", F.coalesce("bound", F.lit(float("-inf"))).alias("bound"))).alias("g")
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            groups = [g for g in rows["g"] if len(g) > 1]
            for at in range(0, len(groups), _PAIRS_AT_ONCE):
                some = groups[at : at + _PAIRS_AT_ONCE]
                yield _best_of_groups(
                    [np.array([m["member"] for m in g]) for g in some],
                    [[m["packed"] for m in g] for g in some],
                    [np.array([m["bound"] for m in g]) for g in some],
                    degree,
                )

    fresh = groups.select("g").mapInPandas(compare, _EDGES)
    return work_table(_best_edges(graph.unionByName(fresh), degree), "ann-graph")


def build(nodes: DataFrame, rounds: int = ROUNDS, degree: int = DEGREE, settled: float = 0.02) -> DataFrame:
    """The graph, descended until a round changes at most ``settled`` of its edges."""
    graph = first_graph(nodes, degree=degree)
    for turn in range(rounds):
        better = descend(graph, nodes, turn, degree)
        fresh = better.join(graph, ["node", "near"], "left_anti").count()
        total = better.count()
        graph = better
        if fresh <= settled * total:
            break
    return graph


def search(vectors: DataFrame, queries: DataFrame, k: int, beam: int = BEAM, width: int = WIDTH, entries: int = ENTRIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found by inner product for each query."""
    spark = vectors.sparkSession
    nodes = distinct_nodes(vectors, k)
    squared = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    longest = nodes.orderBy(F.desc(squared), "node").limit(entries).select("node", "vector").toPandas()
    first = nodes.orderBy(F.xxhash64("node"), "node").limit(entries).select("node", "vector").toPandas()
    first = pd.concat([first, longest]).drop_duplicates("node", ignore_index=True)
    if not len(first):
        return spark.createDataFrame([], _RESULT)
    graph = build(nodes)
    size = len(first["vector"][0])
    asked = queries.where(F.col("id").isNotNull() & usable(F.col("vector"))).select(
        F.col("id").cast("bigint").alias("query_id"), F.transform("vector", lambda x: x.cast("double")).alias("vector")
    )
    asked = asked.where((F.size("vector") == size) & F.exists("vector", lambda x: x != 0))
    asked = asked.groupBy("query_id").agg(F.min("vector").alias("vector"))
    own = nodes.select("vector", F.col("node").alias("own"))
    asked = work_table(asked.join(own, "vector", "left"), "ann-queries")
    entry_ids, entry = first["node"].to_numpy(), np.stack(first["vector"].to_numpy())
    beams = "query_id bigint, packed binary, nodes array<bigint>, scores array<double>, done array<boolean>"

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            made = []
            for i, vector, node in zip(rows["query_id"], rows["vector"], rows["own"], strict=True):
                vector = np.asarray(vector, np.float64)
                known = dict(zip(entry_ids.tolist(), (entry @ vector).tolist(), strict=True))
                if not pd.isna(node):
                    known[int(node)] = float(vector @ vector)
                best = sorted(known.items(), key=lambda x: (-x[1], x[0]))[:beam]
                made.append((i, vector.astype("<f4").tobytes(), [n for n, _ in best], [s for _, s in best], [False] * len(best)))
            yield pd.DataFrame(made, columns=["query_id", "packed", "nodes", "scores", "done"])

    state = work_table(asked.select("query_id", "vector", F.col("own").cast("string").alias("own")).mapInPandas(start, beams), "ann-beams")
    adjacent = graph.groupBy("node").agg(F.collect_list("near").alias("near"))
    adjacent = work_table(adjacent, "ann-lists")
    packed = work_table(nodes.select(F.col("node").alias("near"), _packed(F.col("vector"), "<f4").alias("vector")), "ann-vectors")

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            made = []
            for i, q, held, scores, done, met in zip(*(rows[c] for c in rows.columns), strict=True):
                left = [n for n, d in enumerate(done) if not d][:width]
                known = {n: (s, d or at in left) for at, (n, s, d) in enumerate(zip(held, scores, done, strict=True))}
                if met is not None and len(met):
                    values = _unpacked([m["vector"] for m in met], "<f4") @ np.frombuffer(q, "<f4")
                    for m, s in zip(met, values.tolist(), strict=True):
                        known.setdefault(m["near"], (s, False))
                best = sorted(known.items(), key=lambda x: (-x[1][0], x[0]))[:beam]
                made.append((i, q, [n for n, _ in best], [v[0] for _, v in best], [v[1] for _, v in best]))
            yield pd.DataFrame(made, columns=["query_id", "packed", "nodes", "scores", "done"])

    open_ = F.filter(F.arrays_zip("nodes", "done"), lambda x: ~x["done"])
    while True:
        pending = state.where(F.exists("done", lambda d: ~d))
        if pending.isEmpty():
            break
        expanded = pending.select("query_id", F.explode(F.slice(open_, 1, width)["nodes"]).alias("node"))
        met = expanded.join(adjacent, "node").select("query_id", F.explode("near").alias("near")).distinct()
        met = met.join(packed, "near").groupBy("query_id").agg(F.collect_list(F.struct("near", "vector")).alias("met"))
        state = work_table(
            state.join(met, "query_id", "left").select("query_id", "packed", "nodes", "scores", "done", "met").mapInPandas(merge, beams),
            "ann-beams",
        )

    found = state.select("query_id", F.explode("nodes").alias("node")).join(nodes.select("node", "ids", F.col("vector").alias("other")), "node")
    found = found.join(asked.select("query_id", "vector"), "query_id")

    @F.pandas_udf("double")
    def product(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([float(np.dot(np.asarray(a), np.asarray(b))) for a, b in zip(left, right, strict=True)], dtype="float64")

    scored = found.select("query_id", "ids", product("vector", "other").alias("score"))
    rows = scored.select("query_id", F.explode("ids").alias("vec_id"), "score").where(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

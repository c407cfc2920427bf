"""Exact top-k by inner product with a pivot-distance index.

Vectors are placed on a sphere by one added component, sqrt(M - |x|^2) with M the
largest squared length; the order by distance from a query (added component 0)
is then the order by inner product: |q' - x'|^2 = |q|^2 + M - 2 q.x.

Index: a bounded number of pivots is taken from the vectors; every vector is
keyed by its nearest pivot and its distance from it, and each pivot's vectors are
cut into annuli by distance.  Search, in two rounds:

1. A query looks into the annuli around its own distance from its nearest
   pivots, which gives a lower bound of its k-th best score.
2. That bound is a radius r, and by the triangle inequality an annulus [a, b] of
   pivot p can hold a better vector only if a - r <= |q' - p| <= b + r.  Only
   those annuli are opened, and only scores that reach the bound come out.

Pivots and annuli are bounded in number, so what is broadcast is bounded; a large
annulus is dealt over many cells of at most about ``CELL_ROWS`` rows.  Scores are
exact (the caller's vectors are whole numbers, added as 64-bit integers or
doubles without rounding); distances only prune, with a margin for rounding.

Nulls and edge cases: rows with a null id, a null vector or null or non-finite
components take no part.  Vectors of several lengths have an index for each length, and
a query is answered from its own.  Ties go to the smaller id.  Of repeated rows with one
id each is a candidate; none is a candidate for its own id; a query repeated as a row is
answered once for each length, for its smallest vector.  With fewer candidates than k all
are returned.  Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlens.llm.common import work_table

PIVOTS = 16
ANNULI = 8
CELL_ROWS = 8_192
_MARGIN = 1e-6


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))


def usable(vector: Column) -> Column:
    """True for a vector without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack(values.to_numpy()).astype(np.float64) if len(values) else np.zeros((0, 1))


def _lifted(x: np.ndarray, top: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0.0, top - (x * x).sum(1)))
    return np.hstack([x, rest[:, None]])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(0.0, square))


class Index:
    """The vectors in cells, and the bounded description of the annuli."""

    def __init__(self, cells: DataFrame, pivots: np.ndarray, top: float, annuli: pd.DataFrame) -> None:
        self.cells, self.pivots, self.top, self.annuli = cells, pivots, top, annuli


def build(vectors: DataFrame, pivots: int = PIVOTS, annuli: int = ANNULI) -> Index | None:
    """Index (id, vector) rows; None if no row is usable."""
    spark = vectors.sparkSession
    kept = vectors.where(F.col("id").isNotNull() & usable(F.col("vector")))
    lengths = kept.groupBy(F.size("vector").alias("n")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("top"),
    )
    chosen = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    if chosen is None:
        return None
    kept = kept.where(F.size("vector") == chosen["n"])
    top = float(chosen["top"]) * (1 + 1e-12)
    picked = kept.orderBy(F.xxhash64("id"), "id").limit(pivots).toPandas()
    centres = _lifted(_matrix(picked["vector"]), top)
    shared = spark.sparkContext.broadcast(centres)

    @F.pandas_udf("pivot int, distance double")
    def place(vector: pd.Series) -> pd.DataFrame:
        found = _distances(_lifted(_matrix(vector), top), shared.value)
        near = found.argmin(1)
        return pd.DataFrame({"pivot": near, "distance": found[np.arange(len(near)), near]})

    placed = kept.select("id", F.col("vector").cast("array<double>").alias("vector"))
    placed = placed.withColumn("at", place("vector")).select("id", "vector", "at.pivot", "at.distance")
    placed = work_table(placed, "pivots")
    shares = [i / annuli for i in range(1, annuli)] or [0.5]
    cuts = placed.groupBy("pivot").agg(
        F.percentile_approx("distance", shares, 1_000).alias("cuts"), F.count(F.lit(1)).alias("rows")
    )
    number = F.aggregate("cuts", F.lit(0), lambda n, c: n + (F.col("distance") > c).cast("int"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rows") / F.lit(annuli * CELL_ROWS))).cast("int")
    dealt = placed.join(F.broadcast(cuts), "pivot").select(
        "id", "vector", "pivot", "distance", number.alias("annulus"), F.pmod(F.xxhash64("id"), parts).alias("part")
    )
    cells = work_table(dealt, "pivot-cells")
    described = (
        cells.groupBy("pivot", "annulus")
        .agg(F.min("distance").alias("near"), F.max("distance").alias("far"), (F.max("part") + 1).alias("parts"))
        .toPandas()
    )
    return Index(cells, centres, top, described.sort_values(["pivot", "annulus"]).reset_index(drop=True))


def _open_cells(index: Index, queries: DataFrame, first: bool, k: int) -> DataFrame:
    """One row per query and cell to open: in the first round the home annuli, then what the bound leaves."""
    pivots, top, annuli = index.pivots, index.top, index.annuli
    of_pivot, near, far = (annuli[c].to_numpy() for c in ("pivot", "near", "far"))
    number, parts = annuli["annulus"].to_numpy(), annuli["parts"].to_numpy()

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if not len(rows):
                continue
            q = np.hstack([_matrix(rows["vector"]), np.zeros((len(rows), 1))])
            to_pivot = _distances(q, pivots)[:, of_pivot]
            outside = np.maximum(0.0, np.maximum(near - to_pivot, to_pivot - far))
            home = np.argsort(outside, axis=1, kind="stable")[:, :2]
            at_home = np.zeros(outside.shape, bool)
            np.put_along_axis(at_home, home, True, 1)
            if first:
                wanted = at_home
            else:
                square = (q * q).sum(1) + top - 2 * rows["bound"].fillna(-np.inf).to_numpy()
                radius = np.sqrt(np.maximum(0.0, square))
                wanted = outside <= (radius * (1 + _MARGIN) + _MARGIN * np.sqrt(top))[:, None]
                wanted &= ~at_home
            query, annulus = np.nonzero(wanted)
            times = parts[annulus]
            query, annulus = np.repeat(query, times), np.repeat(annulus, times)
            part = np.arange(len(query)) - np.repeat(np.cumsum(times) - times, times)
            yield pd.DataFrame(
                {
                    "query_id": rows["query_id"].to_numpy()[query],
                    "bound": rows["bound"].to_numpy()[query],
                    "vector": rows["vector"].to_numpy()[query],
                    "pivot": of_pivot[annulus],
                    "annulus": number[annulus],
                    "part": part,
                }
            )

    schema = "query_id bigint, bound double, vector array<double>, pivot int, annulus int, part bigint"
    return queries.select("query_id", "bound", "vector").mapInPandas(choose, schema)


def best_of_block(
    query_ids: np.ndarray, q: np.ndarray, bounds: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, whole: bool = False
) -> pd.DataFrame:
    """The k best rows of a block for each query, ties to the smaller id, not below the bound."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    none = -np.inf
    if whole and np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * x.shape[1] >= 2.0**53:
        # Sums wrap around on the way and come out right where they fit.
        q, x, none = q.astype(np.int64), x.astype(np.int64), np.iinfo(np.int64).min
        # The bound is a sum too, rounded to a double.
        bounds = np.nextafter(bounds, -np.inf)
    found = []
    for at in range(0, len(q), 256):
        rows = slice(at, at + 256)
        score = q[rows] @ x.T
        score[query_ids[rows, None] == ids[None, :]] = none
        keep = min(k, score.shape[1])
        kth = np.partition(score, score.shape[1] - keep, axis=1)[:, score.shape[1] - keep]
        wanted = (score >= kth[:, None]) & (score.astype(np.float64) >= bounds[rows][:, None]) & (score > none)
        row, col = np.nonzero(wanted)
        # Rows come in order of id: of equal scores the first ones are kept.
        sort = np.lexsort((-col, score[row, col], -row))[::-1]
        row, col = row[sort], col[sort]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        row, col = row[place < k], col[place < k]
        found.append((query_ids[rows][row], ids[col], score[row, col]))
    ids_, vecs, scores = (np.concatenate(c) for c in zip(*found, strict=True))
    return pd.DataFrame({"query_id": ids_, "vec_id": vecs, "score": scores.astype(np.int64) if whole else scores})


def _search_cells(index: Index, opened: DataFrame, k: int, whole: bool) -> DataFrame:
    """Scores of the opened cells: each cell meets the queries that open it."""

    def score(queries: pd.DataFrame, cell: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(cell):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        bounds = queries["bound"].fillna(-np.inf).to_numpy(np.float64)
        return best_of_block(
            queries["query_id"].to_numpy(), _matrix(queries["vector"]), bounds, cell["id"].to_numpy(), _matrix(cell["vector"]), k, whole
        )

    keys = ["pivot", "annulus", "part"]
    return (
        opened.groupBy(*keys).cogroup(index.cells.groupBy(*keys)).applyInPandas(score, f"query_id bigint, vec_id bigint, score {_kind(whole)}")
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    """Per query its k best rows; a cell has sent at most k."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _kind(whole: bool) -> str:
    return "bigint" if whole else "double"


def search(
    vectors: DataFrame, queries: DataFrame, k: int, pivots: int = PIVOTS, annuli: int = ANNULI, whole: bool = False
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best by inner product for each query.

    ``vectors`` and ``queries`` have columns id and vector; a query's own id is
    no candidate.  With ``whole`` the components are whole numbers, and the scores too.
    """
    asked = queries.where(F.col("id").isNotNull() & usable(F.col("vector")))
    # An inner product needs two vectors of one length; a table has few lengths.
    lengths = sorted(r["n"] for r in asked.select(F.size("vector").alias("n")).distinct().collect())
    found = []
    for n in lengths:
        index = build(vectors.where(F.size("vector") == n), pivots, annuli)
        if index is not None:
            found.append(_answers(index, asked.where(F.size("vector") == n), k, whole))
    if not found:
        return vectors.sparkSession.createDataFrame([], f"query_id bigint, rank int, vec_id bigint, score {_kind(whole)}")
    return functools.reduce(DataFrame.unionByName, found)


def _answers(index: Index, asked: DataFrame, k: int, whole: bool) -> DataFrame:
    asked = asked.groupBy("id").agg(F.min(F.col("vector").cast("array<double>")).alias("vector"))
    asked = work_table(
        asked.select(F.col("id").cast("bigint").alias("query_id"), "vector", F.lit(None).cast("double").alias("bound")),
        "pivot-queries",
    )
    first = work_table(_best(_search_cells(index, _open_cells(index, asked, True, k), k, whole), k), "pivot-first")
    bounds = first.where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("bound"))
    bounded = asked.drop("bound").join(bounds, "query_id", "left")
    rest = _search_cells(index, _open_cells(index, bounded, False, k), k, whole)
    return _best(first.drop("rank").unionByName(rest), k).select("query_id", "rank", "vec_id", "score")

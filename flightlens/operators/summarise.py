"""Aggregate expressions and the weighted median."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlens.functions import numeric
from flightlens.operators.lookup import ROWS, null_safe_join
from flightlens.operators.rank import ranks_from_counts, require_number
from flightlens.settings import SCALING, Scaling


def row_count() -> Column:
    return F.count(F.lit(1))


def mean_speed(column: str = "velocity_kmh") -> Column:
    return numeric.mean(F.sum(column), F.count(column))


def mean_altitude(column: str) -> Column:
    exact = numeric.summable(F.col(column))
    return numeric.mean(F.sum(exact), F.count(exact))


def distinct(column: str, approximate: bool = False) -> Column:
    return F.approx_count_distinct(column) if approximate else F.count_distinct(column)


def lower_median(
    df: DataFrame,
    groups: Sequence[str],
    metric: str,
    median: str,
    sizes: DataFrame,
    count: str,
    scaling: Scaling = SCALING,
) -> DataFrame:
    """The median as an actual element (the lower of two middles), exact at any size.

    ``sizes`` is written already and has the number of rows of each group.  A
    group of fewer than ``rows_per_salt`` rows has a value map that fits a task,
    so one aggregate does it.  Larger groups are counted by value over many
    tasks instead.
    """
    require_number(df, metric)
    # Raised with the number of rows until the large groups fit the checked broadcast.
    total = sizes.agg(F.sum(count)).first()[0] or 0
    limit = max(scaling.rows_per_salt, -(-total // scaling.hot_keys))
    hot = sizes.filter(F.col(count) >= limit).select(*groups)
    if hot.isEmpty():
        return _median_by_map(df, groups, metric, median)
    hot = F.broadcast(hot)
    ordinary = _median_by_map(null_safe_join(df, hot, groups, "left_anti"), groups, metric, median)
    large = _median_by_counts(null_safe_join(df, hot, groups, "left_semi"), groups, metric, median)
    return ordinary.unionByName(large)


def _median_by_map(df: DataFrame, groups: Sequence[str], metric: str, median: str) -> DataFrame:
    kind = df.schema[metric].dataType
    middle = F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {metric})")
    return df.groupBy(*groups).agg(middle.cast(kind).alias(median))


def _median_by_counts(df: DataFrame, groups: Sequence[str], metric: str, median: str) -> DataFrame:
    counts = df.groupBy(*groups, metric).agg(F.count(F.lit(1)).alias(ROWS))
    return _middle_of_counts(counts, groups, metric, median)


def median_from_counts(counts: DataFrame, groups: Sequence[str], metric: str, median: str) -> DataFrame:
    """The lower median of every group from its rows per value, NULL where no row has a value.

    Counts of parts of the rows can be added up before, so the median of a whole
    needs no row of its parts.
    """
    middles = _middle_of_counts(counts, groups, metric, median)
    return null_safe_join(counts.select(*groups).distinct(), middles, groups, "left")


def _middle_of_counts(counts: DataFrame, groups: Sequence[str], metric: str, median: str) -> DataFrame:
    """No task sees a whole group: see :func:`ranks_from_counts`."""
    valued = counts.filter(F.col(metric).isNotNull())
    ranked = ranks_from_counts(valued, groups, metric, "_rank", total="_rows")
    # Counted from the top, the lower middle stands at rows div 2 + 1.
    middle = F.call_function("div", F.col("_rows"), F.lit(2)) + 1
    return ranked.filter(
        (F.col("_rank") <= middle) & (middle < F.col("_rank") + F.col(ROWS))
    ).select(*groups, F.col(metric).alias(median))

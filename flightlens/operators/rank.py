"""Ranks and group statistics on every row, without sorting the rows.

A rank by a number depends only on how many rows hold each value.
So the rows are counted by value once, ranks are worked out on those counts,
and every row looks its rank up.

While the counts are few (a checked number), one task orders them.  Beyond
that no task receives all counts, nor all counts of one group: running totals
are taken first over ranges of values and then inside each range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlens.functions import numeric
from flightlens.operators.lookup import (
    ROWS,
    KeyCounts,
    count_keys,
    join_lookup,
    null_safe_join,
)
from flightlens.session import materialise
from flightlens.settings import SCALING, Scaling

StatNames = tuple[str, str, str]


def require_number(df: DataFrame, metric: str) -> None:
    """Refuse what cannot be ranked before anything is counted, at any size alike."""
    kind = df.schema[metric].dataType
    if not isinstance(kind, T.NumericType):
        raise ValueError(f"{metric} is {kind.simpleString()}: ranking takes a number")


def _bucketed(counts: DataFrame, groups: Sequence[str], metric: str) -> DataFrame:
    """Counts with the number of the value range they fall in, written once.

    Ranges come from a sample of the values, so the table is written: both
    readers must see the same ranges.
    """
    ranges = 4 * int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.select(*groups, metric, ROWS).repartitionByRange(ranges, F.asc_nulls_first(metric))
    return materialise(dealt.withColumn("_bucket", F.spark_partition_id()))[0]


def ranks_from_counts(
    counts: DataFrame,
    groups: Sequence[str],
    metric: str,
    rank: str,
    total: str | None = None,
) -> DataFrame:
    """Descending rank of each counted value inside its group, ties shared, NULL last.

    ``counts`` has the columns ``groups``, ``metric`` and ``row_count``.  With
    ``total`` the number of rows in the group is added as well.
    """
    require_number(counts, metric)
    tagged = _bucketed(counts, groups, metric)

    group = Window.partitionBy(*groups)
    higher_buckets = group.orderBy(F.desc_nulls_last("_bucket")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One row per bucket, carrying the rows ahead of it.  It leads its bucket in
    # the next window, so the running total starts there without a join.
    leads = (
        tagged.groupBy(*groups, "_bucket")
        .agg(F.sum(ROWS).alias("_in_bucket"))
        .select(
            *groups,
            "_bucket",
            F.coalesce(F.sum("_in_bucket").over(higher_buckets), F.lit(0)).alias(ROWS),
            F.sum("_in_bucket").over(group).alias("_total"),
            F.lit(True).alias("_leads"),
        )
    )
    bucket = Window.partitionBy(*groups, "_bucket")
    ahead = bucket.orderBy(F.desc("_leads"), F.desc_nulls_last(metric)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranked = tagged.withColumn("_leads", F.lit(False)).unionByName(leads, allowMissingColumns=True)
    ranked = ranked.withColumn(rank, F.sum(ROWS).over(ahead) + 1)
    if total:
        ranked = ranked.withColumn(total, F.max("_total").over(bucket))
    return ranked.filter(~F.col("_leads")).drop("_leads", "_bucket", "_total")


def _rank_in_one_task(metric: str, groups: Sequence[str]) -> Column:
    """The same rank as a window over all counts, for counts of a checked size.

    One more than the rows that are not at or below the value; ascending order
    serves the group totals and the running totals with one sort.
    """
    group = Window.partitionBy(*groups)
    at_or_below = F.sum(ROWS).over(group.orderBy(F.asc_nulls_first(metric)))
    return F.sum(ROWS).over(group) - at_or_below + 1


def _stats(metric: str, names: StatNames) -> list[Column]:
    """Mean, maximum and minimum, each value weighted by its rows."""
    mean, highest, lowest = names
    weight = F.when(F.col(metric).isNotNull(), F.col(ROWS))
    rows = F.coalesce(F.sum(weight), F.lit(0))
    return [
        numeric.mean(F.sum(F.col(metric) * weight), rows).alias(mean),
        F.max(metric).alias(highest),
        F.min(metric).alias(lowest),
    ]


def rank_within(
    df: DataFrame,
    groups: Sequence[str],
    metric: str,
    rank: str,
    top: int | None = None,
    scaling: Scaling = SCALING,
) -> DataFrame:
    """Rank of every row inside its group; ``top`` keeps ranks up to that number."""
    require_number(df, metric)
    keys = [*groups, metric]
    counts = count_keys(df, keys)
    if counts.size <= scaling.one_task_rows:
        ranks = counts.table.coalesce(1).select(*keys, ROWS, _rank_in_one_task(metric, groups).alias(rank))
    else:
        ranks = ranks_from_counts(counts.table, groups, metric, rank)
    if top is None:
        return join_lookup(df, ranks.drop(ROWS), counts, scaling)
    # Only the wanted ranks are looked up: few, so the rows rarely move at all.
    few, size = materialise(ranks.filter(F.col(rank) <= top))
    wanted = KeyCounts(few.select(*keys, ROWS), tuple(keys), size)
    return join_lookup(df, few.drop(ROWS), wanted, scaling).filter(F.col(rank).isNotNull())


def rank_overall(df: DataFrame, metric: str, rank: str, scaling: Scaling = SCALING) -> DataFrame:
    """Rank of every row among all rows."""
    return rank_within(df, [], metric, rank, scaling=scaling)


def group_stats(
    df: DataFrame,
    groups: Sequence[str],
    metric: str,
    names: StatNames,
    scaling: Scaling = SCALING,
) -> DataFrame:
    """Mean, maximum and minimum of the group on every row."""
    mean, highest, lowest = names
    table, size = materialise(
        df.groupBy(*groups).agg(
            F.count(F.lit(1)).alias(ROWS),
            numeric.mean(F.sum(metric), F.count(metric)).alias(mean),
            F.max(metric).alias(highest),
            F.min(metric).alias(lowest),
        )
    )
    per_group = KeyCounts(table.select(*groups, ROWS), tuple(groups), size)
    return join_lookup(df, table.drop(ROWS), per_group, scaling)


def rank_and_compare(
    df: DataFrame,
    group: str,
    metric: str,
    group_rank: str,
    overall_rank: str,
    names: StatNames,
    scaling: Scaling = SCALING,
    counts: KeyCounts | None = None,
) -> DataFrame:
    """Both ranks and the group statistics on every row: one count, one join.

    ``counts`` of the rows by (group, metric) may be at hand already.
    """
    require_number(df, metric)
    counts = counts or count_keys(df, [group, metric])
    if counts.size <= scaling.one_task_rows:
        table = counts.table.coalesce(1)
        ranks = table.select(
            group,
            metric,
            _rank_in_one_task(metric, [group]).alias(group_rank),
            _rank_in_one_task(metric, []).alias(overall_rank),
        )
        # Not more groups than counts, so within the same bound.
        by_group = F.broadcast(table.groupBy(group).agg(*_stats(metric, names)))
    else:
        table = counts.table
        in_group = ranks_from_counts(table, [group], metric, group_rank).drop(ROWS)
        # A value such as zero or NULL stands in every group, a group has many
        # values: both joins know how many counts each of their keys has.
        pairs = F.count(F.lit(1)).alias("_pairs")
        by_value, values = materialise(table.groupBy(metric).agg(F.sum(ROWS).alias(ROWS), pairs))
        overall = ranks_from_counts(by_value, [], metric, overall_rank).drop(ROWS)
        of_value = KeyCounts(by_value.select(metric, F.col("_pairs").alias(ROWS)), (metric,), values)
        by_group, found = materialise(table.groupBy(group).agg(pairs, *_stats(metric, names)))
        of_group = KeyCounts(by_group.select(group, F.col("_pairs").alias(ROWS)), (group,), found)
        both = join_lookup(in_group, overall, of_value, scaling)
        return join_lookup(df, join_lookup(both, by_group.drop("_pairs"), of_group, scaling), counts, scaling)
    lookup = null_safe_join(ranks, by_group, [group])
    return join_lookup(df, lookup, counts, scaling)


def rank_and_share(
    df: DataFrame, size: int, count: str, rank: str, share: str, scaling: Scaling = SCALING
) -> DataFrame:
    """Rank groups by their row count and give each its percentage of all rows.

    ``df`` has one row per group, ``size`` of them.  With few groups one window
    orders them.  A dirty grouping column can have as many groups as rows; then
    the distinct counts are ordered instead.  They add up to the N rows, so
    there are at most sqrt(2 N) of them.
    """
    everything = Window.partitionBy()
    if size <= scaling.one_task_rows:
        larger_first = Window.orderBy(F.desc_nulls_last(count))
        whole = F.sum(count).over(everything)
        return df.coalesce(1).select(
            "*",
            F.rank().over(larger_first).cast("bigint").alias(rank),
            numeric.percent(F.col(count), whole).alias(share),
        )
    sizes, distinct = materialise(df.groupBy(count).agg(F.count(F.lit(1)).alias(ROWS)))
    whole = F.sum(F.col(count) * F.col(ROWS)).over(everything)
    ranked = sizes.select(
        count,
        _rank_in_one_task(count, []).alias(rank),
        numeric.percent(F.col(count), whole).alias(share),
    )
    # With dirty groups nearly all have one row: that key is spread like any hot key.
    return join_lookup(df, ranked, KeyCounts(sizes, (count,), distinct), scaling)

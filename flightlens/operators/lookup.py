"""Joining every row with a small-per-key table, whatever the skew of the key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlens.session import materialise
from flightlens.settings import SCALING, Scaling

ROWS = "row_count"


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match; the right copies of the keys are dropped."""
    twins = {key: f"_right_{key}" for key in keys}
    right = right.withColumnsRenamed(twins)
    matches = [left[key].eqNullSafe(right[twin]) for key, twin in twins.items()]
    return left.join(right, matches, how).drop(*twins.values())


@dataclass(frozen=True)
class KeyCounts:
    """Rows per distinct key: written once, its own size known."""

    table: DataFrame
    keys: tuple[str, ...]
    size: int


def count_keys(df: DataFrame, keys: Sequence[str]) -> KeyCounts:
    """Count rows by key, pre-aggregated in each task before the shuffle."""
    table, size = materialise(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(ROWS)))
    return KeyCounts(table, tuple(keys), size)


def join_lookup(
    rows: DataFrame, lookup: DataFrame, counts: KeyCounts, scaling: Scaling = SCALING
) -> DataFrame:
    """Add the columns of ``lookup`` (one row per key) to every row.

    ``counts`` holds the same keys, so the size of the lookup is known.  Small:
    the lookup is broadcast and the rows do not move.  Large: both sides are
    shuffled on the keys plus a salt, see :func:`_salted_join`.
    """
    if counts.size <= scaling.broadcast_rows:
        return null_safe_join(rows, F.broadcast(lookup), counts.keys, "left")
    return _salted_join(rows, lookup, counts, scaling)


def _salted_join(
    rows: DataFrame, lookup: DataFrame, counts: KeyCounts, scaling: Scaling
) -> DataFrame:
    """Shuffle join that spreads each hot key over ``rows / per_salt`` tasks.

    The lookup holds one copy of a key per salt.  A row of a hot key takes the
    salt of the task that reads it, so re-running a lost task routes its rows
    the same way and identical rows still spread.  Rows of other keys take salt
    0, which every key has, so each row meets exactly one copy.

    N rows have at most ``N / per_salt`` keys of ``per_salt`` rows or more.  That
    number is raised with N until those keys fit the checked broadcast, so every
    hot key is spread.
    """
    keys = counts.keys
    total = counts.table.agg(F.sum(ROWS)).first()[0] or 0
    per_salt = max(scaling.rows_per_salt, -(-total // scaling.hot_keys))
    last_salt = F.call_function("div", F.col(ROWS), F.lit(per_salt))
    hot = counts.table.filter(F.col(ROWS) >= per_salt).select(*keys, (last_salt + 1).alias("_salts"))
    task = F.pmod(F.spark_partition_id().cast("bigint"), F.col("_salts"))
    salted_rows = null_safe_join(rows, F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.coalesce(task, F.lit(0))
    )
    salts = counts.table.select(
        *keys, F.explode(F.sequence(F.lit(0).cast("bigint"), last_salt)).alias("_salt")
    )
    copies = null_safe_join(lookup, salts, keys)
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if counts.size <= scaling.hashed_rows * partitions:
        copies = copies.hint("shuffle_hash")
    return null_safe_join(salted_rows, copies, [*keys, "_salt"], "left").drop("_salt", "_salts")

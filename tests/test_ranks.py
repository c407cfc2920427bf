"""Ranks and group statistics against the plain definition, on every plan shape."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from flightlens.operators.lookup import count_keys, join_lookup
from flightlens.operators.rank import (
    group_stats,
    rank_and_compare,
    rank_and_share,
    rank_overall,
    rank_within,
)
from flightlens.operators.summarise import lower_median
from flightlens.settings import Scaling

SHAPES = {
    "broadcast": Scaling(),
    "broadcast, ordered in buckets": Scaling(one_task_rows=0),
    "shuffled and sorted": Scaling(one_task_rows=0, broadcast_rows=0, rows_per_salt=3, hashed_rows=0),
    "shuffled": Scaling(one_task_rows=0, broadcast_rows=0),
    "salted": Scaling(one_task_rows=0, broadcast_rows=0, rows_per_salt=3, hot_keys=4),
    "salted, every key hot": Scaling(one_task_rows=0, broadcast_rows=0, rows_per_salt=1, hot_keys=1000),
}
NAMES = ("mean", "highest", "lowest")


def sample(spark, rows=2000):
    """A third of the rows share one key; NULL groups and NULL values occur."""
    i = F.col("id")
    group = F.when(i % 3 == 0, "hot").when(i % 97 == 0, None).otherwise(F.concat(F.lit("g"), (i % 11).cast("string")))
    value = (
        F.when((i % 3 == 0) & (i % 2 == 0), F.lit("0.00"))
        .when(i % 13 == 0, None)
        .otherwise(((i * 7919) % 250_000 / 100 - 300).cast("string"))
        .cast("decimal(10,2)")
    )
    value = F.when(i % 11 != 5, value)
    return spark.range(0, rows, 1, 5).select("id", group.alias("g"), value.alias("v"))


def expected(df):
    group = Window.partitionBy("g")
    return df.select(
        "*",
        F.rank().over(group.orderBy(F.desc("v"))).alias("in_group"),
        F.rank().over(Window.orderBy(F.desc("v"))).alias("overall"),
        F.max("v").over(group).alias("highest"),
        F.min("v").over(group).alias("lowest"),
    )


def same(left, right):
    left = left.select(*[F.col(c).cast("string").alias(c) for c in sorted(left.columns)])
    right = right.select(*[F.col(c).cast("string").alias(c) for c in sorted(right.columns)])
    assert Counter(map(tuple, left.collect())) == Counter(map(tuple, right.collect()))


@pytest.mark.parametrize("shape", SHAPES)
def test_everything_at_once(spark, shape):
    df = sample(spark)
    got = rank_and_compare(df, "g", "v", "in_group", "overall", NAMES, SHAPES[shape])
    same(got.drop("mean"), expected(df))
    means = {r.g: r.mean for r in got.select("g", "mean").distinct().collect()}
    for r in df.groupBy("g").agg(F.sum("v").alias("s"), F.count("v").alias("n")).collect():
        exact = None if r.n == 0 else r.s / r.n
        assert means[r.g] is None if exact is None else abs(means[r.g] - exact) <= Decimal("0.005")
    assert len(means) == df.select("g").distinct().count()


@pytest.mark.parametrize("shape", SHAPES)
def test_single_operators(spark, shape):
    df, scaling = sample(spark, 700), SHAPES[shape]
    truth = expected(df)
    same(rank_within(df, ["g"], "v", "in_group", scaling=scaling), truth.drop("overall", "highest", "lowest"))
    same(rank_overall(df, "v", "overall", scaling), truth.drop("in_group", "highest", "lowest"))
    stats = group_stats(df, ["g"], "v", NAMES, scaling).drop("mean")
    same(stats, truth.drop("in_group", "overall"))


def test_ties_and_missing_values(spark):
    df = spark.createDataFrame(
        [(Decimal(v),) if v else (None,) for v in ("7", "7", "5", "1", None)], "v decimal(10,2)"
    )
    for scaling in SHAPES.values():
        ranks = [r.rank for r in rank_overall(df, "v", "rank", scaling).orderBy("rank").collect()]
        assert ranks == [1, 1, 3, 4, 5]


def test_group_with_no_values(spark):
    df = spark.createDataFrame([("a", None), ("a", None)], "g string, v decimal(10,2)")
    for scaling in SHAPES.values():
        rows = rank_and_compare(df, "g", "v", "in_group", "overall", NAMES, scaling).collect()
        assert [tuple(r)[2:] for r in rows] == [(1, 1, None, None, None)] * 2


def test_top_per_group_keeps_ties(spark):
    df = spark.createDataFrame([(Decimal(v),) for v in "99887"], "v decimal(10,2)")
    assert sorted(r.v for r in rank_within(df, [], "v", "rank", top=3).collect()) == [8, 8, 9, 9]


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, v decimal(10,2)")
    for scaling in SHAPES.values():
        assert rank_and_compare(df, "g", "v", "in_group", "overall", NAMES, scaling).count() == 0


def test_full_value_range(spark):
    """The ends of the type, and values on both sides of a bucket border."""
    texts = ["99999999.99", "-99999999.99", "0.00", "-0.01", "0.01", "999.99", "1000.00", "-1000.00", "-1000.01"]
    df = spark.createDataFrame([(Decimal(t),) for t in texts], "v decimal(10,2)")
    for scaling in SHAPES.values():
        got = rank_overall(df, "v", "rank", scaling).orderBy("rank").collect()
        assert [r.v for r in got] == sorted(map(Decimal, texts), reverse=True)
        assert [r["rank"] for r in got] == list(range(1, 10))


@pytest.mark.parametrize("shape", SHAPES)
def test_what_is_ranked_does_not_depend_on_the_size(spark, shape):
    rows = [("a", "b"), ("a", None)]
    df = spark.createDataFrame(rows, "g string, v string")
    sizes = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    for attempt in (
        lambda: rank_within(df, ["g"], "v", "r", scaling=SHAPES[shape]),
        lambda: rank_and_compare(df, "g", "v", "r", "o", NAMES, SHAPES[shape]),
        lambda: lower_median(df, ["g"], "v", "m", sizes, "n", SHAPES[shape]),
    ):
        with pytest.raises(ValueError, match="ranking takes a number"):
            attempt()


@pytest.mark.parametrize("kind", ["double", "bigint"])
def test_every_number_is_ranked_at_every_size(spark, kind):
    rows = [(f"g{i % 3}", None if i % 11 == 0 else float(i * 7 % 13)) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("v", F.col("v").cast(kind))
    sizes = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    found = set()
    for scaling in (SHAPES["broadcast"], SHAPES["salted"]):
        ranked = rank_overall(df, "v", "o", scaling)
        top = rank_within(df, ["g"], "v", "r", top=4, scaling=scaling)
        median = lower_median(df, ["g"], "v", "m", sizes, "n", scaling)
        found.add(tuple(repr(sorted(map(repr, d.collect()))) for d in (ranked, top, median)))
    assert len(found) == 1


@pytest.mark.parametrize("small", [True, False])
def test_rank_and_share(spark, small):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 3), (None, 1)], "g string, n bigint")
    scaling = Scaling() if small else Scaling(one_task_rows=0, broadcast_rows=0)
    got = {r.g: (r["rank"], str(r.share)) for r in rank_and_share(df, 4, "n", "rank", "share", scaling).collect()}
    assert got == {"a": (1, "35.71"), "b": (1, "35.71"), "c": (3, "21.43"), None: (4, "7.14")}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["x", "y", None]),
            st.one_of(st.none(), st.decimals(-2000, 2000, places=2), st.just(Decimal("0.00"))),
        ),
        max_size=40,
    )
)
def test_ranks_by_definition(spark, rows):
    df = spark.createDataFrame(rows, "g string, v decimal(10,2)")
    got = rank_and_compare(df, "g", "v", "in_group", "overall", NAMES, SHAPES["salted"]).collect()
    assert len(got) == len(rows)

    def ahead(value, others):
        return sum(o is not None and (value is None or o > value) for o in others)

    for r in got:
        assert r.overall == 1 + ahead(r.v, [v for _, v in rows])
        assert r.in_group == 1 + ahead(r.v, [v for g, v in rows if g == r.g])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["x", "y", None]), st.one_of(st.none(), st.decimals(-3000, 3000, places=2))),
        min_size=1,
        max_size=40,
    ),
    st.sampled_from([1, 5, 1_000_000]),
)
def test_median_by_definition(spark, rows, rows_per_salt):
    df = spark.createDataFrame(rows, "g string, v decimal(10,2)")
    sizes = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    got = lower_median(df, ["g"], "v", "median", sizes, "n", Scaling(rows_per_salt=rows_per_salt, hot_keys=2))
    for r in got.collect():
        values = sorted(v for g, v in rows if g == r.g and v is not None)
        assert r.median == (values[(len(values) - 1) // 2] if values else None)
    groups = {g for g, v in rows if v is not None}
    assert groups <= {r.g for r in got.collect()}


def test_salted_join_spreads_a_hot_key(spark):
    """All rows share one key: the join must still use several tasks."""
    rows = spark.range(0, 4000, 1, 8).select(F.lit(None).cast("string").alias("k"), "id")
    counts = count_keys(rows, ["k"])
    lookup = counts.table.select("k", F.lit("found").alias("hit"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_lookup(rows, lookup, counts, Scaling(one_task_rows=0, broadcast_rows=0, rows_per_salt=500))
        spread = joined.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()
        assert joined.filter("hit = 'found'").select("id").distinct().count() == 4000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(spread) > 1 and sum(r.n for r in spread) == 4000

"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from flightlens import plans
from flightlens.operators.enrich import enrich
from flightlens.operators.rank import rank_and_compare
from flightlens.settings import Scaling
from flightlens.sources import publish, raw

NAMES = ("mean", "highest", "lowest")


@pytest.fixture(scope="module")
def raw_table(spark, tmp_path_factory):
    from flightlens.plans.observations import observations

    path = str(tmp_path_factory.mktemp("raw"))
    publish.append_parquet(observations(spark, "/root/testdata/sf0.001"), path)
    return raw.read_parquet(spark, path)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_position_filter_reaches_the_scan(raw_table):
    plan = plan_of(enrich(raw_table))
    assert "PushedFilters: [IsNotNull(longitude), IsNotNull(latitude)]" in plan
    assert "Exchange" not in plan


def test_cutoff_reaches_the_scan(raw_table):
    from datetime import datetime

    plan = plan_of(raw.snapshot(raw_table, datetime(2024, 1, 5)))
    assert "LessThanOrEqual(fetch_time" in plan


def test_scans_read_only_what_they_use(raw_table):
    totals = plan_of(plans.reports.country_totals(enrich(raw_table)))
    read = re.search(r"ReadSchema: struct<([^>]*)", totals).group(1)
    columns = {part.split(":")[0] for part in read.split(",")}
    assert columns == {"callsign", "origin_country", "longitude", "latitude", "baro_altitude", "velocity"}


def test_small_lookup_is_broadcast_and_rows_do_not_move(raw_table):
    plan = plan_of(plans.enriched_flights(plans.ranked_flights(enrich(raw_table))))
    rows_side = plan[: plan.index("FileScan")]
    assert "BroadcastHashJoin" in rows_side and "Exchange hashpartitioning" not in rows_side
    assert "SinglePartition" not in plan
    # The reports are read once; the other scans are of the small written tables.
    assert sum("longitude" in line for line in plan.splitlines() if "FileScan" in line) == 1


def test_large_lookup_never_gathers_the_rows(raw_table):
    """The one single-task step is over the value buckets, never over reports."""
    ranked = rank_and_compare(
        enrich(raw_table), "origin_country", "velocity_kmh", "a", "b", NAMES, Scaling(one_task_rows=0, broadcast_rows=0)
    )
    plan = plan_of(ranked)
    gathered = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert len(gathered) == 1
    below = plan[plan.index(gathered[0]) :].splitlines()[1]
    assert "HashAggregate(keys=[_bucket" in below
    # The rows reach the final join by a shuffle on the keys and the salt.
    assert re.search(r"hashpartitioning\(coalesce\(origin_country.*_salt", plan)
    scan = next(line for line in plan[plan.index(gathered[0]) :].splitlines() if "FileScan" in line)
    assert "_bucket" in scan and "longitude" not in scan


def test_no_python_and_no_cross_join(raw_table):
    base = enrich(raw_table)
    for df in (
        plans.enriched_flights(plans.ranked_flights(base)),
        plans.country_stats(base),
        plans.flights_analytics(base),
    ):
        plan = plan_of(df)
        for banned in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert banned not in plan


def test_distinct_counting_spreads_a_hot_country(raw_table):
    plan = plan_of(plans.reports.country_totals(enrich(raw_table)))
    first_shuffle = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line][-1]
    assert "origin_country" in first_shuffle and "callsign" in first_shuffle
    assert "partial_count" in plan


def test_approximate_summary_is_one_shuffle(raw_table):
    plan = plan_of(plans.flights_analytics(enrich(raw_table), median="approx", approximate_distinct=True))
    assert plan.count("Exchange") == 1


def test_publishing_lets_adaptive_execution_split_months(raw_table):
    base = enrich(raw_table).select("event_date", "origin_country")
    from flightlens.schema import Layout

    layout = Layout("t", base.schema, ("event_date", "origin_country"), True)
    plan = plan_of(publish.laid_out(base, layout))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    assert plan.index("Sort [") < plan.index("Exchange")


def test_count_of_rows_reads_no_column(raw_table):
    plan = plan_of(raw_table.agg(F.count(F.lit(1))))
    assert "ReadSchema: struct<>" in plan

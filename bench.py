"""Time the headline queries and print one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_REPEATS choose the data, the cores and the
number of timed runs.  A query's time is its best run, from building the plan to
the last row produced; the first run only warms the JVM.

``PLAIN`` holds a generic form of three reports on the same input, for comparison:
windows over the rows, or one grouping with every measure of the layout.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable, Sequence
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from flightlens import plans  # noqa: E402
from flightlens.operators.enrich import enrich  # noqa: E402
from flightlens.plans.catalog import queries  # noqa: E402
from flightlens.plans.observations import observations  # noqa: E402
from flightlens.schema import ANALYTICS_KEYS, ANALYTICS_LAYOUT, COUNTRY_LAYOUT, Layout  # noqa: E402
from flightlens.session import build_session  # noqa: E402

HEADLINE = (
    "enriched_flights",
    "country_stats",
    "flights_analytics",
    "rank_in_country",
    "speed_rank_global",
    "country_window_stats",
    "agg_median",
    "enriched_base",
    "quarantine_counts",
    "ingest_rows",
    "published_analytics",
)


#: What a summary column of the layouts stands for, where its name does not say.
COUNTED = {
    "total_aircraft": "count(1)",
    "flight_count": "count(1)",
    "unique_flights": "count(DISTINCT callsign)",
    "unique_aircraft": "count(DISTINCT icao24)",
    "anomaly_count": "sum(is_anomaly)",
    "avg_speed_kmh": "avg(velocity_kmh)",
}
NAMED = {"avg": "avg({})", "min": "min({})", "max": "max({})", "median": "percentile_approx({}, 0.5)"}


def measure(column: str) -> str | None:
    """The aggregate behind a column of a layout; None for keys and derived columns."""
    kind, _, source = column.partition("_")
    return COUNTED.get(column) or (NAMED[kind].format(source) if kind in NAMED else None)


def one_aggregate(base: DataFrame, layout: Layout, keys: Sequence[str]) -> DataFrame:
    """Every measure of a layout in a single grouping."""
    found = {c: measure(c) for c in layout.schema.names}
    return base.groupBy(*keys).agg(*[F.expr(m).alias(c) for c, m in found.items() if m])


def by_windows(base: DataFrame) -> DataFrame:
    """Ranks and statistics as windows over the rows, in SQL."""
    base.createOrReplaceTempView("bench_reports")
    country, everyone = "PARTITION BY origin_country", ""
    ranks = {"rank_in_country": country, "speed_rank_global": everyone}
    shown = [f"rank() OVER ({over} ORDER BY velocity_kmh DESC) AS {name}" for name, over in ranks.items()]
    shown += [f"{kind}(velocity_kmh) OVER ({country}) AS {kind}_speed_in_country" for kind in ("avg", "max", "min")]
    return plans.enriched_flights(base.sparkSession.sql(f"SELECT *, {', '.join(shown)} FROM bench_reports"))


PLAIN = {
    "enriched_flights": by_windows,
    "country_stats": lambda base: one_aggregate(base, COUNTRY_LAYOUT, ["origin_country"]),
    "flights_analytics": lambda base: one_aggregate(base, ANALYTICS_LAYOUT, ANALYTICS_KEYS),
}


def best_time(build: Callable[[], DataFrame], repeats: int) -> float:
    times = []
    for _ in range(repeats + 1):
        began = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - began)
    return round(min(times[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark: SparkSession = build_session(
        "flightlens-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    timed = {name: best_time(lambda q=known[name]: q(spark, sf_dir), repeats) for name in HEADLINE}
    plain = {
        name: best_time(lambda f=form: f(enrich(observations(spark, sf_dir))), repeats)
        for name, form in PLAIN.items()
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "plain_forms": plain,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()

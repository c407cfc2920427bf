"""Opt-in removal of reports that successive polls repeat."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT_KEY = ("icao24", "time_position")


def first_reports(df: DataFrame, keys: Sequence[str] = REPORT_KEY, arrival: str = "fetch_time") -> DataFrame:
    """Keep the earliest copy of each report.

    A row with a NULL key has no identity and is kept.  The copies are reduced
    to one per task before the shuffle, so a report repeated in a third of all
    rows stays cheap.
    """
    others = [c for c in df.columns if c not in keys and c != arrival]
    identified = _identified(keys)
    kept = (
        df.filter(identified)
        .groupBy(*keys)
        .agg(F.min(F.struct(arrival, *others)).alias("_first"))
        .select(*keys, "_first.*")
        .select(*df.columns)
    )
    return kept.unionByName(df.filter(~identified))


def first_reports_in_stream(
    df: DataFrame, delay: str, keys: Sequence[str] = REPORT_KEY, arrival: str = "fetch_time"
) -> DataFrame:
    """Streaming form: a report is remembered until ``delay`` after its arrival."""
    identified = _identified(keys)
    timed = df.withWatermark(arrival, delay)
    kept = timed.filter(identified).dropDuplicatesWithinWatermark(list(keys))
    return kept.unionByName(timed.filter(~identified))


def first_records_in_stream(
    typed: DataFrame, delay: str, good: Column, keys: Sequence[str] = REPORT_KEY
) -> DataFrame:
    """Typed payload records without good reports that landed less than ``delay`` before.

    One pass over one stream: a record that is not ``good``, or has a NULL key, gets a
    key that no other record has, and so is kept.  The watermark follows the time of
    landing, so nothing is ever too late for it.  Of copies in one batch any may stay.
    """
    known = F.coalesce(good, F.lit(False)) & _identified(keys)
    marks = {f"_by_{key}": F.when(known, F.col(key)) for key in keys}
    marks["_alone"] = F.when(~known, F.expr("uuid()"))
    marked = typed.withColumns({**marks, "_landed": F.current_timestamp()}).withWatermark("_landed", delay)
    return marked.dropDuplicatesWithinWatermark(list(marks)).drop("_landed", *marks)


def _identified(keys: Sequence[str]) -> Column:
    return reduce(and_, (F.col(key).isNotNull() for key in keys))

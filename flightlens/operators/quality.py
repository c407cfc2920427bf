"""Contract checks, quarantine and load counters."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from flightlens.schema import TEXT_LIMITS, Layout

REASONS = "reject_reasons"


def reasons(checks: dict[str, Column]) -> Column:
    """Names of the failed checks as an array; a NULL condition does not fail."""
    return F.array_compact(F.array(*[F.when(failed, F.lit(name)) for name, failed in checks.items()]))


def text_length_checks(columns: list[str] | None = None) -> dict[str, Column]:
    return {
        f"{name}_too_long": F.length(name) > limit
        for name, limit in TEXT_LIMITS.items()
        if columns is None or name in columns
    }


def contract_checks(layout: Layout) -> dict[str, Column]:
    """A required column of the published table is missing."""
    return {f"{name}_missing": F.col(name).isNull() for name in layout.required}


def range_checks(pairs: dict[str, str]) -> dict[str, Column]:
    """A source value is present, but the published type cannot hold it."""
    return {
        f"{published}_out_of_range": F.col(source).isNotNull() & F.col(published).isNull()
        for source, published in pairs.items()
    }


def with_reasons(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    return df.withColumn(REASONS, reasons(checks))


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.size(REASONS) == 0).drop(REASONS)


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.size(REASONS) > 0)


def count_by_reason(df: DataFrame) -> DataFrame:
    """Rows per reason; a row with two reasons counts in both."""
    return (
        df.select(F.explode(REASONS).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
    )


def observe_load(df: DataFrame, name: str = "load") -> tuple[DataFrame, Observation]:
    """Count rows on the pass that uses them; read them with :func:`observed_rows`
    after the first action.  No extra scan is made."""
    observation = Observation(name)
    counters = [F.count(F.lit(1)).alias("total_rows")]
    if REASONS in df.columns:
        counters.append(F.count_if(F.size(REASONS) == 0).alias("accepted_rows"))
    return df.observe(observation, *counters), observation


def observed_rows(observation: Observation, counter: str = "total_rows") -> int:
    """A counter of :func:`observe_load`.

    Zero where nothing was counted, see :func:`observed_values`.
    """
    return observed_values(observation).get(counter) or 0


def observed_values(observation: Observation) -> dict[str, object]:
    """All counters of an observation whose action has run.

    When Spark proves an input empty it drops the counters with the scan, and
    the observation then has no row to read: no counters.
    """
    try:
        return dict(observation.get)
    except Py4JJavaError as missing:
        if "assertion failed" not in str(missing.java_exception):
            raise
        return {}

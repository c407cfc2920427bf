"""Exact fixed-point arithmetic.

Published numbers have two decimals.  Working in decimals makes every mean and
share independent of the order in which rows arrive, and exact at any count.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flightlens.schema import PERCENT, SPEED


def two_decimals(value: Column) -> Column:
    """``value`` rounded half up to the published type; NULL if it cannot hold it
    (NaN, infinity, or more than eight digits before the point)."""
    return value.try_cast(SPEED)


def summable(value: Column) -> Column:
    """A double as an exactly summable number with six decimals."""
    return value.try_cast("decimal(18,6)")


def left_out(value: Column) -> Column:
    """Whether a value is present but no summable number: NaN, infinite, or 10^12 and more."""
    return value.isNotNull() & summable(value).isNull()


def _hundredths(numerator: Column, denominator: Column) -> Column:
    """Half-up quotient in hundredths: floor(100 n / d + 1/2) on whole numbers,
    mirrored for negatives."""
    doubled = F.call_function("div", F.abs(numerator) * 200 + denominator, denominator * 2)
    return doubled * F.sign(numerator).cast("int")


def mean(total: Column, count: Column) -> Column:
    """``total / count`` with two decimals, NULL for an empty group."""
    count = count.cast("decimal(20,0)")
    return F.when(count > 0, _as_decimal(_hundredths(total, count)).try_cast(SPEED))


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` with two decimals, NULL for an empty whole."""
    part, whole = part.cast("decimal(20,0)"), whole.cast("decimal(20,0)")
    return F.when(whole > 0, _as_decimal(_hundredths(part * 100, whole)).try_cast(PERCENT))


def _as_decimal(hundredths: Column) -> Column:
    return hundredths.cast("decimal(20,0)") * F.expr("0.01BD")

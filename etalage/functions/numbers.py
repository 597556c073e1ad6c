"""Number conversion, rounding and ratios."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from etalage import contracts as K


def round_half_even(c: Column, digits: int = 0) -> Column:
    """Scale, round to the nearest even integer, scale back: array-library rounding on doubles."""
    if digits == 0:
        return F.rint(c)
    scale = F.lit(float(10 ** digits))
    return F.rint(c * scale) / scale


def round_half_up(c: Column, digits: int = 2) -> Column:
    """SQL NUMERIC rounding: half away from zero, on decimals."""
    return F.round(c, digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division, null when the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent_of(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, rounded half up to two digits; null when whole is 0.

    Amounts of up to 26 digits before the point fit, and so does any percentage of them.  The quotient is
    taken of whole numbers, because a decimal one would be rounded before it is rounded to two digits.
    """
    cents = [F.abs(c.cast("decimal(28,2)") * F.lit(100).cast("decimal(3,0)")).cast("decimal(30,0)") for c in (part, whole)]
    top = (cents[0] * F.lit(20_000).cast("decimal(5,0)") + cents[1]).cast("decimal(37,0)")
    bottom = F.when(cents[1] != 0, cents[1] * F.lit(2).cast("decimal(1,0)")).cast("decimal(31,0)")
    steps = ((top - top % bottom) / bottom).cast("decimal(34,0)")
    percent = (steps / F.lit(100).cast("decimal(3,0)")).cast("decimal(36,2)")
    return F.when((part < 0) != (whole < 0), -percent).otherwise(percent)


def exact_mean(col: str) -> Column:
    """Aggregate: mean of an amount as a decimal with 15 digits, independent of the row order."""
    total = F.sum(F.col(col).cast(K.MONEY))
    return F.try_divide(total, F.count(col).cast("decimal(18,0)"))


def safe_rate(part: Column, whole: Column) -> Column:
    """Percentage with two digits over at least one row, rounded half even."""
    return round_half_even(ratio(part, F.greatest(whole, F.lit(1))) * F.lit(100.0), 2)


def to_double(c: Column) -> Column:
    """Text to number, null when invalid; a trailing type letter such as ``12d`` is not a number."""
    number = F.when(~c.rlike(r"[dDfF]\s*$"), c.try_cast("double"))
    return F.when(F.isnan(number) | (F.abs(number) == float("inf")), None).otherwise(number)


def to_int_or_zero(c: Column) -> Column:
    """Text to a 64-bit integer: truncated, 0 when missing or invalid."""
    return F.coalesce(to_double(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def to_money(c: Column) -> Column:
    """Text to an exact amount, null when invalid."""
    return c.try_cast(K.MONEY)


def edges_passed(edges: Column, count: int, passed: Callable[[Column], Column]) -> Column:
    """How many of the first ``count`` elements of an array meet a condition; absent ones do not.

    Written out per element, because a scalar subquery may not stand inside a lambda.
    """
    total = F.lit(0)
    for i in range(count):
        total = total + F.coalesce(passed(F.get(edges, F.lit(i))), F.lit(False)).cast("int")
    return total

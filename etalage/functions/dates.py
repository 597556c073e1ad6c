"""Calendar expressions.  ``as_of`` stands for "today" and is always passed in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from etalage import contracts as K


DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def day(value: str | dt.date | Column) -> Column:
    """A date literal from ISO text, a date, or a column as it is."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def to_day(c: Column) -> Column:
    """Text or timestamp to date, null when invalid."""
    return c.try_cast("date")


def to_time(c: Column) -> Column:
    """Text to date and time, null when invalid."""
    return c.try_cast("timestamp_ntz")


def _completed_years(start: Column, end: Column) -> Column:
    before_anniversary = (F.month(end) * 100 + F.dayofmonth(end)
                          < F.month(start) * 100 + F.dayofmonth(start))
    return F.year(end) - F.year(start) - before_anniversary.cast("int")


def whole_years(start: Column, end: Column) -> Column:
    """Completed calendar years between two dates, negative when ``start`` lies ahead."""
    return F.when(start <= end, _completed_years(start, end)).otherwise(-_completed_years(end, start))


def month_key(c: Column) -> Column:
    """``yyyy-MM`` of a date, put together where the year has four digits: a formatter takes several times as long."""
    year, months = F.year(c), F.array(*[F.lit(f"-{m:02d}") for m in range(1, 13)])
    plain = F.concat(year.cast("string"), F.get(months, F.month(c) - 1))
    return F.when(year.between(1000, 9999), plain).otherwise(F.date_format(c, "yyyy-MM"))


def day_name(c: Column) -> Column:
    """English name of the day of the week of a date."""
    return F.get(F.array(*[F.lit(name) for name in DAY_NAMES]), F.weekday(c))


def month_name(c: Column) -> Column:
    """French month name of a date."""
    names = F.array(*[F.lit(name) for name in K.MONTH_NAMES])
    return F.try_element_at(names, F.month(c))


def month_index(c: Column) -> Column:
    """Months since year 0, so that equal values mean the same calendar month."""
    return F.year(c) * 12 + F.month(c) - 1


def month_start(index: Column) -> Column:
    """First day of the month with that index."""
    return F.make_date(F.floor(index / 12).cast("int"), (index % 12 + 1).cast("int"), F.lit(1))


def distinct_months(c: Column) -> Column:
    """Aggregate: the set of months seen.  Bounded by the calendar, whatever the number of rows."""
    return F.collect_set(month_index(c))


def years_of(months: Column) -> Column:
    """Number of years in a set built by ``distinct_months``."""
    return F.size(F.array_distinct(F.transform(months, lambda m: F.floor(m / 12))))

"""Column expressions shared by the plans. All stay inside the JVM."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOCAL_PREFIX = "local"


def flag(column: Column, data_type: T.DataType) -> Column:
    """0/1 integer from a flag that arrives as boolean or as integer.

    Integers pass through as they are: filters on them then reach the scan.
    """
    return column.cast("int") if isinstance(data_type, T.BooleanType) else column


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio, NULL when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rounded_ctr(clicks: Column, checks: Column) -> Column:
    """clicks / checks rounded half up to four places.

    Divided as decimals so that a tie is a tie; published as double.
    """
    exact = F.try_divide(clicks.cast("decimal(20,4)"), checks.cast("decimal(20,0)"))
    return F.round(exact, 4).cast("double")


def starts_local(condition: Column) -> Column:
    """NULL condition gives NULL, so both the test and its negation drop it."""
    return condition.startswith(LOCAL_PREFIX)


def within(day: Column, as_of: date, days_back: int, closed: bool = False) -> Column:
    """Partition filter: the last ``days_back`` days up to ``as_of``.

    Bounds are literals, so they prune partitions. ``closed`` also bounds the
    range above by ``as_of``.
    """
    lower = as_of - timedelta(days=days_back)
    if closed:
        return day.between(F.lit(lower), F.lit(as_of))
    return day >= F.lit(lower)


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def day_epoch(day: Column) -> Column:
    """Epoch seconds of the day's midnight, UTC."""
    return F.unix_date(day).cast("long") * F.lit(86400)


def null_text(column: Column, default: str = "null") -> Column:
    return F.coalesce(column, F.lit(default))


def stripped(column: Column) -> Column:
    """Text without white space at either end, tabs and line ends included."""
    return F.btrim(column, F.lit(" \t\n\r\f\v"))

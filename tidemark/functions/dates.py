"""Calendar arithmetic that counts boundaries crossed, not whole units elapsed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def quarter_start(d: Column) -> Column:
    return F.trunc(d, "QUARTER")


def week_start(d: Column) -> Column:
    """The Monday on or before ``d``."""
    return F.trunc(d, "WEEK")


def add_weeks(d: Column, n: Column) -> Column:
    return F.date_add(d, (n * 7).cast("int"))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("long")


def weeks_crossed(start: Column, end: Column) -> Column:
    """Number of Mondays passed: Sunday to Monday is 1."""
    return (F.datediff(week_start(end), week_start(start)) / 7).cast("long")


def months_crossed(start: Column, end: Column) -> Column:
    return ((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)).cast("long")


def years_crossed(start: Column, end: Column) -> Column:
    """Difference of year numbers: 31 December to 1 January is 1."""
    return (F.year(end) - F.year(start)).cast("long")

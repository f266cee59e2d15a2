"""Arithmetic whose NULL and zero rules differ from Spark's operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(c: Column) -> Column:
    return c.cast("double")


def div0(numerator: Column, denominator: Column) -> Column:
    """Ratio that is 0 when the divisor is 0 and NULL when the divisor is NULL.

    Both sides are converted to double once, after any exact decimal sum, and
    divided once. The zero test comes first, so ANSI mode never sees x / 0.
    """
    return F.when(denominator == 0, F.lit(0.0)).otherwise(to_double(numerator) / to_double(denominator))


def exact_avg(c: Column) -> Column:
    """Average of an exact column: exact sum, one conversion, one division.

    ``avg(decimal)`` would round the quotient to the decimal's scale + 4. The
    count of non-NULL values can be 0, where the average is NULL.
    """
    return to_double(F.sum(c)) / F.nullif(F.count(c), F.lit(0))

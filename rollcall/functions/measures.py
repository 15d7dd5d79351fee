"""Aggregates used across the marts. Each returns a column for `groupBy(...).agg(...)`."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .values import ratio


def rows() -> Column:
    return F.count(F.lit(1))


def count_true(flag: Column) -> Column:
    return F.count_if(flag)


def total(col: Column) -> Column:
    return F.sum(col.cast("bigint"))


def share(flag: Column, digits: int = 1, null_as_false: bool = False) -> Column:
    """Percent of true. Null leaves the denominator unless `null_as_false`."""
    seen = rows() if null_as_false else F.count(flag)
    return ratio(F.count_if(flag), seen, digits, times=100)


def share_ge(col: Column, threshold: int, digits: int = 1, null_as_false: bool = False) -> Column:
    return share(col >= threshold, digits, null_as_false)


def mean(col: Column, digits: int = 1) -> Column:
    """Average of a whole-number column over non-null values."""
    return ratio(F.sum(col.cast("bigint")), F.count(col), digits)

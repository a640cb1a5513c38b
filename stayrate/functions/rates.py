"""Exact rates and means: everything is decimal until the last cast."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """A predicate that treats unknown as false."""
    return F.coalesce(condition, F.lit(False))


def as_int(condition: Column) -> Column:
    """1 where the predicate holds, else 0."""
    return F.when(condition, 1).otherwise(0)


def _exact(x: Column) -> Column:
    return x.cast("decimal(20,2)")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, rounded half up; NULL on an empty whole."""
    ratio = F.lit(Decimal("100")) * _exact(part) / F.nullif(_exact(whole), F.lit(0))
    return F.round(ratio, digits).cast("double")


def mean(total: Column, n: Column, digits: int = 2) -> Column:
    """total / n, rounded half up; NULL when nothing was counted."""
    return F.round(_exact(total) / F.nullif(n, F.lit(0)).cast("decimal(20,0)"), digits).cast("double")


def money(x: Column, digits: int = 2) -> Column:
    """A decimal amount as a rounded double for presentation."""
    return F.round(x, digits).cast("double")


def ratio_or_zero(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 where the whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))



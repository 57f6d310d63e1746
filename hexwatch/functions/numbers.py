"""Coercing casts (F5) and decimal narrowing (F9): what does not fit becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what counts as a number. A plain cast also takes '5d', 'nan' and 'inf'.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(c: Column) -> Column:
    """text to double, anything that is not a number becomes NULL."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def lat_decimal(c: Column) -> Column:
    return c.try_cast("decimal(10,8)")


def lon_decimal(c: Column) -> Column:
    return c.try_cast("decimal(11,8)")

"""Ratios and controllers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def duplication_percent(total: str | Column, unique: str | Column) -> Column:
    """Two decimals; 0 for no rows."""
    return F.when(col(total) == 0, 0.0).otherwise(F.round((col(total) - col(unique)) * 100.0 / col(total), 2))


def ratio(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    """Null for no rows."""
    return F.when(col(whole) != 0, F.round(col(part) / col(whole), digits))


#: Results that leave the next group's size as it is, results a step, and the
#: least size; the legacy controller's bounds.
AIM, STEP, LEAST_SIZE = 60_000, 6_000, 3
LEGACY_LOW, LEGACY_HIGH = 7500, 8500


def group_size(current: str | Column, results: str | Column, first: str | Column) -> Column:
    """Q5: the next group's size; the step counts twice, as in production."""
    step = ((col(results) - AIM) / STEP).cast("int")
    once = F.least((3 * col(first)).cast("int") - 5, col(current) - step)
    return F.greatest(once - step, F.lit(LEAST_SIZE)).cast("int")


def group_size_legacy(current: str | Column, results: str | Column) -> Column:
    """Q5, older: two up or down outside 7500 to 8500."""
    return col(current) + F.when(col(results) < LEGACY_LOW, 2).when(col(results) > LEGACY_HIGH, -2).otherwise(0)


def utilization(used: str | Column, total: str | Column) -> Column:
    """S17."""
    return ratio(used, total)

"""Rates and ages used by run metrics."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate(numerator: Column, denominator: Column) -> Column:
    """Share rounded to 4 places, 0 when there is nothing to divide by."""
    share = numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    return F.coalesce(F.round(share, 4), F.lit(0.0))


def age_hours(timestamp: Column, now: Column) -> Column:
    """Hours between two zone-less timestamps, without a detour over the session zone."""
    gap = now - timestamp
    units = {"DAY": 86400, "HOUR": 3600, "MINUTE": 60, "SECOND": 1}
    seconds = reduce(add, [F.extract(F.lit(unit), gap) * size for unit, size in units.items()])
    return F.round(seconds.cast("double") / 3600, 2)

"""Gates that compare a run with the runs before it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class VolumeLimits:
    #: Earlier entries of a series that make its baseline, and the least of them that can.
    window: int = 7
    least: int = 3
    #: Robust deviations below the median from which a volume warns, and from which it blocks.
    warn_below: float = 3.0
    block_below: float = 6.0
    #: Part of the median that counts as a deviation at least, so that a steady series isn't strict beyond reason.
    least_deviation: float = 0.05


# A normal distribution's standard deviation is so many times its median absolute deviation.
MAD_TO_SIGMA = 1.4826


def _median(values: Column) -> Column:
    ordered, n = F.sort_array(values), F.size(values)
    low, high = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return (F.get(ordered, low) + F.get(ordered, high)) / 2


def volume_gate(
    volumes: DataFrame, series: list[str], order: str, value: str, limits: VolumeLimits = VolumeLimits()
) -> DataFrame:
    """``volumes`` with ``expected``, ``deviation`` and ``verdict`` of each row: pass, warn, block or no_baseline.

    The baseline is the median of the rows before it in its series, and their median absolute deviation:
    one odd day neither moves the baseline nor widens it. A frame holds ``window`` numbers, so a long
    series costs no more per row.
    """
    before = Window.partitionBy(*series).orderBy(order).rowsBetween(-limits.window, -1)
    with_frame = volumes.withColumn("_values", F.collect_list(F.col(value).cast("double")).over(before))
    median = _median(F.col("_values"))
    with_median = with_frame.withColumn("expected", median)
    spread = _median(F.transform("_values", lambda x: F.abs(x - F.col("expected"))))
    deviation = F.greatest(spread * MAD_TO_SIGMA, F.col("expected") * limits.least_deviation)
    judged = with_median.withColumn("deviation", deviation)
    lacking = F.col("expected") - F.col(value)
    verdict = (
        F.when(F.size("_values") < limits.least, "no_baseline")
        .when(lacking > F.col("deviation") * limits.block_below, "block")
        .when(lacking > F.col("deviation") * limits.warn_below, "warn")
        .otherwise("pass")
    )
    return judged.withColumn("verdict", verdict).drop("_values")


def freshness_gate(states: DataFrame, latest: str, now: Column, warn_hours: float, block_hours: float) -> DataFrame:
    """``states`` with ``age_hours`` of the column ``latest`` and a ``verdict``; never an event blocks."""
    seconds = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col(latest).cast("timestamp"))
    age = seconds / F.lit(3600.0)
    verdict = (
        F.when(F.col(latest).isNull() | (age > block_hours), "block").when(age > warn_hours, "warn").otherwise("pass")
    )
    return states.withColumns({"age_hours": F.round(age, 2), "verdict": verdict})

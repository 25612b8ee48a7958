"""Lags, trailing means and slopes per series.

Positions count rows, not calendar units: missing periods are not filled. Feed rows already
aggregated to one per series and period, so that a series is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def series(keys: Sequence[str], period: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(period)


def lag(value: str, rows: int, window: WindowSpec) -> Column:
    return F.lag(value, rows).over(window)


def trailing_mean(value: str, rows: int, window: WindowSpec) -> Column:
    """Mean of the previous ``rows`` values, the current one left out; NULL until all are there."""
    frame = window.rowsBetween(-rows, -1)
    return F.when(F.count(value).over(frame) == rows, F.avg(value).over(frame))


def trailing_slope_of_4(value: str, window: WindowSpec) -> Column:
    """Least-squares slope through the previous four values; NULL until all are there."""
    recent = [lag(value, back, window) for back in (1, 2, 3, 4)]
    return (3 * recent[0] + recent[1] - recent[2] - 3 * recent[3]) / F.lit(10.0)

"""The two kinds of joins: fact with fact, and fact with dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most bytes of a dimension's inputs, as the optimizer knows them from the files, for a broadcast.
BROADCAST_BYTES = 32 << 20
#: Bytes that count for one of its files in a dimension whose rows grow with the data: a row of 2 bytes there takes a hundred or more in a broadcast,
#: which the driver makes and holds.
GROWING = 12


def fact_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join of two inputs that both grow with the data.

    Sort-merge spills and lets the adaptive planner split a hot key. The hint keeps the planner from
    broadcasting a fact because its compressed files look small.
    """
    return left.join(right.hint("merge"), keys, how)


def lookup(dimension: DataFrame, sized_by: DataFrame | None = None, growing: bool = False) -> DataFrame:
    """A dimension to join to: broadcast if its plan reads at most ``BROADCAST_BYTES``, which costs no job.

    Beyond that the planner joins by shuffle and splits hot keys. ``sized_by`` names an input with at
    least as many rows, for a dimension whose own estimate multiplies those of its joins. A ``growing`` dimension counts
    ``GROWING`` times, and beyond the limit the planner may not broadcast it either.
    """
    probe = dimension if sized_by is None else sized_by
    # a number of any length, which arrives as an int or as an object of the JVM
    size = int(str(probe._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size * (GROWING if growing else 1) <= BROADCAST_BYTES:
        return F.broadcast(dimension)
    return dimension.hint("merge") if growing else dimension

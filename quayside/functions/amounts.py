"""Exact money arithmetic.

Line amounts are summed as whole cents in BIGINT, which stays in whole-stage codegen and is exact;
under ANSI mode an overflow raises. Means and deviations are divided out once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(price: Column) -> Column:
    """A DECIMAL(10,2) as whole cents; exact, as ten digits fit a double."""
    return F.rint(price.cast("double") * 100).cast("bigint")


def line_cents() -> Column:
    """``quantity * unit_price`` of an order item in cents; NULL if either is."""
    return F.col("quantity") * cents(F.col("unit_price"))


def square(amount_cents: Column) -> Column:
    """Exact square of a BIGINT."""
    return (amount_cents.cast("decimal(19,0)") * amount_cents).cast("decimal(38,0)")


def money(total_cents: Column) -> Column:
    """Cents to DECIMAL(38,2)."""
    return (total_cents.cast("decimal(38,0)") * F.expr("0.01BD")).cast("decimal(38,2)")


def mean(total: Column, count: Column) -> Column:
    """``total / count`` of a DECIMAL(38,2) with six decimals, rounded half up once.

    NULL where nothing was counted.
    """
    return (total.cast("decimal(38,2)") / F.nullif(count, F.lit(0))).cast("decimal(38,6)")


def mean_money(total_cents: Column, count: Column) -> Column:
    """``total_cents / count`` in whole cents, rounded half away from zero once, as DECIMAL(38,2)."""
    n = F.nullif(count, F.lit(0)).cast("decimal(19,0)")
    doubled = F.abs(total_cents).cast("decimal(19,0)") * 2 + n
    whole = F.floor((doubled - F.pmod(doubled, n * 2)) / (n * 2)).cast("bigint")
    return money(whole * F.signum(total_cents.cast("double")).cast("bigint"))


def sample_stddev(count: Column, total_cents: Column, squares: Column) -> Column:
    """Sample standard deviation, in units, from exact sums of cents; NULL below two values."""
    n = count.cast("decimal(20,0)")
    s = total_cents.cast("decimal(19,0)")
    spread = n * squares - s * s
    pairs = count.cast("double") * (count - 1)
    return F.when(count > 1, F.sqrt(spread.cast("double") / F.nullif(pairs, F.lit(0.0))) / 100)


def clip_at_zero(value: Column) -> Column:
    """Negative values become 0 and NULL stays NULL."""
    return F.when(value < 0, F.lit(0)).otherwise(value)

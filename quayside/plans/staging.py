"""Cleaned orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import day_of_week
from quayside.schema import Tables


def stg_orders(tables: Tables) -> DataFrame:
    """One row per order that has an id and a date."""
    day = F.col("order_date").cast("date")
    return (
        tables["orders"]
        .filter(F.col("order_date").isNotNull() & F.col("order_id").isNotNull())
        .select(
            "order_id",
            "customer_id",
            day.alias("order_date"),
            F.lower(F.trim("status")).alias("status"),
            F.round("total_amount", 2).alias("total_amount"),
            F.year(day).alias("order_year"),
            F.month(day).alias("order_month"),
            day_of_week(day).alias("day_of_week"),
            "created_at",
        )
    )


def negative_revenue(tables: Tables) -> DataFrame:
    """Data test: every row is a failure."""
    return stg_orders(tables).filter(F.col("total_amount") < 0).select("order_id", "total_amount")

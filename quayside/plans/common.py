"""Shared steps of the models and features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.amounts import cents, line_cents, square
from quayside.functions.dates import month_start
from quayside.operators.joins import fact_join, lookup
from quayside.schema import Tables


def _item_totals() -> dict[str, Column]:
    return {
        "units": F.sum("quantity"),
        "amount_cents": F.sum(line_cents()),
        "priced_lines": F.count(line_cents()),
        "amount_squares": F.sum(square(line_cents())),
        "price_cents": F.sum(cents(F.col("unit_price"))),
        "prices": F.count("unit_price"),
    }


def order_totals(tables: Tables, orders: DataFrame, *totals: str) -> DataFrame:
    """Orders that have items, with the named totals of those.

    Items are reduced to one row per order before the join: counting orders needs no distinct
    afterwards (order_id is the primary key), an order with very many items combines map-side,
    and both inputs of the join are partitioned by order_id once.
    """
    sums = _item_totals()
    per_order = tables["order_items"].groupBy("order_id").agg(*(sums[t].alias(t) for t in totals))
    return fact_join(orders, per_order, "order_id")


def customer_months(tables: Tables, orders: DataFrame, *totals: str) -> DataFrame:
    """Order count, last order date and summed totals per customer and month.

    At most one row per month remains of a customer, however many orders there are, so what
    follows (joins, counting customers or months) is free of skew and of distinct counts.
    """
    return (
        order_totals(tables, orders, *totals)
        .groupBy("customer_id", month_start(F.col("order_date")).alias("month"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.max("order_date").alias("last_order_date"),
            *(F.sum(t).alias(t) for t in totals),
        )
    )


def customer_places(tables: Tables) -> DataFrame:
    """Branch and region of each customer that has both, to look up."""
    branches = tables["branches"].select("branch_id", "branch_name", "region_id")
    regions = tables["regions"].select("region_id", "region_name")
    customers = tables["customers"].select("customer_id", "branch_id")
    return lookup(customers.join(branches, "branch_id").join(regions, "region_id"), sized_by=customers, growing=True)

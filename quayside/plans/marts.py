"""Business aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.amounts import mean, money
from quayside.plans.common import customer_months, customer_places
from quayside.plans.staging import stg_orders
from quayside.schema import Tables


def mart_monthly_sales(tables: Tables) -> DataFrame:
    """Sales per region, branch and month. The average is that of the order lines."""
    months = customer_months(tables, stg_orders(tables), "units", "amount_cents", "priced_lines")
    revenue = money(F.sum("amount_cents"))
    return (
        months.join(customer_places(tables), "customer_id")
        .groupBy("region_name", "branch_name", "month")
        .agg(
            F.sum("orders").alias("total_orders"),
            revenue.alias("total_revenue"),
            mean(revenue, F.sum("priced_lines")).alias("avg_order_value"),
            F.sum("units").alias("total_units_sold"),
            # one row per customer and month by now
            F.count("customer_id").alias("unique_customers"),
        )
    )

"""Customer segments and the production-demand gap."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.amounts import mean_money, money, sample_stddev
from quayside.functions.dates import as_date
from quayside.operators.joins import fact_join
from quayside.operators.ranking import sort_key, with_ntiles
from quayside.plans.common import order_totals
from quayside.plans.staging import stg_orders
from quayside.schema import Tables

SCORES = ("r_score", "f_score", "m_score")


def rfm_base(tables: Tables, as_of: str | date | None = None) -> DataFrame:
    """Recency, frequency and spend per customer."""
    totals = order_totals(tables, stg_orders(tables), "amount_cents", "priced_lines", "amount_squares")
    spent, lines = F.sum("amount_cents"), F.sum("priced_lines")
    return totals.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.count(F.lit(1)).alias("frequency"),
        money(spent).alias("monetary"),
        F.datediff(as_date(as_of), F.max("order_date")).alias("recency_days"),
        mean_money(spent, lines).alias("avg_basket_size"),
        sample_stddev(lines, spent, F.sum("amount_squares")).alias("basket_variance"),
    )


def rfm_scored(tables: Tables, as_of: str | date | None = None, higher_is_better: bool = False) -> DataFrame:
    """Adds fifths of the customers by recency, frequency and spend; ties break by customer.

    By default fifth 1 holds the most recent, most frequent and best-paying customers, although
    the segments read high scores as good; ``higher_is_better`` turns the scores round.
    """
    keys = {
        "r_score": sort_key("recency_days", "customer_id"),
        "f_score": sort_key("frequency", "customer_id", descending=True),
        "m_score": sort_key("monetary", "customer_id", descending=True),
    }
    scored = with_ntiles(rfm_base(tables, as_of), keys)
    if higher_is_better:
        scored = scored.withColumns({s: 6 - F.col(s) for s in SCORES})
    return scored


# The segments, first match wins. Bounds on r_score and f_score.
def _segment() -> Column:
    r, f = F.col("r_score"), F.col("f_score")
    return (
        F.when((r >= 4) & (f >= 4), "Champion")
        .when((r >= 3) & (f >= 3), "Loyal")
        .when((r >= 3) & (f < 3), "Potential Loyal")
        .when((r < 2) & (f >= 3), "At Risk")
        .when((r < 2) & (f < 2), "Churned")
        .otherwise("Need Attention")
    )


def customer_rfm(tables: Tables, as_of: str | date | None = None, higher_is_better: bool = False) -> DataFrame:
    return rfm_scored(tables, as_of, higher_is_better).select(
        "customer_id",
        "last_order_date",
        "recency_days",
        "frequency",
        F.col("monetary").alias("lifetime_value"),
        "avg_basket_size",
        *SCORES,
        sum((F.col(s) for s in SCORES[1:]), F.col(SCORES[0])).alias("rfm_total"),
        _segment().alias("segment"),
    )


def production_demand_gap(tables: Tables, ordered: bool = True) -> DataFrame:
    """Units produced and ordered per day and product; latest day and worst shortfall first.

    Both sides are aggregated on the join keys, which the outer join then reuses.
    """
    produced = (
        tables["daily_production"]
        .groupBy(F.col("prod_date").alias("ref_date"), "product_id")
        .agg(F.sum("qty_produced").alias("total_produced"))
    )
    items = tables["order_items"].select("order_id", "product_id", "quantity")
    demanded = (
        fact_join(items, stg_orders(tables).select("order_id", "order_date"), "order_id")
        .groupBy(F.col("order_date").alias("ref_date"), "product_id")
        .agg(F.sum("quantity").alias("total_demanded"))
    )
    made, wanted = (F.coalesce(c, F.lit(0)) for c in ("total_produced", "total_demanded"))
    gap = (
        produced.join(demanded, ["ref_date", "product_id"], "full_outer")
        .select("ref_date", "product_id", made.alias("total_produced"), wanted.alias("total_demanded"))
        .withColumn("gap", F.col("total_produced") - F.col("total_demanded"))
        .withColumn("is_shortfall", F.col("gap") < 0)
    )
    # the product only spreads ties over the sort partitions
    order = (F.desc_nulls_first("ref_date"), F.asc_nulls_last("gap"), "product_id")
    return gap.orderBy(*order) if ordered else gap

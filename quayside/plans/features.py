"""Feature sets of the demand, churn and stockout models."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.functions.amounts import clip_at_zero, mean, money, sample_stddev
from quayside.functions.dates import as_date, day_of_week, week_start
from quayside.operators.joins import fact_join, lookup
from quayside.operators.timeseries import lag, series, trailing_mean, trailing_slope_of_4
from quayside.plans.common import customer_months, customer_places, order_totals
from quayside.schema import Tables

# Lags and windows in rows, and the churn limit in days.
DEMAND_LAGS = (7, 14, 30)
DEMAND_WINDOWS = (7, 30)
STOCKOUT_WINDOW = 4
CHURN_DAYS = 180


def demand_base(tables: Tables) -> DataFrame:
    """Orders, units and average price per day and region."""
    totals = order_totals(
        tables, tables["orders"].select("order_id", "customer_id", "order_date"), "units", "price_cents", "prices"
    )
    ds = F.col("ds")
    return (
        totals.join(customer_places(tables).select("customer_id", "region_id", "region_name"), "customer_id")
        .groupBy(F.col("order_date").alias("ds"), "region_id", "region_name")
        .agg(
            F.count(F.lit(1)).alias("y"),
            F.sum("units").alias("total_units"),
            mean(money(F.sum("price_cents")), F.sum("prices")).alias("avg_unit_price"),
        )
        .withColumns({"day_of_week": day_of_week(ds), "month": F.month(ds), "year": F.year(ds)})
    )


def with_demand_history(base: DataFrame) -> DataFrame:
    """Adds lags and trailing means of ``y`` per region."""
    days = series(["region_id"], "ds")
    return base.withColumns(
        {f"lag_{k}d": lag("y", k, days) for k in DEMAND_LAGS}
        | {f"rolling_{n}d_avg": trailing_mean("y", n, days) for n in DEMAND_WINDOWS}
    )


def demand_features(tables: Tables) -> DataFrame:
    return with_demand_history(demand_base(tables)).na.drop(subset=[f"lag_{k}d" for k in DEMAND_LAGS])


def churn_features(tables: Tables, as_of: str | date | None = None) -> DataFrame:
    """Spending behaviour per customer; churned without an order for more than 180 days."""
    orders = tables["orders"].select("order_id", "customer_id", "order_date")
    months = customer_months(tables, orders, "amount_cents", "priced_lines", "amount_squares")
    spent, lines = F.sum("amount_cents"), F.sum("priced_lines")
    recency = F.datediff(as_date(as_of), F.max("last_order_date"))
    return months.groupBy("customer_id").agg(
        F.max("last_order_date").alias("last_order_date"),
        F.sum("orders").alias("frequency"),
        clip_at_zero(money(spent)).cast("decimal(38,2)").alias("monetary"),
        mean(money(spent), lines).alias("avg_basket_size"),
        F.coalesce(sample_stddev(lines, spent, F.sum("amount_squares")), F.lit(0.0)).alias("basket_variance"),
        recency.alias("recency_days"),
        F.count("month").alias("active_months"),
        F.when(recency > CHURN_DAYS, 1).otherwise(0).alias("churned"),
    )


def regional_production(tables: Tables) -> DataFrame:
    """Units per product, region and week."""
    return (
        tables["daily_production"]
        .join(lookup(tables["suppliers"].select("supplier_id", "region_id")), "supplier_id")
        .groupBy("product_id", "region_id", week_start(F.col("prod_date")).alias("week"))
        .agg(F.sum("qty_produced").alias("produced"))
    )


def weekly_production(tables: Tables) -> DataFrame:
    """Units per product, branch and week; every branch of a region is credited in full.

    Output is summed per region first and fanned out to the branches last.
    """
    branches = lookup(tables["branches"].select("branch_id", "region_id"))
    return regional_production(tables).join(branches, "region_id").select("product_id", "branch_id", "week", "produced")


def weekly_demand(tables: Tables) -> DataFrame:
    """Units ordered per product, branch and week."""
    orders = tables["orders"].select("order_id", "customer_id", week_start(F.col("order_date")).alias("week"))
    placed = orders.join(lookup(tables["customers"].select("customer_id", "branch_id"), growing=True), "customer_id")
    items = tables["order_items"].select("order_id", "product_id", "quantity")
    return (
        fact_join(items, placed, "order_id")
        .groupBy("product_id", "branch_id", "week")
        .agg(F.sum("quantity").alias("demanded"))
    )


def _by_product(tables: Tables) -> DataFrame:
    """Rows of ``weekly_production`` (``made``) and of ``weekly_demand``, partitioned by product.

    Production is moved per region and fanned out to the branches where it arrives, so that no exchange carries a row per branch.
    """
    none = F.lit(None)
    made = regional_production(tables).select(
        "product_id", "region_id", none.alias("own_branch_id"), "week", "produced", none.alias("demanded"), F.lit(True).alias("made")
    )
    wanted = weekly_demand(tables).select(
        "product_id", none.alias("region_id"), F.col("branch_id").alias("own_branch_id"), "week", none.alias("produced"), "demanded", F.lit(False).alias("made")
    )
    branches = lookup(tables["branches"].select("branch_id", "region_id", F.lit(True).alias("placed")))
    fanned = made.union(wanted).repartition("product_id").join(branches, "region_id", "left")
    branch = F.when(F.col("made"), F.col("branch_id")).otherwise(F.col("own_branch_id"))
    return fanned.filter(~F.col("made") | F.col("placed")).select(
        "product_id", branch.alias("branch_id"), "week", "produced", "demanded", "made"
    )


#: A hash of branch and product, the first of their sort keys: it tells most rows apart by a number that the sort holds beside its pointers.
SERIES = "branch_id_product_id_hash"
SERIES_KEYS = [SERIES, "branch_id", "product_id"]


def _with_series(df: DataFrame) -> DataFrame:
    return df.withColumn(SERIES, F.xxhash64("branch_id", "product_id"))


def stockout_base(tables: Tables, keep_series: bool = False) -> DataFrame:
    """Production against demand per product, branch and week.

    The full outer join of both, made on rows that lie together by product: the rows of a key, of which there is
    one per copy of its branch and one of demand, take its demand over, and the row of demand stays where nothing was made.
    A key with a NULL matches nothing. What follows per branch and product needs no exchange and, with ``keep_series``, which
    keeps the first sort key, no sort.
    """
    keys = [*SERIES_KEYS, "week"]
    # rows of a series without a week stay in this order, demand first
    of_key = Window.partitionBy(*keys).orderBy("made").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    matches = F.col("branch_id").isNotNull() & F.col("product_id").isNotNull() & F.col("week").isNotNull()
    joined = (
        _with_series(_by_product(tables))
        .withColumns({"key_made": F.max("made").over(of_key), "key_demanded": F.max("demanded").over(of_key)})
        .filter(F.col("made") | ~(F.col("key_made") & matches))
        .withColumn("demanded", F.when(matches, F.col("key_demanded")).otherwise(F.col("demanded")))
    )
    made, wanted = (F.coalesce(c, F.lit(0)) for c in ("produced", "demanded"))
    return (
        joined.select("product_id", "branch_id", "week", made.alias("produced"), wanted.alias("demanded"), *([SERIES] if keep_series else []))
        .withColumn("gap", F.col("produced") - F.col("demanded"))
        .withColumn("is_stockout", (F.col("gap") < 0).cast("int"))
    )


def with_stockout_history(base: DataFrame) -> DataFrame:
    """Adds last week's gap, the mean gap and the demand slope of four weeks, per branch and product.

    Rows without a branch or product belong to no series.
    """
    weeks = series(SERIES_KEYS, "week")
    placed = base if SERIES in base.columns else _with_series(base)
    return (
        placed.filter(F.col("branch_id").isNotNull() & F.col("product_id").isNotNull())
        .withColumns(
            {
                "fill_rate_lag1": lag("gap", 1, weeks),
                "fill_rate_rolling": trailing_mean("gap", STOCKOUT_WINDOW, weeks),
                "demand_trend": trailing_slope_of_4("demanded", weeks),
            }
        )
        .drop(SERIES)
    )


def stockout_features(tables: Tables) -> DataFrame:
    return with_stockout_history(stockout_base(tables, keep_series=True)).na.drop(subset=["fill_rate_lag1"])

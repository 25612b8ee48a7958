"""One customer, one order and one product hold a third of all rows; no side may be broadcast."""

import pytest
from pyspark.sql import functions as F

from quayside.operators import joins
from quayside.plans.analysis import production_demand_gap, rfm_base, rfm_scored
from quayside.plans.features import churn_features, demand_base, stockout_base
from quayside.plans.marts import mart_monthly_sales
from quayside.sources.star import load_star

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    # split partitions of a few kilobytes already
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
}

LINES = """
select o.order_id, o.customer_id, o.order_date, i.product_id, i.quantity, i.unit_price, i.quantity * i.unit_price as amount
from sk_orders o join sk_order_items i on o.order_id = i.order_id
"""


@pytest.fixture(scope="module")
def tables(spark):
    tables = dict(load_star(spark, "/root/testdata/sf0.001"))

    def third(value, key):
        return F.when(F.col(key) % 3 == 0, value).otherwise

    tables["orders"] = tables["orders"].withColumn("customer_id", third(5, "order_id")(F.col("customer_id")))
    items = tables["order_items"].withColumn("product_id", third(7, "order_id")(F.col("product_id")))
    tables["order_items"] = items.withColumn("order_id", third(11, "quantity")(F.col("order_id")))
    for name, df in tables.items():
        df.createOrReplaceTempView(f"sk_{name}")
    spark.sql(LINES).createOrReplaceTempView("sk_lines")
    return tables


@pytest.fixture(autouse=True)
def shuffled(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def same(ours, spark, sql):
    theirs = spark.sql(sql)
    ours = ours.select(*theirs.columns)
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()


def test_mart(spark, tables):
    same(
        mart_monthly_sales(tables),
        spark,
        """select region_name, branch_name, trunc(order_date, 'month') as month,
        count(distinct order_id) as total_orders, cast(sum(amount) as decimal(38,2)) as total_revenue,
        sum(quantity) as total_units_sold, count(distinct l.customer_id) as unique_customers
        from sk_lines l join sk_customers using (customer_id) join sk_branches using (branch_id)
        join sk_regions using (region_id) group by 1, 2, 3""",
    )


def test_rfm_and_churn(spark, tables):
    sql = """select customer_id, count(distinct order_id) as frequency, cast(sum(amount) as decimal(38,2)) as monetary,
        count(distinct trunc(order_date, 'month')) as active_months from sk_lines group by customer_id"""
    same(churn_features(tables, "2001-08-01"), spark, sql)
    base = rfm_base(tables, "2001-08-01")
    direct = spark.sql("select customer_id, stddev_samp(double(amount)) as expected from sk_lines group by customer_id")
    off = base.join(direct, "customer_id").filter("abs(basket_variance - expected) > 1e-6 * expected")
    assert off.isEmpty() and rfm_scored(tables, "2001-08-01").count() == base.count()


def test_gap(spark, tables):
    same(
        production_demand_gap(tables),
        spark,
        """select ref_date, product_id, coalesce(made, 0) as total_produced, coalesce(wanted, 0) as total_demanded
        from (select prod_date as ref_date, product_id, sum(qty_produced) as made from sk_daily_production group by 1, 2)
        full outer join (select order_date as ref_date, product_id, sum(quantity) as wanted from sk_lines group by 1, 2)
        using (ref_date, product_id)""",
    )


def test_demand_and_stockout(spark, tables):
    same(
        demand_base(tables),
        spark,
        """select order_date as ds, region_id, count(distinct order_id) as y, sum(quantity) as total_units
        from sk_lines join sk_customers using (customer_id) join sk_branches using (branch_id) group by 1, 2""",
    )
    same(
        stockout_base(tables),
        spark,
        """select product_id, branch_id, week, coalesce(made, 0) as produced, coalesce(wanted, 0) as demanded from
        (select product_id, branch_id, trunc(prod_date, 'week') as week, sum(qty_produced) as made
         from sk_daily_production join sk_suppliers using (supplier_id) join sk_branches using (region_id) group by 1, 2, 3)
        full outer join
        (select product_id, branch_id, trunc(order_date, 'week') as week, sum(quantity) as wanted
         from sk_lines join sk_customers using (customer_id) group by 1, 2, 3)
        using (product_id, branch_id, week)""",
    )


def test_hot_keys_are_split(spark):
    star = load_star(spark, "/root/testdata/sf0.01")
    hot = F.when(F.col("quantity") % 3 == 0, 11).otherwise(F.col("order_id"))
    items = star["order_items"].withColumn("order_id", hot).repartition(8).select("order_id", "quantity")
    joined = joins.fact_join(items, star["orders"].select("order_id", "order_date"), "order_id")
    summed = joined.groupBy("order_date").agg(F.sum("quantity"))
    summed.collect()
    assert "SortMergeJoin(skew=true)" in summed._jdf.queryExecution().executedPlan().toString()

"""Small tables for the corner cases of models and features."""

import statistics
from decimal import Decimal

import pytest

from quayside.plans.analysis import customer_rfm, production_demand_gap, rfm_base, rfm_scored
from quayside.plans.features import churn_features, demand_base, stockout_base
from quayside.plans.marts import mart_monthly_sales
from quayside.plans.staging import negative_revenue, stg_orders

SCHEMAS = {
    "regions": "region_id int, region_name string",
    "branches": "branch_id int, branch_name string, region_id int",
    "customers": "customer_id int, branch_id int",
    "suppliers": "supplier_id int, region_id int",
    "orders": "order_id int, customer_id int, order_date string, status string, total_amount decimal(14,3)",
    "order_items": "order_id int, product_id int, quantity int, unit_price decimal(10,2)",
    "daily_production": "supplier_id int, product_id int, prod_date string, qty_produced int",
}
ROWS = {
    "regions": [(1, "north"), (2, "south")],
    "branches": [(10, "a", 1), (11, "b", 1), (20, "c", 2)],
    "customers": [(100, 10), (101, 11), (102, 20), (103, None)],
    "suppliers": [(7, 1), (8, 2)],
    "orders": [
        (1, 100, "2024-01-31", " Pend ", "12.345"),
        (2, 100, "2024-02-01", "DONE", "-1"),
        (3, 101, "2024-02-04", "x", "5"),
        (4, 103, "2024-02-05", "x", "5"),
        (5, 100, None, "x", "5"),
        (6, 102, "2024-02-05", "x", "5"),
        (7, 102, "2024-02-06", "x", "5"),
    ],
    "order_items": [
        (1, 1, 2, "10.00"),
        (1, 2, 1, "5.55"),
        (2, 1, 1, "3.00"),
        (3, 1, 4, "2.50"),
        (4, 1, 1, "1.00"),
        (6, 3, 1, None),
        (None, 1, 1, "1.00"),
        (99, 1, 1, "1.00"),
    ],
    "daily_production": [(7, 1, "2024-01-31", 5), (7, 9, "2024-01-31", 3), (8, 1, "2024-02-05", 2), (None, 1, "2024-02-05", 2)],
}


@pytest.fixture(scope="module")
def tables(spark):
    def build(name):
        decimals = {"orders": 4, "order_items": 3}
        at = decimals.get(name)
        rows = [
            tuple(Decimal(v) if i == at and v is not None else v for i, v in enumerate(row)) for row in ROWS[name]
        ]
        df = spark.createDataFrame(rows, SCHEMAS[name])
        for date_column in ("order_date", "prod_date"):
            if date_column in df.columns:
                df = df.withColumn(date_column, df[date_column].cast("date"))
        return df.selectExpr("*", "timestamp_ntz'2024-03-01 00:00:00' as created_at")

    return {name: build(name) for name in SCHEMAS}


def test_staging(tables):
    rows = {r.order_id: r for r in stg_orders(tables).collect()}
    assert 5 not in rows and len(rows) == 6
    assert rows[1].status == "pend" and rows[1].total_amount == Decimal("12.35")
    assert (rows[3].day_of_week, rows[3].order_year, rows[3].order_month) == (0, 2024, 2)
    assert [tuple(r) for r in negative_revenue(tables).collect()] == [(2, Decimal("-1.00"))]


def test_mart_averages_lines_and_drops_what_has_no_place(tables):
    rows = {(r.region_name, r.branch_name, str(r.month)): r for r in mart_monthly_sales(tables).collect()}
    # the order of the branch-less customer and the one without items are gone
    assert set(rows) == {
        ("north", "a", "2024-01-01"),
        ("north", "a", "2024-02-01"),
        ("north", "b", "2024-02-01"),
        ("south", "c", "2024-02-01"),
    }
    january = rows["north", "a", "2024-01-01"]
    assert (january.total_orders, january.total_units_sold, january.unique_customers) == (1, 3, 1)
    assert january.total_revenue == Decimal("25.55") and january.avg_order_value == Decimal("12.775")
    unpriced = rows["south", "c", "2024-02-01"]
    assert unpriced.total_revenue is None and unpriced.avg_order_value is None and unpriced.total_orders == 1


def test_rfm_base(tables):
    rows = {r.customer_id: r for r in rfm_base(tables, "2024-03-01").collect()}
    assert set(rows) == {100, 101, 102, 103}
    assert (rows[100].frequency, rows[100].recency_days) == (2, 29)
    assert rows[100].basket_variance == pytest.approx(statistics.stdev([20.0, 5.55, 3.0]))
    assert rows[101].basket_variance is None and rows[102].monetary is None


def test_rfm_scores_as_published_or_turned_round(tables):
    plain = {r.customer_id: r for r in rfm_scored(tables, "2024-03-01").collect()}
    turned = {r.customer_id: r for r in rfm_scored(tables, "2024-03-01", higher_is_better=True).collect()}
    # spend unknown sorts first descending; the latest order is the first fifth
    assert plain[102].m_score == 1 and plain[102].r_score == 1
    assert all(turned[c].r_score == 6 - plain[c].r_score for c in plain)
    segments = {r.customer_id: r.segment for r in customer_rfm(tables, "2024-03-01").collect()}
    assert segments == {100: "Potential Loyal", 101: "Potential Loyal", 102: "At Risk", 103: "Need Attention"}


def test_gap_keeps_products_of_either_side(tables):
    rows = production_demand_gap(tables).collect()
    found = {(str(r.ref_date), r.product_id): (r.total_produced, r.total_demanded, r.gap, r.is_shortfall) for r in rows}
    assert found["2024-01-31", 1] == (5, 2, 3, False)
    assert found["2024-01-31", 9] == (3, 0, 3, False)
    assert found["2024-02-04", 1] == (0, 4, -4, True)
    order = [(r.ref_date, r.gap) for r in rows]
    assert order == sorted(order, key=lambda pair: (-pair[0].toordinal(), pair[1]))


def test_demand_base(tables):
    rows = {(str(r.ds), r.region_id): r for r in demand_base(tables).collect()}
    assert rows["2024-01-31", 1].y == 1 and rows["2024-01-31", 1].total_units == 3
    assert rows["2024-01-31", 1].avg_unit_price == Decimal("7.775")
    assert rows["2024-02-04", 1].day_of_week == 0
    assert rows["2024-02-05", 2].avg_unit_price is None


def test_churn_features(tables):
    rows = {r.customer_id: r for r in churn_features(tables, "2024-07-29").collect()}
    assert (rows[100].active_months, rows[100].frequency, rows[100].churned) == (2, 2, 0)
    assert rows[101].basket_variance == 0.0 and rows[102].monetary is None
    later = {r.customer_id: r.churned for r in churn_features(tables, "2024-08-03").collect()}
    # 184, 181 and 180 days
    assert later[100] == 1 and later[101] == 1 and later[102] == 0


def test_production_is_credited_to_every_branch_of_the_region(tables):
    rows = {(r.product_id, r.branch_id, str(r.week)): r for r in stockout_base(tables).collect()}
    for branch in (10, 11):
        assert rows[1, branch, "2024-01-29"].produced == 5 and rows[9, branch, "2024-01-29"].produced == 3
    assert rows[1, 10, "2024-01-29"].demanded == 3 and rows[1, 10, "2024-01-29"].is_stockout == 0
    assert rows[1, 20, "2024-02-05"].produced == 2
    assert rows[3, 20, "2024-02-05"].is_stockout == 1
    # demand of a customer without a branch is a row of its own
    assert rows[1, None, "2024-02-05"].demanded == 1


def test_mean_is_rounded_once(spark):
    from pyspark.sql import functions as F

    from quayside.functions.amounts import mean_money

    df = spark.createDataFrame([(2009999, 20001), (-2009999, 20001), (5, 2), (None, 0)], "cents bigint, n bigint")
    got = [r.m for r in df.select(mean_money(F.col("cents"), F.col("n")).alias("m")).collect()]
    assert [None if m is None else str(m) for m in got] == ["1.00", "-1.00", "0.03", None]


def test_items_without_a_month_stay(spark):
    from quayside.plans import layout

    items = spark.createDataFrame([(1, 5), (None, 6), (99, 7)], "order_id bigint, quantity int")
    orders = spark.sql("SELECT 1L order_id, DATE'2001-02-03' order_date")
    got = layout.items_with_month({"order_items": items, "orders": orders}).collect()
    assert sorted((r.quantity, r.order_ym) for r in got) == [(5, "2001-02"), (6, "none"), (7, "none")]


def test_regions_without_a_model_stay(spark):
    from quayside.ml import forecast

    days = spark.sql(
        "SELECT r region_id, date_add(DATE'2001-01-01', CAST(d AS INT)) ds, 10 + d % 7 y, CAST(5.0 AS DOUBLE) avg_unit_price, "
        "CAST(10 + d % 3 AS DOUBLE) rolling_7d_avg FROM (SELECT explode(sequence(1L, 2L)) r), (SELECT explode(sequence(0L, 59L)) d)"
    )
    models = forecast.fit(days.filter("region_id = 1"))
    got = forecast.predict(models, forecast.future_frame(days, 3)).groupBy("region_id").count().collect()
    assert sorted((r.region_id, r["count"]) for r in got) == [(1, 3), (2, 3)]


def test_stockout_base_is_the_full_outer_join(spark):
    """Copies of a branch, a branch of two regions and one without an id, NULL keys, regions without a branch or supplier."""
    from pyspark.sql import functions as F

    from quayside.plans.features import stockout_base, weekly_demand, weekly_production

    def build(kind, rows):
        return spark.createDataFrame(rows, kind)

    faulty = {
        "branches": build("branch_id int, region_id int", [(10, 1), (10, 1), (11, 1), (20, 2), (11, 2), (None, 2), (30, None)]),
        "suppliers": build("supplier_id int, region_id int", [(7, 1), (7, 1), (8, 2), (9, 3), (5, None)]),
        "customers": build("customer_id int, branch_id int", [(1, 10), (2, 11), (2, 11), (3, 20), (4, None), (5, 30), (6, 77)]),
        "orders": build("order_id int, customer_id int, order_date string", [(i, i % 7 + 1, None if i % 5 == 0 else f"2024-01-{i % 28 + 1:02}") for i in range(60)]),
        "order_items": build("order_id int, product_id int, quantity int", [(i % 61, None if i % 11 == 0 else i % 4, None if i % 13 == 0 else i) for i in range(240)]),
        "daily_production": build(
            "supplier_id int, product_id int, prod_date string, qty_produced int",
            [(5 + i % 6, None if i % 7 == 0 else i % 5, None if i % 9 == 0 else f"2024-01-{i % 28 + 1:02}", None if i % 8 == 0 else i) for i in range(200)],
        ),
    }
    for table, day in (("orders", "order_date"), ("daily_production", "prod_date")):
        faulty[table] = faulty[table].withColumn(day, F.col(day).cast("date"))
    keys = ["product_id", "branch_id", "week"]
    amounts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("produced", "demanded")]
    expected = weekly_production(faulty).join(weekly_demand(faulty), keys, "full_outer").select(*keys, *amounts)
    got = stockout_base(faulty).select(*expected.columns)
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty() and got.count() == expected.count() > 50


def test_stockout_rows_are_not_moved_per_branch(spark, sf):
    from quayside.plans.features import stockout_features
    from quayside.sources.star import load_star

    plan = stockout_features(load_star(spark, sf))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line.split("Exchange ")[1] for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # days, regions, orders, items, demand, and both by product, after which the series need no other
    assert plan.count("+- Sort [branch_id") == 1  # for the join and the series
    assert len(exchanges) == 6 and sum(e.startswith("hashpartitioning(product_id") and "REPARTITION_BY_COL" in e for e in exchanges) == 1

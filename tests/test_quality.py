from datetime import date

import pytest

from quayside.operators import constraints
from quayside.plans import quality
from quayside.registry import MINIMUM_ROWS
from quayside.sources.star import load_star


@pytest.fixture(scope="module")
def broken(spark):
    day = date(2024, 1, 1)
    return {
        "customers": spark.createDataFrame([(1, "a"), (2, None)], "customer_id int, customer_name string"),
        "orders": spark.createDataFrame(
            [(1, 1, day, "x" * 51), (1, 1, day, "y"), (1, 9, None, "z"), (2, None, day, "z")],
            "order_id int, customer_id int, order_date date, status string",
        ),
        "order_items": spark.createDataFrame(
            [(1, 1), (None, 0), (77, -1), (2, None)], "order_id int, quantity int"
        ).selectExpr("*", "1 as product_id"),
        "products": spark.createDataFrame([(1, "p")], "product_id int, product_name string"),
        "suppliers": spark.createDataFrame([(1, "s")], "supplier_id int, supplier_name string"),
        "daily_production": spark.createDataFrame([(1, 1, day, 0)], "supplier_id int, product_id int, prod_date date, qty_produced int"),
    }


def test_checks_count_what_is_wrong(broken):
    minimums = quality.MINIMUM_ROWS | dict.fromkeys(quality.COUNTED, 2)
    rows = {r.name: (r.result, r.status) for r in quality.report(broken, minimums).collect()}
    assert rows == {
        "row_count_orders": (4, "PASS"),
        "row_count_order_items": (4, "PASS"),
        "row_count_customers": (2, "PASS"),
        "row_count_daily_production": (1, "FAIL"),
        "orphan_items": (2, "FAIL"),  # NULL counts here
        "orphan_orders": (2, "FAIL"),
        "orphan_production": (0, "PASS"),
        "null_order_date": (1, "FAIL"),
        "bad_quantity": (3, "FAIL"),
        "duplicate_orders": (1, "FAIL"),  # keys, not rows
    }


def test_constraints(broken):
    rows = {(r.kind, r.table_name, r.rule): r.violations for r in constraints.report(broken).collect()}
    assert rows["primary_key", "orders", "order_id"] == 1
    assert rows["foreign_key", "orders", "customer_id -> customers"] == 1  # NULL is legal here
    assert rows["foreign_key", "order_items", "order_id -> orders"] == 1
    assert rows["not_null", "customers", "customer_name"] == 1
    assert rows["not_null", "orders", "order_date"] == 1
    assert rows["max_length", "orders", "status <= 50"] == 1
    assert rows["check", "order_items", "quantity_positive"] == 2
    assert rows["check", "daily_production", "qty_produced_not_negative"] == 0


def test_runner_stops_at_the_first_failure(broken):
    results = quality.run_checks(broken, quality.MINIMUM_ROWS, fail_fast=True)
    assert [r[2] for r in results] == ["FAIL"]
    assert len(quality.run_checks(broken)) == 10


def test_a_check_that_cannot_run_is_an_error(broken):
    without = {**broken, "customers": broken["customers"].drop("customer_id")}
    results = {r[0]: r[2] for r in quality.run_checks(without)}
    assert results["orphan_orders"] == "ERROR"
    missing = {k: v for k, v in broken.items() if k != "suppliers"}
    assert {r[0]: r[2] for r in quality.run_checks(missing)}["orphan_production"] == "ERROR"


def test_gate(spark, broken):
    with pytest.raises(quality.QualityError, match="row_count_orders"):
        quality.gate(broken)
    tables = load_star(spark, "/root/testdata/sf0.01")
    quality.gate(tables, MINIMUM_ROWS)

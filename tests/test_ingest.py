from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quayside.ml import runs, train
from quayside.operators import joins
from quayside.operators.constraints import orphans
from quayside.operators.keys import with_file_order_key
from quayside.plans import jobs, layout, models, quality
from quayside.plans.common import customer_places
from quayside.sources.csv_load import ConstraintError, load_table, load_tables, read_csv
from quayside.sources.star import load_star


def write(folder, name, text):
    path = folder / f"{name}.csv"
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_null_marker_empty_and_quoted_values(spark, tmp_path):
    path = write(
        tmp_path,
        "suppliers",
        'any,header,names\nAcme,\\N,1\n"Say ""hi"", Ltd",,\\N\nÜber,"",2\n',
    )
    rows = read_csv(spark, "suppliers", path).orderBy("supplier_id").collect()
    assert [(r.supplier_id, r.supplier_name, r.contact_email, r.region_id) for r in rows] == [
        (1, "Acme", None, 1),
        (2, 'Say "hi", Ltd', "", None),
        (3, "Über", "", 2),
    ]
    assert rows[0].created_at is not None


def test_redundant_column_is_dropped(spark, tmp_path):
    path = write(tmp_path, "regions", "region_name,column1,country\nnorth,x,DE\n")
    row = read_csv(spark, "regions", path).first()
    assert (row.region_id, row.region_name, row.country) == (1, "north", "DE")


def test_wrong_columns_and_values_fail(spark, tmp_path):
    with pytest.raises(ValueError, match="expected the columns"):
        read_csv(spark, "regions", write(tmp_path, "regions", "region_name\nnorth\n"))
    bad = write(tmp_path, "branches", "a,b,c\nx,not a number,y\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_csv(spark, "branches", bad)
    short = write(tmp_path, "products", "a,b,c\nx,y\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv(spark, "products", short)


def test_decimals_round_half_up(spark, tmp_path):
    row = read_csv(spark, "products", write(tmp_path, "products", "a,b,c\nx,y,12.345\n")).first()
    assert row.unit_cost == Decimal("12.35")
    too_large = write(tmp_path, "products", "a,b,c\nx,y,123456789.00\n")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        read_csv(spark, "products", too_large)


def test_keys_follow_the_files_over_many_splits(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for part in range(3):
        lines = "\n".join(str(part * 1000 + i) for i in range(1000))
        (folder / f"part-{part}.csv").write_text("n\n" + lines + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        scan = spark.read.schema("n long").option("header", True).csv(str(folder))
        assert scan.rdd.getNumPartitions() > 8
        keyed = with_file_order_key(scan, "key")
        assert keyed.filter("key <> n + 1").isEmpty() and keyed.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_load_modes_and_failures(spark, tmp_path):
    layout.create_tables(spark, "load_test")
    layout.create_tables(spark, "load_test")
    write(tmp_path, "regions", "a,b\nnorth,DE\nsouth,\\N\n")
    write(tmp_path, "suppliers", "a,b,c\nAcme,\\N,1\n")
    assert [(x.table, x.rows) for x in load_tables(spark, str(tmp_path), "load_test")] == [("regions", 2), ("suppliers", 1)]
    load_table(spark, "regions", str(tmp_path), "load_test")
    assert spark.table("load_test.regions").count() == 2
    load_table(spark, "regions", str(tmp_path), "load_test", mode="append")
    keys = [r.region_id for r in spark.table("load_test.regions").orderBy("region_id").collect()]
    assert keys == [1, 2, 3, 4]
    with pytest.raises(ValueError, match="unknown table"):
        load_tables(spark, str(tmp_path), "load_test", "nothing")

    write(tmp_path, "suppliers", "a,b,c\nAcme,\\N,99\n\\N,\\N,1\n")
    with pytest.raises(ConstraintError, match="not_null supplier_name.*foreign_key region_id"):
        load_table(spark, "suppliers", str(tmp_path), "load_test")
    assert spark.table("load_test.suppliers").count() == 1  # the load before is untouched


@pytest.fixture(scope="module")
def csv_dir(spark, tmp_path_factory):
    """The smallest star-schema tables as CSV files, whose keys are assigned at load from 1 on."""
    folder = tmp_path_factory.mktemp("csv")
    tables = load_star(spark, "/root/testdata/sf0.001")

    def save(name, order, *columns):
        rows = tables[name].orderBy(*order).selectExpr(*columns)
        rows.coalesce(1).write.option("header", True).option("nullValue", "\\N").csv(f"{folder}/{name}.csv")

    save("regions", ["region_id"], "region_name", "string(null) country")
    save("suppliers", ["supplier_id"], "supplier_name", "string(null) email", "region_id + 1 region_id")
    save("branches", ["branch_id"], "branch_name", "region_id + 1 region_id", "string(null) address")
    save("products", ["product_id"], "product_name", "category", "unit_cost")
    save("customers", ["customer_id"], "customer_name", "string(null) email", "branch_id + 1 branch_id", "date(null) joined_at")
    save("orders", ["order_id"], "customer_id + 1 customer_id", "order_date", "status", "total_amount")
    save("order_items", ["order_id"], "order_id + 1 order_id", "product_id + 1 product_id", "quantity", "unit_price")
    save("daily_production", ["prod_date"], "supplier_id + 1 supplier_id", "product_id + 1 product_id", "prod_date", "qty_produced")
    return str(folder)


SMALL = quality.MINIMUM_ROWS | dict.fromkeys(quality.COUNTED, 100)


def test_everything_from_files_to_models(spark, csv_dir, tmp_path):
    paths = jobs.run_all(
        spark,
        csv_dir,
        str(tmp_path),
        "full",
        SMALL,
        "2001-08-01",
        ("2000-06-30", "2001-03-31"),
        {"numTrees": 3, "maxDepth": 3},
        {"trees": 2, "depth": 3},
    )
    star, raw = load_star(spark, "/root/testdata/sf0.001"), layout.read_tables(spark, "full")
    assert {n: df.count() for n, df in raw.items()} == {n: df.count() for n, df in star.items()}
    assert spark.table("stg_orders").count() == star["orders"].count()

    columns = ["region_name", "branch_name", "month", "total_orders", "total_revenue", "unique_customers"]
    stored = spark.table("full_marts.mart_monthly_sales").select(*columns)
    direct = models.LAYERS["marts"]["mart_monthly_sales"].plan(star).select(*columns)
    assert stored.exceptAll(direct).isEmpty() and direct.exceptAll(stored).isEmpty()

    assert spark.table("full_analysis.analysis_customer_rfm").count() > 0
    assert spark.table("full_analysis.analysis_production_demand_gap").count() > 0
    described = spark.sql("DESCRIBE EXTENDED full.orders").filter("col_name = 'Statistics'").first()
    assert "rows" in described.data_type
    logged = {r.run_name: r for r in runs.runs(spark, f"{tmp_path}/store").collect()}
    assert set(logged) == {
        "churn_logistic_regression", "churn_random_forest", "stockout_boosted_trees", "demand_per_region",
    }
    assert logged["churn_random_forest"].metrics["test_auc"] > 0.5
    assert logged["stockout_boosted_trees"].metrics["val_auc"] > 0.5
    assert logged["demand_per_region"].metrics["mean_mape"] >= 0

    for _ in range(2):  # a second run replaces the first
        written = jobs.score_all(spark, paths, f"{tmp_path}/store", "full_predictions", "2001-08-01")
    churn, stockout, demand = (spark.table(f"full_predictions.predictions_{n}") for n in ("churn", "stockout", "demand"))
    assert len(written) == 3
    assert churn.columns == ["customer_id", "churn_probability", "label", "prediction_date"]
    assert churn.count() == spark.read.parquet(paths["churn"]).na.drop(subset=train.CHURN_COLUMNS).count()
    assert churn.filter("churn_probability not between 0 and 1 or label <> int(churn_probability >= 0.5)").isEmpty()
    assert stockout.columns == ["branch_id", "product_id", "week", "stockout_probability", "risk_label", "prediction_date"]
    assert demand.filter("not (yhat_lower <= predicted_orders and predicted_orders <= yhat_upper)").isEmpty()
    assert {r["count"] for r in demand.groupBy("region_id").count().collect()} == {30}


def test_gate_stops_the_job(spark, tmp_path):
    write(tmp_path, "regions", "a,b\nnorth,DE\n")
    with pytest.raises(quality.QualityError, match="row_count_orders"):
        jobs.ingest(spark, str(tmp_path), "gated", marts_database="gated_marts")
    assert not spark.catalog.databaseExists("gated_marts")


def test_negative_revenue_fails_the_data_test(spark):
    orders = spark.sql("select 1 as order_id, 1 as customer_id, date'2024-01-01' as order_date, 'x' as status, -1.00BD as total_amount, timestamp_ntz'2024-01-01' as created_at")
    with pytest.raises(models.DataTestError):
        models.run_data_tests({"orders": orders})


def test_layout(spark):
    tables = load_star(spark, "/root/testdata/sf0.001")
    spark.sql("CREATE DATABASE IF NOT EXISTS laid_out")
    layout.write_bucketed(tables, "laid_out", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders, items = (spark.table(f"laid_out.{n}_by_order") for n in ("orders", "order_items"))
        joined = orders.join(items, "order_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == tables["order_items"].count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    layout.write_items_by_month(tables, "laid_out.items_by_month")
    monthly = spark.table("laid_out.items_by_month").filter(F.col("order_ym") == "1998-03")
    assert "PartitionFilters: [isnotnull(order_ym" in monthly._jdf.queryExecution().executedPlan().toString()
    expected = tables["orders"].filter("date_format(order_date, 'yyyy-MM') = '1998-03'").join(tables["order_items"], "order_id")
    assert monthly.count() == expected.count() > 0


def test_growing_dimensions_are_broadcast_by_what_they_take_there(spark, sf, monkeypatch):
    tables = load_star(spark, sf)
    customers = tables["customers"].select("customer_id", "branch_id")
    size = int(str(customers._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))

    def hints(df):
        plan = df._jdf.queryExecution().analyzed().toString()
        return "strategy=broadcast" in plan, "strategy=merge" in plan

    plans = [lambda: customer_places(tables), lambda: orphans(tables["orders"], "customer_id", customers, "customer_id")]
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 2 * size)  # fits as a file, not as rows
    assert [hints(plan()) for plan in plans] == [(False, True)] * 2
    monkeypatch.setattr(joins, "BROADCAST_BYTES", joins.GROWING * size)
    assert [hints(plan()) for plan in plans] == [(True, False)] * 2

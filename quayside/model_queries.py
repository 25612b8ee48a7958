"""Registered queries over models with given parameters, single steps of training, loads, sinks and stores."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.ml import boosting, decomposed, runs, score, train
from quayside.ml.boosting import Boosted, Tree
from quayside.operators.staged import best_prefix, running, staged_auc
from quayside.plans import clustering, distribution, features, jobs, models, quality
from quayside.registry import AS_OF, Query, activity_score, churn, demand_features, over_tables, portable, rounded
from quayside.schema import TABLES, Tables
from quayside.session import materialize, new_path
from quayside.sources import csv_load
from quayside.sources.star import load_star, read_star

# -- boosted trees -----------------------------------------------------------------------------

#: Cuts of three columns of the stockout features.
GIVEN_EDGES = {"produced": [20.0, 50.0, 100.0], "demanded": [10.0, 30.0, 60.0], "gap": [-20.0, 0.0, 40.0]}
#: Sums of gradients are whole numbers of a quarter.
GIVEN_SCALE = 4.0


def boosted_histogram(t: Tables) -> DataFrame:
    """Gradients of two nodes before any tree, stockouts weighted threefold."""
    rows = features.stockout_features(t).select(*GIVEN_EDGES, "is_stockout")
    binned = boosting.with_bins(rows, list(GIVEN_EDGES), list(GIVEN_EDGES.values()))
    weighted = binned.withColumn("weight", F.when(F.col("is_stockout") == 1, 3.0).otherwise(1.0))
    gradients = boosting.with_gradients(weighted, "is_stockout", "weight", F.lit(0.0), GIVEN_SCALE)
    node = F.when(F.col("demanded") >= 30, 3).otherwise(2)
    return boosting.histogram(gradients, node, range(len(GIVEN_EDGES)))


def first_cuts(t: Tables) -> list[boosting.Cut]:
    return boosting.best_cuts(boosted_histogram(t), GIVEN_SCALE, penalty=1.0, least_hessian=1.0)


def boosted_first_cuts(t: Tables) -> DataFrame:
    schema = "node bigint, g double, h double, feature bigint, cut bigint, gain double, g_left double, h_left double"
    return rounded(t["orders"].sparkSession.createDataFrame(first_cuts(t), schema), 6, "gain")


def boosted_importances(t: Tables) -> DataFrame:
    """Importances of a tree that has the best cuts of both nodes."""
    tree = Tree.empty(2)
    for r in first_cuts(t):
        tree.feature[r.node], tree.gain[r.node] = r.feature, r.gain
    columns = list(GIVEN_EDGES)
    return rounded(train.importances(t["orders"].sparkSession, Boosted(columns, 2, [tree]), columns), 6, "importance")


#: Two trees over the stockout columns: produced, demanded, gap, fill_rate_lag1, fill_rate_rolling, demand_trend.
GIVEN_TREES = [
    Tree([None, 2, 1, None], [None] * 4, [None, 0.0, 30.0, None], [None, 0.0, 0.0, -0.5, 0.25, 0.75, None, None], [None, 2.0, 1.0, None]),
    Tree([None, 5, None, None], [None] * 4, [None, 0.5, None, None], [None, 0.0, -0.125, 0.125], [None, 1.0, None, None]),
]


def predictions_stockout_given(t: Tables) -> DataFrame:
    """Scores of an ensemble that was stored as a table."""
    model = Boosted(train.STOCKOUT_COLUMNS, 2, GIVEN_TREES)
    stored = materialize(model.to_rows(t["orders"].sparkSession))
    return rounded(score.stockout(features.stockout_features(t), stored, AS_OF), 9, "stockout_probability")


def boosted_early_stop(t: Tables) -> DataFrame:
    """Eight steps by a customer's orders, the later ones partly by its number; patience of three."""
    steps = [F.when(F.col("frequency") >= 4 * k, -0.25).otherwise(0.25) for k in range(1, 5)]
    steps += [F.when(F.col("customer_id") % k == 0, 0.5).otherwise(-0.25) for k in range(5, 9)]
    customers = churn(t).select("churned", running(F.lit(0.0), F.array(*steps)).alias("margins"))
    return rounded(best_prefix(staged_auc(customers, "churned", "margins"), 3), 9, "auc")


# -- classifiers whose fit has a closed form ---------------------------------------------------


def flagged(t: Tables) -> DataFrame:
    """Customers with one feature, whether they bought in many months."""
    return churn(t).select("customer_id", (F.col("active_months") >= 8).cast("double").alias("often"), "churned")


def predictions_churn_flag_forest(t: Tables) -> DataFrame:
    rows = materialize(flagged(t))
    model = train.fit_random_forest(rows, ["often"], "churned", numTrees=1, maxDepth=1, bootstrap=False, featureSubsetStrategy="all")
    return rounded(score.churn(rows, model, AS_OF), 6, "churn_probability")


def predictions_churn_flag_logistic(t: Tables) -> DataFrame:
    rows = materialize(flagged(t))
    model = train.fit_logistic(rows, ["often"], "churned", c=1e9)  # next to no penalty
    return rounded(score.churn(rows, model, AS_OF), 2, "churn_probability")


# -- forecast ----------------------------------------------------------------------------------


def decomposed_given_weights(t: Tables) -> DataFrame:
    """History as a model of given parameters sees it."""
    days = materialize(demand_features(t))
    spans = decomposed.spans(days.na.drop(subset=["y", *decomposed.REGRESSORS]))

    def weights(n: int, given: dict[int, float]):
        return F.lit([given.get(i, 0.0) for i in range(n)])

    seasons = weights(2 * (decomposed.WEEKLY_ORDER + decomposed.YEARLY_ORDER) + 2, {0: 0.1, 7: 0.2, 26: 0.05, 27: 0.02})
    parameters = {"line": F.lit([0.5, 0.2]), "bends": weights(decomposed.CHANGEPOINTS, {4: 0.3}), "seasons": seasons}
    found = decomposed.expected(spans.withColumns(parameters), days)
    return rounded(found.select("region_id", "ds", "yhat"), 3, "yhat")


def forecast_bands_of_paths(t: Tables) -> DataFrame:
    """Bands of given paths: per region and weekday, each week's units are one."""
    days = features.demand_features(t).select("region_id", "day_of_week", F.col("total_units").cast("double").alias("value"))
    return rounded(decomposed.bands(days, ["region_id", "day_of_week"]), 6, "yhat_lower", "yhat_upper")


# -- files, tables, stores ---------------------------------------------------------------------


def csv_products(spark: SparkSession, folder: str) -> DataFrame:
    """Products as CSV with a redundant column and a third decimal, loaded at a given time and at the present one."""
    path = new_path(spark)
    price = F.concat(F.col("p_retailprice").cast("decimal(12,2)").cast("string"), F.lit("5"))
    rows = read_star(spark, folder, "part").select(
        F.col("p_name").alias("name"), F.lit("x").alias(csv_load.REDUNDANT_COLUMN), F.col("p_type").alias("kind"), price.alias("price")
    )
    rows.write.option("header", True).csv(path)
    given = csv_load.read_csv(spark, "products", path, F.lit("2001-08-01 12:00:00"))
    now = csv_load.read_csv(spark, "products", path).select(
        F.col("product_id").alias("__id"), (F.col("created_at") >= F.date_sub(F.current_date(), 1)).alias("stamped_now")
    )
    columns = ["product_name", "category", "unit_cost", "created_at", "stamped_now"]
    return portable(given.join(now, F.col("product_id") == F.col("__id")).select(*columns))


def feature_files(t: Tables) -> DataFrame:
    """The churn features as the feature job stores them."""
    spark = t["orders"].sparkSession
    paths = jobs.build_features(t, new_path(spark), "churn", AS_OF)
    return rounded(spark.read.parquet(paths["churn"]), 4, "basket_variance")


def _database(spark: SparkSession) -> str:
    """A database of this query alone, whose tables lie in the shared folder."""
    name = f"quayside_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_path(spark)}'")
    return name


def refreshed_scores(t: Tables) -> DataFrame:
    """A prediction table after two full refreshes."""
    spark = t["orders"].sparkSession
    table = f"{_database(spark)}.scores"
    scores = activity_score(t)
    score.refresh(scores.withColumn("score", F.lit(-1.0)), table)
    score.refresh(scores, table)
    return rounded(spark.table(table), 9, "score")


def catalog_staging_view(t: Tables) -> DataFrame:
    spark = t["orders"].sparkSession
    (name,) = models.build(spark, t, "staging")
    return spark.table(name)


def catalog_mart_table(t: Tables) -> DataFrame:
    spark = t["orders"].sparkSession
    (name,) = models.build(spark, t, "marts", _database(spark))
    return spark.table(name)


def model_store(t: Tables) -> DataFrame:
    """The model table of the run that started last, after an older run was logged after it."""
    spark, root, now = t["orders"].sparkSession, new_path(t["orders"].sparkSession), datetime.now(timezone.utc)
    days = materialize(features.demand_features(t))
    newer = decomposed.spans(days).select("region_id", "first_ds", "last_ds", "y_scale")
    for model, age in ((newer, 0), (newer.withColumn("y_scale", F.lit(0.0)), 1)):
        runs.log_run(spark, root, "q", "r", model, {"kind": "table"}, {"n": 1.0}, now - timedelta(days=age))
    return runs.load_latest(spark, root, "q")


def clustered_lookup(t: Tables) -> DataFrame:
    """Some customers' orders of a year, from the table laid out for such reads."""
    spark = t["orders"].sparkSession
    (name,) = clustering.write_clustered(t, _database(spark), 16, names=["orders"])
    rows = spark.table(name).filter("customer_id BETWEEN 20 AND 60 AND order_date >= DATE'1999-01-01' AND order_date < DATE'2000-01-01'")
    return rows.select("order_id", "customer_id", "order_date")


def common_values(t: Tables) -> DataFrame:
    """Common values of columns with few of them, which the sketch counts exactly."""
    found = distribution.describe_tables(t, {"orders": ["status"], "customers": ["branch_id"]})
    return found.select("table_name", "column", "n_rows", "n_nulls", F.inline("common"))


def join_salted_buckets(t: Tables) -> DataFrame:
    spark = t["orders"].sparkSession
    database = _database(spark)
    tables = {"orders": t["orders"].select("order_id", "customer_id"), "order_items": t["order_items"].select("order_id", "product_id", "quantity")}
    distribution.write_salted(tables, database, 8)
    return distribution.join_salted(*(spark.table(f"{database}.{n}_salted") for n in ("orders", "order_items")))


def write_csvs(t: Tables, folder: str) -> None:
    """The tables as CSV files in the order of their keys, which the load assigns from 1 on."""

    def save(name: str, order: str, *columns: str) -> None:
        t[name].orderBy(order).selectExpr(*columns).write.option("header", True).option("nullValue", csv_load.NULL_MARKER).csv(f"{folder}/{name}.csv")

    save("regions", "region_id", "region_name", "string(null) country")
    save("suppliers", "supplier_id", "supplier_name", "string(null) email", "region_id + 1 region_id")
    save("branches", "branch_id", "branch_name", "region_id + 1 region_id", "string(null) address")
    save("products", "product_id", "product_name", "category", "unit_cost")
    save("customers", "customer_id", "customer_name", "string(null) email", "branch_id + 1 branch_id", "date(null) joined_at")
    save("orders", "order_id", "customer_id + 1 customer_id", "order_date", "status", "total_amount")
    save("order_items", "order_id", "order_id + 1 order_id", "product_id + 1 product_id", "quantity", "unit_price")
    save("daily_production", "prod_date", "supplier_id + 1 supplier_id", "product_id + 1 product_id", "prod_date", "qty_produced")


def ingest_job(spark: SparkSession, folder: str) -> DataFrame:
    """The whole ingestion job over CSV files: rows that the load reports and rows of the tables afterwards."""
    t, csvs = load_star(spark, folder), new_path(spark)
    write_csvs(t, csvs)
    database = _database(spark)
    minimums = quality.MINIMUM_ROWS | dict.fromkeys(quality.COUNTED, 1)
    loaded = jobs.ingest(spark, csvs, database, minimums, _database(spark), store=new_path(spark))
    stored = {name: spark.table(f"{database}.{name}") for name in TABLES}
    reported = spark.createDataFrame([(x.table, x.rows) for x in loaded], "table_name string, n_loaded bigint")  # one row per table
    return reported.join(quality.row_counts(stored).withColumnRenamed("n_rows", "n_stored"), "table_name")


OVER_TABLES: dict[str, Callable[[Tables], DataFrame]] = {
    f.__name__: f
    for f in (
        boosted_histogram, boosted_first_cuts, boosted_importances, predictions_stockout_given, boosted_early_stop,
        predictions_churn_flag_forest, predictions_churn_flag_logistic, decomposed_given_weights, forecast_bands_of_paths,
        feature_files, refreshed_scores, catalog_staging_view, catalog_mart_table, model_store, clustered_lookup,
        common_values, join_salted_buckets,
    )
}

QUERIES: dict[str, Query] = {
    **{name: over_tables(plan) for name, plan in OVER_TABLES.items()},
    "csv_products": csv_products,
    "ingest_job": ingest_job,
}

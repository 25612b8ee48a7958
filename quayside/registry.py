"""The registered queries: every model, feature set, check and operator over the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.ml import boosting, decomposed, forecast, score, train
from quayside.operators import constraints, metrics, splits, weights
from quayside.operators.joins import fact_join
from quayside.operators.keys import with_file_order_key
from quayside.plans import analysis, common, features, layout, marts, quality, staging
from quayside.schema import Tables
from quayside.session import materialize, new_path
from quayside.sources import csv_load
from quayside.sources.star import load_star, read_star

# Parameters that fit the star-schema tables, whose last order is of this date.
AS_OF = "2001-08-01"
TRAIN_UNTIL, VALIDATION_UNTIL = "2000-12-31", "2001-03-31"
MINIMUM_ROWS = quality.MINIMUM_ROWS | {
    "customers": 1_000,
    "orders": 10_000,
    "order_items": 50_000,
    "daily_production": 50_000,
}

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT and decimals as DOUBLE, the types other engines can match."""

    def cast(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        return F.col(field.name)

    return df.select(*(cast(field) for field in df.schema.fields))


def over_tables(plan: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: portable(plan(load_star(spark, folder)))


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# -- models and features ---------------------------------------------------------------------


def customer_rfm(t: Tables) -> DataFrame:
    return analysis.customer_rfm(t, AS_OF)


def rfm_scores(t: Tables) -> DataFrame:
    return analysis.rfm_scored(t, AS_OF).select("customer_id", *analysis.SCORES)


def churn(t: Tables) -> DataFrame:
    return features.churn_features(t, AS_OF)


def churn_features(t: Tables) -> DataFrame:
    return rounded(churn(t), 4, "basket_variance")


# -- joins, aggregates, series ---------------------------------------------------------------


def join_orders_items(t: Tables) -> DataFrame:
    orders = t["orders"].select("order_id", "customer_id", "order_date")
    items = t["order_items"].select("order_id", "product_id", "quantity", "unit_price")
    return fact_join(orders, items, "order_id")


def join_snowflake_chain(t: Tables) -> DataFrame:
    return t["orders"].select("order_id", "customer_id").join(common.customer_places(t), "customer_id")


def join_full_outer_3key(t: Tables) -> DataFrame:
    keys = ["product_id", "branch_id", "week"]
    return features.weekly_production(t).join(features.weekly_demand(t), keys, "full_outer")


def active_months(t: Tables) -> DataFrame:
    return churn(t).select("customer_id", "active_months")


def basket_stddev(t: Tables) -> DataFrame:
    base = analysis.rfm_base(t, AS_OF)
    return base.select("customer_id", F.round("basket_variance", 4).alias("basket_stddev"))


def class_rates(t: Tables) -> DataFrame:
    return constraints.union(
        [
            weights.class_rates(df, label).select(F.lit(label).alias("label"), "n_rows", "positives", F.round("positive_rate", 9).alias("positive_rate"))
            for df, label in ((churn(t), "churned"), (features.stockout_features(t), "is_stockout"))
        ]
    )


def demand_lags(t: Tables) -> DataFrame:
    history = features.with_demand_history(features.demand_base(t))
    return history.select("region_id", "ds", "y", *(f"lag_{k}d" for k in features.DEMAND_LAGS))


def demand_rolling(t: Tables) -> DataFrame:
    history = features.with_demand_history(features.demand_base(t))
    return history.select("region_id", "ds", *(F.round(f"rolling_{n}d_avg", 6).alias(f"rolling_{n}d_avg") for n in features.DEMAND_WINDOWS))


def demand_features(t: Tables) -> DataFrame:
    return rounded(features.demand_features(t), 6, *(f"rolling_{n}d_avg" for n in features.DEMAND_WINDOWS))


def stockout_rolling(t: Tables) -> DataFrame:
    history = features.with_stockout_history(features.stockout_base(t, keep_series=True))
    return history.select("branch_id", "product_id", "week", "gap", "fill_rate_lag1", "fill_rate_rolling")


def demand_trend_slope(t: Tables) -> DataFrame:
    history = features.with_stockout_history(features.stockout_base(t, keep_series=True))
    return history.select("branch_id", "product_id", "week", "demanded", "demand_trend")


def top1_latest_order(t: Tables) -> DataFrame:
    latest = t["orders"].orderBy(F.desc("order_date"), F.desc("order_id")).limit(1)
    return latest.select("order_id", "customer_id", "order_date")


def duplicate_line_keys(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_star(spark, folder, "lineitem")
    return portable(constraints.duplicate_keys(lines, ["l_orderkey", "l_linenumber"]))


def ingest_surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_star(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return portable(with_file_order_key(orders, "order_id"))


# -- splits, weights, metrics ----------------------------------------------------------------


def demand_split(t: Tables) -> DataFrame:
    split = splits.by_date("ds", TRAIN_UNTIL, VALIDATION_UNTIL)
    return features.demand_features(t).select("region_id", "ds", "y", split.alias("split"))


def concat_region_frames(t: Tables) -> DataFrame:
    days = demand_split(t)
    frames = [
        days.filter(F.col("split") == name)
        .withColumnRenamed("ds", "forecast_date")
        .select("forecast_date", "region_id", "y", F.lit(name).alias("frame"), F.lit(AS_OF).cast("date").alias("prediction_date"))
        for name in ("train", "val", "test")
    ]
    return constraints.union(frames)


def churn_split(t: Tables) -> DataFrame:
    return splits.stratified(churn(t).select("customer_id", "churned"), "customer_id", "churned")


def stockout_keys(t: Tables) -> DataFrame:
    return features.stockout_features(t).select("branch_id", "product_id", "week", "is_stockout")


def stockout_time_split(t: Tables) -> DataFrame:
    return splits.temporal(stockout_keys(t), "week")


def stockout_positional_split(t: Tables) -> DataFrame:
    return splits.positional(stockout_keys(t), ["branch_id", "product_id", "week"])


def class_weights(t: Tables) -> DataFrame:
    return rounded(weights.class_weights(churn(t), "churned"), 9, "weight")


def scale_pos_weight(t: Tables) -> DataFrame:
    rates = weights.scale_pos_weight(features.stockout_features(t).na.drop(), "is_stockout")
    return rounded(rates, 9, "positive_rate")


def standardized_features(t: Tables) -> DataFrame:
    names = train.CHURN_COLUMNS
    customers = materialize(churn(t).select("customer_id", *names))
    return rounded(weights.standardize(customers, names), 6, *names)


def activity_score(t: Tables) -> DataFrame:
    """A score without a model: the fewer the orders of a customer, the closer to 1."""
    frequency = F.col("frequency").cast("double")
    return churn(t).select("customer_id", "churned", (10 / (10 + frequency)).alias("score"))


def threshold_label(t: Tables) -> DataFrame:
    return rounded(activity_score(t).withColumn("label", metrics.threshold_label("score")), 9, "score")


def metric_auc(t: Tables) -> DataFrame:
    return metrics.auc(activity_score(t), "churned", "score")


def metric_classification(t: Tables) -> DataFrame:
    labelled = activity_score(t).withColumn("label", metrics.threshold_label("score"))
    return metrics.classification(labelled, "churned", "label")


def classification_report(t: Tables) -> DataFrame:
    labelled = activity_score(t).withColumn("label", metrics.threshold_label("score"))
    return metrics.classification_report(labelled, "churned", "label")


def metric_forecast_naive(t: Tables) -> DataFrame:
    return metrics.forecast_errors(features.demand_features(t), "y", "lag_7d", by="region_id")


def forecast_gate(t: Tables) -> DataFrame:
    return metrics.forecast_gate(metric_forecast_naive(t))


def forecast_calendar(t: Tables) -> DataFrame:
    return forecast.calendar(features.demand_features(t))


# -- models ----------------------------------------------------------------------------------


def churn_parts(t: Tables) -> dict[str, DataFrame]:
    rows = train.usable(churn(t), train.CHURN_COLUMNS, train.CHURN_TARGET)
    whole = materialize(splits.stratified(rows, "customer_id", train.CHURN_TARGET))
    return {"all": whole, **{name: whole.filter(F.col("split") == name) for name in ("train", "val", "test")}}


def churn_forest(parts: dict[str, DataFrame]) -> PipelineModel:
    return train.fit_random_forest(parts["train"], train.CHURN_COLUMNS, train.CHURN_TARGET)


def predictions_churn(t: Tables) -> DataFrame:
    parts = churn_parts(t)
    return score.churn(parts["all"], churn_forest(parts), AS_OF)


def churn_feature_importance(t: Tables) -> DataFrame:
    parts = churn_parts(t)
    return train.importances(parts["all"].sparkSession, churn_forest(parts), train.CHURN_COLUMNS)


def churn_logistic_metrics(t: Tables) -> DataFrame:
    parts = churn_parts(t)
    model = train.fit_logistic(parts["train"], train.CHURN_COLUMNS, train.CHURN_TARGET)
    measured = [(name, train.evaluate(model, parts[name], train.CHURN_TARGET)) for name in ("val", "test")]
    rows = [(name, *(m[k] for k in ("auc", "f1", "precision", "recall"))) for name, m in measured]
    schema = "split string, auc double, f1 double, precision double, recall double"
    return parts["all"].sparkSession.createDataFrame(rows, schema)


def predictions_stockout(t: Tables) -> DataFrame:
    rows = train.usable(features.stockout_features(t), train.STOCKOUT_COLUMNS, train.STOCKOUT_TARGET)
    whole = splits.temporal(rows, "week")  # over stored rows
    older, newer = (whole.filter(F.col("split") == name) for name in ("train", "val"))
    scale = weights.scale_pos_weight(whole, train.STOCKOUT_TARGET).first().scale_pos_weight or 1.0
    keys = ["branch_id", "product_id", "week"]
    model = boosting.fit(older, newer, train.STOCKOUT_COLUMNS, train.STOCKOUT_TARGET, scale, identified_by=keys)
    return score.stockout(whole, model, AS_OF)


def forecast_validation(t: Tables) -> DataFrame:
    days = materialize(features.demand_features(t))
    days = days.withColumn("split", splits.by_date("ds", TRAIN_UNTIL, VALIDATION_UNTIL))
    models = decomposed.fit(days.filter(F.col("split") == "train"))
    return decomposed.evaluate(models, days.filter(F.col("split") == "val"))


#: Weights of a forecast without a fit: level, trend, first bend, first weekly sine, first yearly cosine, both regressors.
GIVEN_WEIGHTS = {0: 2.0, 1: 0.5, 2: 0.3, 27: 0.1, 34: 0.2, 53: 0.05, 54: 0.02}
GIVEN_SIGMA = 0.25


def forecast_given_weights(t: Tables) -> DataFrame:
    days = materialize(demand_features(t))
    models = forecast.with_weights(days, [GIVEN_WEIGHTS.get(i, 0.0) for i in range(55)], GIVEN_SIGMA)
    columns = ["predicted_orders", "yhat_lower", "yhat_upper"]
    return rounded(score.demand(days, models, AS_OF, kind=forecast), 3, *columns)


def predictions_demand(t: Tables) -> DataFrame:
    days = materialize(features.demand_features(t))
    return score.demand(days, materialize(decomposed.fit(days)), AS_OF)


# -- loads, layout, rows without a value -----------------------------------------------------


def faulty(t: Tables) -> Tables:
    """The tables with planted faults, so that checks have something to find."""
    return {name: t[name] for name in t} | {
        "order_items": t["order_items"].selectExpr(
            "case when order_id % 97 = 0 then null when order_id % 89 = 0 then -order_id else order_id end as order_id",
            "product_id",
            "case when product_id % 101 = 0 then 0 when product_id % 103 = 0 then null else quantity end as quantity",
            "unit_price",
        ),
        "orders": t["orders"].withColumns(
            {
                "order_id": F.expr("case when order_id % 53 = 0 then 53 else order_id end"),
                "customer_id": F.expr("case when customer_id % 61 = 0 then -customer_id else customer_id end"),
                "order_date": F.expr("case when order_id % 71 = 0 then null else order_date end"),
            }
        ),
        "daily_production": t["daily_production"].withColumn(
            "supplier_id", F.expr("case when supplier_id % 7 = 0 then -supplier_id else supplier_id end")
        ),
        "customers": t["customers"].withColumn(
            "customer_name", F.expr("case when customer_id % 11 = 0 then null else customer_name end")
        ),
    }


def items_by_month(t: Tables) -> DataFrame:
    """Items without an order, or with an order that does not exist, stay in a month of their own."""
    tables = {"orders": t["orders"], "order_items": faulty(t)["order_items"]}
    return layout.items_with_month(tables).groupBy("order_ym").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("quantity").alias("units")
    )


def demand_one_region(t: Tables) -> DataFrame:
    return features.demand_features(t).filter(F.col("region_id") == 2).select("region_id", "ds", "y", "total_units")


def csv_customers(t: Tables) -> DataFrame:
    """The customers written as CSV and loaded again."""
    spark = t["customers"].sparkSession
    path = new_path(spark)
    text = [F.col(c).cast("string") for c in ("customer_name", "branch_id")]
    empty = F.lit(csv_load.NULL_MARKER)
    rows = t["customers"].select(text[0], empty.alias("email"), text[1], empty.alias("joined_at"))
    rows.write.option("header", True).csv(path)
    return csv_load.read_csv(spark, "customers", path).select("customer_name", "branch_id")


def churn_split_null_labels(t: Tables) -> DataFrame:
    label = F.when(F.col("customer_id") % 10 != 0, F.col("churned")).alias("churned")
    return splits.stratified(churn(t).select("customer_id", label), "customer_id", "churned")


def stockout_time_split_null_weeks(t: Tables) -> DataFrame:
    week = F.when(F.col("product_id") % 50 != 0, F.col("week"))
    return splits.temporal(stockout_keys(t).withColumn("week", week), "week")


# -- constraints and quality -----------------------------------------------------------------


def checks_named(*names: str) -> Callable[[Tables], DataFrame]:
    chosen = [c for c in quality.checks(MINIMUM_ROWS) if c.name in names]
    return lambda t: quality.evaluate(t, chosen)


OVER_TABLES: dict[str, Callable[[Tables], DataFrame]] = {
    "stg_orders": staging.stg_orders,
    "mart_monthly_sales": marts.mart_monthly_sales,
    "customer_rfm": customer_rfm,
    "rfm_scores": rfm_scores,
    "production_demand_gap": analysis.production_demand_gap,
    "demand_features": demand_features,
    "churn_features": churn_features,
    "stockout_base": features.stockout_base,
    "stockout_features": features.stockout_features,
    "demand_lags": demand_lags,
    "demand_rolling": demand_rolling,
    "stockout_rolling": stockout_rolling,
    "demand_trend_slope": demand_trend_slope,
    "join_orders_items": join_orders_items,
    "join_snowflake_chain": join_snowflake_chain,
    "production_fanout": features.weekly_production,
    "join_full_outer_3key": join_full_outer_3key,
    "active_months": active_months,
    "basket_stddev": basket_stddev,
    "class_rates": class_rates,
    "row_counts": quality.row_counts,
    "constraint_pk_duplicates": constraints.primary_keys,
    "constraint_fk_violations": constraints.foreign_keys,
    "constraint_not_null": lambda t: constraints.columns(t, ["not_null"]),
    "constraint_check": lambda t: constraints.columns(t, ["check"]),
    "constraint_varchar_length": lambda t: constraints.columns(t, ["max_length"]),
    "dq_row_counts": checks_named(*(f"row_count_{t}" for t in quality.COUNTED)),
    "dq_orphan_items": checks_named("orphan_items"),
    "dq_orphan_orders": checks_named("orphan_orders"),
    "dq_orphan_production": checks_named("orphan_production"),
    "dq_null_order_date": checks_named("null_order_date"),
    "dq_bad_quantity": checks_named("bad_quantity"),
    "dq_duplicate_orders": checks_named("duplicate_orders"),
    "dq_report": lambda t: quality.report(t, MINIMUM_ROWS),
    "test_no_negative_revenue": staging.negative_revenue,
    "threshold_label": threshold_label,
    "demand_split": demand_split,
    "concat_region_frames": concat_region_frames,
    "churn_split": churn_split,
    "stockout_time_split": stockout_time_split,
    "stockout_positional_split": stockout_positional_split,
    "class_weights": class_weights,
    "scale_pos_weight": scale_pos_weight,
    "standardized_features": standardized_features,
    "metric_auc": metric_auc,
    "metric_classification": metric_classification,
    "classification_report": classification_report,
    "metric_forecast_naive": metric_forecast_naive,
    "forecast_gate": forecast_gate,
    "forecast_calendar": forecast_calendar,
    "top1_latest_order": top1_latest_order,
    "items_by_month": items_by_month,
    "demand_one_region": demand_one_region,
    "csv_customers": csv_customers,
    "churn_split_null_labels": churn_split_null_labels,
    "stockout_time_split_null_weeks": stockout_time_split_null_weeks,
    "dq_report_faulty": lambda t: quality.report(faulty(t), MINIMUM_ROWS),
    "constraint_pk_duplicates_faulty": lambda t: constraints.primary_keys(faulty(t)),
    "constraint_fk_violations_faulty": lambda t: constraints.foreign_keys(faulty(t)),
    "constraint_not_null_faulty": lambda t: constraints.columns(faulty(t), ["not_null"]),
    "constraint_check_faulty": lambda t: constraints.columns(faulty(t), ["check"]),
    "forecast_given_weights": forecast_given_weights,
    "predictions_churn": predictions_churn,
    "predictions_stockout": predictions_stockout,
    "predictions_demand": predictions_demand,
    "churn_feature_importance": churn_feature_importance,
    "churn_logistic_metrics": churn_logistic_metrics,
    "forecast_validation": forecast_validation,
}

QUERIES: dict[str, Query] = {
    **{name: over_tables(plan) for name, plan in OVER_TABLES.items()},
    "duplicate_line_keys": duplicate_line_keys,
    "ingest_surrogate_keys": ingest_surrogate_keys,
}

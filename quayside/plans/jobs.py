"""The scheduled jobs: ingestion, feature building, training and scoring."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import asdict, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.ml import boosting, decomposed, runs, score, train
from quayside.operators import splits, weights
from quayside.plans import features, layout, models, quality
from quayside.plans.branches import run_branches
from quayside.schema import Tables
from quayside.session import materialize
from quayside.sources.csv_load import Loaded, load_tables
from quayside.sources.snapshot import Snapshot

# Experiment names, and the last days of the training and validation spans.
CHURN, STOCKOUT, DEMAND = "customer_churn", "stockout_risk", "demand_forecasting"
TRAIN_UNTIL, VALIDATION_UNTIL = "2023-06-30", "2023-09-30"
ANALYZED = ("orders", "order_items", "daily_production", "customers")


def ingest(
    spark: SparkSession,
    data_dir: str,
    database: str = "raw",
    minimums: Mapping[str, int] = quality.MINIMUM_ROWS,
    marts_database: str = "marts",
    store: str | None = None,
) -> list[Loaded]:
    """Schema, load, quality gate, staging, marts, data tests, statistics; stops at the first failure.

    With a ``store`` (a folder) all tables are loaded there in one transaction, and the database names its newest
    state; without one each table is loaded into the database by itself.
    """
    if store is None:
        layout.create_tables(spark, database)
        loaded = load_tables(spark, data_dir, database)
    else:
        snapshot = Snapshot(spark, store)
        loaded = snapshot.load(data_dir)
        snapshot.register(database)
    tables = layout.read_tables(spark, database)
    quality.gate(tables, minimums)
    models.build(spark, tables, "staging")
    models.build(spark, tables, "marts", marts_database)
    models.run_data_tests(tables)
    layout.analyze(spark, [f"{database}.{name}" for name in ANALYZED])
    return loaded


def build_features(
    tables: Tables, folder: str, model: str = "all", as_of: str | date | None = None
) -> dict[str, str]:
    """Writes the feature sets to parquet; returns their paths."""
    plans = {
        "demand": lambda: features.demand_features(tables),
        "churn": lambda: features.churn_features(tables, as_of),
        "stockout": lambda: features.stockout_features(tables),
    }
    if model != "all" and model not in plans:
        raise ValueError(f"unknown model {model!r}; known: all, {', '.join(plans)}")
    paths = {}
    for name in plans if model == "all" else [model]:
        paths[name] = f"{folder}/{name}_features.parquet"
        plans[name]().write.mode("overwrite").parquet(paths[name])
    return paths


class ScoringError(RuntimeError):
    """Raised when some scorers failed; the others have written their tables."""


def _parts(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(df.filter(F.col("split") == name).drop("split") for name in ("train", "val", "test"))


def _measured(model, validation: DataFrame, test: DataFrame, target: str) -> dict[str, float]:
    return {
        f"{name}_{metric}": value
        for name, rows in (("val", validation), ("test", test))
        for metric, value in train.evaluate(model, rows, target).items()
    }


def _importances(spark: SparkSession, model, columns: list[str]) -> dict[str, float]:
    return {f"importance_{r.feature}": r.importance for r in train.importances(spark, model, columns).collect()}


def train_churn(spark: SparkSession, churn: DataFrame, root: str, exclude_leaky: bool = False, **forest) -> list[str]:
    """Logistic baseline, then the forest, which is the newest run and so the one that scores."""
    target = train.CHURN_TARGET
    columns = train.feature_columns(train.CHURN_COLUMNS, target, exclude_leaky)
    rows = train.usable(churn, columns, target)
    training, validation, test = _parts(splits.stratified(rows, "customer_id", target))
    fits = {
        "churn_logistic_regression": (lambda: train.fit_logistic(training, columns, target), train.LOGISTIC),
        "churn_random_forest": (
            lambda: train.fit_random_forest(training, columns, target, **forest),
            {**train.FOREST, **forest},
        ),
    }
    ids = []
    for name, (fit, params) in fits.items():
        model = fit()
        measured = _measured(model, validation, test, target)
        if hasattr(model.stages[-1], "featureImportances"):
            measured |= _importances(spark, model, columns)
        sizes = {f"{part}_rows": df.count() for part, df in (("train", training), ("val", validation), ("test", test))}
        ids.append(runs.log_run(spark, root, CHURN, name, model, {**params, **sizes, "features": columns}, measured))
    return ids


def train_stockout(
    spark: SparkSession,
    stockout: DataFrame,
    root: str,
    positional: bool = False,
    exclude_leaky: bool = False,
    **boosted,
) -> str:
    """Boosted trees on the older weeks; ``positional`` splits by branch and product order instead.

    ``boosted`` replaces some of ``boosting.Settings``.
    """
    target = train.STOCKOUT_TARGET
    columns = train.feature_columns(train.STOCKOUT_COLUMNS, target, exclude_leaky)
    rows = train.usable(stockout, columns, target)
    split = splits.positional(rows, ["branch_id", "product_id", "week"]) if positional else splits.temporal(rows, "week")
    training, validation, test = _parts(split)
    settings = replace(boosting.Settings(), **boosted)
    scale = weights.scale_pos_weight(rows, target).first().scale_pos_weight or 1.0
    model = boosting.fit(training, validation, columns, target, scale, settings, ["branch_id", "product_id", "week"])
    sizes = {f"{part}_rows": df.count() for part, df in (("train", training), ("val", validation), ("test", test))}
    params = {"kind": "table", **asdict(settings), "scale_pos_weight": scale, "kept_trees": len(model.trees), **sizes, "features": columns}
    measured = _measured(model, validation, test, target) | _importances(spark, model, columns)
    return runs.log_run(spark, root, STOCKOUT, "stockout_boosted_trees", model.to_rows(spark), params, measured)


def train_demand(
    spark: SparkSession,
    demand: DataFrame,
    root: str,
    region_id: int | None = None,
    train_until: str = TRAIN_UNTIL,
    validation_until: str = VALIDATION_UNTIL,
) -> str:
    """One forecast model per region, checked on the days after the training span.

    Trained for one region only, the new run keeps the other regions' models of the run before.
    """
    earlier = None if region_id is None else runs.load_latest(spark, root, DEMAND, missing_ok=True)
    if region_id is not None:
        demand = demand.filter(F.col("region_id") == region_id)
    days = demand.withColumn("split", splits.by_date("ds", train_until, validation_until))
    training, validation, _ = _parts(days)
    fitted = decomposed.fit(training)
    if earlier is not None:
        fitted = fitted.unionByName(earlier.filter(F.col("region_id") != region_id))
    fitted = materialize(fitted)
    errors = decomposed.evaluate(fitted, validation)
    overall = errors.agg(
        F.avg("mape").alias("mean_mape"), F.avg("rmse").alias("mean_rmse"), F.count_if(F.col("status") == "PASS").alias("passed")
    ).first()
    params = {"kind": "table", "train_until": train_until, "validation_until": validation_until}
    return runs.log_run(spark, root, DEMAND, "demand_per_region", fitted, params, overall.asDict())


def score_all(
    spark: SparkSession,
    feature_paths: Mapping[str, str],
    root: str,
    database: str = "predictions",
    on: str | date | None = None,
) -> list[str]:
    """Scores with the newest models and replaces the prediction tables; a scorer that fails is named at the end."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    jobs = {"churn": (score.churn, CHURN), "stockout": (score.stockout, STOCKOUT), "demand": (score.demand, DEMAND)}
    written, failed = [], {}
    for name, path in feature_paths.items():
        scorer, experiment = jobs[name]
        try:
            scores = scorer(spark.read.parquet(path), runs.load_latest(spark, root, experiment), on)
            score.refresh(scores, f"{database}.predictions_{name}")
        except Exception as error:  # one scorer must not stop the others
            failed[name] = error
        else:
            written.append(f"{database}.predictions_{name}")
    if failed:
        raise ScoringError(f"scored {written}; failed: {failed}") from next(iter(failed.values()))
    return written


def features_and_scores(
    spark: SparkSession,
    tables: Tables,
    folder: str,
    root: str,
    database: str = "predictions",
    as_of: str | date | None = None,
) -> list[str]:
    """The serving job: all feature sets anew, then every scorer on its own."""
    return score_all(spark, build_features(tables, folder, as_of=as_of), root, database, as_of)


def serve(
    spark: SparkSession,
    tables: Tables,
    folder: str,
    root: str,
    database: str = "predictions",
    as_of: str | date | None = None,
    limit: float | None = None,
    retries: int = 0,
) -> list[str]:
    """``features_and_scores`` with the three models as concurrent branches, each with a time limit and retries.

    A branch that fails is named at the end; the others have written their tables.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def branch(name: str) -> list[str]:
        return score_all(spark, build_features(tables, folder, name, as_of), root, database, as_of)

    outcomes = run_branches(spark, {n: lambda n=n: branch(n) for n in ("demand", "churn", "stockout")}, limit, retries)
    failed = {name: o.error for name, o in outcomes.items() if o.error}
    written = [table for o in outcomes.values() if not o.error for table in o.value]
    if failed:
        raise ScoringError(f"scored {written}; failed: {failed}") from next(iter(failed.values()))
    return written


def run_all(
    spark: SparkSession,
    data_dir: str,
    folder: str,
    database: str = "raw",
    minimums: Mapping[str, int] = quality.MINIMUM_ROWS,
    as_of: str | date | None = None,
    demand_cutoffs: tuple[str, str] = (TRAIN_UNTIL, VALIDATION_UNTIL),
    forest: Mapping[str, object] | None = None,
    boosted: Mapping[str, object] | None = None,
) -> dict[str, str]:
    """Everything from CSV files to trained models: ingestion, analysis, features, training."""
    ingest(spark, data_dir, database, minimums, f"{database}_marts")
    tables = layout.read_tables(spark, database)
    models.build(spark, tables, "analysis", f"{database}_analysis")
    paths = build_features(tables, f"{folder}/features", as_of=as_of)
    read = {name: spark.read.parquet(path) for name, path in paths.items()}
    train_demand(spark, read["demand"], f"{folder}/store", None, *demand_cutoffs)
    train_churn(spark, read["churn"], f"{folder}/store", **(forest or {}))
    train_stockout(spark, read["stockout"], f"{folder}/store", **(boosted or {}))
    return paths

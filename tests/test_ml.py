from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from quayside.ml import forecast, runs, train
from quayside.operators import splits
from quayside.plans import features
from quayside.sources.star import load_star

AS_OF = "2001-08-01"


@pytest.fixture(scope="module")
def tables(spark):
    return load_star(spark, "/root/testdata/sf0.001")


def test_newest_run_wins(spark, tmp_path):
    now = datetime.now(timezone.utc)
    for age, value in ((0, 1), (5, 2)):
        model = spark.range(1).select(F.lit(value).alias("v"))
        runs.log_run(spark, str(tmp_path), "x", "r", model, {"kind": "table"}, {}, now - timedelta(days=age))
    assert runs.load_latest(spark, str(tmp_path), "x").first().v == 1
    with pytest.raises(ValueError, match="no runs"):
        runs.load_latest(spark, str(tmp_path), "y")


def test_forecast_follows_trend_and_week(spark):
    history = spark.sql(
        """
        select 1 as region_id, date_add(date'2020-01-01', i) as ds,
               bigint(round((100 + 0.1 * i) * (1 + 0.3 * if(i % 7 = 0, 1, 0)))) as y,
               decimal(10.0) as avg_unit_price, 100.0 as rolling_7d_avg
        from (select explode(sequence(0, 729)) as i)
        """
    )
    days = history.withColumn("split", splits.by_date("ds", "2021-10-31", "2021-12-30"))
    models = forecast.fit(days.filter("split = 'train'"))
    row = forecast.evaluate(models, days.filter("split = 'val'")).first()
    assert row.mape < 0.10 and row.status == "PASS"
    ahead = forecast.future_frame(history)
    assert ahead.count() == 30 and str(ahead.agg(F.min("ds")).first()[0]) == "2021-12-31"


def test_leaky_columns_can_be_left_out():
    assert train.feature_columns(train.STOCKOUT_COLUMNS, "is_stockout", True) == [
        "fill_rate_lag1", "fill_rate_rolling", "demand_trend",
    ]
    assert "recency_days" not in train.feature_columns(train.CHURN_COLUMNS, "churned", True)


def test_same_seed_same_forest(spark, tables):
    churn = features.churn_features(tables, AS_OF)
    rows = splits.stratified(train.usable(churn, train.CHURN_COLUMNS), "customer_id", "churned").filter("split = 'train'")
    first, second = (
        train.fit_random_forest(rows, train.CHURN_COLUMNS, "churned", numTrees=3, maxDepth=3).stages[-1] for _ in range(2)
    )
    # the first line names the model
    assert first.toDebugString.splitlines()[1:] == second.toDebugString.splitlines()[1:]


def test_forest_rows_are_spread_over_tasks(spark, monkeypatch):
    """What a task of a forest reads is bounded by bytes, not by the number of files; few rows stay in place."""
    rows = spark.range(3000).selectExpr("cast(id % 7 as double) a", "cast(id % 2 as int) y").coalesce(1)
    fitted = []
    monkeypatch.setattr(train, "Pipeline", lambda stages: type("P", (), {"fit": lambda self, df: fitted.append(df)})())
    train.fit_random_forest(rows, ["a"], "y", numTrees=300)
    monkeypatch.setattr(train, "TASK_BYTES", 100_000)
    train.fit_random_forest(rows, ["a"], "y", numTrees=300)
    parts = [df.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect() for df in fitted]
    assert parts[0] == [3000] and len(parts[1]) >= 39 and max(parts[1]) * 1332 < 2 * 100_000 and sum(parts[1]) == 3000

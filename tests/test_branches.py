"""Concurrent branches: one fails, one times out, one succeeds at the second attempt, and the others finish."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from quayside.ml import boosting, decomposed, runs, train
from quayside.operators import splits
from quayside.plans import features, jobs
from quayside.plans.branches import run_branches
from quayside.sources.star import load_star


def test_outcomes(spark):
    tries, meeting = [], threading.Barrier(2, timeout=60)

    def slow():
        def sleep(batches):
            time.sleep(120)
            yield from batches

        return spark.range(0, 1, 1, 1).mapInPandas(sleep, "id long").count()

    def second():
        tries.append(1)
        if len(tries) == 1:
            raise ValueError("once")
        return spark.range(5).count()

    def together():
        meeting.wait()  # both branches run at the same time
        return spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    start = time.monotonic()
    got = run_branches(spark, {"slow": slow, "second": second, "a": together, "b": together}, limit=8, retries=1)
    assert time.monotonic() - start < 60
    assert isinstance(got["slow"].error, TimeoutError) and got["slow"].attempts == 2
    assert (got["second"].value, got["second"].error, got["second"].attempts) == (5, None, 2)
    assert (got["a"].value, got["b"].value) == ("a", "b") and got["a"].attempts == 1
    assert spark.range(3).count() == 3  # nothing of it is left in this thread
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_failures_are_kept(spark):
    def wrong():
        return spark.range(1).select(F.raise_error(F.lit("broken"))).collect()

    got = run_branches(spark, {"wrong": wrong, "right": lambda: spark.range(2).count()})
    assert "broken" in str(got["wrong"].error) and got["right"].value == 2
    assert run_branches(spark, {}) == {}


def test_serving_job(spark, tmp_path):
    tables, root = load_star(spark, "/root/testdata/sf0.001"), f"{tmp_path}/store"
    demand = features.demand_features(tables)
    runs.log_run(spark, root, jobs.DEMAND, "r", decomposed.fit(demand), {"kind": "table"}, {})
    rows = splits.temporal(train.usable(features.stockout_features(tables), train.STOCKOUT_COLUMNS), "week")
    older, newer = (rows.filter(F.col("split") == n) for n in ("train", "val"))
    model = boosting.fit(older, newer, train.STOCKOUT_COLUMNS, "is_stockout", settings=boosting.Settings(trees=1, depth=2))
    runs.log_run(spark, root, jobs.STOCKOUT, "r", model.to_rows(spark), {"kind": "table"}, {})
    with pytest.raises(jobs.ScoringError, match="failed: .'churn'.*no runs of experiment"):
        jobs.serve(spark, tables, f"{tmp_path}/features", root, "served", "2001-08-01", limit=120)
    # the branches of the other models have finished
    assert spark.table("served.predictions_demand").count() == 30 * demand.select("region_id").distinct().count()
    assert spark.table("served.predictions_stockout").count() == train.usable(features.stockout_features(tables), train.STOCKOUT_COLUMNS).count()

"""Run log and model store: one row per training run, newest model by experiment."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import path_exists

RUNS = (
    "run_id string, experiment string, run_name string, start_time timestamp, "
    "params map<string,string>, metrics map<string,double>, model_path string"
)


def log_run(
    spark: SparkSession,
    root: str,
    experiment: str,
    run_name: str,
    model: PipelineModel | DataFrame,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    start_time: datetime | None = None,
) -> str:
    """Saves the model, then appends the run, so that a listed run always has its model."""
    run_id = uuid.uuid4().hex
    path = f"{root}/models/{experiment}/{run_id}"
    if isinstance(model, DataFrame):
        model.write.parquet(path)
    else:
        model.write().save(path)
    row = (
        run_id,
        experiment,
        run_name,
        start_time or datetime.now(timezone.utc),
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items() if v is not None},
        path,
    )
    spark.createDataFrame([row], RUNS).coalesce(1).write.mode("append").parquet(f"{root}/runs")
    return run_id


def runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(f"{root}/runs")


def load_latest(spark: SparkSession, root: str, experiment: str, missing_ok: bool = False) -> PipelineModel | DataFrame | None:
    """The model of the run that started last; forecast models are tables."""
    if missing_ok and not path_exists(spark, f"{root}/runs"):
        return None
    newest = runs(spark, root).filter(F.col("experiment") == experiment).orderBy(F.desc("start_time")).limit(1).first()
    if newest is None and missing_ok:
        return None
    if newest is None:
        raise ValueError(f"no runs of experiment {experiment!r}")
    if newest.params.get("kind") == "table":
        return spark.read.parquet(newest.model_path)
    return PipelineModel.load(newest.model_path)

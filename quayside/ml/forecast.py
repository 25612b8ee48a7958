"""Daily demand forecast per region.

A decomposable model (Taylor & Letham, "Forecasting at scale", 2018) on the logarithm of demand,
which makes the seasons multiplicative: a piecewise linear trend, weekly and yearly Fourier terms and
two regressors. Design rows and predictions are built-in expressions; only the small ridge solve per
region runs in Python, over that region's daily rows. ``decomposed`` fits the same terms on the demand itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators import metrics

# Model settings and forecast horizon.
REGRESSORS = ("avg_unit_price", "rolling_7d_avg")
CHANGEPOINTS, CHANGEPOINT_SHARE, CHANGEPOINT_PRIOR = 25, 0.8, 0.05
WEEKLY_ORDER, YEARLY_ORDER, OTHER_PRIOR = 3, 10, 10.0
HORIZON_DAYS = 30
BAND_80_PERCENT = 1.2815515655446004


def _cycle(days: float, order: int) -> list[Column]:
    turn = F.unix_date("ds") * F.lit(2 * math.pi / days)
    return [wave(turn * k) for k in range(1, order + 1) for wave in (F.sin, F.cos)]


def _design() -> Column:
    """Array of model terms; needs ds, the regressors and the region's span and scales."""
    day = F.datediff("ds", "first_ds") / F.greatest(F.datediff("last_ds", "first_ds"), F.lit(1))
    bends = [CHANGEPOINT_SHARE * j / (CHANGEPOINTS + 1) for j in range(1, CHANGEPOINTS + 1)]
    regressors = [
        (F.col(r).cast("double") - F.col(f"{r}_mean")) / F.coalesce(F.nullif(F.col(f"{r}_std"), F.lit(0.0)), F.lit(1.0))
        for r in REGRESSORS
    ]
    return F.array(
        F.lit(1.0),
        day,
        *(F.greatest(day - bend, F.lit(0.0)) for bend in bends),
        *_cycle(7, WEEKLY_ORDER),
        *_cycle(365.25, YEARLY_ORDER),
        *regressors,
    )


def spans(days: DataFrame) -> DataFrame:
    """First and last day and the scales of the regressors, per region."""
    return days.groupBy("region_id").agg(
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        *(F.avg(F.col(r).cast("double")).alias(f"{r}_mean") for r in REGRESSORS),
        *(F.stddev_pop(r).alias(f"{r}_std") for r in REGRESSORS),
    )


def with_weights(history: DataFrame, weights: list[float], sigma: float) -> DataFrame:
    """Models of given weights (in the order of the terms) over the spans of a history."""
    days = history.na.drop(subset=["y", *REGRESSORS])
    return spans(days).withColumns({"weights": F.array(*(F.lit(float(w)) for w in weights)), "sigma": F.lit(sigma)})


def fit(history: DataFrame) -> DataFrame:
    """One model row per region. A region's group is one row per day, so the calendar bounds it."""
    days = history.na.drop(subset=["y", *REGRESSORS])
    scales = spans(days)
    rows = days.join(scales, "region_id").select(
        F.col("region_id").cast("bigint").alias("region_id"), F.log1p("y").alias("target"), _design().alias("terms")
    )
    bend_terms = slice(2, 2 + CHANGEPOINTS)

    def solve(pdf):
        # nested, so that it travels to the workers by value
        import numpy as np
        import pandas as pd

        x, target = np.stack(pdf["terms"].to_numpy()), pdf["target"].to_numpy()
        prior = np.full(x.shape[1], OTHER_PRIOR)
        prior[bend_terms] = CHANGEPOINT_PRIOR
        variance = target.var() + 1e-9
        for _ in range(2):  # the penalty depends on the noise, estimated by the first round
            weights = np.linalg.solve(x.T @ x + np.diag(variance / prior**2), x.T @ target)
            variance = ((target - x @ weights) ** 2).mean() + 1e-9
        return pd.DataFrame(
            {"region_id": pdf["region_id"].iloc[:1], "weights": [weights.tolist()], "sigma": [math.sqrt(variance)]}
        )

    solved = rows.groupBy("region_id").applyInPandas(solve, "region_id bigint, weights array<double>, sigma double")
    return solved.join(scales, "region_id")


def predict(models: DataFrame, days: DataFrame) -> DataFrame:
    """Adds yhat and its 80 % band to rows with region_id, ds and the regressors; NULL where a region has no model."""
    terms = F.zip_with(_design(), "weights", lambda value, weight: value * weight)
    level = F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)
    band = F.col("sigma") * BAND_80_PERCENT
    return (
        days.join(models, "region_id", "left")
        .withColumn("level", level)
        .select(
            *days.columns,
            F.expm1("level").alias("yhat"),
            F.expm1(F.col("level") - band).alias("yhat_lower"),
            F.expm1(F.col("level") + band).alias("yhat_upper"),
        )
    )


def calendar(history: DataFrame, days: int = HORIZON_DAYS) -> DataFrame:
    """The days that follow each region's last one."""
    last = history.groupBy("region_id").agg(F.max("ds").alias("last_ds"))
    ahead = F.sequence(F.date_add("last_ds", 1), F.date_add("last_ds", days))
    return last.select("region_id", F.explode(ahead).alias("forecast_date"))


def future_frame(history: DataFrame, days: int = HORIZON_DAYS) -> DataFrame:
    """Future days with each region's last known regressors."""
    known = history.na.drop(subset=list(REGRESSORS))
    last = known.groupBy("region_id").agg(*(F.max_by(r, "ds").alias(r) for r in REGRESSORS))
    return calendar(history, days).withColumnRenamed("forecast_date", "ds").join(last, "region_id", "left")


def evaluate(models: DataFrame, validation: DataFrame) -> DataFrame:
    """MAPE, RMSE and PASS or WARN per region."""
    predicted = predict(models, validation.na.drop(subset=list(REGRESSORS)))
    return metrics.forecast_gate(metrics.forecast_errors(predicted, "y", "yhat", by="region_id"))

"""Daily demand per region as a trend times seasons, fitted to the most probable parameters.

A decomposable model (Taylor & Letham, "Forecasting at scale", 2018) on the demand itself:

    y = trend(t) * (1 + seasons and regressors) + noise

The trend is a line whose slope changes at fixed places of the first 80 % of a region's history. Changes of slope have a Laplace prior, so
those that the data do not call for are exactly zero; all other parameters have normal priors. The two factors are fitted
in turn: with the seasons held, the trend is a linear model whose slope changes are found by coordinate descent with a soft threshold;
with the trend held, the seasons are a ridge solution. Design rows and predictions are built-in expressions, only the fit
of a region runs in Python, over that region's daily rows.

Bands come from simulated futures: slope changes go on as often and as large as in the history, noise is added, and the
percentiles of all paths of a day are its band, so that it widens with the horizon. Draws are hashes of region, path and
day: reruns agree, and no state is kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.ml.forecast import CHANGEPOINT_SHARE, CHANGEPOINTS, REGRESSORS, WEEKLY_ORDER, YEARLY_ORDER, _cycle
from quayside.operators import metrics

# Scales of the priors, number of simulated paths and width of the band.
CHANGEPOINT_PRIOR, LINE_PRIOR, SEASON_PRIOR = 0.05, 5.0, 10.0
PATHS, BAND = 1000, 0.8
#: Rounds of the fit at most, and the relative change of the parameters that ends it.
ROUNDS, TOLERANCE = 60, 1e-6
MODEL = "region_id bigint, line array<double>, bends array<double>, seasons array<double>, sigma double"
_UNIT = float(1 << 53)


def spans(days: DataFrame) -> DataFrame:
    """First and last day, largest demand and the scales of the regressors, per region."""
    return days.groupBy("region_id").agg(
        F.min("ds").alias("first_ds"),
        F.max("ds").alias("last_ds"),
        F.greatest(F.max(F.abs("y")).cast("double"), F.lit(1.0)).alias("y_scale"),
        *(F.avg(F.col(r).cast("double")).alias(f"{r}_mean") for r in REGRESSORS),
        *(F.stddev_pop(r).alias(f"{r}_std") for r in REGRESSORS),
    )


def time(day: Column | str = "ds") -> Column:
    """0 on the first day of a region's history and 1 on its last."""
    return F.datediff(day, "first_ds") / F.greatest(F.datediff("last_ds", "first_ds"), F.lit(1))


def places() -> list[float]:
    return [CHANGEPOINT_SHARE * j / CHANGEPOINTS for j in range(1, CHANGEPOINTS + 1)]


def bend_terms(t: Column) -> Column:
    return F.array(*(F.greatest(t - p, F.lit(0.0)) for p in places()))


def season_terms() -> Column:
    scaled = [
        (F.col(r).cast("double") - F.col(f"{r}_mean")) / F.coalesce(F.nullif(F.col(f"{r}_std"), F.lit(0.0)), F.lit(1.0))
        for r in REGRESSORS
    ]
    return F.array(*_cycle(7, WEEKLY_ORDER), *_cycle(365.25, YEARLY_ORDER), *scaled)


def fit(history: DataFrame) -> DataFrame:
    """One model row per region. A region's group is one row per day, so the calendar bounds it."""
    days = history.na.drop(subset=["y", *REGRESSORS])
    scales = spans(days)
    rows = days.join(scales, "region_id").select(
        F.col("region_id").cast("bigint").alias("region_id"),
        (F.col("y") / F.col("y_scale")).cast("double").alias("y"),
        time().alias("t"),
        bend_terms(time()).alias("bends"),
        season_terms().alias("seasons"),
    )

    def solve(pdf):
        # nested, so that it travels to the workers by value
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values("t")
        y, t = pdf["y"].to_numpy(), pdf["t"].to_numpy()
        bend_design, season_design = (np.stack(pdf[c].to_numpy()) for c in ("bends", "seasons"))
        line_design = np.column_stack([np.ones(len(t)), t])
        line, bends, seasons = np.zeros(2), np.zeros(bend_design.shape[1]), np.zeros(season_design.shape[1])
        variance = y.var() + 1e-9

        def ridge(design, target, prior):
            return np.linalg.solve(design.T @ design + np.eye(design.shape[1]) * (variance / prior**2), design.T @ target)

        for _ in range(ROUNDS):
            before = np.concatenate([line, bends, seasons])
            factor = 1 + season_design @ seasons
            a, b = line_design * factor[:, None], bend_design * factor[:, None]
            gram, threshold = b.T @ b, variance / CHANGEPOINT_PRIOR
            for _ in range(200):  # coordinate descent on line and bends
                old = bends.copy()
                line = ridge(a, y - b @ bends, LINE_PRIOR)
                pull = b.T @ (y - a @ line - b @ bends)
                for j in np.flatnonzero(gram.diagonal() > 0):
                    free = pull[j] + gram[j, j] * bends[j]
                    new = np.sign(free) * max(abs(free) - threshold, 0.0) / gram[j, j]
                    pull -= gram[:, j] * (new - bends[j])
                    bends[j] = new
                if np.abs(bends - old).max() <= TOLERANCE * (1 + np.abs(bends).max()):
                    break
            trend = line_design @ line + bend_design @ bends
            seasons = ridge(season_design * trend[:, None], y - trend, SEASON_PRIOR)
            variance = ((y - trend * (1 + season_design @ seasons)) ** 2).mean() + 1e-9
            after = np.concatenate([line, bends, seasons])
            if np.abs(after - before).max() <= TOLERANCE * (1 + np.abs(after).max()):
                break
        values = {"line": [line.tolist()], "bends": [bends.tolist()], "seasons": [seasons.tolist()], "sigma": [math.sqrt(variance)]}
        return pd.DataFrame({"region_id": pdf["region_id"].iloc[:1].to_list(), **values})

    return rows.groupBy("region_id").applyInPandas(solve, MODEL).join(scales, "region_id")


def _dot(terms: Column, weights: str) -> Column:
    return F.aggregate(F.zip_with(terms, weights, lambda x, w: x * w), F.lit(0.0), lambda total, term: total + term)


def trend(day: Column | str = "ds") -> Column:
    t = time(day)
    return F.get("line", F.lit(0)) + F.get("line", F.lit(1)) * t + _dot(bend_terms(t), "bends")


# -- simulated futures -------------------------------------------------------------------------


def uniform(*seeds: Column | str) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*seeds), 11).cast("double") + 0.5) / _UNIT


def laplace(u: Column, scale: Column) -> Column:
    return -scale * F.signum(u - 0.5) * F.log1p(-2 * F.abs(u - 0.5))


def normal(u: Column, v: Column) -> Column:
    return F.sqrt(-2 * F.log(u)) * F.cos(2 * math.pi * v)


def slope_changes(paths: int, seed: int) -> Column:
    """Changes of slope of the days after the history, one array element per day up to ``last``, for each path of a row.

    A day has one with the rate of the history; its size follows the mean size there.
    """
    rate = F.least(F.lit(CHANGEPOINTS) / F.greatest(F.datediff("last_ds", "first_ds"), F.lit(1)), F.lit(1.0))
    size = F.aggregate("bends", F.lit(0.0), lambda total, b: total + F.abs(b)) / CHANGEPOINTS + 1e-8

    def change(step: Column) -> Column:
        happens, how = (uniform(F.lit(seed), F.lit(kind), "region_id", "path", step) for kind in ("when", "size"))
        return F.when(happens < rate, laplace(how, size)).otherwise(0.0)

    return F.transform(F.sequence(F.lit(1), "ahead"), change)


def simulated(models: DataFrame, days: DataFrame, paths: int = PATHS, seed: int = 42) -> DataFrame:
    """region_id, ds, path, value: simulated demand on the days (region_id, ds, regressors) of every path.

    There is one row per region and path until the days are attached; a region's days are one array.
    """
    point = F.struct(
        "ds",
        F.datediff("ds", "last_ds").alias("step"),
        trend().alias("trend"),
        (1 + _dot(season_terms(), "seasons")).alias("factor"),
    )
    known = days.join(models, "region_id")  # by region: one row per day
    per_region = known.groupBy("region_id").agg(
        F.array_sort(F.collect_list(point)).alias("points"),
        *(F.first(c).alias(c) for c in ("first_ds", "last_ds", "bends", "sigma", "y_scale")),
    )
    ahead = F.greatest(F.lit(1), F.get("points", F.size("points") - 1)["step"])
    each = per_region.withColumn("ahead", ahead).withColumn("path", F.explode(F.sequence(F.lit(1), F.lit(paths))))
    length = 1 / F.greatest(F.datediff("last_ds", "first_ds"), F.lit(1))  # a day, as the trend counts time

    # a change on a day bends all days from the next on: value = sum of slopes so far
    start = F.struct(F.lit(0.0).alias("slope"), F.lit(0.0).alias("value"), F.array().cast("array<double>").alias("all"))

    def move(state: Column, change: Column) -> Column:
        value = state["value"] + state["slope"] * length
        return F.struct((state["slope"] + change).alias("slope"), value.alias("value"), F.concat(state["all"], F.array(value)).alias("all"))

    bent = each.withColumn("drift", F.aggregate(slope_changes(paths, seed), start, move)["all"])
    noise = normal(*(uniform(F.lit(seed), F.lit(kind), "region_id", "path", F.unix_date("p.ds")) for kind in ("one", "two"))) * F.col("sigma")
    drift = F.coalesce(F.get("drift", F.col("p.step") - 1), F.lit(0.0))  # days of the history have none
    value = ((F.col("p.trend") + drift) * F.col("p.factor") + noise) * F.col("y_scale")
    return bent.select("*", F.explode("points").alias("p")).select("region_id", "p.ds", "path", value.alias("value"))


def bands(paths: DataFrame, keys: list[str], value: str = "value", width: float = BAND) -> DataFrame:
    """yhat_lower and yhat_upper per key: exact percentiles of the values, between which ``width`` of them lie."""
    shares = [(1 - width) / 2, (1 + width) / 2]
    found = paths.groupBy(*keys).agg(F.percentile(value, F.array(*map(F.lit, shares))).alias("__band"))
    return found.select(*keys, F.get("__band", F.lit(0)).alias("yhat_lower"), F.get("__band", F.lit(1)).alias("yhat_upper"))


def expected(models: DataFrame, days: DataFrame) -> DataFrame:
    """Adds yhat to rows with region_id, ds and the regressors; NULL where a region has no model."""
    level = trend() * (1 + _dot(season_terms(), "seasons")) * F.col("y_scale")
    return days.join(models, "region_id", "left").select(*days.columns, level.alias("yhat"))


def predict(models: DataFrame, days: DataFrame, paths: int = PATHS, seed: int = 42) -> DataFrame:
    """Adds yhat and its band; NULL where a region has no model."""
    found = bands(simulated(models, days.select("region_id", "ds", *REGRESSORS), paths, seed), ["region_id", "ds"])
    return expected(models, days).join(found, ["region_id", "ds"], "left").select(*days.columns, "yhat", "yhat_lower", "yhat_upper")


def evaluate(models: DataFrame, validation: DataFrame) -> DataFrame:
    """MAPE, RMSE and PASS or WARN per region."""
    predicted = expected(models, validation.na.drop(subset=list(REGRESSORS)))
    return metrics.forecast_gate(metrics.forecast_errors(predicted, "y", "yhat", by="region_id"))

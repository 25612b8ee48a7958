"""The forecast as trend times seasons: planted changes of slope, bands that widen, exact percentiles."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from quayside.ml import decomposed, forecast


def history(spark, value, days=1000, regions=(1,)):
    """Daily rows whose demand is ``value(day number, region)``."""
    r = random.Random(2)
    rows = [(g, i, value(i, g), 10.0 + r.random(), 50.0 + r.random()) for g in regions for i in range(days)]
    df = spark.createDataFrame(rows, "region_id int, i int, y double, avg_unit_price double, rolling_7d_avg double")
    return df.select("region_id", F.date_add(F.lit("2020-01-06").cast("date"), F.col("i")).alias("ds"), "y", "avg_unit_price", "rolling_7d_avg")


@pytest.fixture(scope="module")
def bent(spark):
    """One change of slope at 0.32 of the history, a weekly season, noise."""
    r = random.Random(1)
    places = decomposed.places()

    def value(i, _):
        t = i / 999
        trend = 100 + 40 * t + 160 * max(0.0, t - places[9])
        return trend * (1 + 0.2 * math.sin(2 * math.pi * (i + 4) / 7)) + r.gauss(0, 8)

    return history(spark, value)


def test_finds_planted_change_and_keeps_others_at_zero(bent):
    model = decomposed.fit(bent).first()
    scale = model.y_scale
    assert max(range(25), key=lambda j: abs(model.bends[j])) in (8, 9, 10)
    assert sum(model.bends) * scale == pytest.approx(160, rel=0.15)
    far = [b for j, b in enumerate(model.bends) if abs(j - 9) > 3]
    assert sum(b == 0.0 for b in far) >= len(far) - 3 and all(abs(b) * scale < 16 for b in far), far
    assert model.line[0] * scale == pytest.approx(100, rel=0.05)
    assert model.sigma * scale == pytest.approx(8, rel=0.15)


def test_straight_history_has_no_bends(spark):
    r = random.Random(4)
    model = decomposed.fit(history(spark, lambda i, _: 50 + i / 20 + r.gauss(0, 3))).first()
    assert sum(b == 0.0 for b in model.bends) >= 20 and all(abs(b) * model.y_scale < 5 for b in model.bends), model.bends


def test_predicts_days_not_seen(spark, bent):
    last = bent.agg(F.max("ds")).first()[0]
    train = bent.filter(F.col("ds") < F.date_sub(F.lit(last), 60))
    row = decomposed.evaluate(decomposed.fit(train), bent.join(train, "ds", "left_anti")).first()
    assert row.mape < 0.05 and row.status == "PASS"


def test_bands_widen_cover_and_agree(spark, bent):
    models = decomposed.fit(bent)
    ahead = forecast.future_frame(bent, 900)
    first, again = (decomposed.predict(models, x, 200).orderBy("ds").collect() for x in (ahead, ahead.repartition(3)))
    assert first == again
    widths = [r.yhat_upper - r.yhat_lower for r in first]
    assert statistics.mean(widths[-30:]) > 2 * statistics.mean(widths[:7])
    assert all(r.yhat_lower < r.yhat < r.yhat_upper for r in first)
    # the first days have little but the noise: 80 % of a normal lie within 1.28 deviations
    sigma = models.select(F.col("sigma") * F.col("y_scale")).first()[0]
    assert statistics.mean(widths[:7]) == pytest.approx(2 * 1.2816 * sigma, rel=0.3)


def test_bands_are_exact_percentiles(spark):
    r = random.Random(3)
    rows = [(k, r.gauss(0, 1)) for k in (1, 2) for _ in range(101)]
    got = decomposed.bands(spark.createDataFrame(rows, "k int, value double"), ["k"]).collect()
    for row in got:
        values = sorted(v for k, v in rows if k == row.k)
        assert (row.yhat_lower, row.yhat_upper) == (pytest.approx(values[10]), pytest.approx(values[90]))


def test_draws_have_their_distributions(spark):
    df = spark.range(20000).select(decomposed.uniform("id").alias("u"), decomposed.uniform("id", F.lit("v")).alias("v"))
    df = df.select("u", decomposed.normal(F.col("u"), F.col("v")).alias("n"), decomposed.laplace(F.col("u"), F.lit(0.5)).alias("l"))
    row = df.agg(F.avg("u"), F.avg("n"), F.stddev("n"), F.avg("l"), F.avg(F.abs("l")), F.min("u"), F.max("u")).first()
    assert row[0] == pytest.approx(0.5, abs=0.01) and row[1] == pytest.approx(0, abs=0.03) and row[2] == pytest.approx(1, abs=0.03)
    assert row[3] == pytest.approx(0, abs=0.03) and row[4] == pytest.approx(0.5, abs=0.02) and 0 < row[5] and row[6] < 1


def test_regions_without_a_model_and_short_histories(spark):
    days = history(spark, lambda i, g: 10.0 * g, days=3, regions=(1, 2))
    models = decomposed.fit(days.filter("region_id = 1"))
    got = decomposed.predict(models, forecast.future_frame(days, 2), 20).collect()
    assert sorted((r.region_id, r.yhat is None, r.yhat_lower is None) for r in got) == [(1, False, False)] * 2 + [(2, True, True)] * 2
    assert all(r.yhat == pytest.approx(10, rel=0.01) for r in got if r.region_id == 1)
    assert decomposed.fit(days.limit(0)).count() == 0

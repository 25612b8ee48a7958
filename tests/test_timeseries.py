from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.functions.dates import day_of_week, month_start, week_start
from quayside.plans import features
from quayside.plans.features import with_demand_history, with_stockout_history
from quayside.sources.star import load_star


def test_demand_history_counts_rows_not_days(spark):
    # every third day is missing
    days = [date(2020, 1, 1) + timedelta(days=d) for d in range(52) if d % 3][:35]
    y = [int(v) for v in np.random.default_rng(1).integers(0, 50, len(days))]
    df = spark.createDataFrame([(1, d, v) for d, v in zip(days, y)], "region_id int, ds date, y long")
    rows = with_demand_history(df).orderBy("ds").collect()
    for i, row in enumerate(rows):
        for k in (7, 14, 30):
            assert row[f"lag_{k}d"] == (y[i - k] if i >= k else None)
        for n in (7, 30):
            expected = pytest.approx(np.mean(y[i - n : i])) if i >= n else None
            assert row[f"rolling_{n}d_avg"] == expected


def test_stockout_windows_stay_within_their_series(spark):
    rng = np.random.default_rng(2)
    series = {p: [(int(a), int(b)) for a, b in rng.integers(-20, 20, (9, 2))] for p in (1, 2)}
    rows = [
        (5, p, date(2020, 1, 6) + timedelta(weeks=w), gap, wanted)
        for p, values in series.items()
        for w, (gap, wanted) in enumerate(values)
    ] + [(None, 1, date(2020, 1, 6), 1, 1)]
    df = spark.createDataFrame(rows, "branch_id int, product_id int, week date, gap long, demanded long")
    result = with_stockout_history(df).orderBy("product_id", "week").collect()
    assert len(result) == 18
    for p in (1, 2):
        gaps, wanted = zip(*series[p])
        for i, row in enumerate(r for r in result if r.product_id == p):
            assert row.fill_rate_lag1 == (gaps[i - 1] if i else None)
            if i < 4:
                assert row.fill_rate_rolling is None and row.demand_trend is None
            else:
                assert row.fill_rate_rolling == pytest.approx(np.mean(gaps[i - 4 : i]))
                assert row.demand_trend == pytest.approx(np.polyfit(range(4), wanted[i - 4 : i], 1)[0], abs=1e-9)


def test_calendar(spark):
    days = ["2023-12-31", "2024-01-01", "2024-02-29", "2024-03-02"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.col("d").cast("date").alias("d"))
    rows = df.select("d", day_of_week(F.col("d")), week_start(F.col("d")), month_start(F.col("d"))).collect()
    assert [tuple(map(str, r)) for r in rows] == [
        ("2023-12-31", "0", "2023-12-25", "2023-12-01"),
        ("2024-01-01", "1", "2024-01-01", "2024-01-01"),
        ("2024-02-29", "4", "2024-02-26", "2024-02-01"),
        ("2024-03-02", "6", "2024-02-26", "2024-03-01"),
    ]


def test_stockout_series_are_sorted_once_by_a_telling_key(spark, sf):
    tables = load_star(spark, sf)
    rows = features.stockout_features(tables)
    sorts = [x for x in rows._jdf.queryExecution().executedPlan().toString().splitlines() if " Sort [" in x and "week" in x]
    assert len(sorts) == 1 and f"Sort [{features.SERIES}" in sorts[0]
    assert features.SERIES not in rows.columns
    again = features.with_stockout_history(features.stockout_base(tables)).na.drop(subset=["fill_rate_lag1"])
    assert again.columns == rows.columns and again.exceptAll(rows).isEmpty() and rows.exceptAll(again).isEmpty()

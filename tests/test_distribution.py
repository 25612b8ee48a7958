"""Descriptions of columns against exact counts, and the salted bucket layout with one order of a third of the items."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quayside.plans import distribution


def test_describe(spark):
    r = random.Random(4)
    rows = [(None if i % 10 == 3 else 42 if i % 3 == 0 else r.randrange(5000), r.choice("abc"), r.random()) for i in range(30_000)]
    df = spark.createDataFrame(rows, "k int, s string, x double").withColumn("d", F.date_add(F.lit("2020-01-01").cast("date"), F.coalesce("k", F.lit(0))))
    got = {x.column: x for x in distribution.describe(df.repartition(7), ["k", "s", "x", "d"]).collect()}
    exact = Counter(k for k, _, _ in rows if k is not None)
    k = got["k"]
    assert (k.n_rows, k.n_nulls) == (30_000, sum(v is None for v, _, _ in rows)) and k.n_distinct == pytest.approx(len(exact), rel=0.1)
    assert k.common[0].value == "42" and abs(k.common[0].n - exact[42]) <= 3.5 / distribution.TRACKED * 30_000
    assert {(x.value, x.n) for x in got["s"].common} == {(v, n) for v, n in Counter(s for _, s, _ in rows).items()}
    assert got["s"].quantiles is None
    values = sorted(x for *_, x in rows)
    for share, q in zip(distribution.SHARES, got["x"].quantiles):
        rank = sum(v <= q for v in values) / len(values)
        assert abs(rank - share) < 0.001
    assert got["d"].quantiles[0] >= 18262  # days
    assert [(h.value, h.rows) for h in distribution.heavy_values(distribution.describe(df, ["k"]), "k", 5000)] == [(42, exact[42])]


def test_describe_empty(spark):
    row = distribution.describe(spark.createDataFrame([], "k int"), ["k"]).first()
    assert (row.n_rows, row.n_nulls, row.n_distinct, row.common) == (0, 0, 0, []) and row.quantiles is None


def test_salted_buckets(spark):
    orders = spark.range(3000).select(F.col("id").alias("order_id"), (F.col("id") % 7).alias("customer_id"))
    order = F.when(F.col("id") % 3 == 0, 17).when(F.col("id") % 1000 == 1, None).otherwise(F.pmod(F.hash("id"), F.lit(3000)))
    items = spark.range(90_000).select(order.cast("bigint").alias("order_id"), F.lit(1).alias("quantity"), F.lit("same").alias("note"))
    spark.sql("CREATE DATABASE IF NOT EXISTS salted")
    heavy = distribution.write_salted({"orders": orders, "order_items": items}, "salted", 12)
    assert [h.value for h in heavy] == [17]
    stored = {n: spark.table(f"salted.{n}_salted") for n in ("orders", "order_items")}
    sizes = Counter(r.b for r in stored["order_items"].select(F.input_file_name().alias("b")).collect())
    assert max(sizes.values()) < 2.5 * 90_000 / 12 and sum(sizes.values()) == 90_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = distribution.join_salted(stored["orders"], stored["order_items"])
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        columns = ["order_id", "quantity", "note", "customer_id"]
        plain = items.join(orders, "order_id").select(*columns)
        assert joined.select(*columns).exceptAll(plain).isEmpty() and plain.exceptAll(joined.select(*columns)).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError, match="common values"):
        distribution.write_salted({"orders": orders, "order_items": items}, "salted", 80)


def test_no_heavy_orders(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS salted")
    orders = spark.range(100).withColumnRenamed("id", "order_id")
    assert distribution.write_salted({"orders": orders, "order_items": orders.union(orders)}, "salted", 4) == []
    assert spark.table("salted.orders_salted").count() == 100

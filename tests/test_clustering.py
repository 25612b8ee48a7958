"""Layout for selective reads: what a lookup reads, and that no row is lost or doubled."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quayside.plans import clustering


@pytest.fixture(scope="module")
def orders(spark):
    """60,000 orders of 3,000 customers over 1,000 days, a third of them of one customer, and some without a date."""
    customer = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.hash("id"), F.lit(3000)))
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.hash("id", F.lit(1)), F.lit(1000)))
    rows = spark.range(60_000).select(
        F.col("id").alias("order_id"), customer.cast("bigint").alias("customer_id"), F.when(F.col("id") % 500 != 1, day).alias("order_date")
    )
    spark.sql("CREATE DATABASE IF NOT EXISTS clustered")
    clustering.write_clustered({"orders": rows}, "clustered", 24, 1 << 16, ["orders"])
    return rows


def test_rows_stay(spark, orders):
    stored = spark.table("clustered.orders_clustered")
    assert stored.columns == orders.columns
    assert stored.exceptAll(orders).isEmpty() and orders.exceptAll(stored).isEmpty()


def test_files_hold_even_shares(spark, orders):
    files = spark.table("clustered.orders_clustered").inputFiles()
    assert len(files) >= 20
    sizes = [pq.ParquetFile(f.removeprefix("file://").removeprefix("file:")).metadata.num_rows for f in files]
    assert max(sizes) < 3 * sum(sizes) / len(sizes)  # the hot customer's rows are spread by date


@pytest.mark.parametrize(
    "condition, share",
    [
        ("customer_id = 1234", 0.3),
        ("order_date BETWEEN DATE'2021-03-01' AND DATE'2021-03-20'", 0.35),
        ("customer_id = 7 AND order_date = DATE'2021-03-01'", 0.25),
        ("customer_id = 99999", 0.0),
        ("order_id = 4321", 0.15),
    ],
)
def test_a_lookup_reads_a_part(spark, orders, condition, share):
    stored = spark.table("clustered.orders_clustered").filter(condition)
    assert clustering.rows_read(stored) <= share * 60_000
    assert stored.count() == orders.filter(condition).count()


def test_interleaving(spark):
    got = spark.range(16).select("id", clustering.interleaved([F.shiftright("id", 2), F.col("id").bitwiseAND(F.lit(3))], 2).alias("z")).collect()
    for r in got:
        a, b = r.id >> 2, r.id & 3
        assert r.z == ((a >> 1) << 3) | ((b >> 1) << 2) | ((a & 1) << 1) | (b & 1)

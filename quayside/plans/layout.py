"""Tables in the catalog: creation, physical layout and statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.joins import fact_join
from quayside.schema import TABLES, Tables


def create_tables(spark: SparkSession, database: str) -> None:
    """Creates the database and its tables where they do not exist, parents first."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for spec in TABLES.values():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spec.schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{spec.name} ({columns}) USING parquet")


def read_tables(spark: SparkSession, database: str) -> Tables:
    return {name: spark.table(f"{database}.{name}") for name in TABLES}


def write_bucketed(tables: Tables, database: str, buckets: int) -> None:
    """Orders and their items bucketed by order, so that joining them needs no shuffle.

    Rows are brought to their bucket first, which makes one file per bucket instead of one per
    task and bucket. An order with very many items fills its bucket; keep such data unbucketed.
    """
    for name in ("orders", "order_items"):
        (
            tables[name]
            .repartition(buckets, "order_id")
            .write.mode("overwrite")
            .bucketBy(buckets, "order_id")
            .sortBy("order_id")
            .saveAsTable(f"{database}.{name}_by_order")
        )


#: Partition of the items whose order or order date is missing.
NO_MONTH = "none"


def items_with_month(tables: Tables) -> DataFrame:
    """All items, with the date and month of their order, which they do not carry themselves."""
    orders = tables["orders"].select("order_id", "order_date")
    month = F.coalesce(F.date_format("order_date", "yyyy-MM"), F.lit(NO_MONTH))
    return fact_join(tables["order_items"], orders, "order_id", "left").withColumn("order_ym", month)


def write_items_by_month(tables: Tables, table: str) -> None:
    """Items partitioned by month of order; a month that is too large is written by several tasks."""
    items = items_with_month(tables).hint("rebalance", "order_ym")
    items.write.mode("overwrite").partitionBy("order_ym").saveAsTable(table)


def analyze(spark: SparkSession, tables: Sequence[str]) -> None:
    """Table and column statistics for the optimizer."""
    for table in tables:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")

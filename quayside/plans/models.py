"""The SQL-style models by layer, and how each is stored."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from quayside.plans.analysis import customer_rfm, production_demand_gap
from quayside.plans.marts import mart_monthly_sales
from quayside.plans.staging import negative_revenue, stg_orders
from quayside.schema import Tables


@dataclass(frozen=True)
class Model:
    plan: Callable[[Tables], DataFrame]
    materialized: str = "table"
    partition_by: str | None = None


LAYERS: dict[str, dict[str, Model]] = {
    "staging": {"stg_orders": Model(stg_orders, "view")},
    "marts": {"mart_monthly_sales": Model(mart_monthly_sales, partition_by="month")},
    "analysis": {
        "analysis_customer_rfm": Model(customer_rfm),
        "analysis_production_demand_gap": Model(partial(production_demand_gap, ordered=False)),
    },
}


def build(spark: SparkSession, tables: Tables, layer: str, database: str | None = None) -> list[str]:
    """Builds the models of a layer: temporary views, or tables in the layer's database."""
    database = database or layer
    names = []
    for name, model in LAYERS[layer].items():
        df = model.plan(tables)
        if model.materialized == "view":
            df.createOrReplaceTempView(name)
            names.append(name)
            continue
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        if model.partition_by:
            df = df.hint("rebalance", model.partition_by)
        writer = df.write.mode("overwrite")
        if model.partition_by:
            writer = writer.partitionBy(model.partition_by)
        writer.saveAsTable(f"{database}.{name}")
        names.append(f"{database}.{name}")
    return names


class DataTestError(RuntimeError):
    """Raised when a data test returns rows."""


def run_data_tests(tables: Tables) -> None:
    failures = negative_revenue(tables).count()
    if failures:
        raise DataTestError(f"{failures} orders have a negative amount")

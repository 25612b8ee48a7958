"""The eight logical tables, mapped from a folder of star-schema parquet files."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.schema import TABLES, Tables

LOADED_AT = "2001-08-01 00:00:00"

# Column types of the files. Naming them saves reading footers to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_shipdate timestamp_ntz",
}


def read_star(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


class StarTables(Mapping[str, DataFrame]):
    """Reads a table when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str, loaded_at: str = LOADED_AT):
        self._read = partial(read_star, spark, folder)
        self._loaded_at = loaded_at
        self._tables: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            if name not in TABLES:
                raise KeyError(name)
            stamp = F.lit(self._loaded_at).cast("timestamp_ntz")
            self._tables[name] = getattr(self, f"_{name}")().withColumn("created_at", stamp)
        return self._tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)

    def _regions(self) -> DataFrame:
        return self._read("region").selectExpr("r_regionkey as region_id", "r_name as region_name")

    def _branches(self) -> DataFrame:
        return self._read("nation").selectExpr(
            "n_nationkey as branch_id", "n_name as branch_name", "n_regionkey as region_id"
        )

    def _customers(self) -> DataFrame:
        return self._read("customer").selectExpr(
            "c_custkey as customer_id", "c_name as customer_name", "c_nationkey as branch_id"
        )

    def _suppliers(self) -> DataFrame:
        placed = self._read("supplier").join(self._read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        return placed.selectExpr("s_suppkey as supplier_id", "s_name as supplier_name", "n_regionkey as region_id")

    def _products(self) -> DataFrame:
        return self._read("part").selectExpr(
            "p_partkey as product_id",
            "p_name as product_name",
            "p_type as category",
            "cast(p_retailprice as decimal(10,2)) as unit_cost",
        )

    def _orders(self) -> DataFrame:
        return self._read("orders").selectExpr(
            "o_orderkey as order_id",
            "o_custkey as customer_id",
            "cast(o_orderdate as date) as order_date",
            "o_orderstatus as status",
            "cast(o_totalprice as decimal(14,2)) as total_amount",
        )

    def _order_items(self) -> DataFrame:
        # the unit price is truncated to whole cents
        return self._read("lineitem").selectExpr(
            "l_orderkey as order_id",
            "l_partkey as product_id",
            "cast(l_quantity as int) as quantity",
            "cast((cast(rint(l_extendedprice * 100) as bigint) div cast(l_quantity as int)) / 100D as decimal(10,2)) as unit_price",
        )

    def _daily_production(self) -> DataFrame:
        shipped = self._read("lineitem").selectExpr(
            "l_suppkey as supplier_id",
            "l_partkey as product_id",
            "cast(l_shipdate as date) as prod_date",
            "cast(l_quantity as int) as quantity",
        )
        return shipped.groupBy("supplier_id", "product_id", "prod_date").agg(
            F.sum("quantity").cast("int").alias("qty_produced")
        )


def load_star(spark: SparkSession, folder: str, loaded_at: str = LOADED_AT) -> Tables:
    return StarTables(spark, folder, loaded_at)

"""The eight tables: columns, keys and constraints."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Table:
    """``columns`` are those of the input file, in file order; the key and ``created_at`` are
    assigned at load."""

    name: str
    key: str
    columns: Mapping[str, str]
    required: tuple[str, ...]
    lengths: Mapping[str, int] = field(default_factory=dict)
    parents: Mapping[str, str] = field(default_factory=dict)
    checks: Mapping[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        ddl = ", ".join(f"{name} {kind}" for name, kind in self.columns.items())
        return T.StructType.fromDDL(f"{self.key} bigint, {ddl}, created_at timestamp_ntz")


# Table layout, string lengths, keys and checks of the data model. Parents come
# before children, which makes this the load order.
TABLES: dict[str, Table] = {
    table.name: table
    for table in (
        Table(
            "regions",
            "region_id",
            {"region_name": "string", "country": "string"},
            required=("region_name",),
            lengths={"region_name": 100, "country": 100},
        ),
        Table(
            "suppliers",
            "supplier_id",
            {"supplier_name": "string", "contact_email": "string", "region_id": "bigint"},
            required=("supplier_name",),
            lengths={"supplier_name": 200, "contact_email": 200},
            parents={"region_id": "regions"},
        ),
        Table(
            "branches",
            "branch_id",
            {"branch_name": "string", "region_id": "bigint", "address": "string"},
            required=("branch_name",),
            lengths={"branch_name": 150},
            parents={"region_id": "regions"},
        ),
        Table(
            "products",
            "product_id",
            {"product_name": "string", "category": "string", "unit_cost": "decimal(10,2)"},
            required=("product_name",),
            lengths={"product_name": 200, "category": 100},
        ),
        Table(
            "customers",
            "customer_id",
            {"customer_name": "string", "email": "string", "branch_id": "bigint", "joined_at": "date"},
            required=("customer_name",),
            lengths={"customer_name": 200, "email": 200},
            parents={"branch_id": "branches"},
        ),
        Table(
            "orders",
            "order_id",
            {"customer_id": "bigint", "order_date": "date", "status": "string", "total_amount": "decimal(14,2)"},
            required=("order_date",),
            lengths={"status": 50},
            parents={"customer_id": "customers"},
        ),
        Table(
            "order_items",
            "item_id",
            {"order_id": "bigint", "product_id": "bigint", "quantity": "int", "unit_price": "decimal(10,2)"},
            required=("quantity",),
            parents={"order_id": "orders", "product_id": "products"},
            checks={"quantity_positive": "quantity > 0"},
        ),
        Table(
            "daily_production",
            "prod_id",
            {"supplier_id": "bigint", "product_id": "bigint", "prod_date": "date", "qty_produced": "int"},
            required=("prod_date", "qty_produced"),
            parents={"supplier_id": "suppliers", "product_id": "products"},
            checks={"qty_produced_not_negative": "qty_produced >= 0"},
        ),
    )
}

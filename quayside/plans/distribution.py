"""What the values of a column look like, from mergeable sketches, and a bucket layout that heavy values do not upset.

One pass describes any number of columns: most common values with their counts, quantiles, distinct values and NULLs. Sketches are
built per task and merged, so a value that fills a third of the table costs no more than another; a description is a row
per column and can be stored with the tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.constraints import union
from quayside.schema import Tables

#: Values that a task's sketch of common values keeps. Values held by more than some 3.5 / TRACKED of all rows are certain to be found.
TRACKED = 10_000
#: Common values reported per column, and shares at which quantiles are given.
COMMON = 100
SHARES = tuple(i / 20 for i in range(21))
#: Accuracy of the quantiles: ranks are off by at most 1 / ACCURACY of the rows.
ACCURACY = 10_000


def _described(df: DataFrame, column: str) -> list[Column]:
    value = F.col(column)
    kind = df.schema[column].dataType.typeName()
    numeric = F.unix_date(value) if kind == "date" else value.try_cast("double") if kind != "string" else F.lit(None).cast("double")
    return [
        F.count(F.lit(1)).alias(f"{column}|n_rows"),
        F.count_if(value.isNull()).alias(f"{column}|n_nulls"),
        F.approx_count_distinct(value).alias(f"{column}|n_distinct"),
        F.call_function("approx_top_k", value, F.lit(COMMON), F.lit(TRACKED)).alias(f"{column}|common"),
        F.percentile_approx(numeric.cast("double"), list(SHARES), ACCURACY).alias(f"{column}|quantiles"),
    ]


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, n_rows, n_nulls, n_distinct, common (value, n, most frequent first), quantiles: all columns in one pass.

    Dates have quantiles as days since 1970; strings have none.
    """
    totals = df.agg(*(x for c in columns for x in _described(df, c)))

    def common(column: str) -> Column:
        known = F.filter(F.col(f"`{column}|common`"), lambda x: x["item"].isNotNull())
        return F.transform(known, lambda x: F.struct(x["item"].cast("string").alias("value"), x["count"].alias("n"))).alias("common")

    rows = [
        F.struct(
            F.lit(c).alias("column"),
            *(F.col(f"`{c}|{name}`").alias(name) for name in ("n_rows", "n_nulls", "n_distinct")),
            common(c),
            F.col(f"`{c}|quantiles`").alias("quantiles"),
        )
        for c in columns
    ]
    return totals.select(F.inline(F.array(*rows)))


def describe_tables(tables: Tables, columns: dict[str, Sequence[str]]) -> DataFrame:
    """``describe`` of several tables, with their names."""
    return union([describe(tables[name], chosen).select(F.lit(name).alias("table_name"), "*") for name, chosen in columns.items()])


@dataclass(frozen=True)
class Heavy:
    value: int
    rows: int


def heavy_values(description: DataFrame, column: str, above: float) -> list[Heavy]:
    """Values of a described column held by more than ``above`` rows; fewer than rows / above."""
    row = description.filter(F.col("column") == column).select("common").first()
    return [Heavy(int(x.value), x.n) for x in (row.common if row else []) if x.n > above]


# -- buckets -----------------------------------------------------------------------------------


def salts(heavy: Sequence[Heavy], limit: float, key: Column) -> Column:
    """Into how many parts the rows of a key go: one, or for a heavy key as many as keep a part below ``limit`` rows."""
    if not heavy:
        return F.lit(1)
    parts = F.create_map(*(F.lit(x) for h in heavy for x in (h.value, int(h.rows // limit) + 1)))
    return F.coalesce(F.try_element_at(parts, key), F.lit(1))


def write_salted(tables: Tables, database: str, buckets: int, parts_per_bucket: int = 2) -> list[Heavy]:
    """Orders and their items bucketed by order and salt, so that joining them by both needs no shuffle.

    Items of an order that holds more than a fraction of a bucket's mean get one of several salts, by a hash of the item;
    the order's own row is repeated for each of them. Returns the orders so treated. There are fewer than
    ``buckets * parts_per_bucket`` of them, and COMMON at most are reported by the description, which bounds ``buckets`` here.
    Items should be read from files, whose rows have lasting places: equal items are told apart by theirs.
    """
    if buckets * parts_per_bucket > COMMON:
        raise ValueError(f"the description reports {COMMON} common values; buckets * parts_per_bucket must not exceed that")
    items, orders = tables["order_items"], tables["orders"]
    described = describe(items, ["order_id"])
    limit = max(1.0, described.first().n_rows / (buckets * parts_per_bucket))
    heavy = heavy_values(described, "order_id", limit)
    key = F.col("order_id").cast("bigint")
    parts = salts(heavy, limit, key)
    spread = F.when(parts > 1, F.pmod(F.xxhash64(*items.columns, F.monotonically_increasing_id()), parts)).otherwise(0)
    salted = {
        "order_items": items.withColumn("salt", spread.cast("int")),
        "orders": orders.withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1))),
    }
    for name, df in salted.items():
        (
            df.repartition(buckets, "order_id", "salt")
            .write.mode("overwrite")
            .bucketBy(buckets, "order_id", "salt")
            .sortBy("order_id", "salt")
            .saveAsTable(f"{database}.{name}_salted")
        )
    return heavy


def join_salted(orders: DataFrame, items: DataFrame, how: str = "inner") -> DataFrame:
    """Items with their orders, from the two salted tables; each item once."""
    return items.join(orders, ["order_id", "salt"], how).drop("salt")

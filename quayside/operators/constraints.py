"""Constraint violations, counted. Spark does not enforce keys or checks, so loads are validated."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.joins import lookup
from quayside.schema import TABLES, Table, Tables


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Values of ``column`` without a parent row, NULL included, with their number of rows.

    Child rows are counted per value before the join, so a value that fills a third of the table
    is still one row of the join.
    """
    values = child.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
    return values.join(lookup(parent.select(F.col(parent_key).alias("value")), growing=True), "value", "left_anti")


def _not_checkable(some: DataFrame, kind: str, table: str, rule: str) -> DataFrame:
    """A rule whose table, column or parent is missing: its violations are unknown, so NULL."""
    return some.sparkSession.range(1).select(
        F.lit(kind).alias("kind"),
        F.lit(table).alias("table_name"),
        F.lit(rule).alias("rule"),
        F.lit(None).cast("bigint").alias("violations"),
    )


def _violation(kind: str, table: str, rule: str, counted: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("rows"), F.lit(0)).alias("violations")
    return counted.agg(total).select(
        F.lit(kind).alias("kind"), F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "violations"
    )


def primary_keys(tables: Tables) -> DataFrame:
    """Per table: key values that are duplicated or NULL; NULL if the table has no such column."""
    return union(
        [
            _violation(
                "primary_key",
                spec.name,
                spec.key,
                tables[spec.name]
                .groupBy(spec.key)
                .agg(F.count(F.lit(1)).alias("n"))
                .filter((F.col("n") > 1) | F.col(spec.key).isNull())
                .select(F.lit(1).alias("rows")),
            )
            if spec.key in tables[spec.name].columns
            else _not_checkable(tables[spec.name], "primary_key", spec.name, spec.key)
            for spec in TABLES.values()
            if spec.name in tables
        ]
    )


def foreign_keys(tables: Tables) -> DataFrame:
    """Per foreign key: rows that point nowhere. NULL points nowhere legally. NULL violations if there is no parent table."""
    return union(
        [
            _violation(
                "foreign_key",
                spec.name,
                f"{column} -> {parent}",
                orphans(
                    tables[spec.name].filter(F.col(column).isNotNull()), column, tables[parent], TABLES[parent].key
                ),
            )
            if parent in tables and column in tables[spec.name].columns
            else _not_checkable(tables[spec.name], "foreign_key", spec.name, f"{column} -> {parent}")
            for spec in TABLES.values()
            for column, parent in spec.parents.items()
            if spec.name in tables
        ]
    )


def column_rules(df: DataFrame, spec: Table, kinds: Sequence[str]) -> DataFrame | None:
    """NOT NULL, length and CHECK rules of one table, in one pass over it; NULL for those of missing columns."""
    present = set(df.columns)
    unknown = F.lit(None).cast("bigint")
    counted: dict[str, Column] = {}
    if "not_null" in kinds:
        counted |= {f"not_null|{c}": F.count_if(F.col(c).isNull()) if c in present else unknown for c in spec.required}
    if "max_length" in kinds:
        counted |= {
            f"max_length|{c} <= {n}": F.count_if(F.char_length(c) > n) if c in present else unknown
            for c, n in spec.lengths.items()
        }
    if "check" in kinds:
        counted |= {f"check|{name}": F.count_if(~F.expr(rule)) for name, rule in spec.checks.items()}
    if not counted:
        return None
    totals = df.agg(*(value.alias(name) for name, value in counted.items()))
    return totals.unpivot([], list(counted), "rule", "violations").select(
        F.split_part("rule", F.lit("|"), F.lit(1)).alias("kind"),
        F.lit(spec.name).alias("table_name"),
        F.split_part("rule", F.lit("|"), F.lit(2)).alias("rule"),
        "violations",
    )


def columns(tables: Tables, kinds: Sequence[str] = ("not_null", "max_length", "check")) -> DataFrame:
    reports = (column_rules(tables[s.name], s, kinds) for s in TABLES.values() if s.name in tables)
    return union([report for report in reports if report is not None])


def report(tables: Tables) -> DataFrame:
    """Every constraint of the data model: kind, table_name, rule, violations."""
    return union([primary_keys(tables), foreign_keys(tables), columns(tables)])

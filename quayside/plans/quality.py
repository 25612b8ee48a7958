"""Post-load quality checks and the gate built on them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.constraints import duplicate_keys, orphans, union
from quayside.schema import TABLES, Tables

# The fewest rows expected per table in production.
MINIMUM_ROWS = {
    "regions": 1,
    "suppliers": 1,
    "branches": 1,
    "products": 1,
    "customers": 200_000,
    "orders": 19_000_000,
    "order_items": 50_000_000,
    "daily_production": 1_000_000,
}
COUNTED = ("orders", "order_items", "customers", "daily_production")


@dataclass(frozen=True)
class Check:
    """One number that must be at least ``minimum`` or, without one, zero.

    It is an aggregate over one table, or ``measure`` gives it as one row (result).
    """

    name: str
    message: str
    table: str | None = None
    aggregate: Callable[[], Column] | None = None
    measure: Callable[[Tables], DataFrame] | None = None
    minimum: int | None = None

    def passed(self) -> Column:
        return F.col("result") == 0 if self.minimum is None else F.col("result") >= self.minimum


def row_counts(tables: Tables) -> DataFrame:
    return union(
        [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
            for name, df in tables.items()
        ]
    )


def count_where(condition: str) -> Callable[[], Column]:
    return lambda: F.count_if(F.expr(condition))


def count_orphans(table: str, column: str) -> Callable[[Tables], DataFrame]:
    """Rows of a child table without a parent; NULL counts as an orphan here."""
    parent = TABLES[TABLES[table].parents[column]]
    return lambda tables: orphans(tables[table], column, tables[parent.name], parent.key).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("result")
    )


def count_duplicate_keys(table: str) -> Callable[[Tables], DataFrame]:
    """Number of keys, not rows, that occur more than once."""
    return lambda tables: duplicate_keys(tables[table], [TABLES[table].key]).agg(F.count(F.lit(1)).alias("result"))


def checks(minimums: Mapping[str, int] = MINIMUM_ROWS) -> list[Check]:
    """The ten checks, in the order in which they run."""
    rows = [
        Check(f"row_count_{t}", f"at least {minimums[t]} rows expected", t, count_where("true"), minimum=minimums[t])
        for t in COUNTED
    ]
    return rows + [
        Check("orphan_items", "order items without an order", measure=count_orphans("order_items", "order_id")),
        Check("orphan_orders", "orders without a customer", measure=count_orphans("orders", "customer_id")),
        Check(
            "orphan_production", "production without a supplier", measure=count_orphans("daily_production", "supplier_id")
        ),
        Check("null_order_date", "order_date is missing", "orders", count_where("order_date is null")),
        Check(
            "bad_quantity", "quantity is not positive", "order_items", count_where("quantity is null or quantity <= 0")
        ),
        Check("duplicate_orders", "order_id occurs more than once", measure=count_duplicate_keys("orders")),
    ]


def evaluate(tables: Tables, chosen: Sequence[Check]) -> DataFrame:
    """The chosen checks as one lazy plan: name, result, status, msg.

    Aggregates over the same table share one pass over it.
    """
    by_table: dict[str, list[Check]] = {}
    for check in chosen:
        if check.table:
            by_table.setdefault(check.table, []).append(check)
    parts = [
        tables[table].agg(*(c.aggregate().alias(c.name) for c in group)).unpivot([], [c.name for c in group], "name", "result")
        for table, group in by_table.items()
    ] + [c.measure(tables).select(F.lit(c.name).alias("name"), "result") for c in chosen if c.measure]

    def per_check(value: Callable[[Check], Column]) -> Column:
        return F.coalesce(*(F.when(F.col("name") == c.name, value(c)) for c in chosen))

    return union(parts).select(
        "name",
        "result",
        F.when(per_check(Check.passed), "PASS").otherwise("FAIL").alias("status"),
        per_check(lambda c: F.lit(c.message)).alias("msg"),
    )


def report(tables: Tables, minimums: Mapping[str, int] = MINIMUM_ROWS) -> DataFrame:
    return evaluate(tables, checks(minimums))


def run_checks(
    tables: Tables, minimums: Mapping[str, int] = MINIMUM_ROWS, fail_fast: bool = False
) -> list[tuple[str, int | None, str, str]]:
    """Runs all checks in one plan, or one by one if that fails; one that cannot run is an ERROR.

    With ``fail_fast`` the first check that does not pass is the last in the result.
    """
    results = []
    try:
        found = {r["name"]: tuple(r) for r in report(tables, minimums).collect()}  # one row per check
    except Exception:  # some check cannot run: find out which
        found = {}
    for check in checks(minimums) if found else ():
        results.append(found[check.name])
        if fail_fast and results[-1][2] != "PASS":
            break
    if results:
        return results
    for check in checks(minimums):
        try:
            results.append(tuple(evaluate(tables, [check]).first()))
        except Exception as error:  # whatever went wrong, the check did not pass
            results.append((check.name, None, "ERROR", str(error)))
        if fail_fast and results[-1][2] != "PASS":
            break
    return results


class QualityError(RuntimeError):
    """Raised by the gate; the message names the checks that did not pass."""


def gate(tables: Tables, minimums: Mapping[str, int] = MINIMUM_ROWS, fail_fast: bool = True) -> None:
    failed = [r for r in run_checks(tables, minimums, fail_fast) if r[2] != "PASS"]
    if failed:
        raise QualityError("; ".join(f"{name}: {status} {result} ({msg})" for name, result, status, msg in failed))

"""Bulk load of CSV files into managed tables.

The file format is comma-separated with a header, doubled quotes inside quoted values, and ``\\N`` for
NULL. Columns are taken by position. An empty value stays an empty string, and is an error in a column
that is not a string.
"""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators import constraints
from quayside.operators.keys import with_file_order_key
from quayside.schema import TABLES, Table

log = logging.getLogger(__name__)

# The NULL marker and a column that some exports carry and that is dropped.
NULL_MARKER = "\\N"
REDUNDANT_COLUMN = "column1"


class ConstraintError(ValueError):
    """Raised when a file breaks the constraints of its table; nothing is loaded then."""


@dataclass(frozen=True)
class Loaded:
    table: str
    rows: int
    seconds: float


def read_csv(
    spark: SparkSession, table: str, path: str, loaded_at: Column | None = None, first_key: int = 1, multi_line: bool = False
) -> DataFrame:
    """The file as rows of the table: keys from ``first_key`` on in file order, and the load time.

    ``multi_line`` allows line breaks within quotes; such a file cannot be split, so one task reads it.
    """
    spec = TABLES[table]
    options = {"header": True, "escape": '"', "mode": "FAILFAST", "encoding": "UTF-8", "multiLine": multi_line}
    # without a schema only the header of one file is read
    header = spark.read.options(header=True, escape='"').csv(path).columns
    names = iter(spec.columns)
    redundant = REDUNDANT_COLUMN in header and REDUNDANT_COLUMN not in spec.columns
    fields = [h if redundant and h == REDUNDANT_COLUMN else next(names, None) for h in header]
    if None in fields or next(names, None) is not None:
        raise ValueError(f"{path}: expected the columns {list(spec.columns)}, found {header}")

    raw = spark.read.schema(", ".join(f"`{f}` string" for f in fields)).options(**options).csv(path)

    def typed(name: str, kind: str) -> Column:
        # the reader gives NULL for an empty value and leaves the marker alone
        text = F.when(F.col(name) == NULL_MARKER, None).otherwise(F.coalesce(F.col(name), F.lit("")))
        return text.cast(kind).alias(name)

    rows = raw.drop(REDUNDANT_COLUMN).select(*(typed(n, k) for n, k in spec.columns.items()))
    stamp = (F.current_timestamp() if loaded_at is None else loaded_at).cast("timestamp_ntz")
    return with_file_order_key(rows, spec.key, first_key).withColumn("created_at", stamp)


def broken_constraints(spark: SparkSession, rows: DataFrame, spec: Table, database: str) -> list[tuple[str, int]]:
    """Rules of the table that the rows break, with the number of rows."""
    tables = {parent: spark.table(f"{database}.{parent}") for parent in spec.parents.values()}
    reports = [constraints.columns({spec.name: rows})]
    if spec.parents:
        own = constraints.foreign_keys({**tables, spec.name: rows}).filter(F.col("table_name") == spec.name)
        reports.append(own)
    broken = constraints.union(reports).filter("violations > 0").collect()  # one row per rule
    return [(f"{r.kind} {r.rule}", r.violations) for r in broken]


def load_table(
    spark: SparkSession, table: str, data_dir: str, database: str, mode: str = "overwrite", loaded_at: Column | None = None
) -> Loaded | None:
    """Loads ``<data_dir>/<table>.csv`` (a file or a folder); None if there is none.

    The file is parsed once, into the shared folder; it reaches the table only if all its rows keep
    the constraints. ``append`` adds to the table and goes on counting its keys.
    """
    if table not in TABLES:
        raise ValueError(f"unknown table {table!r}; known: {', '.join(TABLES)}")
    spec, target, start = TABLES[table], f"{database}.{table}", time.monotonic()
    last_key = spark.table(target).agg(F.max(spec.key)).first()[0] if mode == "append" else None
    try:
        parsed = read_csv(spark, table, f"{data_dir}/{table}.csv", loaded_at, (last_key or 0) + 1)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no file for table %s in %s, skipped", table, data_dir)
        return None
    broken = broken_constraints(spark, parsed, spec, database)
    if broken:
        raise ConstraintError(f"{table}: " + ", ".join(f"{rule} ({rows} rows)" for rule, rows in broken))
    parsed.select(*spec.schema.names).write.insertInto(target, overwrite=mode == "overwrite")
    loaded = Loaded(table, parsed.count(), time.monotonic() - start)
    log.info("%s: %d rows loaded in %.1f s", table, loaded.rows, loaded.seconds)
    return loaded


def load_tables(
    spark: SparkSession,
    data_dir: str,
    database: str,
    table: str = "all",
    mode: str = "overwrite",
    loaded_at: Column | None = None,
) -> list[Loaded]:
    """Loads one table or all, parents before children; the first failure ends the load."""
    names = list(TABLES) if table == "all" else [table]
    results = [load_table(spark, name, data_dir, database, mode, loaded_at) for name in names]
    return [result for result in results if result]

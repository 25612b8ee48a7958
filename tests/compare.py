"""Runs registered queries next to their SQL and compares the rows.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TYPES = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, query, sql: str, folder: str) -> str:
    """An empty string if both results agree in columns, types and rows, else what differs."""
    df = query(spark, folder)
    names = sorted(df.columns)
    cursor = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in cursor.description}
    if sorted(theirs) != names:
        return f"columns {names} != {sorted(theirs)}"
    ours = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    if ours != theirs:
        return f"types {[(n, ours[n], theirs[n]) for n in names if ours[n] != theirs[n]]}"
    order = [d[0] for d in cursor.description]
    picks = [order.index(n) for n in names]
    expected = Counter(tuple(row[i] for i in picks) for row in cursor.fetchall())
    actual = Counter(tuple(row) for row in df.select(*names).collect())
    if expected != actual:
        extra, missing = actual - expected, expected - actual
        return f"rows {sum(actual.values())} vs {sum(expected.values())}: extra {list(extra)[:3]} missing {list(missing)[:3]}"
    return ""


def main() -> int:
    import __spark_entry__ as contract
    from quayside.session import get_spark

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = get_spark("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, oracle = connect(folder), contract.queries(), contract.oracle_sql()
    failed = 0
    for name in chosen or queries:
        start = time.time()
        try:
            if name in oracle:
                result = compare(spark, con, queries[name], oracle[name], folder)
            else:
                result = "" if queries[name](spark, folder).count() else "no rows"
        except Exception as error:  # report and go on
            result = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(result)
        print(f"{name:28s} {time.time() - start:6.2f}s {result or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))

"""Tables laid out for selective reads, in place of secondary indexes.

Rows are placed along a curve that interleaves the bits of several columns' quantile ranks, so that a file holds a narrow range
of each of them and the minima and maxima that Parquet keeps rule most files out, whichever of the columns a read names. Columns with
many values also get bloom filters, which rule out the row groups that do not hold a single looked-up value. Both are
what Parquet readers use by themselves: a lookup is a plain filter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.ml.boosting import quantile_edges, with_bins
from quayside.schema import Tables

#: Bits of a column's quantile rank; a file holds a range of the interleaved ranks.
RANK_BITS = 8


@dataclass(frozen=True)
class Clustering:
    """``by``: columns whose ranks are interleaved; ``looked_up``: columns with a bloom filter."""

    by: tuple[str, ...]
    looked_up: tuple[str, ...]


# The columns that the data model has indexes on.
CLUSTERINGS: Mapping[str, Clustering] = {
    "orders": Clustering(("customer_id", "order_date"), ("customer_id", "order_id")),
    "order_items": Clustering(("order_id", "product_id"), ("order_id", "product_id")),
    "daily_production": Clustering(("supplier_id", "product_id", "prod_date"), ("supplier_id", "product_id")),
    "customers": Clustering(("branch_id",), ("customer_id",)),
}


def number(df: DataFrame, column: str) -> Column:
    """A column as a number in its own order."""
    return F.unix_date(column) if df.schema[column].dataType.typeName() == "date" else F.col(column)


def interleaved(ranks: Sequence[Column], bits: int = RANK_BITS) -> Column:
    """One number from the bits of all ranks, the highest bits of each first."""
    total = F.lit(0).cast("bigint")
    for bit in range(bits):
        for k, rank in enumerate(reversed(ranks)):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint")
            total = total.bitwiseOR(F.shiftleft(one, bit * len(ranks) + k))
    return total


def along_curve(df: DataFrame, by: Sequence[str], files: int, bits: int = RANK_BITS) -> DataFrame:
    """The rows in ``files`` ranges of the curve, sorted within; NULLs rank above all values.

    One pass finds the quantiles of all columns by mergeable sketches. Ranks are few, so rows of one
    rank in every column, however many, are told apart by a hash of the row and spread.
    """
    numbers = df.withColumns({f"__n{i}": number(df, c).cast("double") for i, c in enumerate(by)})
    names = [f"__n{i}" for i in range(len(by))]
    edges = quantile_edges(numbers, names, (1 << bits) - 1)
    ranked = with_bins(numbers, names, edges, "__ranks")
    curve = interleaved([F.get("__ranks", F.lit(i)) for i in range(len(by))], bits)
    spread = F.xxhash64(*(f"`{c}`" for c in df.columns))
    placed = ranked.withColumns({"__curve": curve, "__spread": spread}).repartitionByRange(files, "__curve", "__spread")
    return placed.sortWithinPartitions("__curve", *by).select(*df.columns)


def write_clustered(tables: Tables, database: str, files: int, row_group_bytes: int = 128 << 20, names: Sequence[str] = tuple(CLUSTERINGS)) -> list[str]:
    """Writes the tables as ``<database>.<name>_clustered``."""
    written = []
    for name in names:
        spec, df = CLUSTERINGS[name], tables[name]
        writer = along_curve(df, spec.by, files).write.mode("overwrite").option("parquet.block.size", row_group_bytes)
        for column in spec.looked_up:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.saveAsTable(f"{database}.{name}_clustered")
        written.append(f"{database}.{name}_clustered")
    return written


def rows_read(df: DataFrame) -> int:
    """Runs ``df`` and returns how many rows its file scans gave out, which is what lay in row groups that were not skipped."""
    frame = df._jdf
    frame.collectToPython()
    total, pending = 0, [frame.queryExecution().executedPlan()]
    while pending:
        node = pending.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            pending.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            pending.append(node.plan())
        elif name.startswith("Scan"):
            total += int(node.metrics().apply("numOutputRows").value())
        else:
            pending += [node.children().apply(i) for i in range(node.children().size())]
    return total

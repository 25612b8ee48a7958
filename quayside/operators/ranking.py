"""Positions, running totals and tiles over a whole table, without a single-task window.

A window without PARTITION BY sends every row to one task. Here the rows are range-sorted across
the cluster instead, each carries the id of its sort partition, and only one row per partition is
needed to turn local positions into global ones. Orderings must be total (end in a unique key), so
that ties, however many, spread over the range partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from quayside.session import materialize

_SLOT, _PART, _START = "__slot", "__part", "__start"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _placed(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Globally sorted rows, each with its stored slot (sort partition, row within)."""
    return materialize(df.orderBy(*order).withColumn(_SLOT, F.monotonically_increasing_id()))


def _part() -> Column:
    return F.shiftright(F.col(_SLOT), _ROW_BITS).alias(_PART)


def _before() -> Window:
    # runs over one row per sort partition
    return Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)


def with_row_index(
    df: DataFrame, order: Sequence[Column | str], name: str = "row_index", total: str | None = None
) -> DataFrame:
    """Adds the 0-based position of each row in ``order`` and, if named, the number of all rows."""
    placed = _placed(df, order)
    counted = placed.groupBy(_part()).agg(F.count(F.lit(1)).alias("rows"))
    starts = counted.select(
        _PART,
        F.coalesce(F.sum("rows").over(_before()), F.lit(0)).alias(_START),
        F.sum("rows").over(Window.partitionBy()).alias(total or "__total"),
    )
    local = F.col(_SLOT) - F.shiftleft(F.col(_PART), _ROW_BITS)
    return (
        placed.withColumn(_PART, _part())
        .join(F.broadcast(starts), _PART)  # one row per sort partition
        .withColumn(name, F.col(_START) + local)
        .select(*df.columns, name, *([total] if total else []))
    )


def with_running_total(df: DataFrame, order: Sequence[Column | str], value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over all rows strictly before each row in ``order``."""
    placed = _placed(df, order).withColumn(_PART, _part())
    starts = (
        placed.groupBy(_PART)
        .agg(F.sum(value).alias("total"))
        .select(_PART, F.coalesce(F.sum("total").over(_before()), F.lit(0)).alias(_START))
    )
    earlier = Window.partitionBy(_PART).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn(name, F.coalesce(F.sum(value).over(earlier), F.lit(0)))
        .join(F.broadcast(starts), _PART)  # one row per sort partition
        .withColumn(name, F.col(name) + F.col(_START))
        .select(*df.columns, name)
    )


def sort_key(column: str, unique: str, descending: bool = False) -> Column:
    """Struct that orders by a numeric column, then by the unique key.

    NULLs come last ascending and first descending, as in the SQL dialect the results come from.
    """
    value = F.col(column)
    missing = value.isNotNull() if descending else value.isNull()
    return F.struct(
        missing.alias("missing"),
        (-value if descending else value).alias("value"),
        F.col(unique).alias("unique_key"),
    )


def tile_starts(rows: int, tiles: int) -> list[int]:
    """First row index of tiles 2..n; the leading tiles take the remainder, empty ones drop out."""
    size, extra = divmod(rows, tiles)
    starts = (t * size + min(t, extra) for t in range(1, tiles))
    return [start for start in starts if start < rows]


def with_ntiles(df: DataFrame, keys: Mapping[str, Column], tiles: int = 5) -> DataFrame:
    """NTILE over the whole table, for several orderings at once.

    ``keys`` maps an output column to its ``sort_key``. All orderings go through one sort, of the
    narrow keys only, which finds the ``tiles - 1`` keys per ordering at which a tile begins; the
    rows are then tiled by comparing with those, in one projection.
    """
    base = materialize(df)
    rows = base.count()
    starts = tile_starts(rows, tiles)
    orderings = F.array(*(F.struct(F.lit(i).alias("ordering"), key.alias("key")) for i, key in enumerate(keys.values())))
    narrow = base.select(F.inline(orderings))
    wanted = [i * rows + start for i in range(len(keys)) for start in starts]
    # at most tiles - 1 rows per ordering reach the driver
    cuts = with_row_index(narrow, ["ordering", "key"]).filter(F.col("row_index").isin(wanted)).collect()
    kind = narrow.schema["key"].dataType

    def literal(cut: Row) -> Column:
        return F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(cut.key, kind.fields)))

    def tile(i: int, key: Column) -> Column:
        passed = ((key.cast(kind) >= literal(cut)).cast("int") for cut in cuts if cut.ordering == i)
        return sum(passed, F.lit(1))

    return base.withColumns({name: tile(i, key) for i, (name, key) in enumerate(keys.items())})

"""Text and position helpers shared by the operators."""

from __future__ import annotations

import json
import string
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.session import materialize

#: Words as most operators count them: runs of anything but space, tab and line breaks.
WORD = r"[^\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and leaves every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def stored(df: DataFrame) -> DataFrame:
    """``df`` itself if it reads files, else a copy of it in the shared folder: rows of files have lasting places."""
    try:
        df.select("_metadata.row_index")
        return df
    except AnalysisException:
        return materialize(df)


def row_id() -> Column:
    """File and place of a row of a ``stored`` frame: the same in every run, however its files are split."""
    return F.concat_ws("#", "_metadata.file_path", "_metadata.row_index")


#: Name of the row id beside all columns of a table.
ROW = "__quayside_row"


def with_row_id(df: DataFrame) -> DataFrame:
    return df.select("*", row_id().alias(ROW))


def names(df: DataFrame) -> list[str]:
    """The columns of ``df``, quoted."""
    return [f"`{c}`" for c in df.columns]


def unit(hashed: Column) -> Column:
    """Maps a 64-bit hash to [0, 1)."""
    return F.shiftrightunsigned(hashed, 11).cast("double") / F.lit(float(2**53))


def with_offsets(
    df: DataFrame, group: list[str], key: str, ties: list[str], weight: Column, name: str, rows: int, per_bucket: int = 2_000
) -> DataFrame:
    """Adds the sum of ``weight`` over the rows before each row of its group, in the order of ``key``.

    ``key`` is a 64-bit hash. Its order is cut into buckets of about ``per_bucket`` rows, so that a group
    of any size spreads over many tasks: one pass sums the buckets, a window over those few sums gives
    each bucket's start, and a second window runs within one bucket of one group.
    """
    bits = max(0, (max(1, rows) // per_bucket).bit_length())
    # the sign bit is turned over, so that unsigned buckets follow the signed order
    place = F.shiftrightunsigned(F.col(key).bitwiseXOR(F.lit(-(2**63))), 64 - bits) if bits else F.lit(0).cast("bigint")
    placed = df.withColumn("__place", place).withColumn("__weight", weight.cast("bigint"))
    before = Window.partitionBy(*group).orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*group, "__place")
        .agg(F.sum("__weight").alias("__sum"))
        .withColumn("__start", F.coalesce(F.sum("__sum").over(before), F.lit(0)))
        .drop("__sum")
    )
    within = (
        Window.partitionBy(*group, "__place").orderBy(key, *ties).rowsBetween(Window.unboundedPreceding, -1)
    )
    keys = (*group, "__place")
    starts = starts.select(*(F.col(c).alias(f"__of_{c}") for c in keys), "__start")
    joined = placed.join(starts, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in keys])
    return joined.withColumn(
        name, F.col("__start") + F.coalesce(F.sum("__weight").over(within), F.lit(0))
    ).select(*df.columns, name)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often and wherever the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def local_rows(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A few rows that the driver holds, as a literal of the plan. ``names``: "a int, b double"."""
    fields = [n.split()[0] for n in names.split(",")]
    kind = ",".join(":".join(n.split()) for n in names.split(","))
    text = json.dumps([dict(zip(fields, r)) for r in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{kind}>>")))

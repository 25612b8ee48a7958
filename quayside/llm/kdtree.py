"""Shards of equal bytes as the leaves of a k-d tree over document metadata.

A node that must hold k shards is cut at the weighted quantile ceil(k/2)/k of its bytes (the weighted median
where k is even), along the dimension in which its rows spread widest. All nodes of a level are cut together:
one aggregation gives their extents, and a few histogram passes narrow every node's cut to a
thousandth of a bin each time. A node is named by its first shard; its rows carry that name and the number of
shards, and are stored after each level, so that no plan grows with the depth. Cuts are a table of one row per node,
computed on the executors: the driver holds none of it, however many shards there are.

Defined cases: a null text has no bytes, a null in a dimension is a value of its own, an empty table gives
no rows. Equal metadata is spread by a hash of id, text and place in the input, so that neither ties nor
repeated rows stop a cut. A document is never cut, so shards differ by up to its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import row_id, stored, text_or_empty, unit, with_offsets
from quayside.session import drop_path, materialize, recorded_paths

BINS = 1024
PASSES = 4
#: A cut is good enough when its bin holds this share of one shard's bytes.
TOLERANCE = 0.0005
#: Share of a dimension's range over which equal values are spread.
JITTER = 1e-4
#: Bytes that a stored row takes besides its text.
ROW_BYTES = 16


def measure(docs: DataFrame, numeric: tuple[str, ...], labels: tuple[str, ...]) -> DataFrame:
    """Stores doc_id, size, text_crc32, spread hash and the raw dimensions d0, d1, ... of each row."""
    raw = [F.log2(F.octet_length(text_or_empty()).cast("double") + 1)]
    raw += [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric]
    raw += [unit(F.xxhash64(F.col(c).isNull(), F.col(c).cast("string"))) for c in labels]
    return materialize(
        stored(docs).select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(text_or_empty()).cast("bigint") + ROW_BYTES).alias("size"),
            F.crc32(F.encode(text_or_empty(), "UTF-8")).alias("text_crc32"),
            F.xxhash64("doc_id", F.crc32(F.encode(text_or_empty(), "UTF-8")), row_id()).alias("spread"),
            F.lit(0).alias("node"),  # stored, so that the planner sees a column and not a constant to fold joins with
            *(d.alias(f"raw{i}") for i, d in enumerate(raw)),
        )
    )


def _scaled(measured: DataFrame, count: int) -> tuple[DataFrame, int, int]:
    """Dimensions scaled to [0, 1] plus the spread; number of rows and of bytes."""
    ends = measured.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("size").alias("bytes"),
        *(F.min(f"raw{i}").alias(f"min{i}") for i in range(count)),
        *(F.max(f"raw{i}").alias(f"max{i}") for i in range(count)),
    ).first()

    def scaled(i: int) -> Column:
        low, high = ends[f"min{i}"] or 0.0, ends[f"max{i}"] or 0.0
        jitter = unit(F.xxhash64("spread", F.lit(i))) * JITTER
        return ((F.col(f"raw{i}") - low) / (high - low) if high > low else F.lit(0.0)) + jitter

    kept = [c for c in measured.columns if not c.startswith("raw")]
    return measured.select(*kept, *(scaled(i).alias(f"d{i}") for i in range(count))), ends["rows"], ends["bytes"] or 0


def _left() -> Column:
    """How many of a node's shards lie left of its cut."""
    return F.expr("int((k + 1) div 2)")


def _at(dims: int) -> Column:
    """The value of a row in the dimension ``dim``."""
    return F.element_at(F.array(*(F.col(f"d{i}") for i in range(dims))), F.col("dim") + 1)


def _cuts(rows: DataFrame, dims: int, target: float) -> DataFrame:
    """Stores node, dim, at: the cut of each node that holds more than one shard.

    One row per node, narrowed pass by pass on the executors; Spark broadcasts it as long as it is small.
    """
    wide = rows.filter("k > 1")
    ends = wide.groupBy("node", "k").agg(
        F.sum("size").alias("bytes"),
        *(F.min(f"d{i}").alias(f"low{i}") for i in range(dims)),
        *(F.max(f"d{i}").alias(f"high{i}") for i in range(dims)),
    )
    spans = [
        F.struct((F.col(f"high{i}") - F.col(f"low{i}")).alias("width"), F.lit(-i).alias("turned"), F.col(f"low{i}").alias("low"), F.col(f"high{i}").alias("high"))
        for i in range(dims)
    ]
    widest = F.array_max(F.array(*spans))
    goal = F.col("bytes") * _left() / F.col("k")
    nodes = ends.select("node", goal.alias("goal"), widest.alias("w")).select(
        "node", "goal", (-F.col("w.turned")).alias("dim"), "w.low", "w.high", F.lit(0).cast("bigint").alias("before"), F.lit(None).cast("double").alias("at")
    )
    nodes = materialize(nodes)
    step = F.when(F.col("high") > F.col("low"), (F.col("high") - F.col("low")) / BINS).otherwise(1.0)
    for _ in range(PASSES):
        undecided = nodes.filter("at is null").withColumn("step", step)
        place = F.floor((_at(dims) - F.col("low")) / F.col("step"))
        inside = wide.join(undecided, "node").select("node", "size", place.alias("bin")).filter(F.col("bin").between(0, BINS))
        sums = inside.groupBy("node", F.least("bin", F.lit(BINS - 1)).alias("bin")).agg(F.sum("size").alias("inside"))
        run = F.sum("inside").over(Window.partitionBy("node").orderBy("bin"))  # at most BINS rows
        reached = sums.withColumn("upto", run).join(undecided.select("node", "before", "goal"), "node")
        hits = reached.filter(F.col("before") + F.col("upto") >= F.col("goal")).groupBy("node").agg(F.min(F.struct("bin", "inside", "upto")).alias("hit"))
        low = F.col("low") + F.col("hit.bin") * step
        below = F.col("before") + F.col("hit.upto") - F.col("hit.inside")
        settled = (F.col("hit.inside") <= TOLERANCE * target) | (step < 1e-14)
        nearer = F.when(F.col("goal") - below < below + F.col("hit.inside") - F.col("goal"), low).otherwise(low + step)
        found, lost = F.col("hit").isNotNull(), F.col("at").isNull() & F.col("hit").isNull()
        nodes = materialize(
            nodes.join(hits, "node", "left").select(
                "node",
                "goal",
                "dim",
                F.when(found, low).otherwise(F.col("low")).alias("low"),
                F.when(found, low + step).otherwise(F.col("high")).alias("high"),
                F.when(found, below).otherwise(F.col("before")).alias("before"),
                F.when(found & settled, nearer).when(lost, F.col("high")).otherwise(F.col("at")).alias("at"),
            )
        )
        if nodes.filter("at is null").isEmpty():
            break
    return nodes.select("node", "dim", F.coalesce("at", "high").alias("at"))


def shard(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    numeric: tuple[str, ...] = ("doc_id",),
    labels: tuple[str, ...] = ("source", "lang"),
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row, in ``shards`` leaves or in leaves of about ``target_bytes``."""
    spark, dims = docs.sparkSession, 1 + len(numeric) + len(labels)
    rows, count, total = _scaled(measure(docs, numeric, labels), dims)
    shards = shards or max(1, -(-total // target_bytes))
    rows = rows.withColumn("k", F.lit(shards))
    spent: list[str] = []
    for _ in range((shards - 1).bit_length()):
        with recorded_paths() as paths:
            moved = rows.join(_cuts(rows, dims, max(1.0, total / shards)), "node", "left")
            right = _at(dims) >= F.col("at")  # null in a node that is a shard already
            node = F.when(right, F.col("node") + _left()).otherwise(F.col("node"))
            k = F.when(F.col("dim").isNull(), F.col("k")).when(right, F.col("k") - _left()).otherwise(_left())
            kept = [c for c in rows.columns if c not in ("node", "k")]
            rows = materialize(moved.select(*kept, node.alias("node"), k.alias("k")))
        for path in (*spent, *paths[:-1]):  # all but the rows just stored; nothing reads them any more
            drop_path(spark, path)
        spent = paths[-1:]
    placed = rows.select("doc_id", "size", "text_crc32", "spread", F.col("node").alias("shard"))
    slotted = with_offsets(placed, ["shard"], "spread", ["doc_id"], F.lit(1), "slot", count)
    return slotted.select("doc_id", "size", "text_crc32", "shard", "slot")

"""Packing by concatenation: all documents end to end, cut into windows of equal length.

Pass one tokenizes each input partition and stores every document's ids with the tokens before it in
its partition. The partitions' totals, one row each, are summed up into the global start of every partition. Pass two adds the
two and cuts at the fixed window borders; a document that crosses one becomes a record on either side of it.
Only the last window can be short.

Defined cases: a null text counts as empty and is its end token alone; every row is packed, equal rows as often
as they occur; an empty table gives no pieces. Texts are tokenized in batches of a few megabytes, a longer one by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import tokens
from quayside.session import materialize

#: Bytes of text that are tokenized at a time.
BATCH_BYTES = 4 << 20
SCHEMA = "doc_id bigint, part int, start bigint, n bigint, ids binary"


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Stores doc_id, part, start (tokens before it in its part), n and ids (with the end token) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, start, end = tokens.ids(tokenizer), TaskContext.get().partitionId(), 0, np.uint32(end_id).tobytes()
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for at, rows in tokens.slices(sizes, BATCH_BYTES):
                piece = batch.slice(at, rows)
                ids = [x + end for x in known.texts(piece.column(1))]
                n = np.array([len(x) // 4 for x in ids], "int64")
                starts = start + np.cumsum(n) - n
                start += int(n.sum())
                yield pa.record_batch(
                    [piece.column(0), pa.array(np.full(len(ids), part, "int32")), pa.array(starts), pa.array(n), pa.array(ids, pa.binary())],
                    names=["doc_id", "part", "start", "n", "ids"],
                )

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(narrow.mapInArrow(run, SCHEMA))


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset for every piece."""
    stored = tokenize(docs, tokenizer, end_id)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition of the input
    bases = stored.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = stored.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("start"))
    first, last = F.floor(F.col("at") / window), F.floor((F.col("at") + F.col("n") - 1) / window)

    def piece(k):
        start = F.greatest(F.col("at"), k * window) - F.col("at")
        length = F.least(F.col("n"), (k + 1) * window - F.col("at")) - start
        return F.struct(
            start.alias("start"),
            length.alias("length"),
            F.substr("ids", (start * 4 + 1).cast("int"), (length * 4).cast("int")).alias("ids"),
            F.col("n").alias("doc_tokens"),
            k.alias("sequence_id"),
            (F.col("at") + start - k * window).alias("offset"),
        )

    return placed.select("doc_id", F.transform(F.sequence(first, last), piece).alias("pieces")).select("doc_id", F.inline("pieces"))

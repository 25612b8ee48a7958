"""Exact deduplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest, one row per distinct text ever seen, in one partition per
batch. A batch is first reduced to one row per digest (map-side, so a text held by a third of the rows costs one row per
task), then a sort-merge anti-join against the batches before it leaves the new digests, which are appended. The others
get their owners from the index, and one more join labels the rows. Batches are loaded one at a time.

Defined cases: a null text counts as empty. Of equal texts in one batch the row with the largest doc_id stays
(null ids come last; of repeated rows with that id exactly one stays). A text that an earlier batch brought
is dropped in favour of that batch's row; a batch run again under its name replaces its own part of the index and keeps
the rows it kept before. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import ROW, lower_ascii, row_id, stored, text_or_empty, with_row_id
from quayside.session import materialize, new_path, path_exists


def digest(text: str = "text") -> Column:
    """SHA-256 of the text with A-Z lower-cased, in hexadecimal."""
    return F.sha2(lower_ascii(text_or_empty(text)), 256)


class DigestIndex:
    """``buckets`` is a property of the stored index: one bucket must sort in one task. Default: the session's shuffle partitions."""

    def __init__(self, spark: SparkSession, path: str, table: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = table or f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (text_sha256 STRING, owner BIGINT, batch STRING) USING parquet "
            f"PARTITIONED BY (batch) CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        if path_exists(spark, path):
            spark.catalog.recoverPartitions(self.table)

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def drop(self) -> None:
        """Takes the table out of the catalog; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def append(self, digests: DataFrame, batch: str | None = None) -> DataFrame:
        """Adds what is new in a stored table (doc_id, row_id, text_sha256); returns one labelled row for each.

        ``batch`` names the rows. What stands in the index under that name is replaced, so a batch that failed or is
        run again gives the same rows as the first time. Without a name the batch is a new one.
        """
        batch = batch or uuid.uuid4().hex
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"a batch is named by letters, digits, '_', '.' and '-': {batch!r}")
        groups = materialize(
            digests.groupBy("text_sha256").agg(
                F.max(F.struct("doc_id", "row_id")).alias("best"), F.count(F.lit(1)).alias("group_size")
            )
        )
        history = self.rows().filter(F.col("batch") != batch).select("text_sha256", "owner").hint("merge")
        fresh = materialize(groups.join(history, "text_sha256", "left_anti"))
        earlier = groups.join(history, "text_sha256")
        part = fresh.select("text_sha256", F.col("best.doc_id").alias("owner")).repartition(self.buckets, "text_sha256")
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION (batch = '{batch}') SELECT * FROM {{part}}", part=part)
        self.spark.catalog.refreshTable(self.table)
        mine = fresh.select("text_sha256", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row_id").alias("owner_row"))
        others = earlier.select("text_sha256", "group_size", F.col("owner").alias("keep_id"), F.lit(None).cast("string").alias("owner_row"))
        # stored, so that the rows' own join shuffles both sides and a hot digest can be split
        owners = materialize(mine.unionByName(others))
        return digests.join(owners, "text_sha256").select(
            "doc_id",
            "row_id",
            "keep_id",
            "group_size",
            F.coalesce(F.col("row_id") == F.col("owner_row"), F.lit(False)).alias("kept"),
            "text_sha256",
        )


def digests(docs: DataFrame) -> DataFrame:
    """Stores (doc_id, row_id, text_sha256) of stored ``docs``; the texts are read once and not moved."""
    return materialize(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_id().alias("row_id"), digest().alias("text_sha256"))
    )


def label(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """doc_id, row_id, keep_id, group_size, kept, text_sha256 for every row; without an index, against an empty one."""
    docs, spark = stored(docs), docs.sparkSession
    if index:
        return index.append(digests(docs), batch)
    own = DigestIndex(spark, new_path(spark))
    labelled = own.append(digests(docs))
    own.drop()
    return labelled


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    docs = stored(docs)
    kept = label(docs, index, batch).filter("kept").select(F.col("row_id").alias(ROW))
    return with_row_id(docs).join(kept, ROW, "left_semi").drop(ROW)

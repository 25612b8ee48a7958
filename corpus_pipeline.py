"""The corpus pipeline: documents that pass the quality rules, without exact and near copies, mixed and packed."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quayside.llm import exact, mixing, ngram_join, packing, quality
from quayside.llm.queries import PACKING_TOKENIZER
from quayside.session import drop_path, new_path, recorded_paths

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_spent: list[str] = []


def stage(work: Stage) -> Stage:
    """A stage begins when the result of the one before is written, so it first drops that one's intermediates."""

    @functools.wraps(work)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for path in _spent:
            drop_path(spark, path)
        with recorded_paths() as paths:
            result = work(spark, docs, sf_dir)
        _spent[:] = paths
        return result

    return begun


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


@stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact.deduplicate(docs)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: five-word shingles, similarity 0.8 or more."""
    return ngram_join.keep_one_each(docs, width=5, percent=80)


@stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources, in its order: whole documents, and pieces of those that a block border cuts."""
    return mixing.mixed_documents(docs)


@stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences with their token ids."""
    return packing.pack(docs, public_tokenizers.path(PACKING_TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, work in STAGES[:-1]:
        path = new_path(spark)
        work(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


#: The last stages tokenize and score by methods that SQL cannot express; tests compare them with plain Python.
ORACLE_SQL: str | None = None

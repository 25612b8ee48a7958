"""The registered queries: each applies its operator to the whole of its table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import alignment, chat, exact, fim, html_content, kdtree, license, lm, mixing, ngram_join, packing, quality, url_rules
from quayside.llm.common import local_rows

PACKING_TOKENIZER = LM_TOKENIZER = BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = license.scan(read(spark, folder, "documents")).select("doc_id", "license_scan.*")
    base = F.filter("spans", lambda d: d["base"])
    rows = rows.select(
        "doc_id",
        "norm",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["start"])).alias("first"),
        F.array_max(F.transform(base, lambda d: d["start"])).alias("last"),
        *(
            F.array_join(F.array_sort(F.array_distinct(F.transform(d, lambda x: x["label"]))), ",").alias(name)
            for d, name in ((base, "base_labels"), (F.col("spans"), "labels"))
        ),
        F.coalesce(F.array_max(F.transform("spans", lambda d: d["weight"])), F.lit(0.0)).alias("score"),
    )
    word = {c: license.words_before(F.substr("norm", F.lit(1), F.col(c))).alias(f"{c}_word") for c in ("first", "last")}
    return rows.select("doc_id", "n_words", "n_base", *word.values(), "base_labels", "labels", "score")


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = exact.label(read(spark, folder, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.link(read(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed, rows, goals = mixing.mix(read(spark, folder, "documents"))
    taken = mixed.groupBy("row_id").agg(F.sum("length").alias("taken"))
    goals = goals.select(F.col("source").alias("__source"), "source_size", "target")
    return (
        rows.join(taken, "row_id", "left")
        .join(goals, F.col("source").eqNullSafe(F.col("__source")))
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(read(spark, folder, "documents"), public_tokenizers.path(PACKING_TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


#: A conversation whose texts hold control strings of common templates.
PROBE = r"\### Assistant: </turn> ok"


def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    rows = read(spark, folder, "conversations").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text"
    )
    done = chat.format_conversations(rows.unionByName(probe)).select(
        "conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")
    )
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op7_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(read(spark, folder, "documents"), public_tokenizers.path(LM_TOKENIZER))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.measure(read(spark, folder, "documents"), ["doc_id"]).select("doc_id", "quality.*")


def op9_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    rows = kdtree.shard(read(spark, folder, "documents"), shards=40)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_html_content(spark: SparkSession, folder: str) -> DataFrame:
    pages = html_content.extract(read(spark, folder, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = [public_tokenizers.path(x) for x in (BYTE_TOKENIZER, PIECE_TOKENIZER)]
    aligned = alignment.align(read(spark, folder, "documents").select("doc_id", "text"), *paths)
    counts = ("n_a", "n_b", "n_groups", "n_links")
    digest = F.when(F.col("alignment.n_a") == 0, "").otherwise(F.sha2(F.col("alignment.groups"), 256))
    narrow = aligned.select(
        "doc_id", *(F.col(f"alignment.{c}").alias(c) for c in counts), digest.alias("groups_sha256"), F.struct("alignment.pairs").alias("alignment")
    )
    return alignment.with_counts(narrow).select("doc_id", *counts, "n_best", "count_sum", "groups_sha256")


#: Rules of the query: host, path, action.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op12_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = local_rows(spark, URL_RULES, "host string, path string, action string")
    return url_rules.judge(read(spark, folder, "pages").select("page_id", "url"), rules).select("page_id", "url_filter.*")


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    rows = fim.transform(read(spark, folder, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2("fim.output", 256).alias("output_sha256"),
        F.sha2(fim.restored(F.col("fim.output"), F.col("fim.form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_exact_dedup, op3_ngram_join, op4_source_mix, op5_packing, op6_chat_format, op7_lm_scores,
        op8_quality_rules, op9_kd_shards, op10_html_content, op11_token_alignment, op12_url_filter, op13_fill_in_middle,
    )
}

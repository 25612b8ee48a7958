"""Mixing of sources to target weights by a low-discrepancy schedule.

Each source's rows are shuffled by hash and laid end to end, and the stream of their words is cut into
blocks of equal length. Points of the golden-ratio sequence fall through the cumulative weights of the
sources, so that every stretch of the mix holds the sources in their shares; the k-th slot of a source takes
its block k, beginning again after the last one. Slots are generated by Spark, ranked per source in
chunks, and joined to the blocks and these to the document pieces that lie in them.

Defined cases: a null text has no words and is never taken; a null source is a source of its own, the last in
order; an empty table gives an empty mix; equal rows follow one another in the shuffle. Targets are shares of
all words by weight, held to ``max_repeats`` times the source's words, with the excess shared again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.llm.common import ROW, WORD, names, row_id, stored, text_or_empty, with_offsets, with_row_id
from quayside.operators.ranking import with_row_index, with_running_total
from quayside.session import materialize

#: Fraction of the golden ratio, and the same for steps of 2**20 points (both modulo 1).
GOLDEN = 0.6180339887498949
CHUNK_BITS = 20
GOLDEN_CHUNK = (2**CHUNK_BITS * 6180339887498948482045868343656381177203091798057628621 % 10**55) / 10**55
#: Fewest cells of the unit interval by which points find their source.
CELLS = 4096


def sized(docs: DataFrame) -> DataFrame:
    """Stores the number of words of every row, its source and the hash that shuffles it."""
    text = text_or_empty()
    return materialize(
        stored(docs).select(
            row_id().alias("row_id"),
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"),
            F.xxhash64(F.lit(20), F.col("doc_id"), F.xxhash64(text)).alias("shuffled"),
        )
    )


def targets(rows: DataFrame, weights: tuple[float, ...], max_repeats: int) -> DataFrame:
    """One row per source: its words, weight and target (water-filling; a round per step, two sums each)."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_row_index(sources, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    known = materialize(ranked.select("source", "source_size", weight.alias("weight")))
    most = F.col("source_size") * float(max_repeats)
    total = float(known.agg(F.sum("source_size")).first()[0] or 0)
    level, held = -1.0, 0  # words per unit of weight; number of sources held at their most
    while True:
        free = most > F.col("weight") * level
        r = known.agg(
            F.sum(F.when(free, F.col("weight"))).alias("weight"),
            F.sum(F.when(~free, most)).alias("words"),
            F.count(F.when(~free, 1)).alias("held"),
        ).first()
        if not r["weight"] or (level >= 0 and r["held"] == held):
            break
        level, held = (total - (r["words"] or 0.0)) / r["weight"], r["held"]
    return known.withColumn("target", F.least(most, F.col("weight") * max(level, 0.0)))


def plan(goals: DataFrame, block_words: int, min_blocks: int) -> DataFrame:
    """Adds to each source the number and length of its blocks and the number of slots it gets (its quota)."""
    blocks = F.least(
        F.col("source_size"), F.greatest(F.ceil(F.col("source_size") / block_words), F.lit(min_blocks).cast("bigint"))
    )
    return (
        goals.filter("source_size > 0")
        .withColumn("blocks", blocks)
        .withColumn("quota", F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("bigint"))
    )


def _point(slot: Column) -> Column:
    """Point ``slot`` of the golden-ratio sequence; two factors keep it exact beyond 2**40."""
    low, high = F.pmod(slot, F.lit(2**CHUNK_BITS)), F.shiftright(slot, CHUNK_BITS)
    return F.pmod(low * F.lit(GOLDEN) + F.pmod(high * F.lit(GOLDEN_CHUNK), F.lit(1.0)), F.lit(1.0))


def schedule(spark: SparkSession, planned: DataFrame) -> DataFrame:
    """slot, source, rank (of the slot within its source), for the slots within their source's quota."""
    planned = materialize(planned)
    r = planned.agg(F.sum("quota").alias("slots"), F.count(F.lit(1)).alias("sources")).first()
    slots = r["slots"] or 0
    # a little more than the quotas need: a source's count strays from its share by a few slots
    points = int(slots * 1.02) + 64 * r["sources"]
    order = [F.col("source").asc_nulls_last()]
    shares = materialize(
        _running(planned.filter("quota > 0"), order)
        .withColumn("from", F.col("before") / float(max(slots, 1)))
        .withColumn("to", (F.col("before") + F.col("quota")) / float(max(slots, 1)))
        .select("source", "quota", "from", "to")
    )
    cells = max(CELLS, 4 * r["sources"])

    def cell(name: str) -> Column:
        return F.least(F.floor(F.col(name) * cells), F.lit(cells - 1).cast("bigint"))

    by_cell = shares.withColumn("cell", F.explode(F.sequence(cell("from"), cell("to"))))
    drawn = spark.range(points).select(F.col("id").alias("slot"), _point(F.col("id")).alias("point"))
    drawn = drawn.withColumn("cell", cell("point"))
    placed = materialize(
        drawn.join(by_cell, "cell").filter("point >= from and point < to").select("slot", "source", "quota", F.shiftright("slot", 14).alias("chunk"))
    )
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select(
        F.col("source").alias("__source"), F.col("chunk").alias("__chunk"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("source", "chunk").orderBy("slot")
    joined = placed.join(starts, F.col("source").eqNullSafe(F.col("__source")) & (F.col("chunk") == F.col("__chunk")))
    ranked = joined.withColumn("rank", F.col("start") + F.row_number().over(within) - 1)
    return ranked.filter("rank < quota").select("slot", "source", "rank")


def _running(planned: DataFrame, order: list[Column]) -> DataFrame:
    """Adds the quotas of the sources before each one, through one row per sort partition."""
    return with_running_total(planned, order, "quota", "before")


def pieces(rows: DataFrame, planned: DataFrame, ties: list[str]) -> DataFrame:
    """Every row's words cut at its source's block boundaries: block, and first word and words within the row.

    Block j of a source spans its words from floor(j * words / blocks) up to the same of j + 1.
    """
    placed = with_offsets(rows.filter("size > 0"), ["source"], "shuffled", ties, F.col("size"), "offset", rows.count())
    by_source = planned.select(F.col("source").alias("__source"), "source_size", "blocks")
    placed = placed.join(by_source, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")

    def scaled(value: Column, by: str, over: str) -> Column:
        wide = value.cast("decimal(19,0)") * F.col(by).cast("decimal(19,0)")
        return F.floor(wide / F.col(over)).cast("bigint")

    def begins(block: Column) -> Column:
        return scaled(block, "source_size", "blocks")

    end = F.col("offset") + F.col("size")
    lowest = scaled(F.col("offset"), "blocks", "source_size")  # the block of a word is this or the next one
    highest = F.least(scaled(end - 1, "blocks", "source_size") + 1, F.col("blocks") - 1)
    cut = placed.withColumn("block", F.explode(F.sequence(lowest, highest)))
    cut = cut.withColumn("from", F.greatest("offset", begins(F.col("block"))))
    cut = cut.withColumn("length", F.least(end, begins(F.col("block") + 1)) - F.col("from"))
    return cut.filter("length > 0").withColumn("start", F.col("from") - F.col("offset")).drop("from")


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_repeats: int = 3, block_words: int = 2048, min_blocks: int = 256
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix (slot, row_id, doc_id, start, length), the measured rows and the targets of the sources."""
    rows = sized(docs)
    goals = materialize(targets(rows, weights, max_repeats))
    planned = materialize(plan(goals, block_words, min_blocks))
    slots = schedule(docs.sparkSession, planned)
    by_source = planned.select(F.col("source").alias("__source"), "blocks")
    visits = slots.join(by_source, F.col("source").eqNullSafe(F.col("__source"))).select(
        "slot", "source", F.pmod(F.col("rank"), F.col("blocks")).alias("block")
    )
    cut = pieces(rows, planned, ["doc_id", "row_id"]).select(
        F.col("source").alias("__source"), F.col("block").alias("__block"), "row_id", "doc_id", "start", "length"
    )
    mixed = visits.join(cut, F.col("source").eqNullSafe(F.col("__source")) & (F.col("block") == F.col("__block")))
    return mixed.select("slot", "row_id", "doc_id", "start", "length"), rows, goals


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: in the order of the schedule, each piece a row with the columns of ``docs``.

    A piece that is a whole document keeps its text; others keep their words and what stands after each.
    """
    docs = stored(docs)
    mixed, rows, _ = mix(docs, **options)
    # a document's pieces are at most max_repeats per block that it touches
    taken = mixed.join(rows.select("row_id", "size"), "row_id").groupBy(F.col("row_id").alias("__quayside_of")).agg(
        F.collect_list(F.struct("slot", "start", "length", "size")).alias("__quayside_pieces")
    )
    joined = with_row_id(docs).join(taken, F.col(ROW) == F.col("__quayside_of"))
    piece = joined.select(*names(docs), F.inline("__quayside_pieces").alias("__quayside_slot", "__quayside_start", "__quayside_length", "__quayside_size"))
    words = F.regexp_extract_all("text", F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0))
    cut = F.array_join(F.slice(words, F.col("__quayside_start").cast("int") + 1, F.col("__quayside_length").cast("int")), "")
    text = F.when(F.col("__quayside_length") == F.col("__quayside_size"), F.col("text")).otherwise(cut)
    piece = piece.withColumn("text", text)
    if "n_chars" in docs.columns:
        piece = piece.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return piece.orderBy("__quayside_slot", "doc_id", "__quayside_start").select(*names(docs))

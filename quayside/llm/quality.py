"""Quality rules: divergence of a document's histograms from those of its language, in Spark expressions only.

Reference, per language: the mean shares of seven classes of characters, and of the language's most frequent short
words. Each distinct text that passes the base rules counts once and as much as any other, however long it is or often
it stands there. Texts far from the medians of all of them are left out: first by classes, then by words, and the words
are chosen anew among those that stay. A document is compared with its language by the Jensen-Shannon distance (base
2, so 0 to 1) of both histograms. A document is rejected by distance only where it is long enough for the
histogram to mean something; shorter ones pass that part.

Base rules come first: too few words, or too many words in repeated three-word windows.

Defined cases: a null text has no words; a null language is a language of its own; in a language whose texts hold
no short word all words count as other; a language without a text for its reference has null distances; texts are told
apart by 64-bit hash in the reference; shares are summed in units of 10**-9, so that no order of rows matters; equal rows get equal verdicts; an empty table gives no rows. Work
per row is O(n log n) in its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import ROW, WORD, let, row_id, stored, text_or_empty, with_row_id
from quayside.session import materialize

SPACE = r"\x20\x09-\x0D"
#: Classes of characters; what none of them holds is the last class.
CLASSES = (r"[a-z]+", r"[A-Z]+", r"[0-9]+", rf"[{SPACE}]+", r"[#*$%&|<>]+", r"[!-\"'-);,.-/:=?@\[-`{}~+]+")
SPACES, SYMBOLS = 3, 4
COMMON = 16
#: Longest word that may count as a common word of a language.
COMMON_LENGTH = 4
MIN_WORDS, MAX_REPEAT = 50, 0.5
#: Fewest characters and words for a verdict on each histogram, and the largest distance that passes.
MIN_CHARS_CLASSES, MAX_CLASSES = 200, 0.3
MIN_WORDS_COMMON, MAX_COMMON = 100, 0.4
#: A reference of more languages than this is joined by shuffle instead of a broadcast.
BROADCAST_LANGUAGES = 10_000


def _class_counts(text: Column) -> Column:
    """Characters of each class and of none; each class is looked for in what the ones before have left over."""

    def step(rest: Column, classes: tuple[str, ...], counts: list[Column]) -> Column:
        if not classes:
            return F.array(*counts, F.length(rest))
        return let(
            F.regexp_replace(rest, classes[0], ""), lambda left: step(left, classes[1:], [*counts, F.length(rest) - F.length(left)])
        )

    return step(text, CLASSES, [])


#: Shares are summed as whole numbers of these units; medians are taken to this step.
UNITS, MEDIAN_STEPS = 10**9, 1_000
#: More texts with copies than this are joined by shuffle instead of a broadcast.
BROADCAST_COPIES = 100_000


def _base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (n_repeat_words > MAX_REPEAT * n_words)


def _runs(words: Column) -> Column:
    """Structs of word and n, how often it stands there, of sorted words."""
    starts = F.array_compact(F.transform(words, lambda w, i: F.when(~F.get(words, i - 1).eqNullSafe(w), i)))

    def counted(at: Column) -> Column:
        end = lambda j: F.coalesce(F.get(at, j + 1), F.size(words))
        return F.transform(at, lambda a, j: F.struct(F.get(words, a).alias("word"), (end(j) - a).alias("n")))

    return let(starts, counted)


def _analysed(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Stores what the rules need of each row of stored ``docs``: its id, ``carried`` columns, counts, shares and short words.

    This is the only pass over the texts.
    """
    text = F.col("text")
    own = [F.col(f"`{c}`").alias(f"carried_{i}") for i, c in enumerate(carried)]
    rows = docs.select(row_id().alias(ROW), *own, F.col("lang").cast("string").alias("lang"), text_or_empty().alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).withColumn("classes", _class_counts(text))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(F.btrim(line, F.lit(" \t\n\x0b\f\r"))) > 0)
    return materialize(
        rows.select(
            ROW,
            *(f"carried_{i}" for i in range(len(carried))),
            "lang",
            F.xxhash64("text").alias("digest"),
            F.length("text").alias("n_chars"),
            F.size("words").alias("n_words"),
            F.col("classes")[SPACES].alias("n_spaces"),
            F.col("classes")[SYMBOLS].alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
            _repeat_words(F.col("words")).alias("n_repeat_words"),
            F.transform("classes", lambda x: F.when(F.length("text") > 0, x.cast("double") / F.length("text")).otherwise(0.0)).alias("shares"),
            let(F.sort_array(F.filter("words", lambda w: F.length(w) <= COMMON_LENGTH)), _runs).alias("short"),
        )
    )


def _texts(analysed: DataFrame) -> DataFrame:
    """Each distinct text that passes the base rules once."""
    every = analysed.filter(~_base_failed(F.col("n_words"), F.col("n_repeat_words"))).select(ROW, "lang", "digest", "shares", "n_words", "short")
    copies = every.groupBy("lang", "digest").agg(F.min(ROW).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = materialize(copies.select(F.col("lang").alias("of_lang"), F.col("digest").alias("of_digest"), "first"))
    few = copies.count() <= BROADCAST_COPIES
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & (F.col("digest") == F.col("of_digest"))
    joined = every.join(F.broadcast(copies) if few else copies, same, "left")
    return joined.filter(F.col("first").isNull() | (F.col(ROW) == F.col("first"))).drop("of_lang", "of_digest", "first", "digest", ROW)


def _joined(rows: DataFrame, by_lang: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``by_lang``, which has one row per language."""
    other = by_lang.withColumnRenamed("lang", "__quayside_lang")
    few = other.count() <= BROADCAST_LANGUAGES
    same = F.col("lang").cast("string").eqNullSafe(F.col("__quayside_lang"))
    return rows.join(F.broadcast(other) if few else other, same, "left").drop("__quayside_lang")


def _medians(rows: DataFrame, shares: str) -> DataFrame:
    """lang, centre: the median of each place of ``shares``, together scaled to 1."""
    placed = rows.select("lang", F.posexplode(shares).alias("pos", "x"))
    counted = placed.groupBy("lang", "pos", F.round(F.col("x") * MEDIAN_STEPS).cast("int").alias("step")).agg(F.count(F.lit(1)).alias("n"))
    place = Window.partitionBy("lang", "pos")  # at most MEDIAN_STEPS + 1 rows
    run = counted.withColumns({"upto": F.sum("n").over(place.orderBy("step")), "all": F.sum("n").over(place)})
    middle = run.filter(F.col("upto") * 2 >= F.col("all")).groupBy("lang", "pos").agg(F.min("step").alias("step"))
    listed = middle.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("pos", "step"))).alias("m"))
    values = F.transform("m", lambda m: m["step"].cast("double"))
    total = F.greatest(F.aggregate(values, F.lit(0.0), lambda a, b: a + b), F.lit(1.0))
    return materialize(listed.select("lang", F.transform(values, lambda v: v / total).alias("centre")))


def _near(rows: DataFrame, shares: str, most: float) -> DataFrame:
    """The rows that lie within ``most`` of the medians of their language."""
    joined = _joined(rows, _medians(rows, shares))
    return joined.filter(distance(F.col(shares), F.col("centre")) <= most).drop("centre")


def _means(rows: DataFrame, shares: str, name: str) -> DataFrame:
    """lang, ``name``: the mean of each place of ``shares``."""
    placed = rows.select("lang", F.posexplode(shares).alias("pos", "x"))
    sums = placed.groupBy("lang", "pos").agg(F.sum(F.round(F.col("x") * UNITS).cast("bigint")).alias("sum"), F.count(F.lit(1)).alias("n"))
    listed = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("pos", "sum", "n"))).alias("m"))
    return listed.select("lang", F.transform("m", lambda m: m["sum"] / m["n"] / UNITS).alias(name))


def _common(rows: DataFrame) -> DataFrame:
    """lang, common: the short words of the largest mean shares."""
    unit = F.round(F.lit(float(UNITS)) / F.col("n_words")).cast("bigint")
    each = rows.select("lang", unit.alias("u"), F.explode("short").alias("w"))
    words = each.groupBy("lang", F.col("w.word").alias("word")).agg(F.sum(F.col("u") * F.col("w.n")).alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "word"))
    top = words.withColumn("rank", rank).filter(F.col("rank") <= COMMON).groupBy("lang")
    listed = top.agg(F.array_sort(F.collect_list(F.struct("rank", "word"))).alias("top"))
    return materialize(listed.select("lang", F.transform("top", lambda t: t["word"]).alias("common")))


def _common_shares(short: Column, common: Column, n: Column) -> Column:
    """Shares of the common words among ``n`` words, the last one of all others; ``short`` are counted words."""

    def shares(counts: Column) -> Column:
        rest = n - F.aggregate(counts, F.lit(0), lambda a, b: a + b)
        return F.transform(F.concat(counts, F.array(rest)), lambda c: c.cast("double") / n)

    def found(words: Column, counts: Column) -> Column:
        return F.transform(common, lambda w: F.coalesce(F.get(counts, F.array_position(words, w).cast("int") - 1), F.lit(0)))

    return let(short["word"], lambda words: let(short["n"], lambda counts: let(found(words, counts), shares)))


def _with_shares(rows: DataFrame) -> DataFrame:
    """Adds common, and common_shares of each row."""
    none = F.array().cast("array<string>")
    joined = _joined(rows.drop("common", "common_shares"), _common(rows)).withColumn("common", F.coalesce("common", none))
    return joined.withColumn("common_shares", _common_shares(F.col("short"), F.col("common"), F.col("n_words")))


def references(analysed: DataFrame) -> DataFrame:
    """Stores lang, class_shares, common, common_shares (the last one of all other words): one row per language."""
    near = materialize(_near(_texts(analysed), "shares", MAX_CLASSES))
    shared = materialize(_with_shares(near))
    plain = materialize(_with_shares(_near(shared, "common_shares", MAX_COMMON)))
    common = plain.groupBy("lang").agg(F.first("common").alias("common"))  # equal in all rows of a language
    classes, shares = _means(plain, "shares", "class_shares"), _means(plain, "common_shares", "common_shares")
    for i, part in enumerate((classes, shares)):
        other = part.withColumnRenamed("lang", f"of{i}")
        common = common.join(other, F.col("lang").eqNullSafe(F.col(f"of{i}"))).drop(f"of{i}")
    return materialize(common.select("lang", "class_shares", "common", "common_shares"))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of shares, from 0 to 1."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    total = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def _repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found at least twice: windows are compared by 64-bit hash."""

    def marked(grams: Column) -> Column:
        placed = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def twice(s: Column) -> Column:
            again = F.filter(s, lambda x, i: F.get(s, i - 1)["g"].eqNullSafe(x["g"]) | F.get(s, i + 1)["g"].eqNullSafe(x["g"]))
            return F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

        return F.when(F.size(F.array_distinct(grams)) < F.size(grams), let(placed, twice)).otherwise(0)

    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.xxhash64(a, b))
    windows = F.slice(
        F.zip_with(pairs, F.slice(words, F.lit(3), F.size(words) - 2), lambda x, c: F.xxhash64(x, c)), F.lit(1), F.size(words) - 2
    )
    return F.when(F.size(words) > 3, let(windows, marked)).otherwise(0)


def verdicts(docs: DataFrame, carried: list[str], name: str) -> DataFrame:
    """Row id, ``carried`` columns and the struct ``name`` of each row of stored ``docs``."""
    analysed = _analysed(docs, carried)
    rows = _joined(analysed, references(analysed))
    long_classes = (F.col("n_chars") >= MIN_CHARS_CLASSES) & F.col("class_shares").isNotNull()
    long_common = (F.col("n_words") >= MIN_WORDS_COMMON) & F.col("common").isNotNull()
    rows = rows.withColumn("class_distance", F.when(long_classes, distance(F.col("shares"), F.col("class_shares"))))
    common = _common_shares(F.col("short"), F.col("common"), F.col("n_words"))
    rows = rows.withColumn("common_distance", F.when(long_common, distance(common, F.col("common_shares"))))
    failed = _base_failed(F.col("n_words"), F.col("n_repeat_words"))
    far = F.coalesce(F.col("class_distance") > MAX_CLASSES, F.lit(False)) | F.coalesce(F.col("common_distance") > MAX_COMMON, F.lit(False))
    verdict = F.struct(
        F.col("n_words").cast("bigint").alias("n_words"),
        (F.col("n_chars") - F.col("n_spaces")).cast("bigint").alias("word_chars"),
        *(F.col(c).cast("bigint").alias(c) for c in ("n_symbols", "n_dup_lines", "n_repeat_words")),
        "class_distance",
        "common_distance",
        failed.alias("base_failed"),
        (~failed & ~far).alias("kept"),
    )
    return rows.select(ROW, *(F.col(f"carried_{i}").alias(c) for i, c in enumerate(carried)), verdict.alias(name))


def measure(docs: DataFrame, columns: list[str] | None = None, name: str = "quality") -> DataFrame:
    """``columns`` of ``docs`` and the struct ``name``: the base counts, both distances (null where too short) and the verdicts."""
    return verdicts(stored(docs), docs.columns if columns is None else columns, name).drop(ROW)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that pass, with the columns of ``docs``; texts are read again, not analysed again."""
    docs = stored(docs)
    good = materialize(verdicts(docs, [], "verdict").filter("verdict.kept").select(ROW))
    return with_row_id(docs).join(good, ROW, "left_semi").drop(ROW)

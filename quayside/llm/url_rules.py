"""Allow and block rules for urls, found by the expressions that a url makes and confirmed by full digests.

A rule (host, path, action) fits a url whose host is the rule's or one of its subdomains and whose path starts with
the rule's. Each url is expanded into every suffix of its host at a dot, joined with every prefix of its path
that ends at a slash (and so many characters after it as some rule has after its last slash). Each
expression meets the rules by an equi-join on the first 32 bits of its SHA-256; the full digests then decide. Of the rules that fit, the
longest (host and path together) wins, then the one with the longer host. Everything is Spark expressions.

Only as many labels of a host and slashes of a path are expanded as the rules have at most, which loses no
rule. The rules are broadcast where their size allows, else the join goes by shuffle, in which the adaptive
planner splits the digest of a hot host. Results per row are combined before they are shuffled.

Defined cases: a null url, or one without ``://``, has an empty host and an empty path, to which rules with a host never fit; a url
without a path has the path "", which starts with no "/"; ports and user names belong to the host, as do trailing dots. Rules
without a host, or whose host holds one of ``/?#``, fit nothing; a null path counts as empty; of rules that say both, block wins; other actions than
allow and block are refused. Repeated rows are judged each for itself, an empty table gives no rows, and an empty rule set leaves all to the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ROW, lower_ascii, stored, with_row_id
from quayside.operators.joins import lookup

#: Name of the struct that ``judge`` adds.
RESULT = "url_filter"
#: Hex digits of a digest that the join compares.
PREFIX_DIGITS = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def suffixes(host: Column, most_labels: int) -> Column:
    """The host without its first labels, with at most so many labels left."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    return F.transform(
        F.sequence(F.lit(1), F.least(n, F.lit(most_labels))), lambda k: F.array_join(F.slice(labels, n - k + 1, k), ".")
    )


def prefixes(path: Column, most_slashes: int, tails: list[int]) -> Column:
    """"", every prefix that ends at a slash, and those with so many further characters of the next segment."""
    slashes = F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))
    folders = F.transform(
        F.sequence(F.lit(0), F.least(slashes, F.lit(most_slashes))),
        lambda k: F.when(k == 0, "").otherwise(F.concat(F.call_function("substring_index", path, F.lit("/"), k), F.lit("/"))),
    )

    def longer(folder: Column) -> Column:
        segment = F.call_function("substring_index", F.substr(path, F.length(folder) + 1), F.lit("/"), F.lit(1))
        fitting = F.filter(F.lit(tails), lambda t: t <= F.length(segment))
        return F.transform(fitting, lambda t: F.concat(folder, F.substr(segment, F.lit(1), t)))

    return F.flatten(F.transform(folders, longer))


def expression(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("/"), path)  # hosts hold no slash


def clean_rules(rules: DataFrame) -> DataFrame:
    """One row per host and path: host, path, block."""
    said = F.lower("action")
    block = F.when(said.isin("allow", "block"), said == "block").otherwise(
        F.raise_error(F.concat(F.lit("action is neither allow nor block: "), F.coalesce("action", F.lit("null"))))
    )
    return (
        rules.select(
            lower_ascii(F.col("host").cast("string")).alias("host"),
            F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
            block.alias("block"),
        )
        .filter("host IS NOT NULL AND NOT host RLIKE '[/?#]'")
        .groupBy("host", "path")
        .agg(F.max("block").alias("block"))
    )


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The rows of ``urls`` with a struct ``url_filter`` (host, path, rule, verdict).

    Rows are joined to their rules again, so pass narrow ones (an id and the url), not whole pages.
    """
    rows = with_row_id(stored(urls))
    host, path = host_and_path(F.col(f"`{url}`").cast("string"))
    ruled = clean_rules(rules)
    tail = F.length(F.call_function("substring_index", "path", F.lit("/"), F.lit(-1)))
    shape = ruled.agg(
        F.max(F.size(F.split("host", r"\.", -1))).alias("labels"),
        F.max(F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit("")))).alias("slashes"),
        F.collect_set(tail).alias("tails"),  # lengths of segments, few
    ).first()
    parsed = F.struct(host.alias("host"), path.alias("path"))
    if shape.labels is None:
        found = rows.select(ROW, F.lit(None).cast("struct<length:int,host_length:int,rule:string,block:boolean>").alias("__best")).limit(0)
    else:
        each = F.transform(
            suffixes(F.col("__url.host"), shape.labels),
            lambda h: F.transform(prefixes(F.col("__url.path"), shape.slashes, sorted(shape.tails)), lambda p: expression(h, p)),
        )
        made = (
            rows.select(ROW, parsed.alias("__url"))
            .select(ROW, F.explode(F.flatten(each)).alias("made"))
            .select(ROW, F.sha2(F.col("made"), 256).alias("digest"))
            .withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
        )
        listed = ruled.select(
            F.sha2(expression(F.col("host"), F.col("path")), 256).alias("full"),
            F.struct(
                (F.length("host") + F.length("path")).alias("length"),
                F.length("host").alias("host_length"),
                F.concat("host", "path").alias("rule"),
                "block",
            ).alias("hit"),
        ).withColumn("short", F.substring("full", 1, PREFIX_DIGITS))
        hits = made.join(lookup(listed, sized_by=rules), "short").filter(F.col("digest") == F.col("full"))
        found = hits.groupBy(ROW).agg(F.max("hit").alias("__best"))
    said = F.when(F.col("__best").isNull(), default).when(F.col("__best.block"), "block").otherwise("allow")
    result = F.struct(host.alias("host"), path.alias("path"), F.col("__best.rule").alias("rule"), said.alias("verdict"))
    kept = [f"`{c}`" for c in urls.columns if c != RESULT]
    return rows.join(found, ROW, "left").select(*kept, result.alias(RESULT))

"""Fill-in-the-middle: texts cut at two token boundaries and rearranged, exactly reversible.

A text's tokens are its runs of letters A-Z and a-z, and every other character by itself. The offsets (in code points)
between tokens form a compressed boundary set; two hashes of the document's id choose two ranks in it, and
selection gives the offsets. Boundaries are found for whole batches on the UTF-8 bytes; everything else is Spark
expressions: the form, the cut, the arrangement and the way back.

    psm: <P>prefix<S>suffix<M>middle        spm: <S>suffix<P>prefix<M>middle

Texts that hold a marker stay plain, so in an arranged text the three markers are the only ones: none of them can arise at a seam,
because "<" begins every marker, ">" ends it and neither stands elsewhere in one.

Defined cases: a null text counts as empty and stays plain with no tokens; a null id hashes as the empty string; every row is
transformed for itself, repeated ones alike; an empty table gives no rows. Texts are worked on in batches of a few
megabytes, a longer one by itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm import tokens
from quayside.llm.boundaries import BoundarySet

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Name of the struct that ``transform`` adds.
RESULT = "fim"
#: Bytes of text that are cut at a time.
BATCH_BYTES = 4 << 20


def boundary_offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of all boundaries of every text, one text after the other, and where each text's begin (one more at the end)."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], "int64")[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", "uint8")[ends[0] : ends[-1]]
    ends = ends - ends[0]
    begins = (data & 0xC0) != 0x80  # first bytes of code points
    letters = ((data | 32) - 97).astype("uint8") < 26
    # a boundary lies before a code point, unless a letter stands on either side of it
    cut = begins.copy()
    cut[1:] &= ~(letters[1:] & letters[:-1])
    first = ends[:-1][np.diff(ends) > 0]
    cut[first] = True
    places = np.flatnonzero(cut)
    points = np.concatenate(([0], np.cumsum(begins)))
    # one more boundary at the end of each text
    number = np.searchsorted(places, ends)
    offsets = np.insert(points[places], number[1:], points[ends[1:]])
    starts = number + np.arange(len(ends))
    return offsets - np.repeat(points[ends[:-1]], np.diff(starts)), starts


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in ("n", "first", "second")]))
def cuts(text: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
    """Tokens of each text, and the offsets of the boundaries that two numbers choose, the smaller first."""
    sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
    one, two = one.to_numpy(zero_copy_only=False), two.to_numpy(zero_copy_only=False)
    out = np.zeros((3, len(text)), "int64")
    for at, rows in tokens.slices(sizes, BATCH_BYTES):
        offsets, starts = boundary_offsets(text.slice(at, rows))
        for i in range(rows):
            known = BoundarySet(offsets[starts[i] : starts[i + 1]])
            ranks = sorted((int(one[at + i]) % len(known), int(two[at + i]) % len(known)))
            out[:, at + i] = len(known) - 1, known.select(ranks[0]), known.select(ranks[1])
    return pa.StructArray.from_arrays([pa.array(x) for x in out], ["n", "first", "second"])


def numbers(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def arranged(form: Column, prefix: Column, middle: Column, suffix: Column) -> Column:
    return F.when(form == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)).otherwise(
        F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)
    )


def restored(output: Column, form: Column) -> Column:
    """The text from an output and its form alone."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    one, two, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return (
        F.when(form == "plain", output).when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))
    )


def transform(docs: DataFrame, seed: int = 1, percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """The rows of ``docs`` with a struct ``fim`` (n, form, prefix_chars, middle_chars, output).

    ``percent`` of the texts are rearranged, ``spm_percent`` of those with the suffix first.
    """
    h1, h2, h3, h4 = numbers(F.col("doc_id"), seed)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        held = held | F.contains(text, F.lit(marker))
    form = F.when((text == "") | held | (h3 % 100 >= percent), "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    kept = [f"`{c}`" for c in docs.columns if c != RESULT]
    cut = docs.select(*kept, text.alias("__text"), form.alias("__form"), cuts(text, h1, h2).alias("__cut"))
    plain = F.col("__form") == "plain"
    first, second = F.col("__cut.first").cast("int"), F.col("__cut.second").cast("int")
    pieces = (
        F.substr("__text", F.lit(1), first),
        F.substr("__text", first + 1, second - first),
        F.substr("__text", second + 1),
    )
    result = F.struct(
        F.col("__cut.n").alias("n"),
        F.col("__form").alias("form"),
        F.when(~plain, F.col("__cut.first")).alias("prefix_chars"),
        F.when(~plain, F.col("__cut.second") - F.col("__cut.first")).alias("middle_chars"),
        F.when(plain, F.col("__text")).otherwise(arranged(F.col("__form"), *pieces)).alias("output"),
    )
    return cut.select(*kept, result.alias(RESULT))

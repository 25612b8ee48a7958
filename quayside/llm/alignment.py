"""Tokens of two tokenizers over the same texts, aligned by the bytes they stand for.

Two token sequences of a text are merged like sorted lists of end offsets: the current tokens overlap and are linked, the one that ends
first moves on, and where both end the text is cut. All lanes of a batch take this step at the same time: one NumPy state vector holds
every lane's two pointers, each step emits one link (and maybe a cut) of every lane, and finished lanes are removed from the
vector. A document is one lane; a long one is several, divided where both tokenizers end, so that no single text makes a batch
take many steps.

Links of equal pairs are summed up per document. How many documents of the corpus hold a pair is counted by one aggregate with
map-side combining. The counts, one row per pair of the vocabularies, are joined back: broadcast up to a checked number of rows,
by shuffle beyond it, where the adaptive planner splits the pairs that nearly every document holds.

Defined cases: a null or empty text, and one whose tokens do not give its bytes again (the piece tokenizer turns some
characters into others), has no tokens, groups or links; every row counts as a document, repeated ones
too; an empty table gives no rows. Special-token strings inside texts are ordinary text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm import tokens
from quayside.llm.pieces import Pieces, TokenBytes, byte_level_bytes
from quayside.llm.tokens import ragged
from quayside.operators.joins import fact_join
from quayside.session import materialize

#: Bytes of text that are aligned at a time.
BATCH_BYTES = 1 << 20
#: Tokens after which a document may go on in another lane, and how many ends are tried for it.
LANE, TRIED = 1024, 32
#: Most rows of pair counts (some 50 bytes each in memory) that are broadcast.
BROADCAST_PAIRS = 1 << 20
#: Name of the struct that ``align`` adds.
RESULT = "alignment"
PAIRS = "array<struct<a:int,b:int,n:int>>"
SCHEMA = f"struct<n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups:string,pairs:{PAIRS}>"


def lockstep(
    ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (places of tokens A and B) of all lanes, lane after lane, and whether both tokens end there.

    A lane is a run of tokens of either side over the same bytes; ``ends`` are byte offsets that ascend over all lanes.
    """
    room = stop_a - first_a + stop_b - first_b  # a step moves at least one pointer
    begin = np.cumsum(room) - room
    link_a, link_b = (np.empty(int(room.sum()), "int32") for _ in range(2))
    cut = np.empty(len(link_a), bool)
    made = np.zeros(len(room), "int64")
    lane, a, b, at = np.arange(len(room)), first_a.copy(), first_b.copy(), begin.copy()
    while len(lane):
        # no lane ends before its longer side is through
        for _ in range(int(np.maximum(stop_a - a, stop_b - b).min())):
            end_a, end_b = ends_a[a], ends_b[b]
            link_a[at], link_b[at], cut[at] = a, b, end_a == end_b
            at += 1
            a += end_a <= end_b
            b += end_b <= end_a
        left = a < stop_a
        done = ~left
        made[lane[done]] = at[done] - begin[lane[done]]
        lane, a, b, at, stop_a, stop_b = (x[left] for x in (lane, a, b, at, stop_a, stop_b))
    used = ragged(begin, made, np.arange(len(made)))
    return link_a[used], link_b[used], cut[used]


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First tokens of all lanes: of each document, and of its further lanes, each after a common end."""
    counts = np.diff(np.append(first_a, len(ends_a)))
    more = np.maximum(counts - 1, 0) // LANE
    if not more.sum():
        return first_a, first_b
    document = np.repeat(np.arange(len(more)), more)
    nth = np.arange(len(document)) - np.repeat(np.cumsum(more) - more, more) + 1
    last = (first_a + counts - 2)[document]  # a document's last token begins no lane
    tried = np.minimum((first_a[document] + nth * LANE - 1)[:, None] + np.arange(TRIED), last[:, None])
    there = np.searchsorted(ends_b, ends_a[tried])
    equal = ends_b[there] == ends_a[tried]
    found = np.flatnonzero(equal.any(1))
    best = equal[found].argmax(1)
    new_a, new_b = tried[found, best] + 1, there[found, best] + 1
    return np.union1d(first_a, new_a), np.union1d(first_b, new_b)


@functools.cache
def _sides(path_a: str, path_b: str) -> tuple[tokens.Ids, TokenBytes, Pieces, TokenBytes, TokenBytes]:
    """Both tokenizers with the bytes of their tokens, and every id in decimal with each of the separators."""
    ids, pieces = tokens.ids(path_a), Pieces(path_b)
    bytes_a, bytes_b = byte_level_bytes(path_a), pieces.token_bytes()
    decimal = [b"%d%s" % (i, sign) for i in range(max(len(bytes_a), len(bytes_b))) for sign in SIGNS]
    return ids, TokenBytes.of(bytes_a), pieces, TokenBytes.of(bytes_b), TokenBytes.of(decimal)


#: After a token: another of its side, the other side, the next group, nothing.
SIGNS = (b",", b"|", b";", b"")


def _flat(each: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(each), "<u4").astype("int64"), np.array([len(x) // 4 for x in each], "int64")


def _exact(table: TokenBytes, ids: list[bytes], spaced: pa.Array) -> np.ndarray:
    """Whether the tokens of each text give its bytes."""
    flat, counts = _flat(ids)
    owner = np.repeat(np.arange(len(ids)), counts)
    sizes = pc.binary_length(spaced).to_numpy(zero_copy_only=False)
    made = np.bincount(owner, table.lengths[flat], len(ids)).astype("int64")
    right = made == sizes
    if right.all():
        data = np.frombuffer(pc.binary_join(pa.ListArray.from_arrays([0, len(spaced)], spaced), "")[0].as_buffer(), "uint8")
        wrong = np.flatnonzero(table.joined(flat) != data)
        right[np.searchsorted(np.cumsum(sizes), wrong, "right")] = False
        return right
    for i in np.flatnonzero(right):
        right[i] = table.joined(np.frombuffer(ids[i], "<u4")).tobytes() == spaced[int(i)].as_py().encode()
    return right


def align_texts(texts: pa.Array, path_a: str, path_b: str) -> pa.StructArray:
    """The struct of ``align`` for every text."""
    known_a, bytes_a, known_b, bytes_b, decimal = _sides(path_a, path_b)
    texts = pc.fill_null(texts.cast(pa.string()), "")
    spaced = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
    ids_a, ids_b = known_a.texts(spaced), known_b.texts(texts)
    exact = _exact(bytes_a, ids_a, spaced) & _exact(bytes_b, ids_b, spaced)
    for i in np.flatnonzero(~exact):
        ids_a[i] = ids_b[i] = b""
    (a, count_a), (b, count_b) = _flat(ids_a), _flat(ids_b)
    n = len(texts)
    full = np.flatnonzero(count_a)
    ends_a, ends_b = np.cumsum(bytes_a.lengths[a]), np.cumsum(bytes_b.lengths[b])
    first_a, first_b = ((np.cumsum(c) - c)[full] for c in (count_a, count_b))
    lane_a, lane_b = lanes(ends_a, ends_b, first_a, first_b)
    link_a, link_b, cut = lockstep(ends_a, ends_b, lane_a, lane_b, np.append(lane_a[1:], len(a)), np.append(lane_b[1:], len(b)))
    # links per document
    owner = np.repeat(np.arange(n), count_a)[link_a]
    n_links = np.bincount(owner, minlength=n)
    n_groups = np.bincount(owner[cut], minlength=n)
    group = np.cumsum(cut) - cut
    group_a, group_b = np.empty(len(a), "int64"), np.empty(len(b), "int64")
    group_a[link_a], group_b[link_b] = group, group
    groups = int(n_groups.sum())
    # the tokens of a group: those of A, then those of B, each followed by its sign
    size_a, size_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    place_a = np.arange(len(a)) + (np.cumsum(size_b) - size_b)[group_a]
    place_b = np.arange(len(b)) + np.cumsum(size_a)[group_b]
    written = np.empty(len(a) + len(b), "int64")
    written[place_a] = a * len(SIGNS)
    written[place_b] = b * len(SIGNS)
    sizes = size_a + size_b
    last = np.cumsum(sizes) - 1
    written[last - size_b] += SIGNS.index(b"|")
    written[last] += SIGNS.index(b";")
    written[last[np.cumsum(n_groups)[full] - 1]] += SIGNS.index(b"") - SIGNS.index(b";")
    per_text = np.bincount(np.repeat(np.arange(n), n_groups), sizes, n).astype("int64")
    lengths = decimal.lengths[written]
    ends = np.concatenate(([0], np.cumsum(lengths)))[np.concatenate(([0], np.cumsum(per_text)))]
    strings = pa.LargeStringArray.from_buffers(n, pa.py_buffer(ends), pa.py_buffer(decimal.joined(written)))
    # distinct pairs per document
    width = len(bytes_b.lengths)
    keys, times = np.unique((owner * len(bytes_a.lengths) + a[link_a]) * width + b[link_b], return_counts=True)
    pair, of = keys % (len(bytes_a.lengths) * width), keys // (len(bytes_a.lengths) * width)
    offsets = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=n)))).astype("int32")
    structs = pa.StructArray.from_arrays([pa.array(x.astype("int32")) for x in (pair // width, pair % width, times)], ["a", "b", "n"])
    return pa.StructArray.from_arrays(
        [*(pa.array(x.astype("int64")) for x in (count_a, count_b, n_groups, n_links)), strings.cast(pa.string()), pa.ListArray.from_arrays(offsets, structs)],
        ["n_a", "n_b", "n_groups", "n_links", "groups", "pairs"],
    )


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The rows of ``docs`` with a struct ``alignment``: n_a, n_b (tokens), n_groups, n_links, groups, pairs.

    ``path_a`` is a byte-level tokenizer, which reads a space and the text; ``path_b`` a piece tokenizer, which adds the space itself.
    ``groups`` lists the ids between two cuts, of A and of B; ``pairs`` the distinct linked ids with the number of their links.
    """
    plain = docs.select(*(f"`{c}`" for c in docs.columns if c != RESULT), F.col("text").cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
            for at, rows in tokens.slices(sizes, BATCH_BYTES):
                piece = batch.slice(at, rows)
                done = align_texts(piece.column(piece.num_columns - 1), path_a, path_b)
                yield pa.record_batch([*piece.columns[:-1], done], names=[*piece.schema.names[:-1], RESULT])

    schema = T.StructType([*plain.schema.fields[:-1], *T._parse_datatype_string(f"{RESULT} {SCHEMA}").fields])
    return plain.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """a, b, n_docs (rows of ``aligned`` that hold the pair), best (no other pair of this a is held by more)."""
    pairs = aligned.select(F.explode(f"{RESULT}.pairs").alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("n_docs"))
    most = F.max("n_docs").over(Window.partitionBy("a"))  # at most one row per id of B
    return materialize(pairs.withColumn("best", F.col("n_docs") == most))


def with_counts(aligned: DataFrame) -> DataFrame:
    """Stores the rows of ``aligned``, and adds n_best (links of best pairs) and count_sum (of the pairs' counts over all links)."""

    def key(a: str, b: str):
        return F.shiftleft(F.col(a).cast("bigint"), 32).bitwiseOR(F.col(b)).alias("pair")

    numbered = materialize(aligned.withColumn("__row", F.monotonically_increasing_id()))
    counted = pair_counts(numbered).select(key("a", "b"), "n_docs", "best")
    links = numbered.select("__row", F.explode(f"{RESULT}.pairs").alias("p")).select("__row", key("p.a", "p.b"), "p.n")
    small = counted.limit(BROADCAST_PAIRS + 1).count() <= BROADCAST_PAIRS
    joined = links.join(F.broadcast(counted), "pair") if small else fact_join(links, counted, "pair")
    sums = joined.groupBy("__row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).cast("bigint").alias("__n_best"),
        F.sum(F.col("n") * F.col("n_docs")).alias("__count_sum"),
    )
    kept = [f"`{c}`" for c in aligned.columns if c not in ("n_best", "count_sum")]
    added = [F.coalesce(f"__{c}", F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return numbered.join(sums, "__row", "left").select(*kept, *added)

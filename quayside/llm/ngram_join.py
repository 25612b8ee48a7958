"""N-gram Jaccard join by parity sketches.

A document is the set of its distinct word shingles. Equal sets are one class, found by a 64-bit digest. Each class
has a sketch per size band: every shingle is XORed, as a 64-bit hash, into one of t + 1 words. The number of words in which two
sketches differ is at most the symmetric difference of the sets, and for two sets of the band that link, this is
at most t; so at least one word is equal, and an equi-join on (band, place, word) misses no link. A few spare
words make sure that not only empty ones are equal. What meets there is compared by parity sketches first: two bits for
every shingle, each toggled by one hash value, so that their Hamming distance is a lower bound of the symmetric difference.
Bands are geometric with the smallest size ratio that a link allows, so linked sets share a band or lie in
neighbouring ones; every class joins in its own band and in the next. The spare words that are not empty let a class stay
out of as many of its largest buckets: the order of buckets by size is the same for all, so two linked classes keep one in common.

Candidates are verified on the full sets. As a component is asked for, not all pairs of it, the members of
a bucket are first verified against one of them, its leader, the one that meets the most others, twice over. Buckets that still hold
more than one component are refined: each member is reduced to what it adds to its leader's set and what it lacks of it, and two
members that link, not both with the leader, have a part of that in common. So they meet again in a smaller bucket, named by the
leader and one such shingle, a rare one where it can be. What a family has in common drops out, and members that each differ from it in their own places do not
meet again, however many they are. Only what is left when that does not help any more is joined out, and only across components. A family of k
near copies so costs about k verifications, and no link between components is lost.

Shingles and sets are compared by 64-bit hashes (two different shingles of a pair of documents of a thousand words
collide with a probability below 1e-12, two sets among 10**9 with one of about 3 %).

Defined cases: a null, empty or blank text has the empty set and links with nothing, not even another
empty one; a text with fewer words than a shingle is one shingle of all its words; equal rows fall in one class; null ids
are looked through when the smallest id of a component is taken.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quayside.llm import tokens
from quayside.llm.common import ROW, row_id, stored, with_row_id
from quayside.llm.components import components
from quayside.session import freed_shuffles, materialize, new_path, release

#: Most sets that a task remembers to have met.
REMEMBERED = 1_000_000
#: Times that the members of a bucket are verified against a leader before what is left is joined out.
LEADER_ROUNDS = 2
#: Most times that buckets are refined before what is left is joined out.
REFINEMENTS = 3
#: Most shingles that are known as frequent when those that name the smaller buckets are chosen.
FREQUENT = 1 << 16
#: Bytes of text that are cut into words at a time.
BATCH_BYTES = 1 << 20
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], "uint64")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX[4]
    x = (x ^ (x >> np.uint64(29))) * _MIX[3]
    return x ^ (x >> np.uint64(32))


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text, from the hashes of its words."""
    if not len(h):
        return h
    wide = min(width, len(h))
    with np.errstate(over="ignore"):
        out = np.full(len(h) - wide + 1, wide, "uint64")
        for i in range(wide):
            out = _mixed(out * _MIX[0] + h[i : i + len(out)])
    return np.unique(out)


def text_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Shingle sets of texts, a few megabytes at a time: first row, rows and their sets."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for at, rows in tokens.slices(sizes, BATCH_BYTES):
        codes, dictionary, counts = tokens.words(texts.slice(at, rows))
        listed = dictionary.to_pylist()
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, listed), "uint64", len(listed))[codes]
        yield at, rows, [shingles(h, width) for h in np.split(hashes, np.cumsum(counts)[:-1])]


class Bands:
    """Size bands, and the differences and places of their sketches, for a similarity of at least ``percent`` / 100."""

    #: A band's largest size over its smallest, as a logarithm, if the smallest ratio that a link allows isn't larger.
    WIDTH = 0.45

    def __init__(self, percent: int):
        self.percent, self.step = percent, math.log(100 / percent)
        self.width = self.step * max(1, int(self.WIDTH / self.step))
        self._places: dict[int, tuple[int, int]] = {}

    def of(self, size: int) -> list[int]:
        """A set's own band, and the next one where a larger set that links with it may lie there."""
        own, above = (int((math.log(size) + more) / self.width + 1e-9) for more in (0.0, self.step))
        return [own] if own == above else [own, above]

    def differences(self, band: int) -> int:
        """Largest symmetric difference of two linked sets, the larger one of ``band`` (with a margin of one in its size)."""
        most = math.floor(math.exp((band + 1) * self.width)) + 1
        return (100 - self.percent) * 2 * most // (100 + self.percent)

    def places(self, band: int) -> tuple[int, int]:
        """Words of a sketch, and how many of them are spare: more than a small set of the band is likely to leave empty."""
        if band not in self._places:
            words, least = self.differences(band) + 1, math.exp(band * self.width) * self.percent / 100
            spare = 0
            while spare <= words // 4:
                empty = (words + spare) * (1 - 1 / (words + spare)) ** least
                if empty + 3 * math.sqrt(empty) < spare + 1:
                    break
                spare += 1
            self._places[band] = words + spare, spare
        return self._places[band]


def sketches(hashes: np.ndarray, bands: Bands) -> tuple[np.ndarray, list[int]]:
    """Keys (64-bit hashes of band, place and word) of a set's sketches, and how many it may leave out in even and in odd bands.

    With s spare words, two linked sets agree in at least s + 1 words. Empty words would fill large
    buckets; a set with e of them, at most s, leaves them out, and of its others any s - e that come first in an order that
    depends on the word alone: of the words in which two linked sets agree, both then keep the last. A key ends in the parity of its band.
    """
    keys, left = [], [0, 0]
    with np.errstate(over="ignore"):
        for band in bands.of(len(hashes)):
            places, spare = bands.places(band)
            h = _mixed(hashes ^ _MIX[1])
            place = ((h >> np.uint64(32)) % np.uint64(places)).astype("int64")
            words = np.zeros(places, "uint64")
            np.bitwise_xor.at(words, place, hashes)
            key = _mixed(_mixed(words + _MIX[2]) + np.arange(places, dtype="uint64") * _MIX[0] + np.uint64(band) * _MIX[1])
            key = key >> np.uint64(1) << np.uint64(1) | np.uint64(band % 2)
            empty = words == 0
            left[band % 2] = max(0, spare - int(empty.sum()))
            keys.append(key if empty.sum() > spare else key[~empty])
    return np.concatenate(keys), left


def sketch_keys(hashes: np.ndarray, bands: Bands) -> np.ndarray:
    """The keys of a set's sketches alone."""
    return sketches(hashes, bands)[0]


def parity(hashes: np.ndarray) -> np.ndarray:
    """Parity sketch of a set: at least two bits for each shingle, a power of two of them."""
    bits = max(64, 1 << (2 * len(hashes) - 1).bit_length())
    out = np.zeros(bits // 64, "uint64")
    at = hashes & np.uint64(bits - 1)
    np.bitwise_xor.at(out, (at >> np.uint64(6)).astype("int64"), np.uint64(1) << (at & np.uint64(63)))
    return out


def hamming(x: np.ndarray, y: np.ndarray) -> int:
    """Distance of two parity sketches, a lower bound of the sets' symmetric difference; the longer one is folded first."""
    x, y = sorted((x, y), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def set_number(hashes: np.ndarray) -> int:
    """64-bit digest of a set, as a signed number."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def sketch(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Stores doc_id, row_id, n_shingles, v (digest; null for the empty set), keys and ``left`` (those it may leave out) of every row.

    A set that a task meets again gets neither there, so a set of very many rows has them once per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, met = Bands(percent), set()
        for batch in batches:
            for at, rows, sets in text_sets(batch.column(2), width):
                piece = batch.slice(at, rows)
                numbers = [set_number(s) if len(s) else None for s in sets]
                keys, left = [], []
                for v, s in zip(numbers, sets):
                    some, spare = (np.empty(0, "uint64"), None) if v is None or v in met else sketches(s, bands)
                    keys.append(some.view("int64"))
                    left.append(spare)
                    if len(met) >= REMEMBERED:
                        met.clear()
                    met.add(v)
                ends = np.cumsum([0, *map(len, keys)]).astype("int32")
                yield pa.record_batch(
                    [
                        piece.column(0),
                        piece.column(1),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(numbers, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys) if keys else np.empty(0, "int64"))),
                        pa.array(left, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "row_id", "n_shingles", "v", "keys", "left"],
                )

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_id().alias("row_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, row_id string, n_shingles bigint, v bigint, keys array<bigint>, left array<bigint>"
    return materialize(narrow.mapInArrow(run, schema))


def _members(stored_sketches: DataFrame, classes: DataFrame) -> DataFrame:
    """key and v: the classes that meet in each bucket, without the largest buckets that a class may leave out.

    A word of few shingles that texts have from a common line makes a bucket that grows with the table, and says least.
    """
    entries = stored_sketches.select("v", F.explode("keys").alias("key"))
    # a class has a large number of keys, so even one of a family that fills the table is a small share of the rows
    bucket = Window.partitionBy("key")
    sizes = {"low": F.min("v").over(bucket), "high": F.max("v").over(bucket), "c": F.count(F.lit(1)).over(bucket)}
    shared = entries.withColumns(sizes).filter("low <> high").select("v", "key", "c", F.expr("key & 1").alias("odd"))
    # a class may stand in a bucket once per task that met it
    order = Window.partitionBy("v", "odd").orderBy(F.desc("c"), "key")
    ranked = shared.join(classes.select("v", "left"), "v").withColumn("rank", F.dense_rank().over(order))
    return ranked.filter(F.col("rank") > F.get("left", F.col("odd").cast("int"))).select("v", "odd", "key").distinct().select("key", "v")


def _full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Stores v, size, parity sketch and sorted hashes (as bytes) for the rows that stand for the wanted classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, rows, sets in text_sets(batch.column(1), width):
                piece = batch.slice(at, rows)
                yield pa.record_batch(
                    [
                        piece.column(0),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([parity(x).tobytes() for x in sets], pa.binary()),
                        pa.array([x.tobytes() for x in sets], pa.binary()),
                    ],
                    names=["v", "n", "parity", "hashes"],
                )

    texts = docs.select(row_id().alias("row_id"), F.col("text").cast("string").alias("text"))
    narrow = texts.join(wanted, "row_id").select("v", "text")
    return materialize(narrow.mapInArrow(run, "v bigint, n bigint, parity binary, hashes binary"))


def _joined(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """Pairs with the named columns of a's set, then of b's."""
    left = sets.select(F.col("v").alias("a"), *(F.col(c).alias(f"{c}_a") for c in columns))
    right = sets.select(F.col("v").alias("b"), *(F.col(c).alias(f"{c}_b") for c in columns))
    return pairs.join(left, "a").join(right, "b").select("a", "b", *(f"{c}_{x}" for x in "ab" for c in columns))


Batches = Iterator[pa.RecordBatch]
_PAIR = "a bigint, b bigint"


def _with_sets(pairs: DataFrame, sets: DataFrame, work: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """Stores what ``work`` makes of stored pairs with the hashes of both sets.

    Pairs go in parts of at most about half as many as there are sets, one after the other, so that a shuffle never has
    much more than the sets on disk, however many pairs there are.
    """
    spark, parts = pairs.sparkSession, max(1, math.ceil(2 * pairs.count() / max(1, sets.count())))
    path = new_path(spark)
    ends = pairs.select(F.col("a").alias("v")).unionAll(pairs.select(F.col("b").alias("v")))
    sets = sets.join(ends, "v", "left_semi")
    for i in range(parts):
        some = pairs.filter(F.pmod(F.xxhash64("a", "b"), F.lit(parts)) == i) if parts > 1 else pairs
        _joined(some, sets, "hashes").mapInArrow(work, schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _kept(test: Callable[..., bool]) -> Callable[[Batches], Batches]:
    """Picks the pairs whose columns pass."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keep = [test(*(x.as_py() for x in row)) for row in zip(*batch.columns[2:])]
            yield pa.record_batch(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stores the pairs (a, b) whose full sets link. Whole sets move only for pairs that their parity sketches leave open."""

    def close(n: int, x: bytes, m: int, y: bytes) -> bool:
        most = (100 - percent) * (n + m) // (100 + percent)
        return abs(n - m) <= most and hamming(np.frombuffer(x, "uint64"), np.frombuffer(y, "uint64")) <= most

    def linked(x: bytes, y: bytes) -> bool:
        x, y = np.frombuffer(x, "uint64"), np.frombuffer(y, "uint64")
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    near = materialize(_joined(pairs, sets, "n", "parity").mapInArrow(_kept(close), _PAIR))
    return _with_sets(near, sets, _kept(linked), _PAIR)


def _leaders(members: DataFrame) -> DataFrame:
    """Each bucket's leader, the member that meets the most others in all its buckets, and how many (w).

    Of a text and copies that each change it in their own places, this is the text, with which they all link, and not
    a copy, with which the others may not link.
    """
    counted = members.groupBy("key").agg(F.count(F.lit(1)).alias("c"))
    weights = members.join(counted, "key").groupBy("v").agg(F.sum("c").alias("w"))
    return members.join(weights, "v").groupBy("key").agg(F.max(F.struct("w", F.col("v").alias("leader"))).alias("l")).select("key", "l.*")


def _to_leaders(members: DataFrame, leaders: DataFrame) -> DataFrame:
    """v and leader: each member of a bucket with the bucket's leader."""
    return members.join(leaders.select("key", "leader"), "key").filter("v <> leader").select("v", "leader").distinct()


def _centres(members: DataFrame) -> DataFrame:
    """A leader for each bucket from all the buckets of its members: a family has the same one in buckets that do not hold it."""
    first = materialize(_leaders(members))
    best = members.join(first, "key").groupBy("v").agg(F.max(F.struct("w", "leader")).alias("l"))
    return members.join(best, "v").groupBy("key").agg(F.max("l").alias("l")).select("key", "l.*")


def _pairs(members: DataFrame) -> int:
    """Pairs that meet in buckets, a pair once per bucket."""
    counted = members.groupBy("key").agg(F.count(F.lit(1)).cast("decimal(38,0)").alias("c"))
    return int(counted.agg(F.sum(F.expr("c * (c - 1)"))).first()[0] or 0) // 2


class Order:
    """A total order of shingles: those not known as frequent by hash, then the frequent ones, the most frequent last."""

    def __init__(self, frequent: np.ndarray):
        """``frequent``: distinct shingles, the most frequent first."""
        at = np.argsort(frequent)
        self.shingles, self.rank = frequent[at], -at

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """``hashes``, sorted by hash before, in this order."""
        if not len(self.shingles):
            return hashes
        at = np.minimum(np.searchsorted(self.shingles, hashes), len(self.shingles) - 1)
        rank = np.where(self.shingles[at] == hashes, self.rank[at], -len(self.shingles))
        return hashes[np.argsort(rank, kind="stable")]


def _order(sets: DataFrame) -> Order:
    """The order that leaves out what many sets hold, if members' first shingles are taken. Any order gives the same links, so it need not be exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False)
            for at, rows in tokens.slices(sizes, 8 * BATCH_BYTES):
                found, n = np.unique(np.frombuffer(b"".join(batch.column(0).slice(at, rows).to_pylist()), "uint64"), return_counts=True)
                yield pa.record_batch([pa.array(found[n > 1].view("int64")), pa.array(n[n > 1].astype("int64"))], names=["shingle", "n"])

    counted = sets.select("hashes").mapInArrow(run, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "shingle").limit(FREQUENT).select("shingle", "n").collect()
    return Order(np.array([r["shingle"] for r in top], "int64").view("uint64"))


def delta(x: np.ndarray, leader: np.ndarray, percent: int, order: Order) -> tuple[int, int, bool, np.ndarray, np.ndarray]:
    """Shingles that ``x`` adds to its leader's set and that it lacks, whether the two link, and the first ones of each.

    Let x and y link. They have at least percent / 100 of their union in common, so x has at most size * (100 - percent) / 100
    shingles that y lacks, and y at most size * (100 - percent) / percent that x lacks (size: of x). That many of the
    added and of the lacking ones can come before the first that both add, or both lack, and no more need to be kept.
    """
    added, lacking = np.setdiff1d(x, leader, assume_unique=True), np.setdiff1d(leader, x, assume_unique=True)
    both = len(x) - len(added)
    near = 100 * both >= percent * (len(x) + len(leader) - both)
    first, less = len(x) * (100 - percent) // 100 + 1, len(x) * (100 - percent) // percent + 1
    return len(added), len(lacking), near, order.of(added)[:first], order.of(lacking)[:less]


def _deltas(pairs: DataFrame, sets: DataFrame, percent: int, order: Order) -> DataFrame:
    """Stores v, leader, n (size of v) and the ``delta`` of each pair (v, leader)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ([np.frombuffer(z.as_py(), "uint64") for z in column] for column in batch.columns[2:])
            found = [delta(a, b, percent, order) for a, b in zip(x, y)]
            added, lacking, near, *firsts = zip(*found) if found else ((),) * 5
            lists = [
                pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, some)]), pa.int32()), pa.array(np.concatenate([np.empty(0, "uint64"), *some]).view("int64"))
                )
                for some in firsts
            ]
            numbers = [pa.array(values, pa.int64()) for values in (list(map(len, x)), added, lacking)]
            names = ["v", "leader", "n", "added", "lacking", "near", "first_added", "first_lacking"]
            yield pa.record_batch([*batch.columns[:2], *numbers, pa.array(near, pa.bool_()), *lists], names=names)

    stored_pairs = materialize(pairs.select(F.col("v").alias("a"), F.col("leader").alias("b")))
    schema = "v bigint, leader bigint, n bigint, added bigint, lacking bigint, near boolean, first_added array<bigint>, first_lacking array<bigint>"
    return _with_sets(stored_pairs, sets, run, schema)


def _sparing(deltas: DataFrame, percent: int) -> DataFrame:
    """leader, added, lacking and near of the members x that may link with one y without adding a shingle that y adds.

    Their distance, at most n * (100 - percent) / percent, is at least added(x) + added(y) + abs(lacking(x) - lacking(y)) then. Whether a leader has
    such a y is found from the least added(y) - lacking(y) of those that lack no more, and the least sum of those that lack no less. Two that both link
    with the leader are in one component as it is.
    """
    kind = ["leader", "added", "lacking", "near"]
    kinds = deltas.select(*kind, F.floor(F.col("n") * (100 - percent) / percent).alias("most")).filter("added <= most").distinct()
    less = Window.partitionBy("leader").orderBy("lacking").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    more = Window.partitionBy("leader").orderBy(F.desc("lacking")).rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def least(value: str, over: WindowSpec) -> Column:
        return F.when(F.col("near"), F.min(F.when(~F.col("near"), F.expr(value))).over(over)).otherwise(F.min(F.expr(value)).over(over))

    bounds = kinds.withColumn("low", least("added - lacking", less)).withColumn("high", least("added + lacking", more))
    return bounds.filter("low <= most - added - lacking or high <= most - added + lacking").select(*kind)


def _refined(deltas: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Smaller buckets (key, v) in which all pairs of a leader's members meet that may link across components.

    Two members that link and do not both link with the leader have an added or a lacking shingle in common: their distance is that of
    their deltas, and the sizes of these add up to more than the distance that a link allows.
    """
    kind = ["leader", "added", "lacking", "near"]
    spared = deltas.join(_sparing(deltas, percent), kind, "left_semi")
    entries = None
    for rows, column, side in ((deltas, "first_added", 0), (spared, "first_lacking", 1)):
        some = rows.select("v", "leader", F.explode(column).alias("shingle"))
        keyed = some.select("v", F.xxhash64("leader", "shingle", F.lit(side)).alias("key"))
        entries = keyed if entries is None else entries.unionAll(keyed)
    placed = _rooted(entries, roots)
    bucket = Window.partitionBy("key")
    mixed = placed.withColumns({"low": F.min("root").over(bucket), "high": F.max("root").over(bucket)}).filter("low <> high")
    return mixed.select("key", "v").distinct()


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, F.col("v") == F.col("node"), "left").select("key", "v", F.coalesce("root", "v").alias("root"))


def _mixed_buckets(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The members of buckets that still hold more than one component."""
    placed = _rooted(members, roots)
    mixed = placed.groupBy("key").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).filter("r1 <> r2").select("key")
    return placed.join(mixed, "key", "left_semi").drop("root")


def _with_links(roots: DataFrame, new: DataFrame) -> DataFrame:
    """The components with more links (a, b)."""
    return roots if new.isEmpty() else components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(new))


def link(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, row_id, n_shingles, component_id and first_row (the row that stands for its component) for every row."""
    docs = stored(docs)
    with freed_shuffles(docs.sparkSession):
        rows, by_class = _by_class(docs, width, percent)
    return rows.join(by_class, "v", "left").select(
        "doc_id",
        "row_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("first_row", "row_id").alias("first_row"),
    )


def _by_class(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Stores doc_id, row_id, n_shingles and v of every row, and component_id and first_row of every class v.

    Keys, sets and deltas, each about as large as the texts, are deleted as soon as the step that reads them last is done.
    """
    stored_sketches = sketch(docs, width, percent)
    rows = materialize(stored_sketches.drop("keys"))
    # one row per class, combined map-side: a hot class costs one row per task
    classes = materialize(
        rows.filter("v is not null")
        .groupBy("v")
        .agg(F.min("doc_id").alias("doc_id"), F.min("row_id").alias("row_id"), F.max("n_shingles").alias("n"), F.max("left").alias("left"))
    )
    members = materialize(_members(stored_sketches, classes))
    release(stored_sketches)
    wanted = classes.select("row_id", "v").join(members.select("v").distinct(), "v", "left_semi")
    sets = _full_sets(docs, wanted, width)

    roots = links = tried = None
    for _ in range(LEADER_ROUNDS):
        led = _to_leaders(members, _leaders(members))
        pairs = led.select(F.least("v", "leader").alias("a"), F.greatest("v", "leader").alias("b")).distinct()
        pairs = materialize(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        tried = pairs if tried is None else tried.unionAll(pairs)
        new = _verified(pairs, sets, percent)
        links = new if roots is None else roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(new)
        if roots is None or not new.isEmpty():
            roots = components(links)
        members = materialize(_mixed_buckets(members, roots))
    meet = _pairs(members)
    order = _order(sets) if meet else Order(np.empty(0, "uint64"))
    for _ in range(REFINEMENTS):
        if not meet:
            break
        deltas = _deltas(_to_leaders(members, _centres(members)), sets, percent, order)
        ends = [roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("v", "leader")]
        near = deltas.filter("near").select("v", "leader").join(ends[0], "v", "left").join(ends[1], "leader", "left")
        near = near.select(F.coalesce("v_root", "v").alias("a"), F.coalesce("leader_root", "leader").alias("b"))
        roots = _with_links(roots, materialize(near.filter("a <> b")))
        refined = materialize(_refined(deltas, roots, percent))
        release(deltas)
        before, now = meet, _pairs(refined)
        if now < before:
            members, meet = refined, now
        if 2 * now > before:
            break
    rooted = _rooted(members, roots).join(classes.select("v", "n"), "v")
    x = rooted.select("key", F.col("v").alias("a"), F.col("n").alias("na"), F.col("root").alias("ra"))
    y = rooted.select("key", F.col("v").alias("b"), F.col("n").alias("nb"), F.col("root").alias("rb"))
    near = (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)
    rest = x.join(y, "key").filter((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & near).select("a", "b").distinct()
    rest = materialize(rest.join(tried, ["a", "b"], "left_anti"))
    roots = _with_links(roots, _verified(rest, sets, percent))
    release(sets)
    labelled = classes.join(roots, F.col("v") == F.col("node"), "left")
    labelled = materialize(labelled.select("v", "doc_id", "row_id", F.coalesce("root", "v").alias("root")))
    firsts = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.min("row_id").alias("first_row"))
    return rows, materialize(labelled.select("v", "root").join(firsts, "root").drop("root"))


def keep_one_each(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """One row of every component, and all rows without shingles, with the columns of ``docs``."""
    docs = stored(docs)
    kept = link(docs, width, percent).filter("row_id = first_row").select(F.col("row_id").alias(ROW))
    return with_row_id(docs).join(kept, ROW, "left_semi").drop(ROW)

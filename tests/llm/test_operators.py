"""Every operator against a brute-force version, on the smallest tables and on a table of edge cases."""

from __future__ import annotations

import re
import time
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quayside.llm import attention, exact, html_content, kdtree, license, lm, mixing, ngram_join, packing, quality, tokens
from quayside.llm.html_training import labelled_pages
from quayside.llm.queries import QUERIES
from quayside.session import freed_shuffles, materialize, new_path, path_exists, recorded_paths, release

SMALL = "/root/testdata/sf0.001"


def rows(spark, folder, table="documents"):
    return [r.asDict() for r in spark.read.parquet(f"{folder}/{table}.parquet").collect()]


def same(spark, query, folder, columns, expected):
    got = QUERIES[query](spark, folder).select(*columns).collect()
    assert Counter(tuple(r) for r in got) == Counter(expected)


@pytest.fixture(params=["small", "edge"])
def folder(request):
    return SMALL if request.param == "small" else request.getfixturevalue("edge")


def test_license(spark, folder):
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    same(spark, "op1_license_scan", folder, columns, brute.license_base(rows(spark, folder)))
    for r in QUERIES["op1_license_scan"](spark, folder).collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_license_rules():
    listed = license.rules()
    assert len(listed) > 200 and all(r["priority"] <= license.LEVELS and r["keywords"] for r in listed)


def forms(expression):
    """A string for every alternative of a regular expression, without its optional parts."""
    out = [""]
    for op, value in expression:
        op = str(op)
        if op == "BRANCH":
            found = [x for branch in value[1] for x in forms(branch)]
        elif op == "SUBPATTERN":
            found = forms(value[-1])
        elif op in ("MAX_REPEAT", "MIN_REPEAT"):
            found = [a * value[0] for a in forms(value[2])] if value[0] else [""]
        elif op == "IN":
            kind, first = value[0][0], value[0][1]
            found = [chr(v) for _, v in value] if all(str(k) == "LITERAL" for k, _ in value) else [chr(first[0]) if str(kind) == "RANGE" else "1"]
        elif op == "LITERAL":
            found = [chr(value)]
        else:
            assert op in ("ANY", "ASSERT", "CATEGORY"), op
            found = ["1" if op != "ASSERT" else " "]
        out = [a + b for a in out for b in dict.fromkeys(found)]
    return out


def test_license_keywords_cover_every_form():
    for r in license.rules():
        lost = [x for x in forms(re._parser.parse(r["regex"])) if not any(k in x for k in r["keywords"])]
        assert not lost, (r["label"], lost[:3])


def test_license_prefilter_loses_nothing(spark):
    texts = ["expat license", "Internet Systems Consortium License", "SPDX-License-Identifier: CC-PDDC"]
    assert [spans(spark, x)[0][0] for x in texts] == ["mit", "isc", "creative-commons"]
    listed = license.rules()
    norm = license.normalized(F.col("text"))
    df = spark.createDataFrame([(x,) for x in [*texts, "under the GPL v2, MIT or CC BY 4.0"]], "text string")
    free = [r | {"keywords": [" "]} for r in listed]
    got = df.select(license._detections(norm, listed).alias("a"), license._detections(norm, free).alias("b")).collect()
    assert all(r.a == r.b and r.a for r in got)


def spans(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    r = license.scan(df).select("license_scan.*").first()
    return [(s.label, r.norm[s.start : s.end].strip()) for s in r.spans if not s.base]


def test_license_containment(spark):
    # the grant covers the name in it; a name outside of it stays
    found = spans(spark, "Licensed under the Apache License, Version 2.0. See the MIT License. x Apache License 2.0")
    assert found == [("apache-2.0", "licensed under the apache license version 2 0"), ("mit", "mit license"), ("apache-2.0", "apache license 2 0")]
    assert spans(spark, "CC BY-NC-SA 4.0")[0][0] == "cc-by-nc-sa"
    assert len(spans(spark, "released under the MIT license. " * 3000)) == 3000
    assert spans(spark, "the mitten licensed nothing") == []


def test_exact(spark, folder):
    got = QUERIES["op2_exact_dedup"](spark, folder).collect()
    expected = brute.exact(rows(spark, folder))
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter((a, b, c, e) for a, b, c, _, e in expected)
    # of every text exactly one row is kept, and it has the id that stays
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and set(kept) == {e for *_, e in expected}
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_index_keeps_earlier_rows(spark):
    def docs(*pairs):
        return spark.createDataFrame(list(pairs), "doc_id bigint, text string")

    index = exact.DigestIndex(spark, new_path(spark), buckets=4)
    first = {r.doc_id: (r.keep_id, r.kept) for r in exact.label(docs((1, "A"), (2, "a"), (3, "b")), index).collect()}
    second = {r.doc_id: (r.keep_id, r.kept) for r in exact.label(docs((9, "a"), (8, "c"), (7, "C")), index).collect()}
    assert first == {1: (2, False), 2: (2, True), 3: (3, True)}
    assert second == {9: (2, False), 8: (8, True), 7: (8, False)}
    assert sorted(r.owner for r in index.rows().collect()) == [2, 3, 8]
    assert index.rows().count() == 3


def test_index_takes_a_batch_twice(spark):
    def labels(batch, *pairs):
        got = exact.label(spark.createDataFrame(list(pairs), "doc_id bigint, text string"), index, batch)
        return sorted((r.doc_id, r.keep_id, r.kept) for r in got.collect())

    path, tables = new_path(spark), len(spark.catalog.listTables())
    index = exact.DigestIndex(spark, path, buckets=4)
    one, two = ((1, "A"), (2, "a"), (3, "b")), ((9, "a"), (8, "c"), (7, "C"))
    first = labels("one", *one)
    assert labels("one", *one) == first == [(1, 2, False), (2, 2, True), (3, 3, True)]
    second = labels("two", *two)
    assert labels("two", *two) == second == [(7, 8, False), (8, 8, True), (9, 2, False)]
    assert sorted((r.owner, r.batch) for r in index.rows().collect()) == [(2, "one"), (3, "one"), (8, "two")]
    index.drop()
    index = exact.DigestIndex(spark, path, buckets=4)  # another session finds the batches of the folder
    assert labels("three", (5, "B"), (6, "d")) == [(5, 3, False), (6, 6, True)]
    index.drop()
    exact.label(spark.createDataFrame(list(one), "doc_id bigint, text string")).collect()
    assert len(spark.catalog.listTables()) == tables


def test_near(spark, folder):
    same(spark, "op3_ngram_join", folder, ["doc_id", "n_shingles", "component_id"], brute.near(rows(spark, folder), 3, 90))


def test_near_wide(spark, folder):
    got = ngram_join.link(spark.read.parquet(f"{folder}/documents.parquet"), 5, 80).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == Counter(brute.near(rows(spark, folder), 5, 80))


@pytest.mark.parametrize("percent", [80, 90])
def test_sketches_miss_no_link(percent):
    r = np.random.default_rng(percent)
    bands = ngram_join.Bands(percent)
    for size in [*range(1, 60), 100, 333, 2000]:
        base = np.unique(r.integers(0, 2**64, size, dtype="uint64"))
        for _ in range(20):
            gone, new = (int(x) for x in r.integers(0, max(1, int(size * (100 - percent) / 100)) + 1, 2))
            other = np.unique(np.concatenate((r.permutation(base)[gone:], r.integers(0, 2**64, new, dtype="uint64"))))
            both = len(np.intersect1d(base, other))
            if len(other) and 100 * both >= percent * (len(base) + len(other) - both):
                assert np.intersect1d(ngram_join.sketch_keys(base, bands), ngram_join.sketch_keys(other, bands)).size
                assert ngram_join.hamming(ngram_join.parity(base), ngram_join.parity(other)) <= len(base) + len(other) - 2 * both


@pytest.mark.parametrize("percent", [80, 90])
def test_sketches_without_some_keys_miss_no_link(percent):
    """What a set may leave out, by an order of the keys alone, is never all that it has in common with one that links."""
    r = np.random.default_rng(percent)
    bands, left_out = ngram_join.Bands(percent), 0

    def kept(hashes):
        keys, left = ngram_join.sketches(hashes, bands)
        assert np.array_equal(keys, ngram_join.sketch_keys(hashes, bands))
        by_parity = [np.sort(keys[keys % 2 == odd]) for odd in (0, 1)]
        return np.concatenate([some[n:] for some, n in zip(by_parity, left)]), sum(left)

    for size in [*range(1, 60), 100, 333, 2000]:
        base = np.unique(r.integers(0, 2**64, size, dtype="uint64"))
        for _ in range(20):
            most = size * (100 - percent) // 100
            other = np.unique(np.concatenate((r.permutation(base)[int(r.integers(0, most + 1)) :], r.integers(0, 2**64, int(r.integers(0, most + 1)), dtype="uint64"))))
            both = len(np.intersect1d(base, other))
            if 100 * both >= percent * (len(base) + len(other) - both):
                (x, n), (y, _) = kept(base), kept(other)
                assert np.intersect1d(x, y).size
                left_out += n
    assert left_out > 50


def test_texts_with_a_common_line_hardly_meet(spark, tmp_path, monkeypatch):
    """A line in every text makes words of few shingles, each of which alone would bring very many texts together."""
    r, tried = np.random.default_rng(8), []
    line = " ".join(f"c{i}" for i in range(20))
    texts = [f"{line} " + " ".join(f"w{w}" for w in r.integers(0, 5000, 180 + i % 40)) for i in range(400)]
    texts += [f"{x} end" for x in texts[::10]]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    verified = ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda pairs, *more: (tried.append(pairs.count()), verified(pairs, *more))[1])
    got = ngram_join.link(spark.read.parquet(f"{tmp_path}/documents.parquet"), 5, 80).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == Counter(brute.near([{"doc_id": i, "text": x} for i, x in enumerate(texts)], 5, 80))
    assert sum(tried) < 200, tried


@pytest.mark.parametrize("percent", [80, 90])
def test_deltas_miss_no_link(percent):
    r = np.random.default_rng(percent)

    def changed(base, most):
        gone, new = (int(x) for x in r.integers(0, max(1, int(len(base) * most)) + 1, 2))
        return np.unique(np.concatenate((r.permutation(base)[gone:], r.integers(0, 2**64, new, dtype="uint64"))))

    seen = Counter()
    for size in [*range(2, 60), 100, 333]:
        for _ in range(60):
            leader = np.unique(r.integers(0, 2**64, size, dtype="uint64"))
            x = changed(leader, r.choice([0.05, 0.2, 0.6]))
            y = changed(x, (100 - percent) / 100) if len(x) else x
            if not len(y):
                continue
            order = ngram_join.Order(r.permutation(np.union1d(x, leader))[: r.integers(0, size)])
            assert np.array_equal(np.sort(order.of(x)), x)
            both, (ax, lx, nx, *fx), (ay, ly, ny, *fy) = len(np.intersect1d(x, y)), *(ngram_join.delta(z, leader, percent, order) for z in (x, y))
            if 100 * both < percent * (len(x) + len(y) - both) or nx and ny:
                continue
            if np.intersect1d(fx[0], fy[0]).size:
                seen["added"] += 1
            else:
                seen["lacking"] += 1
                assert np.intersect1d(fx[1], fy[1]).size
                assert all((ax + ay + abs(lx - ly)) * percent <= len(z) * (100 - percent) for z in (x, y))
    assert seen["added"] > 100 and seen["lacking"] > 100


def test_order_puts_frequent_shingles_last():
    frequent = np.array([9, 2, 5], "uint64")
    assert ngram_join.Order(frequent).of(np.array([1, 2, 4, 5, 9], "uint64")).tolist() == [1, 4, 5, 2, 9]


@pytest.mark.parametrize("family", [60, 180])
def test_near_family_that_does_not_link(spark, tmp_path, monkeypatch, family):
    """Texts that differ from one in their own places, too much to link with it or with each other, but for one in ten that has a copy."""
    r, tried = np.random.default_rng(family), []
    texts = [" ".join(f"t{i}" for i in range(200))]
    for i in range(family):
        words = texts[0].split()
        for k in r.choice(198, 5, replace=False):
            words[k] = f"x{i}_{k}"
        texts.append(" ".join(words))
        if i % 10 == 0:
            texts.append(" ".join([*words, "end"]))
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    verified = ngram_join._verified
    monkeypatch.setattr(ngram_join, "_verified", lambda pairs, *more: (tried.append(pairs.count()), verified(pairs, *more))[1])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = ngram_join.link(docs).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == Counter(brute.near([{"doc_id": i, "text": x} for i, x in enumerate(texts)], 3, 90))
    assert sum(tried) < 6 * len(texts), tried


def _kept_columns(spark, paths):
    return [c for path in paths if path_exists(spark, path) for c in spark.read.parquet(path).columns]


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def _left(spark, before):
    """Shuffle files that are there besides those before, when those that go have had time to."""
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return left


def test_freed_shuffles(spark):
    def stored_sums():
        return materialize(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count())

    before = _shuffle_files(spark)
    with freed_shuffles(spark), freed_shuffles(spark):
        rows_ = stored_sums()
        assert spark.range(100).selectExpr("id % 7 AS k").distinct().count() == 7
    assert not _left(spark, before) and rows_.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")
    with recorded_paths() as paths:
        rows_ = stored_sums()
    release(rows_)
    release(spark.read.parquet(f"{SMALL}/documents.parquet"))  # not its own: stays
    assert not path_exists(spark, paths[0]) and path_exists(spark, f"{SMALL}/documents.parquet")


def test_near_leaves_no_large_intermediates(spark):
    before = _shuffle_files(spark)
    with recorded_paths() as paths:
        got = ngram_join.link(spark.read.parquet(f"{SMALL}/documents.parquet"), 5, 80)
    assert not {"keys", "hashes", "first_added"} & set(_kept_columns(spark, paths)) and not _left(spark, before)
    assert got.count() == 200 == got.filter("component_id is not null").count()


def test_near_pairs_go_in_parts(spark):
    """Many pairs of few sets: each is compared once, and no part has many more pairs than half of the sets."""
    hashes = {v: np.arange(v, 50, dtype="uint64") for v in range(8)}
    sets = materialize(spark.createDataFrame([(v, bytearray(h.tobytes())) for v, h in hashes.items()], "v bigint, hashes binary"))
    pairs = materialize(spark.createDataFrame([(a, b) for a in range(8) for b in range(a + 1, 8)], "a bigint, b bigint"))
    keep = ngram_join._kept(lambda x, y: len(x) - len(y) == 16)
    got = ngram_join._with_sets(pairs, sets, keep, "a bigint, b bigint")
    assert sorted(map(tuple, got.collect())) == [(a, a + 2) for a in range(6)]
    everything = ngram_join._with_sets(pairs, sets, ngram_join._kept(lambda x, y: True), "a bigint, b bigint")
    assert sorted(map(tuple, everything.collect())) == sorted(map(tuple, pairs.collect()))


def test_mix(spark, folder):
    docs = rows(spark, folder)
    sizes, targets = brute.mix_targets(docs)
    got = QUERIES["op4_source_mix"](spark, folder).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((d["doc_id"], len(brute.words(d["text"]))) for d in docs)
    assert all(r.taken <= 3 * r.size for r in got)
    by = defaultdict(set)
    for r in got:
        by[r.source_size].add(round(r.target, 6))
    assert {(n, round(targets[s], 6)) for s, n in sizes.items()} == {(n, t) for n, ts in by.items() for t in ts}
    total = sum(sizes.values())
    assert abs(sum(r.taken for r in got) - total) <= 0.01 * total + 64
    again = QUERIES["op4_source_mix"](spark, folder).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mix_is_even_everywhere(spark):
    """Every stretch of the schedule holds the sources in their shares."""
    mixed, table, _ = mixing.mix(spark.read.parquet(f"{SMALL}/documents.parquet"), block_words=64)
    source = {r.row_id: r.source for r in table.select("row_id", "source").collect()}
    parts = sorted((r.slot, source[r.row_id], r.length) for r in mixed.collect())
    slots = max(s for s, _, _ in parts) + 1
    halves = [Counter(), Counter()]
    for slot, s, n in parts:
        halves[2 * slot >= slots][s] += n
    for s in set(halves[0]) | set(halves[1]):
        a, b = halves[0][s], halves[1][s]
        assert abs(a - b) <= 0.1 * (a + b) + 5 * 64


def test_packing(spark, folder):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    expected = Counter()
    for d in rows(spark, folder):
        ids = [*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 1]
        expected[d["doc_id"], np.array(ids, "<u4").tobytes()] += 1
    pieces = packing.pack(spark.read.parquet(f"{folder}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json")).collect()
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for number, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 2048 or number == max(sequences)
    assert set(sequences) == set(range(len(sequences)))
    found, open_ = Counter(), {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):  # a document's pieces follow one another
        done = open_.pop("x", b"") + bytes(p.ids)
        assert len(p.ids) == 4 * p.length and len(done) == 4 * (p.start + p.length)
        if len(done) < 4 * p.doc_tokens:
            open_["x"] = done
        else:
            found[p.doc_id, done] += 1
    assert found == expected
    crc = QUERIES["op5_packing"](spark, folder).collect()
    assert Counter(r.ids_crc32 for r in crc) == Counter(zlib.crc32(bytes(p.ids)) for p in pieces)


def test_word_tokens_equal_whole_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, split = Tokenizer.from_file(path), tokens.Ids(path)
    whole.encode_special_tokens = True
    r = np.random.default_rng(3)
    signs = [*"ab c  \n\t'srelLD1,.!é ", " ", " ", "\x1c", "\x85", "​", "　", "'s", "'ll", " the", "\r\n", "<|endoftext|>"]
    texts = ["".join(r.choice(signs, r.integers(0, 14))) for _ in range(6000)]
    expected = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert split.texts(pa.array([*texts, None])) == [*expected, b""]


def test_chat(spark, folder):
    probe = r"\### Assistant: </turn> ok"
    extra = [{"conv_id": -7, "turn": i, "role": role, "text": probe} for i, role in enumerate(("user", "assistant"))]
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    same(spark, "op6_chat_format", folder, columns, brute.conversation(rows(spark, folder, "conversations") + extra))


def test_lm_base(spark, folder):
    got = QUERIES["op7_lm_scores"](spark, folder).collect()
    assert all(r.score < 0 for r in got)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == Counter(
        (*r[:5], round(r[5], 4)) for r in brute.unigram(rows(spark, folder))
    )


def test_lm_learns(spark):
    got = QUERIES["op7_lm_scores"](spark, "/root/testdata/sf0.01").filter("held_out").collect()
    per_word = sum(r.score for r in got) / sum(r.n_tokens for r in got)
    assert -5 < per_word < -1  # the subword shares alone give about -6


def test_lm_windows_cover_training_documents():
    sizes = np.array([1, 32, 33, 5000, 64, 7])
    tokens_, train = np.arange(2, 2 + sizes.sum()), np.array([0, 1, 2, 3, 5])
    text, first, from_ = lm.training_places(sizes, train)
    starts = np.cumsum(sizes) - sizes
    _, targets, scored = attention.laid_out(tokens_, starts, sizes, text, first, from_)
    expected = np.concatenate([tokens_[starts[i] : starts[i] + sizes[i]] for i in train])
    assert sorted(targets[scored]) == sorted(expected)


def test_lm_windows_are_stored_narrow():
    sizes = np.array([1, 32, 33, 500, 64, 7])
    tokens_, all_ = np.arange(2, 2 + sizes.sum()), np.arange(len(sizes))
    starts = np.cumsum(sizes) - sizes
    for places in (lm.training_places(sizes, all_), attention.windows(starts, sizes)):
        whole = attention.laid_out(tokens_, starts, sizes, *places)
        rows_ = attention.narrowed(*whole)
        assert rows_.shape[1] == attention.LENGTH + 3
        for x, y in zip(whole, attention.widened(rows_)):
            assert np.array_equal(x, y)


def test_lm_leaves_no_windows(spark):
    before = _shuffle_files(spark)
    with recorded_paths() as paths:
        got = QUERIES["op7_lm_scores"](spark, SMALL)
    assert "window" not in _kept_columns(spark, paths) and not _left(spark, before)
    assert got.count() == 200


def test_lm_trains_on_all_windows_of_a_large_corpus(spark):
    text = " ".join(f"w{i % 97}" for i in range(40_000))
    blocks = lm.encode(spark.createDataFrame([(0, text)], "doc_id bigint, text string"), public_tokenizers.path("byte_bpe_50k.json"))
    slots = lm.Slots(lm._subword_counts(blocks))
    counts, slots.counts = slots.counts.sum(), slots.counts * 10_000  # as if it were a small part of a large corpus
    assert lm._training_windows(blocks, slots).count() == -(-counts // attention.LENGTH) and lm.ROUNDS == 3


def test_tokenizer_gets_few_strings_at_a_time():
    class Counting:
        def encode_batch_fast(self, strings, add_special_tokens):
            sizes.append(len(strings))
            return inner.encode_batch_fast(strings, add_special_tokens=add_special_tokens)

    sizes, ids_ = [], tokens.Ids(public_tokenizers.path("byte_bpe_50k.json"))
    inner, ids_.tokenizer = ids_.tokenizer, Counting()
    words = [f" w{i}" for i in range(20_000)]
    assert ids_.of(words) == ids_.of(words)[:] and sum(sizes) == len(words) and max(sizes) <= 8192
    assert ids_[" w19999"] == np.array(inner.encode(" w19999", add_special_tokens=False).ids, "<u4").tobytes()


def test_lm_blocks_are_read_in_pieces(monkeypatch):
    """Pieces are whole documents, hold what the block holds, and only a long document makes a long piece."""
    texts = ["", None, "the cat " * 3, "a", "Word " * 200, "the cat sat", "", "b c d"] * 5
    row = lm._block(0, pa.array(range(len(texts))), pa.array(texts), public_tokenizers.path("byte_bpe_50k.json"))
    row |= {"ids": row["ids"].to_pylist(), "held": row["held"].tolist(), "lengths": row["lengths"].tolist()}
    (whole,) = lm._pieces(row)
    monkeypatch.setattr(lm, "PIECE", 20)
    parts = list(lm._pieces(row))
    assert len(parts) > 5 and max(len(x["codes"]) for x in parts) < 20 + 201
    for name, values in whole.items():
        assert np.array_equal(values, np.concatenate([x[name] for x in parts]))
    assert whole["ids"] == list(range(len(texts))) and whole["sizes"].sum() == len(whole["subwords"])


def test_quality(spark, folder):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    same(spark, "op8_quality_rules", folder, columns, brute.quality_base(rows(spark, folder)))
    assert not [r for r in QUERIES["op8_quality_rules"](spark, folder).collect() if r.base_failed and r.kept]


def test_quality_distances_equal_plain_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    got = quality.measure(docs, docs.columns).select(*docs.columns, "quality.*").collect()
    for r, want in zip(got, brute.quality_distances([r.asDict() for r in got], quality)):
        assert [r.class_distance, r.common_distance] == [None if x is None else pytest.approx(x, abs=1e-6) for x in want]
        far = (want[0] or 0) > quality.MAX_CLASSES or (want[1] or 0) > quality.MAX_COMMON
        assert r.kept == (not r.base_failed and not far)


def test_quality_counts_short_words(spark):
    df = spark.sql("SELECT array('b', 'a', 'b', 'c', 'b') w, array('b', 'x') common UNION ALL SELECT array(), array('b') UNION ALL SELECT array('a'), array()")
    short = quality._runs(F.sort_array("w"))
    got = {r.n: (r.short, r.shares) for r in df.select(F.size("w").alias("n"), short.alias("short"), F.when(F.size("w") > 0, quality._common_shares(short, df.common, F.size("w"))).alias("shares")).collect()}
    assert got == {5: ([("a", 1), ("b", 3), ("c", 1)], [0.6, 0.0, 0.4]), 0: ([], None), 1: ([("a", 1)], [1.0])}


def test_quality_distance(spark):
    df = spark.sql("SELECT array(0.5D, 0.5D, 0D) p, array(0.5D, 0.5D, 0D) q UNION ALL SELECT array(1D, 0D), array(0D, 1D) UNION ALL SELECT array(1D, 0D), array(0.5D, 0.5D)")
    got = sorted(r.d for r in df.select(quality.distance(df.p, df.q).alias("d")).collect())
    assert got == pytest.approx([0, 0.5579230452841438, 1])


def test_quality_keeps_clean_and_rejects_junk(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = [r for r in QUERIES["op8_quality_rules"](spark, "/root/testdata/sf0.01").collect() if not r.base_failed and r.doc_id in labels]
    clean = [r.kept for r in got if labels[r.doc_id] == 1]
    assert sum(clean) == len(clean)


def test_quality_reference_counts_copies_of_junk_once(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang").filter("lang = 'en'")
    labels = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r.quality == 1}
    long = min((r.text for r in docs.collect() if r.doc_id in labels and len(r.text) > 1500), key=len)
    junk = " #*$ ".join(long.split())

    def measured(copies):
        more = spark.createDataFrame([(10**9 + i, junk, "en") for i in range(copies)], docs.schema)
        return {r.doc_id: r for r in quality.measure(docs.union(more)).select("doc_id", "quality.*").collect()}

    one, many = measured(1), measured(docs.count() // 2)
    assert all(r == many[i] for i, r in one.items())  # a third of the rows moves no distance
    assert all(r.kept for i, r in many.items() if i in labels and not r.base_failed)
    assert not any(r.kept for i, r in many.items() if i >= 10**9)


def test_shards(spark, folder):
    got = QUERIES["op9_kd_shards"](spark, folder).collect()
    expected = Counter()
    for d in rows(spark, folder):
        data = (d["text"] or "").encode()
        expected[d["doc_id"], len(data) + 16, zlib.crc32(data)] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == expected
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append(r)
    assert set(shards) <= set(range(40))
    for members in shards.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
    largest, mean = max(r.size for r in got), sum(r.size for r in got) / 40
    assert max(sum(r.size for r in m) for m in shards.values()) <= 1.1 * mean + 2 * largest


def test_shards_equal_exact_tree(spark):
    """Every cut lies within one document of the exact weighted quantile of the widest dimension."""
    folder, n = "/root/testdata/sf0.01", 8
    docs = kdtree.stored(spark.read.parquet(f"{folder}/documents.parquet"))
    scaled, _, total = kdtree._scaled(kdtree.measure(docs, ("doc_id",), ("source", "lang")), 4)
    points = [(tuple(r[f"d{i}"] for i in range(4)), r["size"], (r["doc_id"], r["text_crc32"])) for r in scaled.collect()]

    def cut(members, first, k):
        if k == 1:
            return {first: members}
        extent = [max(p[0][i] for p in members) - min(p[0][i] for p in members) for i in range(4)]
        dim = max(range(4), key=lambda i: (extent[i], -i))
        goal, run, left = sum(p[1] for p in members) * ((k + 1) // 2) / k, 0, []
        ranked = sorted(members, key=lambda p: p[0][dim])
        for p in ranked:
            if run + p[1] / 2 > goal:
                break
            run += p[1]
            left.append(p)
        return cut(left, first, (k + 1) // 2) | cut(ranked[len(left) :], first + (k + 1) // 2, k // 2)

    expected = {p[2]: shard for shard, members in cut(points, 0, n).items() for p in members}
    got = kdtree.shard(docs, shards=n).collect()
    largest = max(p[1] for p in points)
    differ = sum(r.size for r in got if expected[r.doc_id, r.text_crc32] != r.shard)
    assert differ <= 3 * 7 * largest and differ < 0.05 * total  # seven cuts


def test_many_shards_by_bytes(spark):
    docs = spark.range(40_000).selectExpr("id doc_id", "repeat('x', int(50 + id % 101)) text", "'s' source", "'en' lang")
    target = 40_000 * 116 // 2000
    got = kdtree.shard(docs, target_bytes=target).groupBy("shard").agg({"size": "sum", "slot": "max", "*": "count"}).collect()
    assert sum(r["count(1)"] for r in got) == 40_000 and all(r["max(slot)"] == r["count(1)"] - 1 for r in got)
    assert abs(len(got) - 2000) <= 2 and max(r["sum(size)"] for r in got) <= 1.2 * target + 2 * 166


def test_shards_spread_repeated_rows(spark, tmp_path):
    docs = [(i, "x" * (900 + i % 200), "a", "en") for i in range(4000)] + [(7, "y" * 1000, "a", "en")] * 2000
    spark.createDataFrame(docs, "doc_id bigint, text string, source string, lang string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op9_kd_shards"](spark, str(tmp_path)).collect()
    sums = Counter()
    for r in got:
        sums[r.shard] += r.size
    assert len(got) == 6000 and max(sums.values()) <= 1.1 * sum(sums.values()) / 40 + 2 * 1116


def test_html_held_out():
    model = html_content.trained()
    wrong = total = 0
    for page in labelled_pages(200, seed=99):
        parents, tags, attributes, texts = html_content.parse(page)
        odds = model.marginals(parents, tags, html_content.features(parents, tags, attributes, texts))
        for node in {n for n, t in texts if t and t.strip()}:
            total += 1
            wrong += (odds[node] > 0) != ("data-y" in attributes[node])
    assert wrong / total < 0.08


@pytest.mark.parametrize(
    "piece",
    ["<svg viewBox='0 0 1 1'/>", "<math/>", "<svg><title/><style/><path d='M0'/></svg>", "<object data=x>", "<select>", "<video src=x>", "<canvas>", "<audio>", "<template>", "<svg>", "<textarea>", "<iframe src=x>"],
)
def test_html_elements_cut_nothing(piece):
    long = "This sentence belongs to the main article and it is long enough to be told from a menu. " * 4
    page = f"<html><body><article><p>{long}first</p>{piece}<p>{long}last</p></article></body></html>"
    got = " ".join(html_content.trained(300).extract(page).split())
    assert got.endswith(f"{long}last") and f"{long}first" in got


PROSE = "Long prose with many words goes on here and tells the story. " * 6
KEPT = " ".join(PROSE.split())


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article><p>{PROSE}</p><ul><li><a>Ref one</a></li><li><a>Ref two</a></li></ul></article>", f"{KEPT}\nRef one\nRef two"),
        (f'<div class="post"><h2>Head</h2><p>{PROSE}</p><p>{PROSE}</p><div class="comments"><div class="comment"><p>I think so</p></div></div></div>', f"Head\n{KEPT}\n{KEPT}"),
        (f'<div class="story-body"><p>{PROSE}</p><p>{PROSE}</p><div id="comments"><p>Nice one</p><p>Bad</p></div></div>', f"{KEPT}\n{KEPT}"),
        (f"<table><tr><td><a>a</a> <a>b</a></td><td><p>{PROSE}</p><p>{PROSE}</p></td></tr></table>", f"{KEPT}\n{KEPT}"),
        (f"<nav><ul><li><a>Home</a></li></ul></nav><div><h1>T</h1><p>{PROSE}</p><aside>Buy now</aside><p>{PROSE}</p></div>", f"T\n{KEPT}\n{KEPT}"),
    ],
)
def test_html_keeps_articles_around_other_parts(page, text):
    assert html_content.trained().extract(page) == text


@pytest.mark.parametrize(
    "page",
    ["<x" * 50_000, "<div>" * 20_000, "<b>" * 16_000 + "</i>" * 16_000, "<i><div>" + "<b>" * 12_000 + "</i>" * 12_000, '<a "' * 25_000 + ">", "<a '\"" * 20_000 + ">", "<script" + "</script" * 12_000, "<!" * 50_000],
)
def test_html_parses_in_linear_time(page):
    began = time.process_time()
    html_content.parse(page)
    assert time.process_time() - began < 1


def test_html_formulas_stay_in_their_line():
    long = "This sentence belongs to the main article and it is long enough to be told from a menu. " * 4
    page = f"<article><p>{long}where <math><mi>x</mi><mo>+</mo><mi>y</mi></math> holds <svg><path d='M0'/></svg> here</p><object><p>{long}fallback</p></object><script>var a;</script></article>"
    assert html_content.trained(300).extract(page) == f"{long}where x+y holds here\n{long}fallback"


def test_html(spark, folder):
    got = QUERIES["op10_html_content"](spark, folder).collect()
    assert len(got) == len(rows(spark, folder, "pages")) and all(r.n_chars == len(r.text) for r in got)


def test_html_articles(spark):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    for r in QUERIES["op10_html_content"](spark, "/root/testdata/sf0.01").collect():
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(filter(None, blocks))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    got = QUERIES[name](spark, empty)
    assert got.count() == (1 if name == "op6_chat_format" else 0)  # its own conversation


@pytest.mark.parametrize("kind", ["small", "edge", "empty"])
def test_pipeline(spark, request, kind, tmp_path):
    folder = SMALL if kind == "small" else request.getfixturevalue(kind)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for i, (name, work) in enumerate(corpus_pipeline.STAGES):
        work(spark, docs, folder).write.parquet(str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        if name != "packing":
            assert docs.columns == columns
        seen[name] = ([r.asDict() for r in before.collect()], [r.asDict() for r in docs.collect()])
    kept = {name: Counter(r["doc_id"] for r in after) for name, (_, after) in seen.items()}
    before, after = seen["quality_rules"]
    good = Counter(r[0] for r in brute.quality_base(before) if not r[-1])
    assert not kept["quality_rules"] - good
    before, after = seen["exact_dedup"]
    assert len(after) == len({(r["text"] or "").translate(brute.LOWER) for r in before})
    assert kept["exact_dedup"] == Counter({r[1] for r in brute.exact(before)})
    before, after = seen["near_dedup"]
    components = {}
    for r, c in zip(before, brute.near(before, 5, 80)):
        components[r["doc_id"]] = c[2]
    assert Counter(components[i] for i in kept["near_dedup"]) == Counter(set(components.values()))
    before, after = seen["source_mix"]
    sizes, targets = brute.mix_targets(before) if before else ({}, {})
    assert abs(sum(len(brute.words(r["text"])) for r in after) - sum(sizes.values())) <= 0.01 * sum(sizes.values()) + 64
    before, after = seen["packing"]
    assert sum(r["length"] for r in after) == sum(r["doc_tokens"] for r in after if r["start"] == 0)
    assert len(before) == sum(r["start"] == 0 for r in after)


def test_pipeline_run(spark):
    assert corpus_pipeline.run(spark, SMALL).count() > 0

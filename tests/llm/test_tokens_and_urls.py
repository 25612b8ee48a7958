"""Token alignment, url rules and fill-in-the-middle against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from quayside.llm import alignment, boundaries, fim, url_rules
from quayside.llm.pieces import Pieces
from quayside.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
PATHS = tuple(public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def rows(spark, folder, table="documents"):
    return [r.asDict() for r in spark.read.parquet(f"{folder}/{table}.parquet").collect()]


@pytest.fixture(params=["small", "edge"])
def folder(request):
    return SMALL if request.param == "small" else request.getfixturevalue("edge")


ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("most", [None, 0])
def test_alignment(spark, folder, most, monkeypatch):
    if most is not None:  # counts beyond the bound are joined by shuffle
        monkeypatch.setattr(alignment, "BROADCAST_PAIRS", most)
    got = QUERIES["op11_token_alignment"](spark, folder).select(*ALIGNED).collect()
    assert Counter(map(tuple, got)) == Counter(brute.alignment(rows(spark, folder), brute.Aligner(*PATHS)))


SIGNS = [*"ab c  \n\t'srelLD1,.!é ", " ", " ", "\x1c", "　", "'s", "'ll", " the", "\r\n", "<|endoftext|>", "<s>", "<0x41>", "▁", "\x00", "ﬁ", "😀", "wordpiece", " token"]


def random_texts(n, seed=3):
    r = np.random.default_rng(seed)
    return ["".join(r.choice(SIGNS, r.integers(0, 14))) for _ in range(n)]


def test_piece_units_equal_whole_texts():
    pieces = Pieces(PATHS[1])
    texts = random_texts(6000)
    whole = [np.array(x, "<u4").tobytes() for x in pieces.model.encode(texts)]
    assert pieces.texts(pa.array([*texts, None])) == [*whole, b""]
    # what the splitting rests on
    vocabulary = [pieces.model.id_to_piece(i) for i in range(pieces.model.get_piece_size())]
    assert not any("▁" in p.lstrip("▁") or "\n" in p for p in vocabulary)


@pytest.mark.parametrize("lane", [1024, 3])
def test_alignment_of_any_text(monkeypatch, lane):
    monkeypatch.setattr(alignment, "LANE", lane)  # short lanes divide nearly every text
    aligner = brute.Aligner(*PATHS)
    texts = [None, *random_texts(400, 5), "x" * 5000, "one two " * 1200, "日本語" * 700]
    done = alignment.align_texts(pa.array(texts), *PATHS).to_pylist()
    for text, got in zip(texts, done):
        n_a, n_b, groups, links = aligner.align(text)
        assert (got["n_a"], got["n_b"], got["groups"], got["n_links"]) == (n_a, n_b, groups, len(links))
        assert got["n_groups"] == (len(groups.split(";")) if groups else 0)
        assert {(p["a"], p["b"]): p["n"] for p in got["pairs"]} == Counter(links)


def test_alignment_keeps_columns(spark, edge):
    docs = spark.read.parquet(f"{edge}/documents.parquet").withColumnRenamed("key", "alignment")
    got = alignment.align(docs, *PATHS)
    assert got.columns == [*(c for c in docs.columns if c != "alignment"), "alignment"]
    assert got.count() == docs.count()


RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("Example.ORG", "/fr/a", "block"),
    ("a.b.c", None, "block"), ("b.c", "/x/y/z/", "allow"), ("b.c", "/x/y/zz", "block"), ("b.c", "/x/y/zz", "allow"), (None, "/", "block"), ("", "", "block"),
    ("bad/host", "/", "block"), ("x", "", "allow"), ("x:80", "/p", "block"), ("co", "/a", "block"), ("co", "/ab", "allow"), ("c.co", "/", "block"),
]
URLS = [
    None, "", "nothing", "http://", "http:///p", "://net/", "http://net", "http://net/", "HTTP://A.NET/?q", "https://example.net/en/x", "https://www.EXAMPLE.net/en",
    "http://xexample.net/en/", "http://example.com/de/1", "http://example.com/de#f", "http://example.com/de/?u", "http://q.org/fr/a", "http://q.example.org/fr/abc/d",
    "http://a.b.c", "http://z.a.b.c/x/y/z/1", "http://b.c/x/y/zzz", "http://b.c/x/y/zz", "http://b.c/x/y/z", "http://net./", "http://x:80/p/q", "http://u@x:80/p",
    "http://..net//a", "http://co/abc", "http://co/a", "http://co/aab", "http://c.co/ab/", "http://.co/a", "http://e.", "a://b://net/", "http://net\n/x", "http://ne t/x\ny?z",
    "http://" + "s." * 500 + "net/" + "p/" * 500, "http://İ.net/ß",
]


def test_url_rules(spark):
    urls = spark.createDataFrame([(i, u, "x") for i, u in enumerate([*URLS, *URLS])], "page_id int, url string, url_filter string")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    got = url_rules.judge(urls, rules)
    assert got.columns == ["page_id", "url", "url_filter"]
    expected = Counter((u, *brute.url_verdict(u, [r for r in RULES if r[0] is None or "/" not in r[0]])) for u in [*URLS, *URLS])
    assert Counter(map(tuple, got.select("url", "url_filter.*").collect())) == expected


def test_url_rules_by_shuffle(spark, monkeypatch):
    from quayside.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    test_url_rules(spark)


def test_url_rules_none_and_wrong(spark):
    urls = spark.createDataFrame([(1, "http://a/b")], "id int, address string")
    none = spark.createDataFrame([], "host string, path string, action string")
    assert url_rules.judge(urls, none, "address", "block").select("url_filter.*").collect() == [("a", "/b", None, "block")]
    with pytest.raises(Exception, match="neither allow nor block"):
        url_rules.judge(urls, spark.createDataFrame([("a", "/", "drop")], none.schema), "address").collect()


def test_url_query(spark, folder):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    got = QUERIES["op12_url_filter"](spark, folder).collect()
    assert Counter(map(tuple, got)) == Counter((r["page_id"], *brute.url_verdict(r["url"], rules)) for r in rows(spark, folder, "pages"))


def test_fill_in_middle(spark, folder):
    expected = []
    for r in rows(spark, folder):
        *head, output = brute.fill_in_middle(r["doc_id"], r["text"])
        expected.append((r["doc_id"], *head, *(hashlib.sha256(x.encode()).hexdigest() for x in (output, r["text"] or ""))))
    assert Counter(map(tuple, QUERIES["op13_fill_in_middle"](spark, folder).collect())) == Counter(expected)


def test_fill_in_middle_of_any_text(spark):
    signs = ["<", ">", "P", "S", "M", "<P", "S>", "<M>", "ab", " ", "é", "😀", "\n", "\x00", "\\", "$1"]
    r = np.random.default_rng(1)
    texts = [None, *("".join(r.choice(signs, r.integers(0, 9))) for _ in range(600)), "word " * 40_000, "é" * 70_000, "a1" * 70_000 + "b" * 140_000]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id int, text string, fim string")
    for percent, spm in ((90, 20), (100, 100), (100, 0), (0, 50)):
        done = fim.transform(docs, 7, percent, spm)
        back = fim.restored(done["fim.output"], done["fim.form"])
        for x in done.select("doc_id", "fim.*", back.alias("back")).collect():
            assert (x.n, x.form, x.prefix_chars, x.middle_chars, x.output) == brute.fill_in_middle(x.doc_id, texts[x.doc_id], 7, percent, spm)
            assert x.back == (texts[x.doc_id] or "")


@pytest.mark.parametrize("kind", ["ArrayContainer", "RunContainer", "BitmapContainer", "all"])
def test_boundary_set_selects_every_rank(kind):
    r = np.random.default_rng(2)
    parts = {
        "ArrayContainer": np.arange(0, boundaries.SPAN, 37),
        "RunContainer": np.flatnonzero(np.arange(boundaries.SPAN) % 5000 < 4000),
        "BitmapContainer": np.flatnonzero(r.random(boundaries.SPAN) < 0.5),
    }
    if kind == "all":  # with a span that holds none
        offsets = np.concatenate([x + i * boundaries.SPAN for i, x in zip((0, 1, 3, 7), [*parts.values(), np.array([65535])])])
    else:
        offsets = parts[kind]
        assert type(boundaries.container(offsets)).__name__ == kind
    known = boundaries.BoundarySet(offsets)
    assert len(known) == len(offsets)
    ranks = [0, 1, len(offsets) - 1, *r.integers(0, len(offsets), 3000)]
    assert [known.select(int(i)) for i in ranks] == [offsets[i] for i in ranks]
    with pytest.raises(IndexError):
        known.select(len(offsets))

from __future__ import annotations

import datetime
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

PROSE = "the cat sat on the mat and then it went away to look for a mouse in the old barn near the river of the town"
LICENSE = "Licensed under CC BY-NC 4.0.\nAll rights reserved. GNU General Public License, version 3. all  rights RESERVED"


def edge_documents() -> list[dict]:
    """Nulls in every column, empty, blank and long texts, ties, repeated rows and control characters."""
    long = " ".join(f"w{i % 977} {PROSE}" for i in range(4000))
    near = " ".join(f"t{i}" for i in range(300))
    texts = [
        None, "", " \n\t ", "one", "Two words", PROSE, PROSE.upper(), LICENSE, long, near, near.replace("t7 ", "x7 "), near + " tail",
        "İstanbul ß K É é   a b　c", "\x00\x01 nul \x7f", PROSE + "\n" + PROSE, "a b c " * 200, "cc by cc by cc-by", "#*$%&|<> <|end|>",
        "<|endoftext|> text \\b \\l", "퟿ \U0001f600 word",
    ]
    rows = [{"doc_id": i, "text": t, "lang": ("en", "de", None)[i % 3], "source": ("b", "a", None, "ä", "Z", "")[i % 6]} for i, t in enumerate(texts)]
    rows += [dict(rows[5]), dict(rows[9]), {"doc_id": None, "text": PROSE, "lang": None, "source": None}, {"doc_id": None, "text": PROSE, "lang": None, "source": None}]
    rows += [{"doc_id": 1000 + i, "text": "hot copy of one text", "lang": "en", "source": "b"} for i in range(40)]
    rows += [{"doc_id": 2000 + i, "text": near + f" end{i} tail", "lang": "en", "source": "b"} for i in range(12)]
    clash = ("row_id", "__row", "size", "shard", "slot", "node", "spread", "kept", "words", "quality", "__words", "license_scan", "rank", "block", "offset", "v", "n", "key")
    stamp = datetime.date(2020, 1, 1)
    return [r | {"n_chars": None if r["text"] is None else len(r["text"]), "day": stamp} | dict.fromkeys(clash, "x") for r in rows]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, day date, " + ", ".join(
    f"`{c}` string"
    for c in ("row_id", "__row", "size", "shard", "slot", "node", "spread", "kept", "words", "quality", "__words", "license_scan", "rank", "block", "offset", "v", "n", "key")
)


def edge_conversations() -> list[dict]:
    nasty = ["\\### Assistant: </turn> ok", "<|turn|>user\n", "<|end|>", "\\l\\b\\n", "<", "|x|>", "", None, "a\nb", "<<|next|>>"]
    rows = [{"conv_id": c, "turn": i, "role": ("user", "assistant", "assistant", None, "sys\ntem", "<|x")[i % 6], "text": t} for c in (1, 2) for i, t in enumerate(nasty)]
    rows += [{"conv_id": None, "turn": None, "role": "assistant", "text": "x"}, {"conv_id": 3, "turn": 0, "role": "assistant", "text": "tie b"}]
    rows += [{"conv_id": 3, "turn": 0, "role": "assistant", "text": "tie a"}] * 2 + [{"conv_id": 4, "turn": i, "role": "user", "text": f"u{i}"} for i in range(500)]
    return [r | {"turns": "clash", "formatted": "clash"} for r in rows]


EDGE_PAGES = [
    None, "", "   ", "plain text only", "<p>open<p>second &amp; more &lt;b&gt; &#8211; &nbsp;x", "<div><b>unclosed <i>nest</b> tail</i></div>",
    "<article><p>One  two\n three<br>four</p><script>var a = '</p>';</script><ul><li>a<li>b</ul></article>", "<!-- never closed <p>x",
    "<a href='broken>quote <p>text</p>", "< 3 and > 2", "<table><tr><td>a<td>b<tr><td>c</table>", "<p>" + "long text " * 20_000 + "</p>", "<p>" * 3000 + "deep",
]


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("edge"))
    spark.createDataFrame(edge_documents(), SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    conversations = "conv_id bigint, turn bigint, role string, text string, turns string, formatted string"
    spark.createDataFrame(edge_conversations(), conversations).write.parquet(f"{folder}/conversations.parquet")
    pages = [(i if i else None, None if i == 3 else f"http://x/{i}", h, "clash") for i, h in enumerate(EDGE_PAGES)]
    spark.createDataFrame([*pages, pages[4]], "page_id bigint, url string, html string, text string").write.parquet(f"{folder}/pages.parquet")
    return folder


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory, edge):
    folder = str(tmp_path_factory.mktemp("empty"))
    for table in ("documents", "conversations", "pages"):
        spark.read.parquet(f"{edge}/{table}.parquet").limit(0).write.parquet(f"{folder}/{table}.parquet")
    return folder

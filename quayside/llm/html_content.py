"""Main text of HTML pages by a tree-structured graphical model.

Every element is a variable: content or not. Its own potential comes from its tag, the words of its class, id
and role, its amount of text and the share of it in links; a potential of parent and child says how likely
either label passes on, by the tag of the child. Sum-product messages go up from the leaves and back down from the
root; the text of elements whose marginal says content is kept. Both potentials are trained together on labelled
pages (``html_training``), by the gradient that the same messages give.

Spark maps the pages in Arrow batches; the trained weights (a few hundred numbers) travel with the task.

Defined cases: a null, empty or text-free page gives an empty text; unclosed and misnested elements are
closed by the elements that follow; an unclosed raw-text element other than a script or style is an ordinary one;
character references are decoded; white space within a block becomes one
space (a line break element is white space); blocks are joined by one line feed; equal rows give equal rows.
"""

from __future__ import annotations

import functools
import html
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.html_training import labelled_pages

NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
DELIMITER = re.compile("[>\"']")
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-z]+")
UNSEEN = re.compile(r"\bhidden\b|display\s*:\s*none", re.I)
#: Elements whose inside is raw text and never text of the page; if one is not closed, only code takes the rest of the page.
RAW = frozenset("script style title textarea iframe xmp noembed noframes".split())
CODE = frozenset(("script", "style"))
#: Elements whose inside follows the rules of XML: '/>' closes, and whatever lies in them is within a line.
FOREIGN = frozenset(("svg", "math"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img input".split())
#: Foreign elements whose text is apart from that around them.
SPACED = frozenset("text title desc mtr mtd mlabeledtr foreignobject".split())
#: Elements that end an open paragraph, and those that end an open one of their own kind.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
ENDS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table"))}
LENGTHS = (0, 25, 100, 400, 1200)
SHARES = (0.0, 0.3, 0.6)


def _tag_end(page: str, at: int, failed: set[int]) -> int:
    """Place of the first '>' outside quotes, -1 if there is none. ``failed``: quotes known to lead to none."""
    opened = []
    while found := DELIMITER.search(page, at):
        quote = found.start()
        if page[quote] == ">":
            return quote
        if quote in failed:
            break
        opened.append(quote)
        at = page.find(page[quote], quote + 1) + 1
        if not at:
            break
    failed.update(opened)
    return -1


def _tags(page: str) -> Iterator[tuple[int, int, str | None, str, bool]]:
    """Start, end, name (None: a comment or declaration), inside and whether it closes, of every tag from the last ``send`` on.

    Each part of the page is looked at a bounded number of times, whatever it holds.
    """
    at, last, size, failed = 0, page.rfind(">"), len(page), set()
    while (start := page.find("<", at)) >= 0:
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4) + 3
            at = (yield start, end if end > 2 else size, None, "", False) or (end if end > 2 else size)
        elif start > last:
            at = page.find("<!--", start)
            if at < 0:
                return
        elif page[start + 1] in "!?":
            end = page.find(">", start) + 1
            at = (yield start, end, None, "", False) or end
        elif named := NAME.match(page, start):
            end = _tag_end(page, named.end(), failed)
            if end < 0:
                end = page.find(">", named.end())
            at = (yield start, end + 1, named[1].lower(), page[named.end() : end], page[start + 1] == "/") or end + 1
        else:
            at = start + 1


class _Open:
    """The open elements; the deepest of a name is known without a walk."""

    def __init__(self):
        self.stack, self.names = [0], ["#root"]
        self.depths: dict[str, list[int]] = {}
        self.blocks = [0]

    def push(self, node: int, name: str) -> None:
        depth = len(self.stack)
        self.stack.append(node)
        self.names.append(name)
        self.depths.setdefault(name, []).append(depth)
        if name not in INLINE:
            self.blocks.append(depth)

    def deepest(self, names: tuple[str, ...]) -> int:
        return max((self.depths[n][-1] for n in names if self.depths.get(n)), default=0)

    def cut(self, depth: int) -> None:
        while depth and len(self.stack) > depth:
            self.stack.pop()
            self.depths[self.names.pop()].pop()
        while self.blocks[-1] >= len(self.stack):
            self.blocks.pop()


def parse(page: str) -> tuple[list[int], list[str], list[str], list[tuple[int, str | None]]]:
    """Parents, tags and attributes of the elements in page order, and the texts (element, text; None ends a block)."""
    parents, tags, attributes, texts = [-1], ["#root"], [""], []
    foreign, opened, at, size = [False], _Open(), 0, len(page)
    stack, unclosed = opened.stack, set()
    found = _tags(page)
    tag = next(found, None)
    while tag:
        start, end, name, inside, closing = tag
        if start > at:
            texts.append((stack[-1], page[at:start]))
        at = end
        if name:
            within = foreign[stack[-1]] or name in FOREIGN
            if within and name in SPACED:
                texts.append((stack[-1], " "))
            block = name not in INLINE and not within
            if closing:
                if block:
                    texts.append((0, None))
                depth = opened.deepest((name,))
                if name not in INLINE or depth > opened.blocks[-1]:
                    opened.cut(depth)
            else:
                if not within and (name in ENDS_P or name in ENDS):
                    ended, limits = (("p",), ("button", "td", "th", "caption")) if name in ENDS_P else (tuple(ENDS[name][0].split()), ENDS[name][1])
                    depth = opened.deepest(ended)
                    if depth > opened.deepest(limits):
                        opened.cut(depth)
                if block:
                    texts.append((0, None))
                elif name == "br":
                    texts.append((stack[-1], " "))
                slashed, skipped = inside.endswith("/"), False
                if name in RAW and name not in unclosed and not (within and slashed):
                    stop = re.compile(rf"</{name}\b", re.I).search(page, at)
                    stop_at = page.find(">", stop.end()) if stop else -1
                    if stop_at >= 0 or name in CODE:
                        at, skipped = (stop_at + 1 if stop_at >= 0 else size), True
                    else:
                        unclosed.add(name)
                if not skipped and not slashed and name not in VOID:
                    parents.append(stack[-1])
                    tags.append(name)
                    attributes.append(inside)
                    foreign.append(within)
                    opened.push(len(tags) - 1, name)
        try:
            tag = found.send(at)
        except StopIteration:
            tag = None
    if size > at:
        texts.append((stack[-1], page[at:]))
    return parents, tags, attributes, texts


def features(parents: list[int], tags: list[str], attributes: list[str], texts: list[tuple[int, str | None]]) -> list[list[str]]:
    """Names of the features of every element."""
    n = len(tags)
    length, linked = [0] * n, [0] * n
    for node, text in texts:
        if text is not None:
            length[node] += len(text) - text.count(" ") if len(text) < 40 and not text.strip() else len(text)
    for i in range(n - 1, 0, -1):
        if tags[i] == "a":
            linked[i] = length[i]
        length[parents[i]] += length[i]
        linked[parents[i]] += linked[i]
    out = []
    for i in range(n):
        names = [f"t:{tags[i]}"]
        if attributes[i]:
            for m in NAMED.finditer(attributes[i]):
                names += {f"w:{w}" for w in WORDS.findall((m[1] or m[2] or m[3] or "").lower())}
            if UNSEEN.search(attributes[i]):
                names.append("w:hidden")
        names.append(f"l:{sum(length[i] > x for x in LENGTHS)}")
        names.append(f"s:{sum(linked[i] > x * length[i] for x in SHARES)}")
        out.append(names)
    return out


def inline(parents: list[int], tags: list[str]) -> list[bool]:
    """Which elements lie within a line: inline ones, and foreign ones with all that is in them."""
    foreign = [False] * len(tags)
    for i in range(1, len(tags)):
        foreign[i] = foreign[parents[i]] or tags[i] in FOREIGN
    return [f or tag in INLINE for f, tag in zip(foreign, tags)]


Pair = list[list[float]]


class Forest:
    """The elements of many pages as arrays, for messages by level. Log potentials of (parent, child): [edge, 2, 2]."""

    def __init__(self, parents: np.ndarray, depths: np.ndarray):
        self.parents = parents
        self.levels = [np.flatnonzero(depths == d) for d in range(1, depths.max() + 1)]

    def beliefs(self, own: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log odds of every element, and the probabilities of both labels of every edge (of its child's index)."""
        n, belief, up, joint = len(own), own.copy(), np.zeros(len(own)), np.zeros((len(own), 2, 2))
        for level in reversed(self.levels):
            t, b = pair[level], belief[level]
            up[level] = np.logaddexp(t[:, 1, 1] + b, t[:, 1, 0]) - np.logaddexp(t[:, 0, 1] + b, t[:, 0, 0])
            belief += np.bincount(self.parents[level], up[level], n)
        for level in self.levels:
            t, b = pair[level], belief[level]
            c = belief[self.parents[level]] - up[level]
            logs = t.copy()
            logs[:, 1, :] += c[:, None]
            logs[:, :, 1] += b[:, None]
            weight = np.exp(logs - logs.max(axis=(1, 2), keepdims=True))
            joint[level] = weight / weight.sum(axis=(1, 2), keepdims=True)
            belief[level] = b + np.logaddexp(t[:, 1, 1] + c, t[:, 0, 1]) - np.logaddexp(t[:, 1, 0] + c, t[:, 0, 0])
        return belief, joint


class ContentModel:
    """Weights of the elements' own potentials; log potentials of (parent, child) by the child's tag, and for any other block or inline tag."""

    def __init__(self, weights: dict[str, float], pairs: dict[str | bool, Pair]):
        self.weights, self.pairs = weights, pairs

    @classmethod
    def train(cls, pages: list[str], rounds: int = 150, rate: float = 0.15, decay: float = 1e-3) -> ContentModel:
        """Both potentials together, by the gradient of the labels' likelihood: observed less expected, from the messages."""
        names: dict[str, int] = {"bias": 0}
        kinds: dict[str | bool, int] = {False: 0, True: 1}
        rows, cols, target, parents, depths, shared, special = [], [], [], [], [], [], []
        for page in pages:
            above, tags, attributes, texts = parse(page)
            base, lines = len(target), inline(above, tags)
            for i, own in enumerate(features(above, tags, attributes, texts)):
                parents.append(base + above[i] if i else base)
                depths.append(depths[base + above[i]] + 1 if i else 0)
                shared.append(int(lines[i]))
                special.append(kinds.setdefault(tags[i], len(kinds)))
                for name in ("bias", *own):
                    rows.append(len(target))
                    cols.append(names.setdefault(name, len(names)))
                target.append(int("data-y" in attributes[i]))
        rows, cols, y, parents, depths, shared, special = map(np.array, (rows, cols, target, parents, depths, shared, special))
        n, forest = len(y), Forest(parents, depths)
        sorts, sort = np.unique(np.stack((shared, special)), axis=1, return_inverse=True)
        place = 4 * sort.reshape(-1, 1) + np.arange(4)
        edge = depths > 0
        seen = np.bincount(place[edge, 2 * y[parents[edge]] + y[edge]], minlength=4 * sorts.shape[1])
        place = place.ravel()
        size, cells = len(names), 4 * len(kinds)
        w = np.zeros(size + cells)
        m, v = np.zeros_like(w), np.zeros_like(w)
        for step in range(1, rounds + 1):
            tables = w[size:].reshape(-1, 2, 2)
            belief, joint = forest.beliefs(np.bincount(rows, w[cols], n), (tables[sorts[0]] + tables[sorts[1]])[sort.ravel()])
            error = 1 / (1 + np.exp(-np.clip(belief, -500, 500))) - y
            excess = (np.bincount(place, joint.ravel(), len(seen)) - seen).reshape(-1, 4)
            by_kind = np.zeros((len(kinds), 4))
            for kind in sorts:
                np.add.at(by_kind, kind, excess)
            g = np.concatenate((np.bincount(cols, error[rows], size), by_kind.ravel()))
            g = g / n + decay * w / size
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        tables = w[size:].reshape(-1, 2, 2)
        lines = dict(zip(special.tolist(), shared.tolist()))
        pairs = {k: (tables[i] + (tables[lines[i]] if i > 1 else 0)).tolist() for k, i in kinds.items()}
        return cls({name: float(w[i]) for name, i in names.items()}, pairs)

    def marginals(self, parents: list[int], tags: list[str], own: list[list[str]]) -> list[float]:
        """Log odds that an element is content, by one pass of messages up the tree and one down."""
        weights, n, exp, log = self.weights, len(tags), math.exp, math.log
        belief = [weights["bias"] + sum(weights.get(name, 0.0) for name in names) for names in own]
        known = {k: [[exp(x) for x in row] for row in table] for k, table in self.pairs.items()}
        factors = [known.get(tag, known[line]) for tag, line in zip(tags, inline(parents, tags))]
        up = [0.0] * n
        for i in range(n - 1, 0, -1):
            f, b = factors[i], exp(max(-30.0, min(30.0, belief[i])))
            up[i] = log((f[1][1] * b + f[1][0]) / (f[0][1] * b + f[0][0]))
            belief[parents[i]] += up[i]
        for i in range(1, n):
            f, b = factors[i], exp(max(-30.0, min(30.0, belief[parents[i]] - up[i])))
            belief[i] += log((f[1][1] * b + f[0][1]) / (f[1][0] * b + f[0][0]))
        return belief

    def extract(self, page: str) -> str:
        parents, tags, attributes, texts = parse(page)
        odds = self.marginals(parents, tags, features(parents, tags, attributes, texts))
        blocks, block = [], []
        for node, text in (*texts, (0, None)):
            if text is None:
                if block:
                    joined = " ".join("".join(block).split())
                    if joined:
                        blocks.append(joined)
                    block = []
            elif odds[node] > 0:
                block.append(html.unescape(text) if "&" in text else text)
        return "\n".join(blocks)


#: Labelled pages that the model is trained on.
TRAINING_PAGES = 1500


@functools.cache
def trained(pages: int = TRAINING_PAGES) -> ContentModel:
    return ContentModel.train(labelled_pages(pages))


def extract(pages: DataFrame, model: ContentModel | None = None) -> DataFrame:
    """page_id, url and the main text of every page."""
    model = model or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                found = pa.array([model.extract(x.as_py() or "") for x in piece.column(2)], pa.string())
                yield pa.record_batch([piece.column(0), piece.column(1), found], names=["page_id", "url", "text"])

    narrow = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return narrow.mapInArrow(run, "page_id bigint, url string, text string")

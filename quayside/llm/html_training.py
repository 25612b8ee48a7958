"""Labelled pages for the content model: written by rules, so that every element's label is known.

Each page puts an article in one of many containers among menus, headers, footers, side columns, notices,
adverts, forms and comments. Content elements carry the attribute ``data-y="1"``, all others are not content.
"""

from __future__ import annotations

import random

_SYLLABLES = "ka lo mi ter on sa ver du pe ran tor el is ba nu che fi gra".split()
#: Names of classes that sites give to what is not the article.
ASIDE = (
    "ad ads advert advertisement banner promo sponsor sponsored cookie consent gdpr notice alert popup modal overlay newsletter "
    "subscribe signup share sharing social follow related recommended recommendations trending popular comment comments reply replies respond "
    "discussion disqus breadcrumb breadcrumbs menu nav navbar navigation footer foot header masthead topbar sidebar side rail widget "
    "login search toolbar pagination pager tags meta copyright legal disclaimer skip hidden print tools sitemap"
).split()
#: Names of classes that sites give to the article and its parts.
INSIDE = "content article post entry story main body text maincontent articlebody postbody entrycontent prose page paragraph lead intro".split()
NEUTRAL = "wrap wrapper container row col inner outer layout box block section grid clearfix left right center".split()


class _Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.r
        out = " ".join("".join(r.choices(_SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(low, high)))
        return out.capitalize() + r.choice((".", ".", ".", "", "!", "?"))

    def tag(self, name: str, inner: str, content: bool, classes: str = "", extra: str = "") -> str:
        mark = ' data-y="1"' if content else ""
        named = f' {self.r.choice(("class", "class", "id"))}="{classes}"' if classes else ""
        return f"<{name}{named}{extra}{mark}>{inner}</{name}>"

    def link(self, content: bool, low: int = 1, high: int = 3) -> str:
        return self.tag("a", self.words(low, high), content, extra=' href="/x"')

    def prose(self, content: bool) -> str:
        r, parts = self.r, []
        for _ in range(r.choice((1, 1, 1, 2, 3))):
            parts.append(self.words(1, r.choice((3, 12, 40, 120) if content else (3, 12, 20, 40))))
            if r.random() < 0.3:
                kind = r.choice(("b", "em", "strong", "i", "span", "code", "a", "mark"))
                parts.append(self.link(content) if kind == "a" else self.tag(kind, self.words(1, 6), content))
        return " ".join(parts)

    def part(self) -> str:
        """One part of an article."""
        r = self.r
        kind = r.choice(("p",) * 12 + ("h2", "h3", "h4", "ul", "ol", "blockquote", "pre", "figure", "table", "dl", "div", "section"))
        cls = r.choice(("",) * 6 + (r.choice(INSIDE), r.choice(NEUTRAL)))
        if kind in ("ul", "ol"):
            items = "".join(self.tag("li", self.prose(True) if r.random() < 0.7 else self.link(True, 1, 8), True) for _ in range(r.randint(1, 6)))
            return self.tag(kind, items, True, cls)
        if kind == "blockquote":
            return self.tag(kind, self.tag("p", self.prose(True), True), True, cls)
        if kind == "figure":
            return self.tag(kind, '<img src="x">' + self.tag("figcaption", self.words(2, 12), True), True)
        if kind == "table":
            rows = "".join(self.tag("tr", "".join(self.tag(r.choice(("td", "th")), self.words(1, 4), True) for _ in range(3)), True) for _ in range(r.randint(1, 4)))
            return self.tag(kind, rows, True)
        if kind == "dl":
            return self.tag(kind, self.tag("dt", self.words(1, 3), True) + self.tag("dd", self.words(3, 20), True), True)
        if kind in ("div", "section"):
            return self.tag(kind, "".join(self.tag("p", self.prose(True), True) for _ in range(r.randint(1, 3))), True, cls)
        return self.tag(kind, self.prose(True) if kind == "p" else self.words(1, 9), True, cls)

    def comments(self) -> str:
        """What readers wrote."""
        r = self.r
        inner = "".join(self.tag("div", self.tag("p", self.prose(False), False) + self.tag("span", self.words(1, 2), False), False, r.choice(("comment", "reply", "comment-body"))) for _ in range(r.randint(1, 4)))
        if r.random() < 0.3:
            inner = "".join(self.tag("p", self.prose(False), False) for _ in range(r.randint(1, 5)))
        return self.tag(r.choice(("div", "section", "ol")), inner, False, r.choice(("comments", "comments", "comment-list", "discussion", "responses comments", "respond")))

    def noise(self) -> str:
        """Something on the page that is not the article."""
        r, kind = self.r, self.r.randrange(9)
        cls = r.choice(ASIDE) + r.choice(("", "", f" {r.choice(NEUTRAL)}", f"-{r.choice(NEUTRAL)}", f" {r.choice(ASIDE)}"))
        if kind < 2:
            items = "".join(self.tag("li", self.link(False), False) for _ in range(r.randint(2, 8)))
            return self.tag(r.choice(("nav", "nav", "header", "aside", "div", "footer")), self.tag("ul", items, False), False, cls)
        if kind == 2:
            inner = self.words(2, 14) + " " + self.link(False)
            return self.tag(r.choice(("footer", "header", "footer")), self.tag("p", inner, False) if r.random() < 0.5 else inner, False, r.choice(("", cls)))
        if kind == 3:
            fields = self.tag("label", self.words(1, 4), False) + '<input name="q">' + self.tag("button", self.words(1, 2), False)
            return self.tag("form", fields + (self.tag("p", self.words(3, 12), False) if r.random() < 0.4 else ""), False, r.choice(("", cls)))
        if kind == 4:
            return self.comments()
        if kind == 5:
            return self.tag("aside", "".join(self.tag(r.choice(("p", "h3", "div")), self.prose(False), False) for _ in range(r.randint(1, 3))), False, r.choice(("", cls)))
        inner = self.prose(False) if r.random() < 0.5 else "".join(self.tag(r.choice(("p", "div", "span", "h4")), self.prose(False), False) for _ in range(r.randint(1, 3)))
        return self.tag(r.choice(("div", "div", "section", "p", "ul" if "<li" in inner else "div", "noscript" if r.random() < 0.2 else "div")), inner, False, cls)

    def page(self) -> str:
        r = self.r
        parts = ([self.tag("h1", self.words(2, 10), True)] if r.random() < 0.8 else []) + [self.part() for _ in range(r.randint(1, 14))]
        for _ in range(r.choice((0, 0, 0, 1, 2))):
            parts.insert(r.randint(1, len(parts)), self.noise())
        inner = "".join(parts)
        if r.random() < 0.2:  # references of the article
            inner += self.tag(r.choice(("ul", "ol")), "".join(self.tag("li", self.link(True, 1, 8), True) for _ in range(r.randint(1, 12))), True)
        if r.random() < 0.3:
            inner += self.comments()
        form = r.randrange(7)
        if form < 2:
            article = self.tag("article", inner, True, r.choice(("", r.choice(INSIDE))))
        elif form == 2:
            article = self.tag("main", inner, True, r.choice(("", r.choice(INSIDE))))
        elif form == 3:
            article = self.tag(r.choice(("div", "div", "section", "td")), inner, True, r.choice(INSIDE) + r.choice(("", f"-{r.choice(INSIDE)}", f" {r.choice(NEUTRAL)}")))
        elif form == 4:
            article = self.tag("main", self.tag("article", inner, True), True)
        elif form == 5:
            article = self.tag("div", inner, True) if r.random() < 0.5 else inner
        else:  # a layout table: links in one cell, the article in another
            cells = [self.tag("td", "".join(self.link(False) for _ in range(r.randint(1, 6))), False, r.choice(("", "", r.choice(ASIDE))))]
            cells.insert(r.randrange(2), self.tag("td", inner, True, r.choice(("", r.choice(INSIDE)))))
            article = self.tag("table", self.tag("tr", "".join(cells), False), False)
        before, after = ([self.noise() for _ in range(r.randint(0, 4))] for _ in range(2))
        body = "".join((*before, article, *after))
        if r.random() < 0.4:
            body = self.tag("div", body, False, r.choice(("", r.choice(NEUTRAL))))
        return f"<html><head><title>{self.words(1, 5)}</title></head><body>{body}</body></html>"


def labelled_pages(count: int, seed: int = 7) -> list[str]:
    return [_Writer(seed * 1_000_003 + i).page() for i in range(count)]

"""Main text of HTML pages by scoring the element tree.

A page becomes a tree of block elements; text lies in blocks, the stretches between the borders of block
elements. Each block passes points for its length and commas to its element's ancestors: all of them to the
nearest, half to the next, ever less further up. A container's sum is discounted by its link density. The best
container and those of its siblings that look like part of the article are kept, and all their blocks come out
in page order; menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments
are left out.

Elements that look like such a part by their tag or by a word of their class, id or role are marked, not thrown away:
they stay in the tree, get points, and the marks are then judged by these. A mark falls where the element is what
holds the article: it has an article or main element while there is none outside of marked elements; or, on a page
without one, it is a form, or has the word only as part of a longer name (``with-sidebar``, ``has-comments``), and
holds most of the page's points. The largest are judged first, so that a wrapper is freed before what lies in it.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from html import unescape

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

#: Elements whose content is no element text at all.
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html",
    "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead",
    "tr", "ul",
}
#: Elements that are never part of an article.
LEFT_OUT = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "label", "fieldset", "search"}
#: Of these, the ones that some pages wrap around everything.
WRAPPERS = {"form", "fieldset"}
#: Words of class, id or role that mark such parts in other elements.
LEFT_OUT_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice "
    "notices alert popup modal overlay newsletter subscribe signup sidebar sidebars aside nav navbar navigation menu menus "
    "breadcrumb breadcrumbs pagination pager toolbar footer masthead comment comments disqus respond reply replies discussion "
    "share sharing social related recommended recommendations widget complementary contentinfo search login form".split()
)
#: What closes an open element of the key's name when it begins.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
#: Ancestors that get points of a block.
LEVELS = 8
#: A marked element that may wrap an article is freed from this part of the page's points on, and these points at least.
MOST, LEAST_POINTS = 2 / 3, 3.0
#: Marks: by a word within a longer name, by a wrapping element, by a whole word or another element.
_WEAK, _WRAPPER, _STRONG = 1, 2, 3
_LIST_BORDER = {"ul", "ol", "dl", "table", "menu", "dir"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+>|[^>]*(?:>|\Z))", re.S
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_HIDDEN = re.compile(r"""\s(?:hidden(?=[\s/>=])|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_NAME = re.compile(r"[^\s\"']+")


class _Page:
    """The tree of one page: elements by number, and the blocks of text."""

    def __init__(self, html: str):
        self.tag, self.parent, self.out, self.mark = ["#"], [-1], [False], [0]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters inside links
        self._open, self._text, self._links, self._in_link = [0], [], 0, 0
        self._opened: Counter[str] = Counter()
        self._parse(html)

    def _end_block(self) -> None:
        if self._text:
            text = " ".join(unescape("".join(self._text)).split())
            if text:
                at = self._open[-1]
                while self.tag[at] not in BLOCK and at:
                    at = self.parent[at]
                self.blocks.append((at, text, min(self._links, len(text))))
            self._text, self._links = [], 0

    def _close_to(self, depth: int) -> None:
        for at in self._open[depth:]:
            self._in_link -= self.tag[at] == "a"
            self._opened[self.tag[at]] -= 1
        if any(self.tag[at] in BLOCK for at in self._open[depth:]):
            self._end_block()
        del self._open[depth:]

    def _find_open(self, tags: set[str], border: set[str]) -> int | None:
        if not any(self._opened[t] > 0 for t in tags):
            return None
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[depth]]
            if tag in tags:
                return depth
            if tag in border:
                return None
        return None

    def _begin(self, tag: str, rest: str) -> None:
        if self.tag[self._open[-1]] == "head" and tag not in ("meta", "link", "base", "basefont", "bgsound"):
            self._close_to(len(self._open) - 1)  # a forgotten end of the head
        if tag in BLOCK:
            # a block ends an open paragraph
            depth = self._find_open({"p"}, {"td", "th", "table", "button", "object"})
            if depth is not None:
                self._close_to(depth)
            if tag in CLOSED_BY and (depth := self._find_open(CLOSED_BY[tag], _LIST_BORDER)) is not None:
                self._close_to(depth)
            self._end_block()
        if tag == "br":
            self._text.append(" ")
        if tag in VOID:
            return
        mark = self._mark_of(tag, rest)
        # inside of a line of text a mark can't be the article's wrapper
        out = self.out[self._open[-1]] or (mark > 0 and tag not in BLOCK) or bool(rest and _HIDDEN.search(" " + rest))
        self.tag.append(tag)
        self.parent.append(self._open[-1])
        self.out.append(out)
        self.mark.append(mark)
        self._open.append(len(self.tag) - 1)
        self._opened[tag] += 1
        self._in_link += tag == "a"

    def _mark_of(self, tag: str, rest: str) -> int:
        """How an element looks like a part that is left out; 0 if it doesn't."""
        if tag in LEFT_OUT:
            return _WRAPPER if tag in WRAPPERS else _STRONG
        # a header of the page, not that of an article
        if tag == "header" and self._find_open({"article", "main"}, set()) is None:
            return _STRONG
        # comments are often articles inside the article
        named = tag not in ("html", "body", "article", "main") or (tag == "article" and self._find_open({"article"}, set()) is not None)
        if not named or "=" not in rest:
            return 0
        mark = 0
        for m in _ATTRIBUTE.finditer(rest):
            for name in _NAME.findall((m[2] or m[3] or m[4] or "").lower()):
                if name in LEFT_OUT_WORDS:
                    return _STRONG
                if not mark and not LEFT_OUT_WORDS.isdisjoint(_WORD.findall(name)):
                    mark = _WEAK
        return mark

    def _add(self, text: str) -> None:
        if text and not self.out[self._open[-1]]:
            self._text.append(text)
            if self._in_link:
                self._links += len(text)

    def _parse(self, html: str) -> None:
        at = 0
        while m := _TAG.search(html, at):
            self._add(html[at : m.start()])
            at = m.end()
            if not m[2]:
                continue  # a comment or declaration
            tag = m[2].lower()
            if m[1]:
                depth = self._find_open({tag}, set())
                if depth is not None:
                    self._close_to(depth)
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>|\Z", re.I).search(html, at)
                at = end.end()
                continue
            self._begin(tag, m[3])
        self._add(html[at:])
        self._close_to(1)
        self._end_block()

    # --- scoring ---

    def _scores(self, blocks: list[tuple[int, str, int]]) -> tuple[list[float], list[int], list[int]]:
        """Points, characters and characters inside links by element, with all below it."""
        n = len(self.tag)
        points, chars, links = [0.0] * n, [0] * n, [0] * n
        for at, text, linked in blocks:
            own = 1 + text.count(",") + min(len(text) / 100, 30)
            # text straight in a container counts there, that of a paragraph in what holds it
            up = at if self.tag[at] not in ("p", "pre", "blockquote", "li", "td", *_HEADINGS) else self.parent[at]
            share, level = 1.0, 1
            while up > 0 and level <= LEVELS:
                points[up] += own * share * (1 - linked / len(text))
                level += 1
                share = 0.5 if level == 2 else 1 / (3 * level)
                up = self.parent[up]
            chars[at] += len(text)
            links[at] += linked
        for at in range(n - 1, 0, -1):  # children have larger numbers
            chars[self.parent[at]] += chars[at]
            links[self.parent[at]] += links[at]
        return points, chars, links

    def _left_out(self) -> list[bool]:
        """Elements that lie in a marked one whose mark stands."""
        n = len(self.tag)
        if not any(self.mark):
            return [False] * n
        held = [0.0] * n  # points of all blocks in an element, not discounted by distance
        for at, text, linked in self.blocks:
            held[at] += (1 + text.count(",") + min(len(text) / 100, 30)) * (1 - linked / len(text))
        for at in range(n - 1, 0, -1):
            held[self.parent[at]] += held[at]
        marks, above = list(self.mark), [0] * n  # marks on the way to the top, own one included
        # an element's subtree is the numbers from it to its end, as elements are numbered in page order
        end = list(range(1, n + 1))
        for at in range(n - 1, 0, -1):
            end[self.parent[at]] = max(end[self.parent[at]], end[at])
        for at in range(1, n):
            above[at] = above[self.parent[at]] + (marks[at] > 0)
        articles = [at for at in range(1, n) if self.tag[at] in ("article", "main") and not marks[at]]
        over = {at: above[at] for at in articles}
        for at in sorted((at for at in range(1, n) if marks[at]), key=lambda at: (-held[at], at)):
            if 0 in over.values():
                break
            inner = articles[bisect_right(articles, at) : bisect_left(articles, end[at])]
            most = marks[at] != _STRONG and held[at] >= max(LEAST_POINTS, MOST * held[0])
            if most or any(held[a] > 0 for a in inner):
                marks[at] = 0
                for a in inner:
                    over[a] -= 1
        left_out = [False] * n
        for at in range(1, n):
            left_out[at] = marks[at] > 0 or left_out[self.parent[at]]
        return left_out

    def main_text(self) -> str:
        out = self._left_out()
        blocks = [block for block in self.blocks if not out[block[0]]]
        if not blocks:
            return ""
        points, chars, links = self._scores(blocks)
        density = lambda at: links[at] / chars[at] if chars[at] else 0.0
        score = [p * (1 - density(at)) for at, p in enumerate(points)]
        best = max(range(1, len(score)), key=lambda at: (score[at], -at), default=0)
        # an article is one whole, however its parts are nested
        at = best
        while at > 0:
            if self.tag[at] == "article":
                best = at
            at = self.parent[at]
        kept = {best}
        for at in range(1, len(score)):
            if self.parent[at] == self.parent[best] and at != best and chars[at]:
                alike = score[at] >= max(3.0, 0.2 * score[best])
                paragraph = self.tag[at] in ("p", "pre", "blockquote") and density(at) < 0.25
                title = self.tag[at] in _HEADINGS and at < best and density(at) < 0.5
                # what stands beside an article is part of it only if it is one too
                if alike if self.tag[best] == self.tag[at] == "article" else self.tag[best] != "article" and (alike or paragraph or title):
                    kept.add(at)
        inside = [False] * len(score)
        for at in range(len(score)):
            inside[at] = at in kept or (at > 0 and inside[self.parent[at]])
        if best <= 0:
            inside = [True] * len(score)
        return "\n\n".join(text for at, text, _ in blocks if inside[at])


def main_text(html: str | None) -> str:
    """Main text of one page; empty for a null or empty page and for one without text."""
    return _Page(html).main_text() if html else ""


def extract_main_text(html: Column) -> Column:
    """Main text of an html column, blocks joined by an empty line. Every page is read whole; a page that isn't
    HTML at all is one block. Null and empty pages give the empty text, repeated pages equal texts."""

    @F.pandas_udf(StringType())
    def extract(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(h) for h in pages], dtype=object)

    return extract(html)

"""Main text of web pages by composite text density (Sun, Song, Liao, 2011).

Every block element has a composite density: characters per tag, lowered by the share of link
text and link tags, relative to the page. The element whose block children have the greatest sum
of densities holds the article. The least density on its path up to the body is the threshold;
block elements outside it that are as dense as that belong to the text as well, also those
without block children. If the element lies in an `article` (the outermost one counts) or else in
a `main`, all of that is taken, however short its other paragraphs are.

Elements that are never article text by their name, role or class are left out before densities
are computed. A class or id counts only as a whole: `sidebar` or `cookie-notice`, not
`has-sidebar` or `search-page`. An element left out by role, class, style or as a form or page
header stays if it contains a main, an article of its own, or most of the page's unlinked text;
the last not if an article or main elsewhere has text. Inside the chosen subtrees nothing else is
dropped.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from pagelarder.operators.shred import _Nodes as Nodes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details",
    "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2",
    "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol",
    "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
NEVER = {
    "aside", "audio", "button", "canvas", "datalist", "dialog", "embed", "footer", "frame",
    "frameset", "head", "iframe", "input", "map", "menu", "nav", "noembed", "noframes", "noscript",
    "object", "optgroup", "option", "script", "select", "style", "svg", "template", "textarea",
    "title", "video",
}
ROLES = {
    "alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu",
    "menubar", "navigation", "search", "toolbar",
}
# Words of class and id values that name what is not the article.
SIDE_WORDS = {
    "ad", "ads", "adsense", "advert", "adverts", "advertisement", "advertising", "alert", "banner",
    "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright",
    "disqus", "donate", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar",
    "navigation", "newsletter", "notice", "notification", "pager", "pagination", "paywall", "popup",
    "promo", "promoted", "promotion", "related", "replies", "reply", "respond", "search", "share",
    "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toc",
    "toolbar", "topbar", "widget",
}
# Words that leave a side name what it is: comment-list, sidebar-primary, ad-container.
PLAIN_WORDS = {
    "area", "articles", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons",
    "container", "content", "form", "google", "header", "icon", "icons", "inner", "item", "items",
    "left", "link", "links", "list", "main", "media", "message", "outer", "overlay", "panel", "post",
    "posts", "primary", "right", "secondary", "section", "site", "slot", "text", "title", "top",
    "unit", "widgets", "wrap", "wrapper",
}
_KEEP = {"html", "body", "main", "article"}
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def side_name(name: str) -> bool:
    """Whether a class or id names a side element: side words, alone or with plain words only."""
    words = [word.lower() for word in _WORD.findall(name)]
    return any(w in SIDE_WORDS for w in words) and all(w in SIDE_WORDS or w in PLAIN_WORDS for w in words)


def side_of(tag) -> int:
    """What a start tag says: 2 for never article text, 1 for a side element, 0 for neither.

    -1 marks an article that is named as a side element, such as a comment.
    """
    name = tag.tag
    if name in NEVER:
        return 2
    attrs = dict(tag.attrs)
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return 1
    if "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return 1
    named = any(map(side_name, f"{attrs.get('class', '')} {attrs.get('id', '')}".split()))
    if name in _KEEP:
        return -1 if named and name == "article" else 0
    if name == "form" or ROLES & set(attrs.get("role", "").lower().split()):
        return 1
    return int(named)


class Page:
    """Nodes of a page without side elements; node 0 is the page itself."""

    def __init__(self, html: str, sides: dict):
        nodes = Nodes()
        nodes.add_page(html)
        n = len(nodes.tags)
        self.tag, self.text = ["#page"] + [t.tag if t else "" for t in nodes.tags], [None, *nodes.text]
        self.parent = [-1] + [p + 1 for p in nodes.parent]
        self.end = [n] + [e + 1 for e in nodes.end]
        self.out = [False] * (n + 1)
        side, inside_article = [0] * (n + 1), [False] * (n + 1)
        for i in range(1, n + 1):
            up, tag = self.parent[i], nodes.tags[i - 1]
            inside_article[i] = inside_article[up] or self.tag[i] in ("article", "main")
            if side[up] == 2:
                side[i] = 2
            elif tag is not None:
                known = sides.get(tag)
                if known is None:
                    known = sides[tag] = side_of(tag)
                # The header of a page is a side element, that of an article has its title.
                side[i] = known or int(tag.tag == "header" and not inside_article[up])
        holds = self.holders(side) if 1 in side else []
        for i in range(1, n + 1):
            self.out[i] = self.out[self.parent[i]] or side[i] == 2 or (side[i] == 1 and not holds[i])

    def holders(self, side: list[int]) -> list[bool]:
        """Whether each node contains a main, an article of its own, or most of the unlinked text."""
        n = len(self.tag)
        chars, articles = [0] * n, [0] * n
        article, in_link, own = ([False] * n for _ in range(3))
        for i in range(1, n):
            up = self.parent[i]
            in_link[i] = in_link[up] or self.tag[i] == "a"
            article[i] = article[up] or self.tag[i] == "article"
            # Articles named as sides (comments) or inside another article say nothing.
            own[i] = not side[i] and (self.tag[i] == "main" or (self.tag[i] == "article" and not article[up]))
        with_text = 0
        for i in range(n - 1, -1, -1):
            if side[i] == 2:
                continue
            if self.text[i] is not None and not in_link[i]:
                chars[i] = len("".join(self.text[i].split()))
            own[i] = own[i] and chars[i] > 0
            with_text += own[i]
            articles[i] += own[i]
            if i:
                chars[self.parent[i]] += chars[i]
                articles[self.parent[i]] += articles[i]
        holds, around = [False] * n, [0] * n
        for i in range(1, n):
            around[i] = around[self.parent[i]] + own[i]
            holds[i] = articles[i] > 0 or (2 * chars[i] > chars[0] and around[i] == with_text)
        return holds

    def densities(self) -> tuple[list[float], list[float]]:
        """Composite density of every node and the sum over its block children."""
        n = len(self.tag)
        chars, tags, link_chars, link_tags = ([0] * n for _ in range(4))
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = in_link[self.parent[i]] or self.tag[i] == "a"
        for i in range(n - 1, -1, -1):
            up = self.parent[i]
            if self.out[i]:
                continue
            if self.text[i] is not None:
                size = len("".join(self.text[i].split()))
                chars[i], link_chars[i] = size, size if in_link[i] else 0
            if up >= 0:
                chars[up] += chars[i]
                link_chars[up] += link_chars[i]
                tags[up] += tags[i] + bool(self.tag[i])
                link_tags[up] += link_tags[i] + (self.tag[i] == "a")
        share = link_chars[0] / chars[0] if chars[0] else 0.0
        density, sums = [0.0] * n, [0.0] * n
        for i in range(n - 1, 0, -1):
            if self.out[i] or not chars[i] or self.tag[i] not in BLOCKS:
                continue
            c, t, lc, lt = chars[i], tags[i] or 1, link_chars[i], link_tags[i]
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            value = (c / max(lc, 1)) * (t / max(lt, 1))
            density[i] = c / t * max(math.log(value), 0.0) / math.log(base + 1) if lc else c / t * (
                math.log(max(value, math.e)) / math.log(base + 1)
            )
            at = self.parent[i]
            while at > 0 and self.tag[at] not in BLOCKS:
                at = self.parent[at]
            sums[max(at, 0)] += density[i]
        return density, sums

    def lifted(self, i: int) -> int:
        """The outermost article around a node, else the outermost main, else the node."""
        found, at = {}, i
        while at >= 0:
            found[self.tag[at]] = at
            at = self.parent[at]
        return found.get("article", found.get("main", i))

    def chosen(self) -> list[int]:
        """Roots of the subtrees that hold the main text, in page order."""
        density, sums = self.densities()
        best = max(range(len(sums)), key=lambda i: (sums[i], i))
        if sums[best] <= 0:
            return [0]  # only bare text, or none
        body = next((i for i, tag in enumerate(self.tag) if tag == "body"), 0)
        threshold, at = math.inf, best
        while at >= 0:
            if density[at]:
                threshold = min(threshold, density[at])
            if at == body:
                break
            at = self.parent[at]
        best = self.lifted(best)
        above = set()
        at = best
        while at >= 0:
            above.add(at)
            at = self.parent[at]
        roots, i = [], 0
        while i < len(self.tag):
            if i == best:
                roots.append(i)
                i = self.end[i] + 1
            elif i not in above and density[i] and density[i] >= threshold:
                roots.append(i)
                i = self.end[i] + 1
            else:
                i += 1
        return roots

    def blocks(self, roots: list[int]) -> list[str]:
        found, parts, last = [], [], None

        def flush() -> None:
            line = " ".join("".join(parts).split())
            if line:
                found.append(line)
            parts.clear()

        block = list(range(len(self.tag)))
        for i in range(1, len(self.tag)):
            if self.tag[i] not in BLOCKS:
                block[i] = block[self.parent[i]]
        for root in roots:
            flush()
            for i in range(root, self.end[root] + 1):
                if self.out[i]:
                    continue
                if self.text[i] is None:
                    if self.tag[i] in BLOCKS:
                        flush()
                    elif self.tag[i] == "br":
                        parts.append(" ")
                    continue
                if block[i] != last:
                    flush()
                    last = block[i]
                parts.append(self.text[i])
        flush()
        return found


def main_text(html: str | None, sides: dict | None = None) -> str:
    """The blocks of the main text joined by line feeds; empty without html or text."""
    if not html:
        return ""
    page = Page(html, {} if sides is None else sides)
    return "\n".join(page.blocks(page.chosen()))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sides: dict = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = [main_text(html.as_py(), sides) for html in part.column(2)]
            sides.clear()
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages (page_id, url, html).

    A null or empty html gives an empty text; repeated rows and null ids are kept as they are. A
    page is held whole, by one task, and moves nowhere.
    """
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long"
    )

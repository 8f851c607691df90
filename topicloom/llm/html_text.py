"""HTML extraction by tree scoring.

A page becomes a light tree without scripts, styles, menus, forms, notices and the like. Each text
block earns points for its length and commas and passes them to its ancestors, less with every
step; a container's points are discounted by the share of its text that stands in links. The best
container and those of its siblings that score or read like text are kept, block by block. If the
best one stands in an article, that is kept whole, and all parts of the enclosing main (of the body,
if there is none) that pass the same rule are kept beside it: text may be split over many articles.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.texts import bound_batches

# Element names of HTML by their role here.
RAW = {"script", "style", "title", "textarea", "xmp", "noscript", "noframes", "iframe", "noembed"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main",
    "menu", "nav", "ol", "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
DROPPED = {
    "aside", "audio", "button", "canvas", "datalist", "dialog", "embed", "fieldset", "footer", "form", "head", "menu", "nav", "object", "option",
    "search", "select", "svg", "template", "video",
}
# Elements that end an open one of the same group.
ENDS_ITSELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"ul", "ol", "dl", "table", "select", "menu", "body"}
# Words of class and id names that mark what is no article, whole or as parts of a name.
UNWANTED = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs", "byline", "comment", "comments",
    "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "hidden", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "notices", "overlay", "pager", "pagination", "popup", "promo", "related", "replies", "respond", "search", "share", "sharing",
    "sidebar", "signup", "skyscraper", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form", "toolbar"}
START = {"article": 10, "main": 10, "div": 5, "section": 5, "pre": 3, "td": 3, "blockquote": 3, "ol": -3, "ul": -3, "dl": -3, "dd": -3, "dt": -3, "li": -3, "h1": -5, "h2": -5, "h3": -5, "h4": -5, "h5": -5, "h6": -5, "th": -5}

# Groups: closing mark, name and attributes of a tag; text; a "<" that opens nothing.
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>|([^<]+)|(<)", re.S)
NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
SPLIT = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Tree:
    """Nodes in page order (so a subtree is a run of nodes) and the text blocks of those not dropped."""

    def __init__(self, html: str):
        self.tag, self.parent, self.dropped, self.end = ["html"], [-1], [False], [0]
        self.blocks: list[tuple[int, str, int]] = []  # (node, text, characters in links)
        self._open, self._text, self._linked, self._in_link = [0], [], 0, 0
        self._read(html)
        self._flush()
        while self._open:
            self.end[self._open.pop()] = len(self.tag)

    def _holder(self) -> int:
        """The innermost open block element."""
        return next((i for i in reversed(self._open) if self.tag[i] in BLOCK), 0)

    def _flush(self) -> None:
        if self._text:
            node = self._holder()
            text = " ".join("".join(self._text).split())
            if text and not self.dropped[self._open[-1]]:
                self.blocks.append((node, text, self._linked))
            self._text, self._linked = [], 0

    def _pop(self, to: int) -> None:
        """Close all elements from place ``to`` of the open ones."""
        for i in self._open[to:]:
            self.end[i] = len(self.tag)
            self._in_link -= self.tag[i] == "a"
        del self._open[to:]

    def _unwanted(self, tag: str, attributes: str) -> bool:
        inside = {self.tag[i] for i in self._open}
        if tag in DROPPED or (tag == "header" and not inside & {"article", "main"}):
            return True
        if not attributes or tag in ("body", "html", "article", "main"):
            return False
        for m in NAMES.finditer(attributes):
            name, value = m[1].lower(), next((v for v in m.groups()[1:] if v is not None), None)
            if name in ("class", "id") and value and any(w.lower() in UNWANTED for w in SPLIT.split(value)):
                return True
            if name == "role" and value and value.lower() in ROLES or name == "style" and value and HIDDEN.search(value):
                return True
            if name == "hidden" and not re.search(r"""["'][^"']*\bhidden""", attributes) or name == "aria-hidden" and value and value.lower() == "true":
                return True
        return False

    def _start(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self._flush()
            if tag not in ("html", "body", "head"):
                opened = [self.tag[i] for i in self._open]
                if "p" in opened and tag != "option":
                    self._pop(opened.index("p"))
        if tag in ENDS_ITSELF:
            for at in range(len(self._open) - 1, 0, -1):
                if self.tag[self._open[at]] in ENDS_ITSELF[tag]:
                    self._pop(at)
                    break
                if self.tag[self._open[at]] in SCOPES:
                    break
        if tag == "body":
            heads = [at for at, i in enumerate(self._open) if self.tag[i] == "head"]
            if heads:
                self._pop(heads[0])
        if tag in ("br", "hr", "wbr", "img", "input"):
            if tag == "br":
                self._text.append(" ")
            return
        if tag in VOID or tag == "html":
            return
        top = self._open[-1]
        self.tag.append(tag)
        self.parent.append(top)
        self.dropped.append(self.dropped[top] or self._unwanted(tag, attributes))
        self.end.append(0)
        if not attributes.rstrip().endswith("/") or tag in BLOCK or tag == "a":
            self._open.append(len(self.tag) - 1)
            self._in_link += tag == "a"
        else:
            self.end[-1] = len(self.tag)

    def _finish(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        for at in range(len(self._open) - 1, 0, -1):
            if self.tag[self._open[at]] == tag:
                self._pop(at)
                return
            if tag not in BLOCK and self.tag[self._open[at]] in BLOCK:
                return

    def _read(self, html: str) -> None:
        at, low = 0, None
        while m := TOKEN.match(html, at):
            at = m.end()
            if m[4] is not None or m[5] is not None:
                if not self.dropped[self._open[-1]]:
                    text = unescape(m[4] or m[5])
                    self._text.append(text)
                    self._linked += len(text) if self._in_link else 0
            elif m[2] is None:  # a comment or a declaration
                continue
            elif m[1] == "/":
                self._finish(m[2].lower())
            else:
                tag = m[2].lower()
                if tag in RAW:
                    low = html.lower() if low is None else low
                    close = low.find("</" + tag, at) if len(low) == len(html) else html.find("</" + tag, at)
                    stop = html.find(">", close) if close >= 0 else -1
                    at = stop + 1 if stop >= 0 else len(html)
                else:
                    self._start(tag, m[3] or "")


def _points(text: str) -> float:
    return 1 + text.count(",") + min(len(text) // 100, 3)


def extract(html: str | None) -> str:
    """The main text: blocks in page order, joined by single spaces; empty if there is none."""
    if not html:
        return ""
    tree = Tree(html)
    n = len(tree.tag)
    score, chars, linked = [0.0] * n, [0] * n, [0] * n
    for node, text, in_link in tree.blocks:
        points = _points(text) if len(text) >= 25 else 0.25
        up, step = node, 0
        # A paragraph's container is its parent; text that stands in a container itself counts for that.
        if tree.tag[node] in ("p", "pre", "blockquote", "td", "li", "dd", "dt", "h1", "h2", "h3", "h4", "h5", "h6", "figcaption"):
            up = tree.parent[node]
        while up >= 0:
            score[up] += points / (1 if step == 0 else 2 if step == 1 else 3 * step)
            up, step = tree.parent[up], step + 1
        up = node
        while up >= 0:
            chars[up] += len(text)
            linked[up] += in_link
            up = tree.parent[up]
    if not tree.blocks:
        return ""

    def density(i: int) -> float:
        return linked[i] / chars[i] if chars[i] else 0.0

    final = [(score[i] + START.get(tree.tag[i], 0)) * (1 - density(i)) if score[i] > 0 else 0.0 for i in range(n)]
    best = max(range(n), key=lambda i: (final[i], -i))
    above, up = [], best
    while up >= 0:
        above.append(up)
        up = tree.parent[up]
    # An article, or else a main, is kept whole, though one of its sections scored best.
    whole = [i for i in above if tree.tag[i] == "article"] or [i for i in above if tree.tag[i] == "main"]
    best = whole[-1] if whole else best
    inside = bytearray(n)
    inside[best : tree.end[best]] = b"\1" * (tree.end[best] - best)
    # Siblings of the best; beside an article or main, also those of the nodes around it, up to the main or body.
    around = above[above.index(best) + 1 :] if tree.tag[best] not in ("body", "html") else []
    if not whole:
        around = around[:1]
    mains = [k for k, i in enumerate(around) if tree.tag[i] == "main"]
    inner = set(around[: mains[-1] + 1] if mains else around[:1])
    around, on_way = set(around[: mains[-1] + 1] if mains else around), set(above)
    enough = max(10.0, 0.2 * final[best])
    holds = [False] * n  # an article that scores enough
    for i in range(n - 1, 0, -1):
        holds[i] = holds[i] or (bool(whole) and tree.tag[i] == "article" and not tree.dropped[i] and final[i] >= enough)
        holds[tree.parent[i]] |= holds[i]
    for i in range(n):
        if tree.parent[i] in around and i not in on_way and not tree.dropped[i] and chars[i]:
            plain = tree.parent[i] in inner and tree.tag[i] in ("p", "h1", "h2", "h3", "blockquote", "pre") and density(i) < 0.25
            if final[i] >= enough or plain or (holds[i] and density(i) < 0.25):
                inside[i : tree.end[i]] = b"\1" * (tree.end[i] - i)
            elif holds[i] and i not in around:  # its articles only
                around.update(j for j in range(i, tree.end[i]) if holds[j] and tree.tag[j] != "article")
    bare = {i for i in inner if mains}  # text of the main that stands in no element of its own
    return " ".join(text for node, text, in_link in tree.blocks if inside[node] or (node in bare and in_link < 0.25 * len(text)))


def extract_text(pages: DataFrame, html: str = "html", carry: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns of ``carry``, ``text`` and ``n_chars`` (its code points) per row.

    Null and empty pages give an empty text. Repeated rows are read each for itself; other columns
    are left out. No shuffle takes place.
    """
    bound_batches(pages)
    names = [*carry, "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):  # so that few texts are held at a time
                part = batch.slice(low, 256)
                texts = [extract(h.as_py()) for h in part.column(len(carry))]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(carry)], pa.array(texts, pa.string())], names=names)

    shape = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in carry)
    found = pages.select(*carry, F.col(html).alias("_html")).mapInArrow(run, shape + "text string")
    return found.withColumn("n_chars", F.length("text").cast("bigint"))

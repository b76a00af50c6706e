"""The article in a web page: a tag tree, densities of text and links by block, and the subtree that holds most of the prose.

A page is read in one pass over its tags. Broken markup is taken as it comes: tags that are never closed end with their parent, an
end tag without a start is passed over, a block inside a paragraph ends the paragraph, entries of lists and tables end the one before.

Text belongs to the nearest open block. A block weighs its characters times the share of them outside links; a subtree weighs what
its blocks do. From the page's root the walk goes down as long as one child holds MAIN of the weight at hand; there is the
article. Its body is its blocks in their order but those that are mostly links and the heading that is the title. Navigation, forms, scripts, tables, figures and
parts that their class or id calls advertising, comments and the like are no part of any article.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Share of the weight that one child must hold to be gone down to, and of characters in links from which a block is a list of links.
MAIN, LINKS = 0.6, 0.5
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template svg iframe textarea select object title".split())
_LEFT_OUT = frozenset("nav footer aside form button table figure menu dialog".split())
_BLOCKS = frozenset("html body main article section div header hgroup address p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre hr".split()) | _LEFT_OUT
_HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ENTRIES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
_SAME = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
_APART = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|comments?|related|share|sharing|social|sidebar|newsletter|subscribe|breadcrumbs?|menu|footer|pagination)(?:$|[\s_-])", re.I)
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>"']++|"[^"]*"|'[^']*')*+/?)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^<>]*)>""", re.S)
_ATTRIBUTE = re.compile(r"""([A-Za-z:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_END = {name: re.compile(rf"</{name}\s*>|\Z", re.I) for name in _RAW}
_SPACE = re.compile(r"\s+")


def _collapsed(text: str) -> str:
    return _SPACE.sub(" ", html.unescape(text)).strip()


class Page:
    """The tag tree of a page: for each element its tag and parent, and the blocks of text in their order."""

    def __init__(self, source: str):
        self.tags, self.parents, self.left_out = ["#root"], [-1], [False]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self.titles: dict[str, str] = {}
        self._open, self._pieces, self._linked, self._links = [0], [], 0, 0
        #: Places in the list of open elements: of blocks, and by tag.
        self._blocks, self._places = [0], defaultdict(list)
        at = 0
        while at < len(source):
            m = _TAG.search(source, at)
            self._text(source[at : m.start() if m else len(source)])
            if not m:
                break
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            if m[1] or m[4]:
                self._close(name)
            else:
                at = self._start(name, m[3] if m[2] else m[6], source, at)
        self._flush()

    def _text(self, text: str) -> None:
        if text:
            self._pieces.append(text)
            if self._links:
                self._linked += len(_collapsed(text))

    def _flush(self) -> None:
        text = _collapsed("".join(self._pieces))
        if text:
            self.blocks.append((self._open[self._blocks[-1]], text, min(self._linked, len(text))))
        self._pieces, self._linked = [], 0

    def _start(self, name: str, attributes: str, source: str, at: int) -> int:
        if name == "meta":
            got = {k.lower(): _collapsed(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(attributes)}
            if got.get("property", got.get("name", "")).lower() == "og:title" and got.get("content"):
                self.titles.setdefault("meta", got["content"])
        if name == "br":
            self._pieces.append(" ")
        if name in _RAW:
            end = _END[name].search(source, at)
            if name == "title" and (text := _collapsed(source[at : end.start()])):
                self.titles.setdefault("title", text)
            return end.end()
        if name in _VOID or attributes.rstrip().endswith("/"):
            if name == "hr":
                self._flush()
            return at
        if name in _BLOCKS:
            self._flush()
            if self.tags[self._open[self._blocks[-1]]] == "p":
                self._cut(self._blocks[-1])
        if name in _ENTRIES:
            self._flush()
            last = max(self._place(t) for t in _SAME.get(name, (name,)))
            if last > max(self._place(t) for t in _ENTRIES[name]):
                self._cut(last)
        marks = " ".join(a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes) if k.lower() in ("class", "id", "role"))
        parent = self._open[-1]
        self.tags.append(name)
        self.parents.append(parent)
        self.left_out.append(self.left_out[parent] or name in _LEFT_OUT or (name in _BLOCKS and name not in ("html", "body") and bool(_APART.search(marks))))
        self._places[name].append(len(self._open))
        if name in _BLOCKS:
            self._blocks.append(len(self._open))
        self._open.append(len(self.tags) - 1)
        self._links += name == "a"
        return at

    def _place(self, tag: str) -> int:
        """Where the innermost open element of a tag is; 0 if there is none."""
        return self._places[tag][-1] if self._places[tag] else 0

    def _cut(self, k: int) -> None:
        """Close the element at place k and all in it."""
        while len(self._open) > k:
            tag = self.tags[self._open.pop()]
            self._places[tag].pop()
            self._links -= tag == "a"
            if tag in _BLOCKS:
                self._blocks.pop()

    def _close(self, name: str) -> None:
        if name in _BLOCKS or name in _ENTRIES:
            self._flush()
        if at := self._place(name):
            self._cut(at)

    def article(self) -> tuple[str | None, str | None]:
        """(body, title); null where there is none."""
        weight = [0.0] * len(self.tags)
        kept = [(e, text, linked) for e, text, linked in self.blocks if not self.left_out[e]]
        for e, text, linked in kept:
            weight[e] += len(text) * (1 - linked / len(text))
        for e in range(len(self.tags) - 1, 0, -1):  # parents come before their children
            weight[self.parents[e]] += weight[e]
        heaviest: dict[int, int] = {}
        for e in range(1, len(self.tags)):
            p = self.parents[e]
            if p not in heaviest or weight[e] > weight[heaviest[p]]:
                heaviest[p] = e
        main = 0
        while weight[main] > 0 and main in heaviest and weight[heaviest[main]] >= MAIN * weight[main] and self.tags[heaviest[main]] in _BLOCKS - {"p"}:
            main = heaviest[main]
        inside = [False] * len(self.tags)
        inside[main] = True
        for e in range(main + 1, len(self.tags)):
            inside[e] = inside[self.parents[e]]
        first = next((text for e, text, _ in kept if self.tags[e] == "h1"), None)
        title = self.titles.get("meta") or first or self.titles.get("title")
        body = "\n".join(text for e, text, linked in kept if inside[e] and linked <= LINKS * len(text) and not (text == title and self.tags[e] in _HEADS))
        return body or None, title


def article(source: Column) -> Column:
    """body (a block a line, null if there is none) and title of a page; whole pages, one at a time. A null page has neither."""
    return F.pandas_udf(_article, "struct<body:string,title:string>")(source)


def _article(pages: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([Page(p or "").article() for p in pages], columns=["body", "title"], dtype=object)

"""Articles against a plain tree parser, and languages against held-out labels and a plain version."""

import html
import math
import random
import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewire.functions import html as P
from tidewire.operators import language as L
from tidewire.plans import catalog

SF = "/root/testdata/sf0.001"


class Plain(HTMLParser):
    """Builds nodes [tag, attributes, children] for well-formed pages; text children are strings."""

    def __init__(self, page):
        super().__init__(convert_charrefs=False)
        self.root = ["#root", {}, []]
        self.stack = [self.root]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        blocks = P._BLOCKS
        if tag in blocks and self.stack[-1][0] == "p" or tag in blocks and any(n[0] == "p" for n in self.stack):
            inner = [n[0] for n in self.stack]
            k = len(inner) - 1 - inner[::-1].index("p")
            if not any(t in blocks for t in inner[k + 1 :]):
                del self.stack[k:]
        if tag == "li":
            inner = [n[0] for n in self.stack]
            if "li" in inner and not {"ul", "ol"} & set(inner[len(inner) - inner[::-1].index("li") :]):
                del self.stack[len(inner) - 1 - inner[::-1].index("li") :]
        node = [tag, dict(attrs), []]
        self.stack[-1][2].append(node)
        if tag not in P._VOID:
            self.stack.append(node)

    def handle_endtag(self, tag):
        names = [n[0] for n in self.stack]
        if tag in names[1:]:
            del self.stack[len(names) - 1 - names[::-1].index(tag) :]

    def handle_data(self, data):
        into = self.stack[-1][2]
        if into and isinstance(into[-1], str):
            into[-1] += data
        else:
            into.append(data)

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def handle_charref(self, name):
        self.handle_data(f"&#{name};")


def plain_article(page):
    root, clean = Plain(page).root, lambda s: re.sub(r"\s+", " ", html.unescape(s)).strip()
    metas, titles, h1 = [], [], []

    def out(node):
        marks = " ".join(v or "" for k, v in node[1].items() if k in ("class", "id", "role"))
        return node[0] in P._LEFT_OUT or node[0] in P._BLOCKS and node[0] not in ("html", "body") and bool(P._APART.search(marks))

    def blocks(node, owner, linked, into, pending):
        """into: list of (path of element ids, text, linked); pending: [text, linked] of the open block."""
        for child in node[2]:
            if isinstance(child, str):
                pending[0] += child
                pending[1] += len(clean(child)) if linked else 0
            elif child[0] == "br":
                pending[0] += " "
            elif child[0] == "meta":
                if child[1].get("property", child[1].get("name")) == "og:title":
                    metas.append(clean(child[1].get("content", "")))
            elif child[0] == "title":
                titles.append(clean("".join(c for c in child[2] if isinstance(c, str))))
            elif child[0] in P._RAW or child[0] in P._VOID and child[0] != "hr":
                continue
            elif child[0] in P._BLOCKS or child[0] in P._ENTRIES:
                flush(owner, into, pending)
                if child[0] in P._BLOCKS:
                    blocks(child, [*owner, child], linked, into, pending)
                    flush([*owner, child], into, pending)
                else:
                    blocks(child, owner, linked, into, pending)
                    flush(owner, into, pending)
            else:
                blocks(child, owner, linked or child[0] == "a", into, pending)

    def flush(owner, into, pending):
        text = clean(pending[0])
        if text:
            into.append((owner, text, min(pending[1], len(text))))
        pending[:] = ["", 0]

    into, pending = [], ["", 0]
    blocks(root, [root], False, into, pending)
    flush([root], into, pending)
    kept = [b for b in into if not any(out(n) for n in b[0][1:])]
    weight = lambda node: sum(len(t) - linked for path, t, linked in kept if any(n is node for n in path))
    main = root

    def inner_blocks(node):
        for c in node[2]:
            if not isinstance(c, str):
                if c[0] in P._BLOCKS:
                    yield c
                elif c[0] not in P._RAW:
                    yield from inner_blocks(c)

    while True:
        total, best = weight(main), None
        for c in inner_blocks(main):
            if best is None or weight(c) > weight(best):
                best = c
        if total <= 0 or best is None or best[0] == "p" or weight(best) < P.MAIN * total:
            break
        main = best
    h1 = [t for path, t, _ in kept if path[-1][0] == "h1"]
    title = next((x for x in [*metas[:1], *h1[:1], *titles[:1]] if x), None)
    body = "\n".join(t for path, t, linked in kept if any(n is main for n in path) and linked <= P.LINKS * len(t) and not (t == title and path[-1][0] in P._HEADS))
    return body or None, title


def made_page(rng):
    words = lambda n: " ".join(rng.choice(["wind", "storm", "caf&eacute;", "&lt;b&gt;", "said", "x &amp; y", "river\n"]) for _ in range(n))
    inline = lambda n: "".join(rng.choice([words(2), f"<b>{words(2)}</b>", f'<a href="/x?a=1">{words(3)}</a>', f"<i>{words(1)}<em>{words(1)}</em></i>", "<br>"]) for _ in range(n))

    def block(depth):
        kind = rng.choice(["p", "p", "p", "div", "section", "article", "ul", "h2", "nav", "aside", "table", "ad", "blockquote", "text", "script"])
        if kind == "p":
            return f"<p>{inline(rng.randrange(1, 9))}" + rng.choice(["</p>", "</p>", ""])
        if kind == "ul":
            return "<ul>" + "".join(f"<li>{inline(2)}" + rng.choice(["", "</li>"]) for _ in range(3)) + "</ul>"
        if kind == "text":
            return inline(2)
        if kind == "script":
            return "<script>if (a < b) { x = '<p>no</p>' }</script>"
        if kind == "h2":
            return f"<h2>{words(3)}</h2>"
        tag, attrs = ("div", ' class="box ad-slot ads"') if kind == "ad" else (kind, "")
        return f"<{tag}{attrs}>" + "".join(block(depth + 1) for _ in range(rng.randrange(0, 4 if depth < 3 else 1))) + f"</{tag}>"

    head = f"<title>{words(2)}</title>" + rng.choice(["", '<meta property="og:title" content="The &quot;story&quot;">'])
    return f"<!DOCTYPE html><html><head>{head}</head><body><!-- <p>no --><h1>{words(3)}</h1>" + "".join(block(0) for _ in range(rng.randrange(1, 7))) + "</body></html>"


@pytest.mark.parametrize("seed", range(40))
def test_article_equals_plain_tree(seed):
    rng = random.Random(seed)
    for _ in range(25):
        page = made_page(rng)
        assert P.Page(page).article() == plain_article(page), page


def test_pages_equal_plain_tree(spark):
    t = pq.read_table(f"{SF}/pages.parquet")
    pages = dict(zip(t["page_id"].to_pylist(), t["html"].to_pylist(), strict=True))
    got = {r.page_id: r for r in catalog.QUERIES["page_articles"](spark, SF).collect()}
    assert got.keys() == pages.keys() and all(r.chars > 0 for r in got.values())
    import hashlib

    sha = lambda s: None if s is None else hashlib.sha256(s.encode()).hexdigest()
    for i, page in pages.items():
        body, title = plain_article(page)
        assert (got[i].body_sha256, got[i].title_sha256) == (sha(body), sha(title))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, (None, None)), ("", (None, None)), ("plain words only", ("plain words only", None)), ("<p>a<p>b", ("a\nb", None)), ("</div></p>x<div", ("x<div", None)), ("<nav>menu</nav>", (None, None)),
        ("<title>T &amp; U</title><body><div><p>One two three four.</p></div><footer>foot</footer>", ("One two three four.", "T & U")), ("<!-- open <p>lost", (None, None)), ("<script>x", (None, None)),
        ('<p>see <a href="x>y">this</a> text that is longer than its link</p>', ("see this text that is longer than its link", None)), ('<div><a href="/1">link one</a> <a href="/2">link two</a></div><p>Some prose here.</p>', ("Some prose here.", None)),
        ("<ul><li>one<li>two<ul><li>deep</ul><li>three</ul>", ("one\ntwo\ndeep\nthree", None)), ("<h1>Head</h1><p>Head</p><p>Rest of it</p>", ("Head\nRest of it", "Head")), ('<p class="x" id=y>a < b and c > d</p>', ("a < b and c > d", None)),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, ("deep", None)), ("<p><b>bold <i>both</b> after</p>", ("bold both after", None)), ('<img src="a" alt="<p>"><p>t</p>', ("t", None)),
    ],
)
def test_broken_pages(spark, page, want):
    got = spark.createDataFrame([(page,)], "h string").select(P.article(F.col("h")).alias("a")).first().a
    assert (got.body, got.title) == want


def test_long_pages_take_linear_time():
    import time

    start = time.process_time()
    for page in ("<p>word <b>" * 20_000, '<a href="' * 60_000, "<" * 400_000, "<!--" * 100_000, "<script>" * 100_000, "<p " + "x=\'" * 100_000, "<b>" * 20_000 + "<p></p>" * 20_000, "<ul>" + "<b>" * 20_000 + "<td>x" * 20_000):
        P.Page(page).article()
    assert time.process_time() - start < 60


def plain_language(texts, langs):
    """Counts of n-grams as strings; no hashing, so only far calls are compared."""
    norm = lambda t: " " + re.sub(r"[\W\d_]+", " ", t.lower()).strip() + " "
    ngrams = lambda t: (lambda s: Counter(s[k : k + n] for n in (1, 2, 3) for k in range(len(s) - n + 1)))(norm(t))
    model = {}
    for t, lang in zip(texts, langs, strict=True):
        model.setdefault(lang, Counter()).update(ngrams(t))
    total = {lang: sum(c.values()) + L.CELLS for lang, c in model.items()}

    def tell(t):
        if len(t.strip()) < 12 or not re.search(r"[^\W\d_]", t):
            return None, 0
        got = ngrams(t)
        by = sorted(((sum(n * math.log((c[g] + 1) / total[lang]) for g, n in got.items()) / sum(got.values()), lang) for lang, c in model.items()), reverse=True)
        return by[0][1], by[0][0] - by[1][0]

    return tell


def test_languages_are_told(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    sample = L.sampled(docs, "doc_id", "lang", 60)
    rows = sample.collect()
    assert rows and max(Counter(r.lang for r in rows).values()) <= 60 and sample.collect() == rows
    langs, table = L.fitted(sample, "lang", "text")
    held = docs.join(sample.select("doc_id"), "doc_id", "left_anti").select("lang", "text", L.detected(F.col("text"), langs, table).alias("told")).where("told IS NOT NULL").collect()
    assert sum(r.lang == r.told for r in held) / len(held) > 0.97
    tell = plain_language([r.text for r in rows], [r.lang for r in rows])
    for r in held[:150]:
        want, margin = tell(r.text)
        assert margin < 0.05 or r.told == want


@pytest.mark.parametrize(("text", "told"), [(None, None), ("", None), ("too short", None), ("1234 5678 9012 3456", None), (" \t\n" * 40, None)])
def test_no_language_is_told(spark, text, told):
    langs, table = ["de", "en"], __import__("numpy").zeros((2, L.CELLS), "float32")
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(L.detected(F.col("t"), langs, table).alias("x")).first().x is told
    assert spark.createDataFrame([("long enough to be told",)], "t string").select(L.detected(F.col("t"), langs, table).alias("x")).first().x == "de"
    assert spark.createDataFrame([("long enough to be told",)], "t string").select(L.detected(F.col("t"), [], table[:0]).alias("x")).first().x is None

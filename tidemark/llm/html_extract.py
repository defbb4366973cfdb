"""Main text of web pages by gradient-boosted trees over DOM nodes (operator 4).

Method. The page becomes a tree of block elements; runs of text between block
boundaries are its leaves. Every node gets features of its tag, attribute
tokens, ancestors, depth, siblings and subtree (text, links, marks per tag).
Boosted trees give each node's log odds of holding main text. They are trained
here on ``TEMPLATES`` pages drawn from random templates with known main text
(``template_page``), a fixed and bounded sample. Decoding is hierarchical: of
all labellings in which a node is kept only if its parent is, the one of the
largest total log odds is taken, by dynamic programming from the leaves; so no
leaf is kept inside a rejected container.

A block's character references are decoded, its white space becomes single
spaces, and the kept blocks are joined in page order by line ends. <br> is
white space. Scripts, styles, comments and markup have no text. MathML is part
of the text it stands in; a label in an svg is a block, judged as any other.

Defined cases: null or empty html, or a page without main text, gives an empty
string. Unclosed and stray tags are repaired as browsers do for paragraphs,
list items and table cells; a tag cut off at the end of the page is dropped.
Nesting beyond ``MAX_DEPTH`` is read on at that depth. Null urls and repeated
rows are returned as they come. Extra columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _bytes as B
from ._boost import Trees
from ._ship import ready

TEMPLATES = 350
MAX_DEPTH = 400
SLICE_BYTES = 2 << 20  # pages parsed together, or one page
_SEED = 17

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")

# fixed values: HTML element names
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noembed noframes noscript template".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                    "strong sub sup time tt u var wbr br img".split())
_FOREIGN = frozenset(("svg", "math"))
_LABELS = frozenset("text title desc foreignobject".split())  # svg elements whose text is a block of its own
_HTML_INSIDE = frozenset("title desc foreignobject mi mn mo ms mtext".split())  # elements of svg and math that may hold HTML
_BREAKS = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr "
                    "ol p pre ruby s small span strong strike sub sup table tt u ul var".split())  # HTML elements that end an open svg or math
_CLOSES = {  # an opening tag ends these open elements, within the given bounds
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"})}
_GROUPS = {name: k for k, names in enumerate((
    "#text", "article", "main", "section", "div", "p", "h1", "h2 h3 h4 h5 h6", "ul ol dl menu", "li dt dd", "nav", "header",
    "footer", "aside", "form fieldset select button input textarea", "table tbody thead tfoot", "tr td th", "blockquote", "pre",
    "figure figcaption", "body html")) for name in names.split()}
_OTHER = 21
_N_GROUPS = 22
_ABOVE = [_GROUPS[x] for x in ("article", "main", "section", "ul", "nav", "header", "footer", "aside", "form", "table", "blockquote", "figure")]
#: attribute tokens by what they usually hold
_ATTRS = {name: k for k, names in enumerate((
    "article post entry story news blog", "content main body text", "nav menu navbar navigation breadcrumb breadcrumbs tabs",
    "header masthead topbar logo brand", "footer copyright colophon legal",
    "sidebar side aside widget rail", "ad ads advert advertisement adverts banner sponsor sponsored promo promotion",
    "cookie cookies notice consent alert gdpr popup modal warning", "form login search signup subscribe newsletter register",
    "comment comments reply replies commentlist respond disqus discussion", "share social follow tweet like",
    "related recommended more teaser popular trending tags meta")) for name in names.split()}
_N_ATTRS = 12
_NUMBERS = 17
N_FEATURES = 2 * _N_GROUPS + len(_ABOVE) + 2 * _N_ATTRS + _NUMBERS


class Page:
    """Block elements and text leaves of a page, parents before children."""

    def __init__(self, source: str):
        self.tag: list[str] = ["body"]
        self.parent = [-1]
        self.attrs = [0]
        self.depth = [0]
        self.text = [""]
        self.links = [0]  # characters inside links
        self.tags = [0]  # elements opened directly inside
        self._read(source)

    def _node(self, tag: str, parent: int, attrs: int, text: str = "", links: int = 0) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.attrs.append(attrs)
        self.depth.append(self.depth[parent] + 1)
        self.text.append(text)
        self.links.append(links)
        self.tags.append(0)
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("body", 0)]  # open elements and their block node
        run: list[str] = []
        foreign: list[tuple[str, int]] = []  # open svg and math, and what may hold HTML in them: name, place in the stack
        linked, in_link, at = 0, 0, 0
        size = len(source)

        def flush() -> None:
            nonlocal linked
            if run:
                words = "".join(run).split()
                if words:
                    text = " ".join(words)
                    self._node("#text", stack[-1][1], 0, text, min(linked, len(text)))
                run.clear()
            linked = 0

        def close(depth: int) -> None:
            nonlocal in_link
            while len(stack) > depth:
                name, _ = stack[-1]
                if name == "a":
                    in_link = max(in_link - 1, 0)
                elif len(stack) == 1 or stack[-2][1] != stack[-1][1]:
                    flush()
                stack.pop()
            while foreign and foreign[-1][1] >= depth:
                foreign.pop()

        def text_until(end: int) -> None:
            nonlocal linked
            if end > at:
                piece = source[at:end]
                piece = html.unescape(piece) if "&" in piece else piece
                run.append(piece)
                if in_link:
                    linked += len(piece)

        while at < size:
            m = _TOKEN.search(source, at)
            if m is None:
                text_until(size)
                break
            text_until(m.start())
            at = m.end()
            name = m[2] or m[5]
            if name is None:
                if foreign and foreign[-1][0] in _FOREIGN and m.group().startswith("<![CDATA["):
                    run.append(m.group()[9:].removesuffix("]]>"))
                continue
            name = name.lower()
            if not (m.group().endswith(">")):
                break  # cut off at the end of the page
            if m[1] or m[4]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == name:
                        close(k)
                        break
                continue
            if name in _BREAKS:
                while foreign and foreign[-1][0] in _FOREIGN:
                    close(foreign[-1][1])
            around = foreign[-1][0] if foreign and foreign[-1][0] in _FOREIGN else ""
            if around and name in ("script", "style") and m.group().endswith("/>"):
                continue
            if (around or name in _FOREIGN) and name not in ("script", "style"):
                self.tags[stack[-1][1]] += not around
                if m.group().endswith("/>") or len(stack) >= MAX_DEPTH:
                    continue
                if name in _FOREIGN or name in _HTML_INSIDE:
                    foreign.append((name, len(stack)))
                if around == "svg" and name in _LABELS:
                    flush()
                    stack.append((name, self._node(name, stack[-1][1], 0)))
                else:
                    stack.append((name, stack[-1][1]))
                    in_link += name == "a"
                continue
            if name in _RAW:
                end = re.compile(rf"</{re.escape(name)}[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else size
                continue
            self.tags[stack[-1][1]] += 1
            if name == "br":
                run.append(" ")
                continue
            if name in _INLINE:
                if name not in _VOID and len(stack) < MAX_DEPTH:
                    stack.append((name, stack[-1][1]))
                    in_link += name == "a"
                continue
            flush()
            if name in _VOID:
                continue
            names, bounds = _CLOSES.get(name, ({"p"}, {"td", "th", "li", "div", "section", "article", "blockquote", "table"}))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in names:
                    close(k)
                elif stack[k][0] in bounds:
                    break
            if name == "xmp":  # its markup is text
                end = re.compile(r"</xmp[^>]*(?:>|\Z)", re.I).search(source, at)
                stack.append((name, self._node(name, stack[-1][1], 0)))
                run.append(source[at:end.start() if end else size])
                at = end.end() if end else size
                close(len(stack) - 1)
                continue
            if len(stack) >= MAX_DEPTH:
                continue
            attrs = 0
            if m[3] or m[6]:
                for q in _ATTRIBUTE.finditer(m[3] or m[6]):
                    for token in _WORD.findall((q[1] or q[2] or q[3] or "").lower()):
                        k = _ATTRS.get(token)
                        if k is not None:
                            attrs |= 1 << k
            stack.append((name, self._node(name, stack[-1][1], attrs)))
        close(0)
        if run:
            stack.append(("body", 0))
            flush()

    def features(self) -> np.ndarray:
        n = len(self.tag)
        parent = np.array(self.parent)
        group = np.array([_GROUPS.get(t, _OTHER) for t in self.tag])
        chars = np.array([len(t) for t in self.text], np.float64)
        marks = np.array([t.count(".") + t.count(",") + t.count("!") + t.count("?") if t else 0 for t in self.text], np.float64)
        legal = np.array(["©" in t for t in self.text], np.float64)
        links, tags = np.array(self.links, np.float64), np.array(self.tags, np.float64)
        blocks, paragraphs = (chars > 0).astype(np.float64), (group == _GROUPS["p"]).astype(np.float64)
        own = chars.copy()
        sums = np.column_stack([chars, marks, legal, links, tags, blocks, paragraphs])
        above = np.zeros((n, len(_ABOVE)))
        attr = ((np.array(self.attrs)[:, None] >> np.arange(_N_ATTRS)) & 1).astype(np.float64)
        attr_above = np.zeros((n, _N_ATTRS))
        flags = np.column_stack([group == g for g in _ABOVE]).astype(np.float64)
        up = self.parent
        for i in range(n - 1, 0, -1):
            sums[up[i]] += sums[i]
        for i in range(1, n):
            np.maximum(above[up[i]], flags[up[i]], out=above[i])
            np.maximum(attr_above[up[i]], attr[up[i]], out=attr_above[i])
        kids = np.bincount(parent[1:], minlength=n).astype(np.float64)
        order = np.argsort(parent[1:], kind="stable") + 1
        first = np.searchsorted(parent[order], np.arange(n))
        place = np.zeros(n)
        place[order] = np.arange(n - 1) - first[parent[order]]
        siblings = np.where(parent >= 0, kids[parent], 1)
        like = np.bincount(np.maximum(parent, 0) * _N_GROUPS + group, minlength=n * _N_GROUPS)
        total = max(sums[0, 0], 1.0)
        text = np.maximum(sums[:, 0], 1.0)
        before = np.cumsum(own) - own
        numbers = np.column_stack([
            np.array(self.depth), np.log1p(sums[:, 0]), sums[:, 3] / text, np.log1p(sums[:, 4]),
            np.log1p(text / (sums[:, 4] + 1)), sums[:, 6], np.log1p(text / np.maximum(sums[:, 5], 1)), sums[:, 1] / text * 100,
            place / np.maximum(siblings, 1), np.log1p(siblings), like[np.maximum(parent, 0) * _N_GROUPS + group] / np.maximum(siblings, 1),
            sums[:, 0] / total, sums[:, 2] > 0, own > 0, before / total, np.log1p(sums[:, 5]),
            np.where(parent >= 0, sums[np.maximum(parent, 0), 3] / np.maximum(sums[np.maximum(parent, 0), 0], 1), 0)])
        hot = np.eye(_N_GROUPS)
        parent_group = np.where(parent >= 0, group[np.maximum(parent, 0)], _OTHER)
        return np.column_stack([hot[group], hot[parent_group], above, attr, attr_above, numbers])

    def decode(self, odds: np.ndarray) -> np.ndarray:
        """Which nodes to keep: the best total log odds with parents kept."""
        n, up = len(odds), self.parent
        gain = odds.astype(np.float64).copy()
        for i in range(n - 1, 0, -1):
            if gain[i] > 0:
                gain[up[i]] += gain[i]
        keep = np.zeros(n, bool)
        keep[0] = gain[0] > 0
        for i in range(1, n):
            keep[i] = gain[i] > 0 and keep[up[i]]
        return keep


# --- training pages ---------------------------------------------------------

def template_page(rng: random.Random) -> tuple[str, list[str]]:
    """A page from a random template and the blocks of its main text."""
    letters = rng.sample("abcdefghijklmnopqrstuvwxyzéñöä", 14)

    def word() -> str:
        return "".join(rng.choice(letters) for _ in range(rng.randint(1, 9)))

    def sentence(lo: int = 3, hi: int = 16) -> str:
        return " ".join(word() for _ in range(rng.randint(lo, hi))).capitalize() + rng.choice([".", ".", ".", "", "!", "?"])

    def prose(lo: int = 1, hi: int = 7) -> str:
        return " ".join(sentence() for _ in range(rng.randint(lo, hi)))

    def kind(*names: str) -> str:
        return f' {rng.choice(["class", "id", "class"])}="{rng.choice(names)}"' if rng.random() < 0.8 else ""

    main: list[str] = []

    def keep(text: str) -> str:
        main.append(" ".join(text.split()))
        return text

    def link_list(n: int) -> str:
        return "<ul>" + "".join(f'<li><a href="/{word()}">{word()} {word() if rng.random() < 0.3 else ""}</a></li>' for _ in range(n)) + "</ul>"

    def menu() -> str:
        inside = link_list(rng.randint(2, 12))
        return rng.choice([f"<nav>{inside}</nav>", f"<nav{kind('menu', 'nav-main')}>{inside}</nav>", f"<div{kind('menu', 'navbar', 'nav')}>{inside}</div>",
                           f"<header><nav>{inside}</nav></header>"])

    def header() -> str:
        return rng.choice([f"<header><h1>{word()}</h1><p>{sentence(2, 6)}</p></header>", f"<div{kind('header', 'masthead', 'logo')}><a href='/'>{word()}</a></div>",
                           f"<header>{word()} {word()}</header>"])

    def advert() -> str:
        text = rng.choice([sentence(2, 8), prose(1, 3)])
        return rng.choice([f'<div class="{rng.choice(["ad", "ads", "advert", "banner", "sponsored", "promo", "ad-box"])}">{text}</div>',
                           f'<aside class="{rng.choice(["ad", "promo"])}"><p>{text}</p></aside>',
                           f'<div id="ad-{rng.randint(1, 9)}"><a href="/x">{text}</a></div>'])

    def notice() -> str:
        return f'<div class="{rng.choice(["cookie-notice", "notice", "consent", "alert", "popup cookie"])}"><p>{prose(1, 3)}</p>' \
            + rng.choice(["", f"<button>{word()}</button>"]) + "</div>"

    def sidebar() -> str:
        inside = f"<h3>{sentence(1, 4)}</h3>" + rng.choice([link_list(rng.randint(2, 8)), f"<p>{prose(1, 3)}</p>"])
        return rng.choice([f"<aside>{inside}</aside>", f"<div{kind('sidebar', 'widget', 'rail')}>{inside}</div>"])

    def form() -> str:
        return f'<form{kind("search", "newsletter", "login")}><label>{sentence(1, 5)}</label><input name="q"><button>{word()}</button></form>'

    def comments() -> str:
        one = lambda: rng.choice([f"<li><b>{word()}</b><p>{prose(1, 3)}</p></li>", f'<div class="comment"><p>{prose(1, 3)}</p></div>'])
        inside = f"<h2>{sentence(1, 4)}</h2>" + "".join(one() for _ in range(rng.randint(1, 6)))
        return rng.choice([f'<section id="comments">{inside}</section>', f'<div class="comments">{inside}</div>', f'<ol class="commentlist">{inside}</ol>'])

    def related() -> str:
        return f'<div class="{rng.choice(["related", "share", "social", "recommended"])}">{link_list(rng.randint(2, 6))}</div>'

    def footer() -> str:
        text = f"&copy; {word()} &middot; {prose(1, 2)}" if rng.random() < 0.6 else prose(1, 2)
        return rng.choice([f"<footer>{text}</footer>", f"<footer><p>{text}</p>{link_list(rng.randint(0, 5))}</footer>", f"<div{kind('footer', 'legal', 'copyright')}>{text}</div>"])

    def paragraph() -> str:
        text = keep(prose())
        r = rng.random()
        if r < 0.15:
            return f"<p><b>{text}<br>"  # left open
        if r < 0.3:
            return f"<p>{text}"
        if r < 0.4 and " " in text:
            head, tail = text.split(" ", 1)
            return f'<p>{head} <a href="/{word()}">{tail}</a></p>' if len(tail) < 40 else f'<p><a href="/{word()}">{head}</a> {tail}</p>'
        return f"<p>{text}</p>"

    def body() -> str:
        out = [f"<h1>{keep(sentence(2, 10))}</h1>"] if rng.random() < 0.85 else []
        for _ in range(rng.randint(1, 9)):
            r = rng.random()
            if r < 0.72:
                out.append(paragraph())
            elif r < 0.8:
                out.append(f"<h2>{keep(sentence(1, 7))}</h2>")
            elif r < 0.86:
                out.append("<ul>" + "".join(f"<li>{keep(sentence(2, 10))}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
            elif r < 0.9:
                out.append(f"<blockquote><p>{keep(prose(1, 3))}</p></blockquote>")
            elif r < 0.93:
                out.append("<table>" + "".join(f"<tr><td>{keep(word())}</td><td>{keep(word())}</td></tr>" for _ in range(rng.randint(2, 4))) + "</table>")
            else:
                out.append(rng.choice([advert, related, advert])())
        return "".join(out)

    inside = body()
    content = rng.choice([f"<article>{inside}</article>", f"<article>{inside}</article>", f"<main>{inside}</main>", f"<main><article>{inside}</article></main>",
                          f"<div{kind('content', 'post', 'entry', 'article-body', 'story', 'main-content')}>{inside}</div>", f"<section>{inside}</section>"])
    front = [f() for f in (menu, header, notice, advert, form) if rng.random() < 0.45]
    back = [f() for f in (comments, related, form, sidebar, advert) if rng.random() < 0.35]
    rng.shuffle(front)
    rng.shuffle(back)
    if rng.random() < 0.85:
        back.append(footer())
    if rng.random() < 0.2:
        front.append(sidebar())
    page = "".join(front) + content + "".join(back)
    for _ in range(rng.randint(0, 2)):
        page = f"<div{kind('page', 'wrapper', 'container')}>{page}</div>"
    return f"<!DOCTYPE html><html><head><title>{word()}</title></head><body>{page}</body></html>", main


def train() -> Trees:
    rng = random.Random(_SEED)
    xs, ys = [], []
    for _ in range(TEMPLATES):
        source, main = template_page(rng)
        page = Page(source)
        holds = np.array([t != "" and t in set(main) for t in page.text])
        for i in range(len(holds) - 1, 0, -1):
            holds[page.parent[i]] |= holds[i]
        xs.append(page.features())
        ys.append(holds)
    return Trees().fit(np.concatenate(xs), np.concatenate(ys).astype(float))


def main_text(pages: list[Page], trees: Trees) -> list[str]:
    x = [p.features() for p in pages]
    odds = np.split(trees.margin(np.concatenate(x)), np.cumsum([len(r) for r in x])[:-1])
    out = []
    for page, o in zip(pages, odds):
        keep = page.decode(o)
        out.append("\n".join(t for t, k in zip(page.text, keep) if t and k))
    return out


def _extract(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = model.value
        for batch in batches:
            _, off = B.buffers(batch.column(2))
            for a, b in B.slices(off, SLICE_BYTES):
                part = batch.slice(a, b - a)
                texts = main_text([Page(x.as_py() or "") for x in part.column(2)], trees)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return run


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) rows -> page_id, url, text, n_chars of each row."""
    spark = ready(pages.sparkSession)
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    out = pages.mapInArrow(_extract(spark.sparkContext.broadcast(train())), "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))

"""Main text of HTML pages by composite text density.

A page becomes a tree of elements. Every element has a density: its characters
a tag, less where much of it is link text. An element's sum adds the densities
of its child elements; the article is the subtree of the greatest sum. The least
density on the way from there to the body is the threshold at which other
subtrees beside that way are text as well.

Elements that are never article text (menus, headers, footers, side bars,
notices, adverts, forms, scripts, styles, reader comments) are told by tag,
role, class and id, and leave the tree before densities are taken.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.llm.common import with_package

TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)|</[^>]*+(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""(?:^|[\s/"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)

# Element names by what they do to a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for tag in RAW}
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr picture q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section summary table ul".split()
)
#: An opening tag closes open elements of these names, up to one of the borders.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "a": ({"a"}, {"td", "th", "table", "li", "p", "div"}),
}
P_BORDER = frozenset("table td th caption button object template".split())
DROPPED = frozenset(
    "head script style title textarea iframe noembed noframes noscript template svg canvas audio video object embed nav footer aside form "
    "button select datalist dialog menu".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist".split()
)
COMMENTS = frozenset("comment comments commentlist respond disqus replies reply discussion".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsbygoogle sponsor sponsored sponsors promo promotion promotions banner "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login paywall "
    "sidebar sidebars sidenav menu menus nav navbar navigation navi topnav breadcrumb breadcrumbs pagination pager toolbar topbar header "
    "masthead footer footers share sharing social related recommended teaser teasers widget widgets search form".split()
)
NEGATED = frozenset("no without with has not hide".split())

#: Beside the article, a subtree with this share of link text is a menu.
LINK_SHARE = 0.8
#: A subtree with a hint stays if it is most of a page that marks no article.
MOST = 0.8


class Page:
    """Elements in page order (0 is the root) and the texts between their tags."""

    def __init__(self, source: str):
        self.tag, self.parent, self.kind = [""], [-1], [""]
        self.texts: list[tuple[int, str]] = []  # (element, text); a space marks the border of a block
        self.open: dict[str, int] = {}  # how many elements of a name are open
        self._parse(source)

    def _open(self, tag: str, parent: int, attributes: str) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.kind.append(boilerplate(tag, attributes))
        return len(self.tag) - 1

    def _parse(self, source: str) -> None:
        stack, at = [0], 0
        tags = self.tag

        def close(place: int) -> None:
            for node in reversed(stack[place:]):
                self.open[tags[node]] -= 1
                if tags[node] not in INLINE:
                    self.texts.append((self.parent[node], " "))
            del stack[place:]

        def nearest(names, borders) -> int:
            if not any(map(self.open.get, names)):
                return 0
            for place in range(len(stack) - 1, 0, -1):
                if tags[stack[place]] in names:
                    return place
                if tags[stack[place]] in borders:
                    break
            return 0

        while True:
            token = TOKEN.search(source, at)
            if between := source[at : token.start() if token else len(source)]:
                self.texts.append((stack[-1], html.unescape(between)))
            if token is None:
                return
            at = token.end()
            if not token[2]:
                continue
            tag = token[2].lower()
            if token[1]:
                self._end(tag, stack, close, nearest)
                continue
            if tag in CLOSES_P and (place := nearest({"p"}, P_BORDER)):
                close(place)
            if tag in HEADING and tags[stack[-1]] in HEADING:
                close(len(stack) - 1)
            if tag in ENDS:
                names, borders = ENDS[tag]
                while place := nearest(names, borders):
                    close(place)
            if tag in ("html", "body") and self.open.get(tag):
                continue
            if tag not in INLINE and tag not in RAW:
                self.texts.append((stack[-1], " "))
            if tag in VOID:
                continue
            node = self._open(tag, stack[-1], token[3])
            if tag in RAW:
                end = RAW_END[tag].search(source, at)
                at = end.end() if end else len(source)
            else:
                stack.append(node)
                self.open[tag] = self.open.get(tag, 0) + 1

    def _end(self, tag: str, stack: list[int], close, nearest) -> None:
        if not self.open.get(tag) and tag not in ("p", "br"):
            return None
        if tag in INLINE:  # an inline element never reaches over the block it stands in
            for place in range(len(stack) - 1, 0, -1):
                if self.tag[stack[place]] == tag:
                    return close(place)
                if self.tag[stack[place]] not in INLINE:
                    return None
        elif tag in ("p", "br"):
            self.texts.append((stack[-1], " "))
            if tag == "p" and (place := nearest({"p"}, P_BORDER)):
                close(place)
        elif place := nearest({tag}, set() if tag in ("table", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html") else {"td", "th"}):
            close(place)
        return None


def boilerplate(tag: str, attributes: str) -> str:
    """What an element is besides article text: ``drop``, ``comment``, ``hint`` (by a class or id) or nothing."""
    if tag in DROPPED:
        return "drop"
    kind = "header" if tag == "header" else ""
    for name, *values in ATTRIBUTE.findall(attributes) if "=" in attributes else ():
        value = "".join(values).lower()
        if name.lower() == "role":
            if value.strip() in ROLES and tag not in ("html", "body", "main"):
                return "drop"
            continue
        for word in value.split():
            parts = set(re.split("[^a-z0-9]+", word))
            if parts & NEGATED or tag in ("html", "body", "main"):
                continue
            if parts & COMMENTS:
                return "comment"
            if parts & HINTS and tag != "article":
                kind = "hint"
    return kind


def density(chars: int, tags: int, link_chars: int, link_tags: int, body_share: float) -> float:
    """Characters a tag, scaled down by the share of links: C/T log_b(C T / (LC LT)), b = ln(C LC / (C - LC) + body share C + e).

    Counts of none stand as 1 in the quotients; b is at least e, so that pages without links have a density.
    """
    if not chars:
        return 0.0
    tags, lc, lt = max(tags, 1), max(link_chars, 1), max(link_tags, 1)
    base = max(math.log(chars * link_chars / max(chars - link_chars, 1) + body_share * chars + math.e), math.e)
    return chars / tags * math.log(max(chars * tags / (lc * lt), 1)) / math.log(base)


def main_text(source: str | None) -> str:
    """The article of a page as one line of text; empty where a page has none."""
    page = Page(source or "")
    tag, parent = page.tag, page.parent
    size = len(tag)

    def upwards(values: list) -> list:
        for node in range(size - 1, 0, -1):
            values[parent[node]] += values[node]
        return values

    raw = [0] * size
    for node, text in page.texts:
        raw[node] += len(text) - text.count(" ")
    raw = upwards(raw)
    marked = upwards([int(t in ("article", "main") and k not in ("comment", "drop")) for t, k in zip(tag, page.kind)])
    out = [False] * size
    inside = [False] * size  # of an article or main element
    for node in range(1, size):
        kind, up = page.kind[node], parent[node]
        whole = raw[node] > MOST * raw[0] and not marked[0]
        mine = kind in ("drop", "comment") or (kind == "hint" and not marked[node] and not whole)
        mine = mine or (kind == "header" and not inside[up] and not marked[node])
        out[node] = out[up] or mine
        inside[node] = not out[node] and (inside[up] or tag[node] in ("article", "main"))

    chars, links = [0] * size, [0] * size
    linked = [False] * size
    for node in range(1, size):
        linked[node] = tag[node] == "a" or linked[parent[node]]
    for node, text in page.texts:
        if not out[node]:
            n = len(" ".join(text.split()))
            chars[node] += n
            links[node] += n * linked[node]
    # formatting says nothing about layout: only blocks and links count as tags
    counted = [int(not o and (t not in INLINE or t == "a")) for t, o in zip(tag, out)]
    own = counted[:]
    chars, links, tags = upwards(chars), upwards(links), upwards(counted)
    link_tags = upwards([int(t == "a" and not o) for t, o in zip(tag, out)])
    if not chars[0]:
        return ""
    share = links[0] / chars[0]
    dense = [density(chars[n], tags[n] - own[n], links[n], link_tags[n], share) if chars[n] else 0.0 for n in range(size)]
    total = [0.0] * size
    for node in range(1, size):
        if not out[node] and tag[node] not in INLINE:
            total[parent[node]] += dense[node]

    within = any(inside[n] and chars[n] for n in range(size))
    candidates = [n for n in range(size) if not out[n] and chars[n] and (inside[n] or not within) and tag[n] not in INLINE]
    top = max(candidates, key=lambda n: (total[n], n))
    article = top
    while article and tag[article] != "article":
        article = parent[article]
    keep = [False] * size
    if article:
        keep[article] = True
    else:
        keep[top] = True
        _beside(page, top, dense, chars, links, link_tags, out, keep)
    for node in range(1, size):
        keep[node] = (keep[node] or keep[parent[node]]) and not out[node]
    return " ".join("".join([text for node, text in page.texts if keep[node]]).split())


def _beside(page: Page, top: int, dense, chars, links, link_tags, out, keep) -> None:
    """Keep the subtrees beside the way from ``top`` to the body that reach its threshold, and headings before them."""
    path, node = [top], top
    while node and page.tag[node] not in ("body", "main"):
        node = page.parent[node]
        path.append(node)
    threshold = min(dense[n] for n in path)
    way = set(path)
    children: dict[int, list[int]] = {}
    for node in range(1, len(page.tag)):
        if page.parent[node] in way and page.parent[node] != top and not out[node]:
            children.setdefault(page.parent[node], []).append(node)
    for own in children.values():
        text = False  # is the next block text?
        for node in reversed(own):
            if node in way:
                text = True
            elif page.tag[node] in HEADING:
                keep[node] = text
            elif chars[node]:
                menu = link_tags[node] > 1 and links[node] >= LINK_SHARE * chars[node]
                text = keep[node] = dense[node] >= threshold and not menu


def extract_main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page: id, url, text (empty if none), n_chars (its code points).

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined by one space in page order. Where a page marks an
    ``article`` (or ``main``) with text, the article is looked for inside it, and an
    ``article`` is taken whole, less what is no article text in it. A ``header`` inside
    an article is its title and stays. Nothing else is dropped or cut.

    Null or empty pages, and pages without article text, give an empty text; ids
    and urls may be null; repeated rows give a row each; an empty table gives no
    rows; other columns are not read. Very long or deeply nested pages are handled
    whole, in time linear in their length but for open tags that are closed late.
    Markup need not be well formed: unclosed tags, comments and quotes end as in
    a browser.
    """
    with_package(pages.sparkSession)
    source = pages.select(id_col, url_col, html_col)
    schema = StructType([*source.schema.fields[:2], StructField("text", StringType()), StructField("n_chars", LongType())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names
            )

    return source.mapInArrow(extract, schema)

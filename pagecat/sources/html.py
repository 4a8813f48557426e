"""One parse of each captured page; everything after it is DataFrame work.

The parse runs once per page inside ``mapInArrow`` and returns what the page holds as nested columns,
so the page text itself never reaches a shuffle. Every selector is part of ``PageLayout``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from html.parser import HTMLParser
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.urls import with_resolved
from ..session import tune


@dataclass(frozen=True)
class PageLayout:
    """Where a site keeps things. Selectors are ``tag``, ``.class`` or ``tag.class``."""

    block: str = "div.entry"
    marker: str = "folder.svg"
    pager: str = "div.pager"
    links: str = ".links"
    info: str = "ul.info"
    synopsis: str = ".synopsis"
    file_block: str = "div.file"
    file_href: str = "/file/"
    probe: str = "Duration:"
    probe_in: tuple[str, ...] = (".details", "li", "div")


PARSED = (
    "page_url STRING, h1 STRING, title STRING, img_srcset STRING, img_src STRING, "
    "synopsis STRING, source_src STRING, video_src STRING, "
    "info ARRAY<STRUCT<pos: INT, k: STRING, v: STRING>>, "
    "blocks ARRAY<STRUCT<pos: INT, text: STRING, link_text: STRING, href: STRING, has_icon: BOOLEAN>>, "
    "files ARRAY<STRUCT<pos: INT, href: STRING, lines: ARRAY<STRING>>>, "
    "anchors ARRAY<STRUCT<pos: INT, text: STRING, href: STRING, box: STRING>>, "
    "probes ARRAY<STRING>"
)

# Elements without content, and which open element an opening tag ends.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "a": ("a",),
}
_SCOPE = frozenset("ul ol dl table select div article section nav body".split())
_ENDS_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header "
    "hr main nav ol p pre section table ul".split()
)


_MARKED = re.compile(r"<!\[[^>]*>")


class _Element:
    __slots__ = ("tag", "attrs", "classes", "at", "last", "text0", "text1")

    def __init__(self, tag, attrs, at, text0):
        self.tag, self.attrs, self.at, self.text0 = tag, attrs, at, text0
        self.classes = (attrs.get("class") or "").split()
        self.last, self.text1 = at, text0


class _Tree(HTMLParser):
    """Elements in document order, each with the range of its descendants and of its text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.elements, self.open, self.text = [], [], []

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS_P and any(e.tag == "p" for e in self.open):
            self._close_in_scope(("p",))
        if tag in _ENDS:
            self._close_in_scope(_ENDS[tag])
        first = {}
        for name, value in attrs:
            first.setdefault(name, value or "")
        element = _Element(tag, first, len(self.elements), len(self.text))
        self.elements.append(element)
        if tag not in _VOID:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth].tag == tag:
                self._close_from(depth)
                return

    def handle_data(self, data):
        self.text.append(data)

    def _close_in_scope(self, tags):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth].tag in tags:
                self._close_from(depth)
                return
            if self.open[depth].tag in _SCOPE:
                return

    def _close_from(self, depth):
        for element in self.open[depth:]:
            element.last, element.text1 = len(self.elements) - 1, len(self.text)
        del self.open[depth:]

    def read(self, html):
        # Anything that opens like a marked section is a comment up to the next ">" in a browser.
        self.feed(_MARKED.sub("", html))
        self.close()
        self._close_from(0)
        return self

    def text_of(self, element):
        return "".join(self.text[element.text0 : element.text1])

    def find(self, selector, under=None):
        tag, _, css = selector.partition(".")
        inside = self.elements if under is None else self.elements[under.at + 1 : under.last + 1]
        return [
            e for e in inside
            if (not tag or e.tag == tag) and (not css or css in e.classes)
        ]


def _first(found, attr):
    return found[0].attrs.get(attr) if found else None


def read_page(html: str, layout: PageLayout) -> dict:
    """The parts of one page; a missing part is None or an empty list."""
    tree = _Tree().read(html)
    find, text_of = tree.find, tree.text_of

    info = []
    for lst in find(layout.info):
        for li in find("li", lst):
            key = "".join(map(text_of, find("strong", li)))
            value = "".join(map(text_of, find("span", li)))
            info.append({"pos": len(info), "k": key, "v": value})

    blocks = []
    for block in find(layout.block):
        links = find("a", block)
        icon = any(layout.marker in (e.attrs.get("src") or "") for e in find("img", block))
        blocks.append({
            "pos": len(blocks),
            "text": text_of(links[0]) if links else "",
            "link_text": "".join(map(text_of, links)),
            "href": _first(links, "href"),
            "has_icon": icon,
        })

    files = []
    for block in find(layout.file_block):
        links = [e for e in find("a", block) if layout.file_href in (e.attrs.get("href") or "")]
        lines = [text_of(e) for e in find("li", block)]
        files.append({"pos": len(files), "href": _first(links, "href"), "lines": lines})

    boxes = [None] * len(tree.elements)
    for name, selector in (("links", layout.links), ("pager", layout.pager)):
        for e in find(selector):
            boxes[e.at + 1 : e.last + 1] = [name] * (e.last - e.at)
    anchors = [
        {"pos": pos, "text": text_of(e), "href": e.attrs.get("href"), "box": boxes[e.at]}
        for pos, e in enumerate(find("a"))
    ]

    probes = []
    if any(layout.probe in part for part in tree.text):
        value = re.compile(re.escape(layout.probe) + r"\s*[^\n\r" + "".join(map(chr, (0x2028, 0x2029))) + "]+", re.I)
        hits = {e.at: e for s in layout.probe_in for e in find(s)}
        # Places in the whole text: of nested elements none is joined again.
        whole, starts = "".join(tree.text), [0, *accumulate(map(len, tree.text))]
        found = [m.start() for m in re.finditer(f"(?={re.escape(layout.probe)})", whole)]
        for at in sorted(hits):
            first, end = starts[hits[at].text0], starts[hits[at].text1]
            k = bisect_left(found, first)
            if k < len(found) and found[k] + len(layout.probe) <= end:
                hit = value.search(whole, first, end)
                probes.append(hit.group(0) if hit else layout.probe)

    headings, pictures = find("h1"), find("picture")
    return {
        "h1": text_of(headings[0]) if headings else None,
        "title": "".join(map(text_of, find("title"))),
        "img_srcset": next((_first(find("source", p), "srcset") for p in pictures if find("source", p)), None),
        "img_src": next((_first(find("img", p), "src") for p in pictures if find("img", p)), None),
        "synopsis": "".join(map(text_of, find(layout.synopsis))),
        "source_src": _first(find("source"), "src"),
        "video_src": _first(find("video"), "src"),
        "info": info, "blocks": blocks, "files": files, "anchors": anchors, "probes": probes,
    }


def parse_pages(pages: DataFrame, layout: PageLayout = PageLayout()) -> DataFrame:
    """(url, html) to one row of parts per page. A page without text gives empty parts."""
    schema = pages.sparkSession.createDataFrame([], PARSED).schema

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        shape = to_arrow_schema(schema)
        for batch in batches:
            # A few pages at a time: pages are large, and their parts larger still as Python objects.
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                rows = [
                    {"page_url": url, **read_page(html or "", layout)}
                    for url, html in zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=shape)

    tune(pages.sparkSession)  # small Arrow batches, in rows and in bytes
    return pages.select("url", "html").mapInArrow(run, schema)


def block_links(parsed: DataFrame) -> DataFrame:
    """Listing blocks as links: first anchor, its text and whether the block shows the marker icon."""
    rows = parsed.select("page_url", F.explode("blocks").alias("b")).select(
        "page_url",
        F.col("b.pos").alias("pos"),
        F.lit("block").alias("box"),
        F.col("b.text").alias("anchor_text"),
        F.col("b.link_text").alias("link_text"),
        F.col("b.href").alias("href"),
        F.col("b.has_icon").alias("has_icon"),
    )
    return with_resolved(rows, "page_url", "href")


def anchor_links(parsed: DataFrame, box: str | None = None) -> DataFrame:
    """All anchors of the page, or those inside one box (``pager`` or ``links``)."""
    anchors = F.col("anchors")
    if box is not None:
        anchors = F.filter(anchors, lambda a: a["box"] == box)
    rows = parsed.select("page_url", F.explode(anchors).alias("a")).select(
        "page_url",
        F.col("a.pos").alias("pos"),
        F.col("a.box").alias("box"),
        F.col("a.text").alias("anchor_text"),
        F.col("a.text").alias("link_text"),
        F.col("a.href").alias("href"),
        F.lit(False).alias("has_icon"),
    )
    return with_resolved(rows, "page_url", "href")


def scan_anchors(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Anchors by pattern alone, inside the JVM: the cheap way for well-formed quoted anchors.

    Comments, scripts and styles are cut first, so that markup inside them is not read.
    """
    dead = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"
    tag = r'(?is)<a\s[^>]*?href\s*=\s*"[^"]*"[^>]*>.*?</a\s*>'
    found = F.regexp_extract_all(F.regexp_replace(html, dead, ""), F.lit(tag), F.lit(0))
    rows = pages.select(F.col(url).alias("page_url"), F.posexplode(found).alias("pos", "a"))
    return rows.select(
        "page_url",
        "pos",
        _plain(F.regexp_extract("a", r"(?is)>(.*)</a\s*>\z", 1)).alias("anchor_text"),
        _entities(F.regexp_extract("a", r'(?is)href\s*=\s*"([^"]*)"', 1)).alias("href"),
    )


def _plain(fragment: Column) -> Column:
    return _entities(F.regexp_replace(fragment, r"(?s)<[^>]*>", ""))


def _entities(text: Column) -> Column:
    """The five named entities markup itself needs; ``&amp;`` last."""
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text

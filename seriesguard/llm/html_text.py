"""Main text of web pages by removing what a site's pages have in common.

1. Every page is parsed once for all its element subtrees: a subtree's hash covers its tag, class and id, its
   texts and its children. Spark counts in how many different pages of a host each subtree occurs (one row for
   each distinct subtree of a page, partial counts first). Pages with the same longest block count once, so that an
   article published many times on a host isn't taken for a part of the site.
2. Subtrees in at least ``min_pages`` different pages and ``min_share`` of the pages of their host are the site's template, and
   those in most of its pages (``MOST``), alike or not. Elements of running text (``PROSE``: a paragraph that several articles quote) are deleted only with a larger subtree around them.
3. A second parse deletes template subtrees; then, as a supplement for what a page has for itself, elements whose tag, role,
   class or id says that they aren't the article (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
   comments). Of the rest, ``<article>`` elements are the main text; without any, ``<main>``; without either, the whole body.

Pages aren't shuffled: template hashes are shipped if there are at most ``BROADCAST`` (8 bytes each); beyond
that each page's own are joined to it.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import free_name

BROADCAST = 2_000_000
#: Pages, and the share of a host's pages, that make a subtree a template even if all these pages have the same longest block.
MOST = (12, 0.6)

# Tags of the HTML standard, by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
NOT_TEXT = frozenset("head nav header footer aside form fieldset button select option datalist menu dialog template svg "
                     "canvas object audio video map script style textarea title noscript iframe".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
# Words that begin or end the class or id of an element beside the article.
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices sidebar aside comment comments discussion reply replies respond menu nav navbar navigation "
    "breadcrumb breadcrumbs footer header masthead share sharing social related recommended newsletter subscribe signup "
    "login popup modal overlay widget toolbar pagination pager form disclaimer".split())
WRAPPER = re.compile(r"(?:^|[-_])(?:has|with|no|without)[-_]")
CONTAINERS = frozenset(("html", "body", "main", "article"))
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption li dt dd tr td th".split())
#: What a start tag closes, if it is open above it, and where the search for that ends.
CLOSES = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
          "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
          "option": (("option",), ("select",))}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)([^<>"']*(?:"[^"]*"[^<>"']*|'[^']*'[^<>"']*)*)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)")
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)


def _beside(tag: str, attrs: dict[str, str]) -> bool:
    if tag in NOT_TEXT:
        return True
    if tag in ("html", "body", "main") or not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or attrs.get("role", "").lower() in ROLES:
        return True
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split():
        words = re.split(r"[-_]+", name)
        if (words[0] in BESIDE or words[-1] in BESIDE) and not WRAPPER.search(name):
            return True
    return False


class Page:
    """One parsed page: ``blocks`` of text in page order, which of them are ``listed`` (in an element that says it is beside the
    article), and the ``elements`` (hash, first block, end block), ``articles`` and ``mains`` (first, end) that hold them."""

    def __init__(self, source: str, host: str):
        self.blocks: list[str] = []
        self.listed: list[bool] = []
        self.elements: list[tuple[int, int, int]] = []
        self.articles: list[tuple[int, int]] = []
        self.mains: list[tuple[int, int]] = []
        self.host = host
        self._texts: list[str] = []
        self._stack: list[tuple[str, str, int, list[str]]] = []  # tag, class and id, first block, hashes and texts inside
        self._open: dict[str, int] = {}
        self._skipped = 0  # open elements beside the article
        self._beside: list[bool] = []
        self._parse(source)

    def _flush(self) -> None:
        if self._texts:
            text = " ".join("".join(self._texts).split())
            if text:
                self.blocks.append(text)
                self.listed.append(self._skipped > 0)
            self._texts.clear()

    def _text(self, raw: str) -> None:
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            self._texts.append(text)
            if self._stack and not text.isspace():
                self._stack[-1][3].append(" ".join(text.split()))

    def _start(self, tag: str, rest: str) -> None:
        if tag in VOID:
            if tag == "hr":
                self._flush()
            elif tag == "br":
                self._texts.append(" ")
            return
        attrs = {}
        if rest and not rest.isspace():
            attrs = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(rest)}
        if tag not in INLINE:
            if self._open.get("p"):
                self._end("p")
            if tag in CLOSES:
                closed, until = CLOSES[tag]
                if any(self._open.get(name) for name in closed):
                    near = next((s[0] for s in reversed(self._stack) if s[0] in closed or s[0] in until), None)
                    if near in closed:
                        self._end(near)
            self._flush()
        beside = _beside(tag, attrs)
        if beside:
            self._flush()
        self._stack.append((tag, f"{tag} {attrs.get('class', '')} {attrs.get('id', '')}", len(self.blocks), []))
        self._beside.append(beside)
        self._skipped += beside
        self._open[tag] = self._open.get(tag, 0) + 1

    def _end(self, tag: str) -> None:
        if not self._open.get(tag):
            return
        while True:
            name, label, first, inside = self._stack.pop()
            beside = self._beside.pop()
            if name not in INLINE or beside:
                self._flush()
            self._open[name] -= 1
            self._skipped -= beside
            if inside or len(self.blocks) > first:
                h = xxhash.xxh64_intdigest("\x00".join([self.host, label, *inside]).encode("utf-8", "surrogatepass"))
                if self._stack:
                    self._stack[-1][3].append(str(h))
                end = len(self.blocks)
                if not self._skipped and not beside:
                    if name == "article":
                        self.articles.append((first, end))
                    elif name == "main":
                        self.mains.append((first, end))
                if name not in INLINE and name not in CONTAINERS and name not in PROSE and end > first:
                    self.elements.append((h - (1 << 64) if h >> 63 else h, first, end))
            if name == tag:
                return

    def _parse(self, s: str) -> None:
        at, n = 0, len(s)
        while at < n:
            lt = s.find("<", at)
            if lt < 0:
                self._text(s[at:])
                break
            if lt > at:
                self._text(s[at:lt])
            if s.startswith("<!--", lt):
                end = s.find("-->", lt + 4)
                at = n if end < 0 else end + 3
                continue
            after = s[lt + 1:lt + 2]
            if after in ("!", "?"):
                end = s.find(">", lt)
                at = n if end < 0 else end + 1
                continue
            m = _TAG.match(s, lt) or _LOOSE.match(s, lt)
            if not m:  # a plain < in the text
                self._text("<")
                at = lt + 1
                continue
            at, tag = m.end(), m[2].lower()
            if m[1]:
                self._end(tag)
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(s, at)
                at = end.end() if end else n
            else:
                self._start(tag, m[3])
        while self._stack:
            self._end(self._stack[-1][0])
        self._flush()

    def signature(self) -> int:
        """A hash of the longest block (the first of several)."""
        h = xxhash.xxh64_intdigest(max(self.blocks, key=len, default="").encode("utf-8", "surrogatepass"))
        return h - (1 << 64) if h >> 63 else h

    def in_template(self, template: np.ndarray) -> list[bool]:
        """Which blocks lie in subtrees whose hash is in the sorted array ``template``."""
        gone = [False] * len(self.blocks)
        if self.elements and len(template):
            hashes = np.array([e[0] for e in self.elements])
            at = np.minimum(np.searchsorted(template, hashes), len(template) - 1)
            for i in np.flatnonzero(template[at] == hashes):
                _, first, end = self.elements[i]
                gone[first:end] = [True] * (end - first)
        return gone

    def text(self, template: np.ndarray, lists: bool = True) -> str:
        """The main text without template subtrees and, with ``lists``, without listed elements and what is outside the article."""
        main = [not lists] * len(self.blocks)
        if lists:
            for first, end in self.articles or self.mains or [(0, len(main))]:
                main[first:end] = [True] * (end - first)
            main = [m and not x for m, x in zip(main, self.listed, strict=True)]
        gone = self.in_template(template)
        return "\n".join(b for b, m, g in zip(self.blocks, main, gone, strict=True) if m and not g)


def host_of(url: Column) -> Column:
    """The lower-case host of a URL, null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def subtrees(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host``, ``subtree`` (hash over host and subtree) and the page's ``signature``, one row for each distinct subtree of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, found, pages_of = [], [], []
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page = Page(source or "", host)
                own = {e[0] for e in page.elements}
                found += own
                hosts += [host] * len(own)
                pages_of += [page.signature()] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(found, pa.int64()), pa.array(pages_of, pa.int64())],
                                             names=["host", "subtree", "signature"])

    with_host = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).where("host is not null")
    return with_host.mapInArrow(run, "host string, subtree long, signature long")


def templates(pages: DataFrame, min_pages: int = 3, min_share: float = 0.05, url_col: str = "url",
              html_col: str = "html") -> DataFrame:
    """``subtree`` hashes found in at least ``min_pages`` pages and ``min_share`` of the pages of their host, where pages of one
    longest block count once for a subtree, or in ``MOST`` of the host's pages, where every page counts."""
    sizes = pages.groupBy(host_of(F.col(url_col)).alias("of_host")).agg(F.count(F.lit(1)).alias("pages"))
    sizes = sizes.where(F.col("pages") >= min_pages)
    found = subtrees(pages, url_col, html_col).groupBy("host", "subtree", "signature").agg(F.count(F.lit(1)).alias("n"))
    found = found.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("different"), F.sum("n").alias("n"))
    found = found.where(F.col("n") >= min_pages).join(sizes, F.col("host") == F.col("of_host"))
    recurs = (F.col("different") >= min_pages) & (F.col("different") >= F.lit(min_share) * F.col("pages"))
    everywhere = (F.col("n") >= max(min_pages, MOST[0])) & (F.col("n") >= MOST[1] * F.col("pages"))
    return found.where(recurs | everywhere).select("subtree")


def extract(pages: DataFrame, min_pages: int = 3, min_share: float = 0.05, url_col: str = "url", html_col: str = "html",
            id_col: str = "page_id", broadcast: int = BROADCAST, lists: bool = True) -> DataFrame:
    """``pages`` without the html and with ``text``: the main text, its blocks joined by line feeds.

    Inside a block, white space becomes one space and character references are decoded. A null or empty
    html gives an empty text. Pages with a null or unusable URL have no host: they lose no template. A
    repeated page counts again for its host. Broken markup is read to its end. A column ``text`` in
    ``pages`` is replaced; other columns pass through; an empty table gives an empty one. Without ``lists`` counted
    subtrees alone decide.
    """
    pages = pages.select(*(c for c in pages.columns if c.lower() != "text"))
    found = materialize(templates(pages, min_pages, min_share, url_col, html_col), "templates")
    host, own = free_name(pages, "_host"), free_name(pages, "_own_template")
    kept = [f for f in pages.schema if f.name != html_col]
    schema = T.StructType([*kept, T.StructField("text", T.StringType())])
    source = pages.withColumn(host, host_of(F.col(url_col)))
    shared = found.count() <= broadcast
    if shared:
        hashes = np.sort(found.toArrow()["subtree"].to_numpy())
        shipped = pages.sparkSession.sparkContext.broadcast(hashes)
    else:
        shipped = None
        marked = _with_subtrees(source, id_col, host, html_col).join(found, "subtree")
        marked = marked.groupBy("id").agg(F.sort_array(F.collect_set("subtree")).alias(own))
        page = free_name(source, "_of_page")
        marked = marked.withColumnRenamed("id", page)
        source = source.join(marked, F.col(id_col) == F.col(page), "left").drop(page)
    at = {c: source.columns.index(c) for c in source.columns}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources, hosts = batch.column(at[html_col]).to_pylist(), batch.column(at[host]).to_pylist()
            if shared:
                template = [shipped.value] * len(hosts)
            else:
                template = [np.array(x or [], np.int64) for x in batch.column(at[own]).to_pylist()]
            texts = [Page(s or "", h or "").text(t if h else t[:0], lists) for s, h, t in zip(sources, hosts, template, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(at[f.name]) for f in kept), pa.array(texts, pa.string())],
                                             names=schema.names)

    return source.mapInArrow(run, schema)


def _with_subtrees(pages: DataFrame, id_col: str, host: str, html_col: str) -> DataFrame:
    """``id`` and ``subtree``, one row for each distinct subtree of a page with a host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, h, source in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                rows += [(i, e) for e in {e[0] for e in Page(source or "", h).elements}]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], batch.column(0).type),
                                              pa.array([r[1] for r in rows], pa.int64())], names=["id", "subtree"])

    slim = pages.where(F.col(host).isNotNull() & F.col(id_col).isNotNull()).select(id_col, host, html_col)
    return slim.mapInArrow(run, T.StructType([T.StructField("id", pages.schema[id_col].dataType), T.StructField("subtree", T.LongType())]))

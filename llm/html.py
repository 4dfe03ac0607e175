"""Main text of web pages, with the site's templates taken out.

A page is parsed into elements. Every element subtree gets a hash of its tag, attributes, text and
children; Spark counts, per host, in how many pages with different main parts each hash occurs, and subtrees that
recur across many of a host's pages are deleted. What is left of the main part (the article elements,
else the main element, else the body) loses menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments, told by tag, role and class, and becomes text blocks.

Inside an article only what at least `SHARE` of the host's different articles hold is a template, so that
copies of an article and passages that some articles share stay. Only block elements are templates,
never words or line breaks within a paragraph. Pages without article or main
element are judged in the same way over their bodies.

Cases: a null or empty page gives an empty text. A null url is the host "". Pages with equal main
parts count once. Broken markup is read as far as it goes; a tag cut off at the end is dropped.
Repeated rows get a row each. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import short_batches

SHARE, LEAST = 0.5, 5

_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: a start tag of the key closes an open element of the values, up to the nearest container
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
CLOSES |= {t: {"p"} for t in BLOCK - {"li", "dt", "dd", "tr", "td", "th", "caption", "tbody", "thead", "tfoot", "body", "html"}}
HOLDS = frozenset("ul ol dl table article section div aside nav body html main blockquote".split())

DROP = RAW | frozenset("head nav aside footer form button select option datalist template svg canvas object audio video dialog menu input".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "popup modal overlay newsletter subscribe subscription signup login sidebar nav navbar navigation menu breadcrumb breadcrumbs footer "
    "comment comments disqus respond reply replies share sharing social related recommended recommendation widget pagination pager toolbar".split()
)
OUTSIDE = frozenset("header masthead topbar".split())  # dropped only outside the main part


class Element:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: str):
        self.tag, self.attrs, self.children = tag, attrs, []


def parse(html: str) -> Element:
    """The page as a tree; text is left undecoded, so that references cut by markup stay as they are."""
    root = Element("#root", "")
    stack = [root]
    at, n = 0, len(html)
    while at < n:
        found = _MARK.search(html, at)
        if found is None:
            stack[-1].children.append(html[at:])
            break
        if found.start() > at:
            stack[-1].children.append(html[at : found.start()])
        at = found.end()
        tag = found["tag"] or found["tag2"]
        if not tag:
            if found[0].startswith("<![CDATA["):
                stack[-1].children.append(found[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        if not found[0].endswith(">"):
            break  # a tag cut off at the end
        tag = tag.lower()
        if found["end"] or found["end2"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in ("article", "td", "th") and tag not in ("body", "html", "table", "tr", "article"):
                    break
            continue
        rest = (found["rest"] if found["tag"] else found["rest2"]).strip()
        closed = CLOSES.get(tag)
        if closed:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closed:
                    del stack[i:]
                    break
                if stack[i].tag in HOLDS:
                    break
        element = Element(tag, rest)
        stack[-1].children.append(element)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[^>]*>", re.I).search(html, at)
            at = end.end() if end else n
        elif tag not in VOID and not rest.endswith("/"):
            stack.append(element)
    return root


def _traits(element: Element) -> tuple[set[str], str, bool]:
    """(words of class and id, role, hidden)."""
    if not element.attrs:
        return set(), "", False
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(element.attrs)}
    names = {w.lower() for w in _NAME.findall(f"{values.get('class', '')} {values.get('id', '')}")}
    hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", "").lower()
    return names, values.get("role", "").lower(), hidden


def _walk(element: Element) -> Iterator[Element]:
    todo = [element]
    while todo:
        e = todo.pop()
        yield e
        todo += [c for c in reversed(e.children) if isinstance(c, Element)]


def _unwanted(element: Element, inside: bool) -> bool:
    if element.tag in DROP:
        return True
    names, role, hidden = _traits(element)
    if hidden or role in ROLES or not inside and (element.tag == "header" or names & OUTSIDE):
        return True
    return bool(names & NAMES) and element.tag not in ("html", "body", "article", "main") or element.tag == "article" and bool(
        names & {"comment", "comments", "reply", "related", "ad", "sponsored", "promo"}
    )


def main_parts(root: Element) -> list[Element]:
    """The outermost article elements; else the main element; else the body; else the page."""
    articles, mains, bodies = [], [], []
    todo = [(root, False)]
    while todo:
        e, dropped = todo.pop()
        names, role, _ = _traits(e)
        # a class name does not drop what holds the article, a tag does
        dropped = dropped or e.tag in DROP or e.tag == "article" and _unwanted(e, True)
        if not dropped:
            if e.tag == "article" or role == "article":
                articles.append(e)
                continue
            if e.tag == "main" or role == "main":
                mains.append(e)
            elif e.tag == "body":
                bodies.append(e)
        todo += [(c, dropped) for c in reversed(e.children) if isinstance(c, Element)]
    return articles or mains[:1] or bodies[:1] or [root]


def hashes(element: Element) -> dict[int, int]:
    """id(element) -> hash of its subtree, for every element below and `element` itself."""
    out: dict[int, int] = {}
    order = list(_walk(element))
    for e in reversed(order):
        inner = [c.strip() if isinstance(c, str) else format(out[id(c)], "x") for c in e.children]
        out[id(e)] = xxhash.xxh64_intdigest("\x1f".join([e.tag, e.attrs, *inner]).encode("utf-8", "surrogatepass"))
    return out


def extract(html: str | None, templates: frozenset[int] = frozenset()) -> str:
    """Text blocks of the main parts, without subtrees whose hash is a template."""
    if not html:
        return ""
    parts = main_parts(parse(html))
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        if line:
            text = _SPACE.sub(" ", unescape("".join(line))).strip()
            line.clear()
            if text:
                blocks.append(text)

    for part in parts:
        known = hashes(part) if templates else {}
        inside = part.tag in ("article", "main")
        todo: list = [part]
        while todo:
            item = todo.pop()
            if item is None:
                flush()
            elif isinstance(item, str):
                line.append(item)
            elif item is not part and (_unwanted(item, inside) or item.tag in BLOCK and known.get(id(item)) in templates):
                if item.tag in BLOCK:
                    flush()
            elif item.tag == "br":
                line.append("\n")
            else:
                block = item.tag in BLOCK
                if block:
                    flush()
                    todo.append(None)
                todo += reversed(item.children)
        flush()
    return "\n\n".join(blocks)


def _host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")))


def templates(pages: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(host, hashes): subtrees in at least `share` of the host's pages with different main parts, and in `least`.

    At most 1 / share times the subtrees of an average page are listed for a host.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, html in zip(batch["host"], batch["html"]):
                if not html:
                    continue
                found, main = set(), 0
                for part in main_parts(parse(html)):
                    known = hashes(part)
                    main = main * 31 + known[id(part)] & (2**64 - 1)
                    found |= {known[id(e)] for e in _walk(part) if e is not part and e.tag in BLOCK}
                rows += [(host, main, h, False) for h in found] + [(host, main, 0, True)]
            host, main, node, page = zip(*rows) if rows else ((), (), (), ())
            signed = [np.array(x, dtype=np.uint64).view(np.int64) for x in (main, node)]
            made = pd.DataFrame({"host": host, "main": signed[0], "hash": signed[1], "page": np.array(page, dtype=bool)})
            yield made.drop_duplicates()

    seen = pages.mapInPandas(work, "host string, main long, hash long, page boolean").distinct()
    counts = seen.groupBy("host", "hash", "page").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.filter("page").select("host", F.col("n").alias("pages"))
    common = counts.filter("not page").filter(F.col("n") >= least).join(sizes, "host").filter(F.col("n") >= share * F.col("pages"))
    return common.groupBy("host").agg(F.collect_list("hash").alias("hashes"))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) per page."""
    short_batches(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), _host(F.col(url_col)).alias("host")
    )
    found = templates(rows.select("host", "html"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for html, known in zip(batch["html"], batch["hashes"]):
                listed = [] if known is None else np.array(known, dtype=np.int64).view(np.uint64).tolist()
                texts.append(extract(html, frozenset(listed)))
            yield pd.DataFrame({"id": batch["id"], "url": batch["url"], "text": texts})

    return rows.join(found, "host", "left").select("id", "url", "html", "hashes").mapInPandas(work, "id long, url string, text string")

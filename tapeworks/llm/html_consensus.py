"""HTML extraction by consensus: pages of a host agree on the path of the container that holds the main text.

Each page's containers are scored by the running text in them. The scores are summed over all pages of a host by
the containers' paths, made general (tags and classes, digits hidden). Every page is then read again, and the text
under its host's winning path is what it gives, with what stands beside it in the container around. A page without such
a container gives its own best one, and so does one with hardly any text there, unless the host has voted that down.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.functions.skew import left_lookup
from tapeworks.llm.columns import Compute, add_columns, stage, without
from tapeworks.llm.components import HOT_ROWS

# Winning paths are broadcast up to so many hosts and characters; beyond that they are joined by a shuffle.
BROADCAST_HOSTS = 10_000
BROADCAST_CHARS = 4_000_000
# Running text, in characters, that hardly makes an article.
HARDLY = 140

# What the tags of a page mean.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
CONTAINERS = frozenset("html body main article section div center table tbody td blockquote ul ol dl figure details".split())
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd pre address hr br tr th thead tfoot caption summary figcaption hgroup header "
    "footer nav aside form fieldset legend option".split())
NEVER = frozenset(
    "head title script style noscript template textarea iframe object svg canvas nav footer aside button select label "
    "legend dialog menu".split())
NEVER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog menu alert".split())
# Words in a class or id that mark what is not the article.
NEVER_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead ad ads advert adverts "
    "advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices alert "
    "comment comments disqus reply replies share sharing social related newsletter subscribe signup login popup "
    "modal overlay widget form".split())

# With these, a header is that of an article.
ARTICLE_NAMES = frozenset("article post entry story content title headline".split())
# Tags whose end may be left out: the next of them ends the one that is open, within the tags behind them.
ENDED_BY = {
    "td": (("td", "th"), "table"), "th": (("td", "th"), "table"), "tr": (("td", "th", "tr"), "table"),
    "tbody": (("td", "th", "tr", "tbody", "thead"), "table"), "tfoot": (("td", "th", "tr", "tbody", "thead"), "table"),
    "li": (("li",), "ul ol"), "dt": (("dt", "dd"), "dl"), "dd": (("dt", "dd"), "dl"),
}

# Quotes hold a value only right after "="; the second is for a tag whose quoted value does not end.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)*+)>""")
_OPEN_QUOTE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][\w-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
_DIGITS = re.compile(r"\d+")
_NAME_PARTS = re.compile(r"[a-z]+")


@dataclass(eq=False)
class Element:
    """An open container: a hash of its general path, and whether it can hold main text.

    ``doubt`` says that its name or tag often marks what is not the article: 1 if only a part of the name does, 2 if
    all of it. ``doubtful`` is the nearest such element from this one upwards.
    """

    tag: str
    path: str
    parent: Element | None
    useful: bool
    in_article: bool
    doubt: int = 0
    chars: float = 0.0
    inner: float = 0.0

    def __post_init__(self) -> None:
        self.depth: int = 0 if self.parent is None else self.parent.depth + 1
        self.doubtful: Element | None = self if self.doubt or self.parent is None else self.parent.doubtful

    def score(self) -> float:
        own = self.chars + 0.5 * self.inner
        return 2 * own if self.tag in ("article", "main") else own


@dataclass(eq=False)
class Block:
    """Text between two block boundaries, and the container that it stands in."""

    element: Element
    pieces: list[str] = field(default_factory=list)
    linked: int = 0

    @cached_property
    def text(self) -> str:
        return " ".join("".join(self.pieces).split())

    @property
    def running(self) -> int:
        """Characters less what is linked; in an article links are part of the text."""
        return len(self.text) if self.element.in_article else max(0, len(self.text) - 2 * self.linked)


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(source)} if source.strip() else {}


def _excluded(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in NEVER or tag == "header" and not in_article:
        return True
    if not attributes:
        return False
    style = attributes.get("style", "").replace(" ", "").lower()
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in style:
        return True
    if attributes.get("role", "").lower() in NEVER_ROLES:
        return True
    return False


def _doubt(tag: str, attributes: dict[str, str], in_article: bool) -> int:
    if tag in ("html", "body", "article", "main"):
        return 0
    found = int(tag == "form")
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        parts = set(_NAME_PARTS.findall(name))
        marks = parts & NEVER_NAMES
        if marks and not (marks == {"header"} and (in_article or parts & ARTICLE_NAMES)):
            found = max(found, 2 if parts == marks else 1)
    return found


def _step(tag: str, attributes: dict[str, str]) -> str:
    classes = sorted(set(_DIGITS.sub("#", attributes.get("class", "").lower()).split()))
    return ".".join([tag, *classes])


def blocks(html: str) -> list[Block]:
    """The page's blocks of text that may be main text, in page order.

    An element of doubtful name or a form is left out, unless it is what the page's text stands in: it is kept if it
    holds four times as much running text as stands in no such element, and, if all of its name says what it is, if
    hardly any stands elsewhere. So wrappers are kept and what is small in them goes.
    """
    found = list(_all_blocks(html))
    running = {block: block.running for block in found}
    if not any(running.values()):
        running = {block: len(block.text) for block in found}
    own: dict[Element, int] = {}
    inner: dict[Element, list[Element]] = {}
    linked: set[Element] = set()
    for block, size in running.items():
        at = block.element.doubtful
        own[at] = own.get(at, 0) + size
        while at.parent is not None and at not in linked:
            linked.add(at)
            inner.setdefault(at.parent.doubtful, []).append(at)
            at = at.parent.doubtful
    held: dict[Element, int] = {}
    for element in sorted({*own, *inner}, key=lambda e: -e.depth):
        held[element] = own.get(element, 0) + sum(held[e] for e in inner.get(element, ()))
    top = next((e for e in held if e.parent is None), None)
    kept, clean, waiting = {top}, own.get(top, 0), list(inner.get(top, ()))
    for doubt in (1, 2):
        while True:
            best = max((e for e in waiting if e.doubt == doubt), key=held.__getitem__, default=None)
            if best is None or held[best] < 4 * clean or not held[best] or doubt == 2 and clean >= HARDLY:
                break
            kept.add(best)
            clean += own.get(best, 0)
            waiting = [e for e in waiting if e is not best] + inner.get(best, [])
    return [block for block in found if block.element.doubtful in kept]


def _all_blocks(html: str) -> Iterator[Block]:
    top = Element("", "", None, True, False)
    here, block, links, at = top, None, 0, 0
    while True:
        mark = html.find("<", at)
        text = html[at:] if mark < 0 else html[at:mark]
        if text and here.useful:
            if block is None:
                block = Block(here)
            piece = unescape(text) if "&" in text else text
            block.pieces.append(piece)
            if links:
                block.linked += len(piece)
        if mark < 0:
            break
        tag_match = _TAG.match(html, mark) or _OPEN_QUOTE.match(html, mark)
        if tag_match is None:
            other = _OTHER.match(html, mark)
            if other is not None:
                at = other.end()
            elif re.match(r"<[a-zA-Z]", html[mark : mark + 2]):
                break  # a tag that the page's end cuts off
            else:  # a bare sign
                if here.useful:
                    block = block or Block(here)
                    block.pieces.append("<")
                at = mark + 1
            continue
        at = tag_match.end()
        closing, tag = tag_match[1], tag_match[2].lower()
        if tag == "a":
            links = 0 if closing else 1
        if tag in BLOCKS and block is not None:
            yield block
            block = None
        if closing:
            open_one = here
            while open_one.parent is not None and open_one.tag != tag:
                open_one = open_one.parent
            if open_one.parent is not None:
                if block is not None:
                    yield block
                    block = None
                here = open_one.parent
                links = 0
            continue
        if tag in BLOCKS and here.tag == "p":
            here = here.parent
        if tag in ENDED_BY:
            ended, within = ENDED_BY[tag]
            open_one = here
            while open_one.parent is not None and open_one.tag not in ended and open_one.tag not in within.split():
                open_one = open_one.parent
            while open_one.parent is not None and open_one.tag in ended:
                here = open_one = open_one.parent
                links = 0
        if tag in VOID:
            continue
        attributes = _attributes(tag_match[3])
        excluded = _excluded(tag, attributes, here.in_article)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else len(html)
            continue
        doubt = _doubt(tag, attributes, here.in_article)
        if excluded or doubt or tag in CONTAINERS:
            if block is not None:
                yield block
                block = None
            path = hashlib.blake2b(f"{here.path}>{_step(tag, attributes)}".encode(), digest_size=8).hexdigest()
            here = Element(tag, path, here, here.useful and not excluded, here.in_article or tag in ("article", "main"), doubt)
    if block is not None:
        yield block


def container_scores(html: str | list[Block]) -> dict[str, float]:
    """For each general path of the page, the score of its containers: running text in them, less what is linked.

    A container counts half of what its inner containers do; article and main count double. On a page whose whole text
    is linked, links count like text.
    """
    found = blocks(html) if isinstance(html, str) else html
    linked_only = not any(block.running for block in found)
    elements: set[Element] = set()
    for block in found:
        block.element.chars += len(block.text) if linked_only else block.running
        element = block.element
        while element is not None and element not in elements:
            elements.add(element)
            element = element.parent
    scores: dict[str, float] = {}
    for element in sorted(elements, key=lambda e: -e.depth):
        score = element.score()
        if element.parent is not None:
            element.parent.inner += score
        if score > 0:
            scores[element.path] = scores.get(element.path, 0.0) + score
    return scores


def best_path(scores: dict[str, float]) -> str | None:
    return min(scores, key=lambda path: (-scores[path], path), default=None)


def whole_path(found: list[Block], path: str) -> str:
    """The highest container around the path that has text of its own, and at least half of whose text is under the path.

    Text counts less what is linked; an article or main is not left.
    """
    own: dict[str, int] = {}
    held: dict[str, int] = {}
    around: dict[str, Element] = {}
    for block in found:
        size, element = block.running, block.element
        own[element.path] = own.get(element.path, 0) + size
        while element is not None:
            held[element.path] = held.get(element.path, 0) + size
            around.setdefault(element.path, element)
            element = element.parent
    best = path
    at = around.get(path)
    while at is not None and at.parent is not None and at.tag not in ("article", "main"):
        at = at.parent
        if 2 * held.get(path, 0) < held[at.path]:
            break
        if own.get(at.path):
            best = at.path
    return best


def main_text(html: str, path: str | None, usual: Sequence[str] = ()) -> str:
    """The text under all containers with the path, and beside them in the container around (see ``whole_path``).

    It is that of the page's best path if there is none, or if that one scores more than twice as much and is not
    among the ``usual`` paths of the host, which had their votes.
    """
    found = blocks(html)

    def under(wanted: str | None) -> list[Block]:
        kept = []
        for block in found:
            element = block.element
            while element is not None and element.path != wanted:
                element = element.parent
            if element is not None:
                kept.append(block)
        return kept

    scores = container_scores(found)
    best = best_path(scores)
    chosen = under(path) if path is not None else []
    other = best is not None and best not in usual and scores[best] > 2 * scores.get(path, 0.0)
    if other or not any(block.text for block in chosen):
        path, chosen = best, under(best)
    if path is not None and chosen:
        inner = {id(block) for block in chosen}
        around = under(whole_path(found, path))
        chosen = [block for block in around if id(block) in inner or block.running]
    return " ".join(filter(None, (block.text for block in chosen)))


def host_of(url: str) -> Column:
    """The lower-case host of a url, without user and port; empty for null and for what is no url."""
    authority = F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)
    return F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", "")


def votes(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path, votes, pages, firsts): each page shares a thousand votes among its paths by their scores.

    ``firsts`` are the pages whose first path it is; over all paths of a host these are its pages.
    """
    def make() -> Compute:
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = []
            for page in batch.column(html).to_pylist():
                scores = container_scores(page or "")
                total = sum(scores.values())
                rows.append([{"path": p, "votes": round(1000 * s / total), "first": int(k == 0)}
                             for k, (p, s) in enumerate(scores.items())])
            return [pa.array(rows, pa.list_(pa.struct([("path", pa.string()), ("votes", pa.int64()), ("first", pa.int64())])))]
        return compute

    fields = T.StructType([T.StructField("paths", T.ArrayType(T.StructType([
        T.StructField("path", T.StringType()), T.StructField("votes", T.LongType()),
        T.StructField("first", T.LongType())])))])
    scored = add_columns(pages.select(host_of(url).alias("host"), F.col(html).alias("__html")).withColumnRenamed(
        "__html", html), html, fields, make, ["host"])
    return scored.select("host", F.explode("paths").alias("p")).groupBy("host", "p.path").agg(
        F.sum("p.votes").alias("votes"), F.count("*").alias("pages"), F.sum("p.first").alias("firsts"))


def winners(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path, pages, usual): the path with most votes of each host, the smaller path among equals.

    ``usual`` are the paths that at least half of the host's pages have; there are at most twice as many as a page has
    on average.
    """
    counted = stage(votes(pages, url, html), "html-votes")
    most = counted.groupBy("host").agg(F.max("votes").alias("most"), F.max("pages").alias("rows"), F.sum("firsts").alias("all"),
                                       F.count("*").alias("paths"))
    known = left_lookup(counted, most, ["host"], "paths", HOT_ROWS).select(*counted.columns, "found.most", "found.rows", "found.all")
    return known.groupBy("host").agg(
        F.min(F.when(F.col("votes") == F.col("most"), F.col("path"))).alias("path"), F.max("rows").alias("pages"),
        F.sort_array(F.collect_list(F.when(2 * F.col("pages") >= F.col("all"), F.col("path")))).alias("usual"))


def extracted(pages: DataFrame, url: str = "url", html: str = "html", text: str = "text",
              keep: Sequence[str] | None = None) -> DataFrame:
    """pages with the main text of each whole page.

    Null and empty pages, and pages without running text, give an empty text. A page whose url is null or has no
    host belongs to a host of its own. Repeated pages stay and vote again. A column that has the name of ``text`` is
    replaced.
    """
    chosen = stage(winners(pages, url, html), "html-winners")
    hosts, chars = chosen.agg(F.count("*"), F.coalesce(F.sum(
        F.length("host") + F.length("path") + F.length(F.array_join("usual", " "))), F.lit(0))).first()
    columns = [c for c in without(pages, [text, "__host", "__path", "__usual"]) if keep is None or c in keep or c == html]
    rows = pages.select(*columns, host_of(url).alias("__host"))
    if hosts <= BROADCAST_HOSTS and chars <= BROADCAST_CHARS:
        found = rows.join(F.broadcast(chosen.select(F.col("host").alias("__host"), F.col("path").alias("__path"),
                                                         F.col("usual").alias("__usual"))), "__host", "left")
    else:
        lookup = chosen.withColumnRenamed("host", "__host")
        held = rows.select("__host", F.struct(*columns).alias("__row"))
        found = left_lookup(held, lookup, ["__host"], "pages", HOT_ROWS).select(
            "__row.*", F.col("found.path").alias("__path"), F.col("found.usual").alias("__usual"))

    def make() -> Compute:
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = zip(*(batch.column(c).to_pylist() for c in (html, "__path", "__usual")))
            return [pa.array([main_text(page or "", path, usual or ()) for page, path, usual in rows], pa.string())]
        return compute

    out = [c for c in columns if keep is None or c in keep]
    read = found.select(*columns, "__path", "__usual")
    return add_columns(read, html, T.StructType([T.StructField(text, T.StringType())]), make, [*out, "__path", "__usual"]) \
        .select(*out, text)

"""Main text of web pages: structure rules and site template removal.

A page is read once, tag by tag, with the end tags that HTML implies. Text is
collected in blocks; every element is hashed over its tag, class, id, text and
the hashes of its children when it closes, so depth costs no recursion.

1. *Templates.* The hashes of block elements are counted per host, once per
   distinct page (equal html counts once), pre-aggregated in each task. A
   container found on at least ``min_pages`` pages and a fifth (``share``) of its
   host's pages is a template and is deleted; a paragraph, heading, list item or
   other text block must be on half (``text_share``) of them. Inside ``article``
   or ``main`` only containers can be templates, at ``inner_share``: passages that
   many articles quote stay. Templates below ``text_share`` that together hold
   more than half of a page's text are its content and stay. Hosts of fewer than
   ``min_pages`` pages are judged by the rules alone.
2. *Rules.* Menus, headers, footers, sidebars, notices, adverts, forms,
   scripts, styles, hidden parts and reader comments go by tag, role, class or
   id. A class or id counts whole or by its first part (``sidebar-left``, not
   ``has-sidebar``) and never removes what encloses an ``article`` or ``main``
   or more than half of the page's text; headings and paragraphs inside them go
   only as adverts, notices or comments. A form around more than half of the
   page's text stays, and so does a ``header``, ``nav``, ``aside`` or ``footer``
   around an ``article`` or ``main`` of that much. Comments of the markup are no
   text.
3. *Main part.* If the page has ``article`` elements, their text is the main
   text, unless ``main`` holds more than twice as much; else that of ``main``;
   else that of the whole page.

Character references are decoded, white space within a block becomes one
space, blocks are trimmed and joined by a line break in page order; ``br``
counts as white space. Null html is empty and gives an empty text. Pages
without a host (null or relative url) are judged by the rules alone. Other
columns are passed through by ``extract_main_text``.

At most ``elements per page / share`` templates exist per host, so the table
joined to the pages stays small; it is written first, so Spark broadcasts it by
its file size or shuffles both sides, splitting a busy host.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from html import unescape
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.llm.arrow import add_columns
from aerolith.session import materialize

MIN_PAGES = 10
SHARE = 0.2
INNER_SHARE = 0.2
TEXT_SHARE = 0.5
# How a template was found: key of a subtree hash inside an article or main, and at text_share.
INNER, STRONG = 1, 2
# Distinct (host, subtree) pairs a task holds before it sends its counts.
HELD_COUNTS = 200_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th figcaption caption address summary".split())
CONTAINERS = frozenset(
    "div section ul ol dl table tbody thead tfoot tr nav aside header footer form fieldset figure details main article".split()
)
BLOCKS = TEXT_BLOCKS | CONTAINERS | frozenset("html body head title center hgroup menu dialog option".split())
DROPPED_TAGS = frozenset(
    "head title script style noscript template nav header footer aside form button select textarea iframe svg canvas "
    "object audio video menu dialog".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs header masthead footer sidebar widget widgets comment comments reply replies disqus respondform cookie "
    "cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe signup login share sharing "
    "social related recommended recommendations pagination pager toolbar copyright skiplink".split()
)
# Dropped by tag unless they enclose the main part.
WRAPPERS = frozenset("form header nav aside footer".split())
# Text blocks of an article or main whose class or id counts only if it is one of these.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
NOT_PROSE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored comment comments reply replies cookie cookies "
    "consent gdpr notice notices".split()
)
# What makes an article element something other than the article.
NOT_ARTICLE = frozenset("ad ads advert advertisement sponsored promo comment comments reply replies related recommended teaser".split())
MAY_REPEAT = BLOCKS - {"html", "body", "head", "title", "article", "main"}
# An opening tag ends these open elements, searched up to the given limits.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
P_SCOPE = ("table", "td", "th", "button", "html")
# Elements whose content is text up to their end tag; only some of it is shown.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
MARKUP = re.compile(r"<(?:(!--)|([!?])|(/?)([A-Za-z][^\s/>]*+))")
ATTRIBUTES = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


def host_of(url: str | None) -> str | None:
    found = HOST.match(url or "")
    return found[1].lower() if found else None


@dataclass
class Element:
    """An element as a range of the page's pieces."""

    tag: str
    start: int
    ruled: bool
    signature: str
    named: bool = False
    wrapper: bool = False
    parts: list[str] = field(default_factory=list)
    end: int = -1
    digest: int = 0
    inside: bool = False


def _signed(digest: int) -> int:
    return digest - (1 << 63)


def _names(attributes: dict[str, str]) -> set[str]:
    """The words of class and id, whole and their leading parts."""
    words = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()
    return {part for word in words for part in (word, re.split(r"[^a-z0-9]+", word, maxsplit=1)[0])}


def is_boilerplate(tag: str, attributes: dict[str, str]) -> bool:
    """Whether the rules remove an element, judged by its tag, role and state."""
    if tag in ("html", "body"):
        return False
    if tag in DROPPED_TAGS or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if not attributes:
        return False
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I):
        return True
    return attributes.get("role", "").lower() in DROPPED_ROLES


def is_named_boilerplate(tag: str, attributes: dict[str, str], inside: bool) -> bool:
    """Whether an element's class or id speaks for removing it."""
    if tag in ("html", "body") or not ("class" in attributes or "id" in attributes):
        return False
    against = NOT_ARTICLE if tag in ("article", "main") else NOT_PROSE if inside and tag in PROSE else DROPPED_NAMES
    return bool(_names(attributes) & against)


def read_markup(html: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """``("text", text, {})``, ``("open", tag, attributes)`` and ``("close",
    tag, {})`` in page order. Whatever the input, its length is passed over a
    bounded number of times."""
    at, last = 0, html.rfind(">")
    while at < len(html):
        less = html.find("<", at)
        if less < 0:
            less = len(html)
        if less > at:
            yield "text", unescape(html[at:less]), {}
        if less == len(html):
            return
        found = MARKUP.match(html, less)
        if not found:
            yield "text", "<", {}
            at = less + 1
            continue
        if less > last:
            return  # the page ends inside a tag or comment
        comment, declared, slash, name = found.groups()
        if comment:
            end = html.find("-->", less + 2)
            at = len(html) if end < 0 else end + 3
            continue
        if declared or slash:
            end = html.find(">", less) + 1
        else:
            inner = ATTRIBUTES.match(html, found.end())
            end = inner.end() if inner else html.find(">", found.end()) + 1
        at = end
        if declared:
            continue
        tag = name.lower()
        if slash:
            yield "close", tag, {}
            continue
        attributes: dict[str, str] = {}
        for key, *values in ATTRIBUTE.findall(html, found.end(), end - 1):
            attributes.setdefault(key.lower(), unescape(next((v for v in values if v), "")))
        yield "open", tag, attributes
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(html, at)
            until = close.start() if close else len(html)
            yield "text", html[at:until], {}
            at = until


class Page:
    """A page as ``pieces`` (text, or None where a block begins or ends) and
    the ``elements`` over them."""

    def __init__(self, html: str):
        self.pieces: list[str | None] = []
        self.elements: list[Element] = []
        self.open: list[Element] = []
        self.depth: Counter = Counter()
        for kind, value, attributes in read_markup(html):
            if kind == "text":
                self._text(value)
            elif kind == "open":
                self._open(value, attributes)
            else:
                self._end(value)
        while self.open:
            self._pop()
        self._spare_wrappers()
        self._rule_named()

    def _shown(self, wanted: Callable[[Element], bool]) -> list[int]:
        """Characters of text before each piece that no wanted element covers."""
        gone = self._covered(wanted)
        return list(accumulate((0 if g or not p else len(p.strip()) for p, g in zip(self.pieces, gone)), initial=0))

    def _spare_wrappers(self) -> None:
        """Keep forms around more than half of the page's text, and other
        wrappers around an article or main of that much."""
        wrappers = [e for e in self.elements if e.wrapper]
        if not wrappers:
            return
        shown = self._shown(lambda e: e.ruled and not e.wrapper)

        def most(e: Element) -> bool:
            return 2 * (shown[e.end] - shown[e.start]) > shown[-1]

        parts = [e for e in self.elements if e.tag in ("article", "main") and not (e.ruled or e.named) and most(e)]
        for e in wrappers:
            if e.tag == "form" and most(e) or any(e.start <= part.start and part.end <= e.end for part in parts):
                e.ruled = False

    def _rule_named(self) -> None:
        """Remove what its class or id speaks against, unless it encloses an
        article or main of the page or most of the page's text."""
        named = [e for e in self.elements if e.named and not e.ruled]
        if not named:
            return
        shown = self._shown(lambda e: e.ruled)
        parts = sorted(e.start for e in self.elements if e.tag in ("article", "main") and not (e.ruled or e.named))
        for e in named:
            if e.tag not in ("article", "main"):
                at = bisect_left(parts, e.start)
                if at < len(parts) and parts[at] < e.end or 2 * (shown[e.end] - shown[e.start]) > shown[-1]:
                    continue
            e.ruled = True

    def _pop(self, at: int = -1) -> None:
        element = self.open.pop(at)
        self.depth[element.tag] -= 1
        if element.tag in BLOCKS:
            self.pieces.append(None)
        element.end = len(self.pieces)
        element.digest = xxhash.xxh64_intdigest("\x00".join([element.signature, *element.parts]))
        parts = self.open[-1].parts if self.open else []
        parts.append(f"{element.digest:x}")
        element.parts = []
        self.elements.append(element)

    def _close_up_to(self, tags: tuple[str, ...], limits: tuple[str, ...]) -> None:
        if not any(self.depth[t] for t in tags):
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at].tag in tags:
                while len(self.open) > at:
                    self._pop()
                return
            if self.open[at].tag in limits:
                return

    def _open(self, tag: str, attributes: dict[str, str]) -> None:
        if tag == "br":
            self.pieces.append(" ")
            return
        if tag in BLOCKS or tag == "hr":
            self._close_up_to(("p",), P_SCOPE)
            self.pieces.append(None)
        if tag in VOID:
            return
        if tag in CLOSES:
            self._close_up_to(*CLOSES[tag])
        signature = f"{tag}|{attributes.get('class', '')}|{attributes.get('id', '')}"
        element = Element(tag, len(self.pieces), is_boilerplate(tag, attributes), signature)
        element.wrapper = element.ruled and tag in WRAPPERS and not is_boilerplate("div", attributes)
        element.inside = self.depth["article"] > 0 or self.depth["main"] > 0
        element.named = is_named_boilerplate(tag, attributes, element.inside)
        self.open.append(element)
        self.depth[tag] += 1

    def _end(self, tag: str) -> None:
        if tag == "br":
            self.pieces.append(" ")
        if not self.depth[tag]:
            return
        at = next(i for i in range(len(self.open) - 1, -1, -1) if self.open[i].tag == tag)
        if tag not in BLOCKS and any(e.tag in BLOCKS for e in self.open[at + 1 :]):
            self._pop(at)  # an inline end tag closes no block
            return
        while len(self.open) > at:
            self._pop()

    def _text(self, data: str) -> None:
        self.pieces.append(data)
        if self.open and (shown := " ".join(data.split())):
            self.open[-1].parts.append(shown)

    def candidates(self) -> list[tuple[int, bool]]:
        """Subtrees that can be templates: ``(hash, inside an article or main)``."""
        shown = list(accumulate((bool(p and not p.isspace()) for p in self.pieces), initial=0))
        return [
            (_signed(e.digest), e.inside)
            for e in self.elements
            if e.tag in MAY_REPEAT and (not e.inside or e.tag in CONTAINERS) and shown[e.end] > shown[e.start]
        ]

    def _covered(self, wanted: Callable[[Element], bool]) -> list[bool]:
        """For each piece, whether a wanted element covers it."""
        steps = [0] * (len(self.pieces) + 1)
        for e in self.elements:
            if wanted(e):
                steps[e.start] += 1
                steps[e.end] -= 1
        return [depth > 0 for depth in accumulate(steps[:-1])]

    def _kept(self, gone: list[bool]) -> list[bool]:
        """For each piece, whether the main part covers it."""
        article, main = (self._covered(lambda e, tag=tag: e.tag == tag and not e.ruled) for tag in ("article", "main"))
        in_article, in_main = self._length(gone, article), self._length(gone, main)
        if in_article and in_main <= 2 * in_article:
            return article
        return main if in_main else [True] * len(self.pieces)

    def _length(self, gone: list[bool], kept: list[bool]) -> int:
        return sum(len(p.strip()) for p, g, k in zip(self.pieces, gone, kept) if p and k and not g)

    def main_text(self, templates: set[int]) -> str:
        """The main text, without ``templates`` (keys of ``site_templates``)."""

        def found(e: Element, strong: int) -> bool:
            able = e.tag in CONTAINERS if e.inside or not strong else True
            return able and e.tag in MAY_REPEAT and _signed(e.digest) ^ (INNER * e.inside) ^ strong in templates

        gone = self._covered(lambda e: e.ruled or (bool(templates) and found(e, STRONG)))
        kept = self._kept(gone)
        if templates:
            fewer = self._covered(lambda e: e.ruled or found(e, 0) or found(e, STRONG))
            if 2 * self._length(fewer, kept) >= self._length(gone, kept):
                gone, kept = fewer, self._kept(fewer)
        blocks, current = [], []
        for piece, dropped, wanted in zip(self.pieces, gone, kept):
            if piece is None:
                blocks.append("".join(current))
                current = []
            elif wanted and not dropped:
                current.append(piece)
        blocks.append("".join(current))
        return "\n".join(block for b in blocks if (block := " ".join(b.split())))


def _host() -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), HOST.pattern, 1))


def _with_copies(pages: DataFrame) -> DataFrame:
    """``url, html, copies``: how many pages of the host have this html. Only
    hashes are shuffled to count them; the table of those that repeat is
    written first, so Spark broadcasts it by its file size."""
    seen = pages.select(F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    seen = seen.withColumn("__host", _host()).withColumn("__page", F.unhex(F.sha2(F.col("html"), 256)))
    repeated = seen.groupBy("__host", "__page").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    joined = seen.join(materialize(repeated, "page-copies"), ["__host", "__page"], "left")
    return joined.select("url", "html", F.coalesce("copies", F.lit(1)).alias("copies"))


def template_counts(pages: DataFrame) -> DataFrame:
    """``host, subtree, inside, n``: on how many distinct pages of its host a
    subtree is; ``subtree`` null counts the host's distinct pages. Each of k
    copies adds 1 / k, which sums to a whole number."""
    schema = pa.schema([("host", pa.string()), ("subtree", pa.int64()), ("inside", pa.bool_()), ("n", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict = defaultdict(float)

        def sent() -> pa.RecordBatch:
            columns = list(zip(*(key + (n,) for key, n in held.items()))) or [()] * 4
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            for url, html, copies in zip(batch.column(0), batch.column(1), batch.column(2)):
                host = host_of(url.as_py())
                if host is None:
                    continue
                part = 1 / copies.as_py()
                held[host, None, False] += part
                for digest, inside in set(Page(html.as_py()).candidates()):
                    held[host, digest, inside] += part
                if len(held) >= HELD_COUNTS:
                    yield sent()
        yield sent()

    counted = _with_copies(pages).mapInArrow(run, "host string, subtree long, inside boolean, n double")
    return counted.groupBy("host", "subtree", "inside").agg(F.round(F.sum("n")).cast("long").alias("n"))


def site_templates(
    pages: DataFrame,
    min_pages: int = MIN_PAGES,
    share: float = SHARE,
    inner_share: float = INNER_SHARE,
    text_share: float = TEXT_SHARE,
) -> DataFrame:
    """``host, templates`` (array of subtree hashes, each combined with
    ``INNER`` if found inside an article or main, and once more with
    ``STRONG`` if found on ``text_share`` of the pages)."""
    counts = materialize(template_counts(pages).where(F.col("subtree").isNull() | (F.col("n") >= min_pages)), "subtree-counts")
    totals = counts.where(F.col("subtree").isNull()).select("host", F.col("n").alias("n_pages"))
    needed = F.when(F.col("inside"), F.lit(inner_share)).otherwise(F.lit(share)) * F.col("n_pages")
    strong = F.col("n") >= F.lit(text_share) * F.col("n_pages")
    key = F.col("subtree").bitwiseXOR(F.when(F.col("inside"), F.lit(INNER).cast("long")).otherwise(F.lit(0).cast("long")))
    keys = F.array(F.when(F.col("n") >= needed, key), F.when(strong, key.bitwiseXOR(F.lit(STRONG).cast("long"))))
    found = counts.where(F.col("subtree").isNotNull()).join(totals, "host")
    found = found.select("host", F.explode(F.array_compact(keys)).alias("key"))
    return found.groupBy("host").agg(F.collect_set("key").alias("templates"))


def extract_main_text(
    pages: DataFrame,
    min_pages: int = MIN_PAGES,
    share: float = SHARE,
    inner_share: float = INNER_SHARE,
    text_share: float = TEXT_SHARE,
) -> DataFrame:
    """``pages`` (``url, html``) with the main text in ``text`` (a column of
    that name is replaced)."""
    templates = materialize(site_templates(pages, min_pages, share, inner_share, text_share), "site-templates")
    templates = templates.select(F.col("host").alias("__host"), F.col("templates").alias("__templates"))
    joined = pages.join(templates, _host() == F.col("__host"), "left").drop("__host")
    both = F.struct(F.col("html").cast("string").alias("html"), F.col("__templates").alias("templates"))

    def make(column: pa.Array) -> list[pa.Array]:
        found = zip(column.field("html"), column.field("templates"))
        return [pa.array([Page(h.as_py() or "").main_text(set(t.as_py() or ())) for h, t in found], pa.string())]

    return add_columns(joined, both, [T.StructField("text", T.StringType())], make, without="__templates")


def main_text_report(pages: DataFrame) -> DataFrame:
    found = extract_main_text(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))

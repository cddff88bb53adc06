"""Operator 9: main text of web pages by removal of site templates.

Each page is read into its elements.  Subtrees (tag, class words, text and children hashed together) are counted per
host, outside articles over the distinct pages and inside them over the distinct articles, so a story under many addresses is
not taken for template; those on at least ``LEAST_PAGES`` and a tenth of the host's are template and are left out, as
are menus, forms, adverts and the like by tag or class.  The article itself, what stands around it and the single cells
of its tables are not counted, what is in them is.  The rest of the main article (see ``Page.text``), or of the body if
none is marked, gives the text: blocks in page order.

Counts are combined before the shuffle, so a host with a third of all pages is no large group; the
template of a host has at most ten times as many subtrees as a page.  Reading a page takes time in proportion to its
length, also where elements stand in one another many thousand deep.

Defined results: null, empty and tag-free pages are read as they are (text without tags is one block);
pages without a host have no site template; equal pages of a host count once; the text may be empty but is never null.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcela.llm.shared import fresh, read, stored
from parcela.llm.urls import host_of

LEAST_PAGES = 5
LEAST_SHARE = 0.1

# Names of elements and class words.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
RAW_END = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small
span strike strong sub sup time tt u var wbr ruby rb rt rp""".split())
CLOSES_P = frozenset("""address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4
h5 h6 header hr main menu nav ol p pre section table ul""".split())
SCOPES = frozenset("article aside body div section main td th li blockquote table form nav footer header html".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
DROPPED_TAGS = frozenset("""head script style noscript template iframe svg canvas nav aside footer form button select input
textarea dialog menu object embed audio video""".split())
DROPPED_WORDS = frozenset("""nav navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar widget ad ads advert
advertisement adverts banner promo promotion sponsored sponsor cookie cookies consent notice alert popup modal
newsletter subscribe share sharing social comment comments disqus replies respond related recommended login signup
search skip toolbar pagination pager""".split())
DROPPED_ROLES = frozenset("""navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar
note toolbar""".split())
ARTICLE_TAGS = frozenset(["article", "main"])
CELLS = frozenset(["td", "th"])
#: A class that says what a page has or allows, and does not name what the element is.
MODIFIER = re.compile(r"^(?:has|no|with|without|is|not|show|hide)[-_]|[-_](?:open|closed|enabled|disabled|on|off|layout)$")

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
                 r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z0-9]+")


class Element:
    __slots__ = ("tag", "words", "unwanted", "article", "inside", "kept", "holds", "digest", "hash", "block", "parent", "state")

    def __init__(self, tag: str, attributes: str, parent: Element | None):
        self.tag, self.parent = tag, parent
        self.inside = parent is not None and (parent.inside or parent.article)  # an article stands around it
        values = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
        named = set(WORD.findall(f"{values.get('class', '')} {values.get('id', '')}")) if values else set()
        meant = named
        if not named.isdisjoint(DROPPED_WORDS) or "header" in named:
            tokens = f"{values.get('class', '')} {values.get('id', '')}".split()
            meant = set(WORD.findall(" ".join(t for t in tokens if not MODIFIER.search(t))))
        role = values.get("role", "")
        self.words = " ".join(sorted(named))
        self.article = tag in ARTICLE_TAGS or role in ("article", "main") or values.get("itemprop") == "articlebody"
        #: 2: by its tag or role, 1: by its class words or as a form, which may stand around everything
        self.unwanted = 0
        if not self.article and tag != "body" and tag != "html":
            if (tag in DROPPED_TAGS and tag != "form") or role in DROPPED_ROLES or (not self.inside and tag == "header"):
                self.unwanted = 2
            elif tag == "form" or not meant.isdisjoint(DROPPED_WORDS) or (not self.inside and "header" in meant):
                self.unwanted = 1
        self.kept = self.article or (self.inside and tag in CELLS)  # never template; nor is what an article stands in
        self.holds = False
        self.digest = hashlib.blake2b(f"{tag} {self.words}".encode(), digest_size=8)
        self.hash = 0
        self.block = tag not in INLINE
        self.state = None


class Page:
    """Text pieces of a page, each with the innermost element around it, and all elements with their hashes.

    The work is in proportion to the length of the page, however deep its elements stand in one another.
    """

    def __init__(self, source: str):
        self.pieces: list[tuple[str, Element | None]] = []
        self.elements: list[Element] = []  # as they begin: an element comes after those around it
        self.stack: list[Element] = []
        self.places: dict[str, list[int]] = {}  # where elements of a name are open
        self.scopes: list[int] = []
        self.has_article = False
        at, size = 0, len(source)
        while at < size:
            m = TAG.search(source, at)
            end = m.start() if m else size
            if end > at:
                self._text(source[at:end])
            if not m:
                break
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<![CDATA["):
                    self._text(m[0][9:].removesuffix("]]>"))
                continue
            tag = m[2].lower()
            if m[1]:
                if self.places.get(tag):
                    self._cut(self.places[tag][-1])
                continue
            if tag in RAW:
                found = RAW_END[tag].search(source, at)
                close = found.start() if found else size
                after = source.find(">", close)
                at = size if after < 0 else after + 1
                continue
            if tag == "br" or tag == "wbr":
                if self.stack:
                    self.stack[-1].digest.update(b"\n")
                self.pieces.append((" " if tag == "br" else "", self._top()))
                continue
            if tag in VOID:
                if tag == "hr":
                    self._pop_to("p")
                    self.pieces.append(("\0", None))
                continue
            if tag in CLOSES_P:
                self._pop_to("p")
            if tag in SIBLINGS:
                for other in SIBLINGS[tag]:
                    self._pop_to(other)
            if m[3].endswith("/") and tag in ("svg", "path", "rect", "circle"):
                continue
            self._open(Element(tag, m[3], self._top()))
        self._cut(0)

    def _top(self) -> Element | None:
        return self.stack[-1] if self.stack else None

    def _open(self, element: Element) -> None:
        if element.article:
            self.has_article = True
            outer = element.parent
            while outer is not None and not outer.holds:
                outer.holds = outer.kept = True
                outer = outer.parent
        self.places.setdefault(element.tag, []).append(len(self.stack))
        if element.tag in SCOPES:
            self.scopes.append(len(self.stack))
        self.stack.append(element)
        self.elements.append(element)
        if element.block:
            self.pieces.append(("\0", None))

    def _text(self, text: str) -> None:
        if "&" in text:
            text = entities.unescape(text)
        text = text.replace("\0", "�")
        self.pieces.append((text, self._top()))
        if self.stack:
            self.stack[-1].digest.update(" ".join(text.split()).encode("utf-8", "replace"))

    def _cut(self, depth: int) -> None:
        """Close all elements from that depth on."""
        while len(self.stack) > depth:
            element = self.stack.pop()
            self.places[element.tag].pop()
            if element.tag in SCOPES:
                self.scopes.pop()
            element.hash = int.from_bytes(element.digest.digest(), "little", signed=True)
            if self.stack:
                self.stack[-1].digest.update(element.digest.digest())
            if element.block:
                self.pieces.append(("\0", None))

    def _pop_to(self, tag: str) -> None:
        """Close an element of that name that is open within the nearest container."""
        open_at = self.places.get(tag)
        if open_at and open_at[-1] >= (self.scopes[-1] if self.scopes else 0):
            self._cut(open_at[-1])

    def template_hashes(self) -> tuple[set[int], set[int]]:
        """Block subtrees that may be template: outside articles, and only inside them."""
        found: tuple[set[int], set[int]] = set(), set()
        for e in self.elements:
            if e.block and not e.kept and e.tag not in ("html", "body", "head"):
                found[e.inside or e.article].add(e.hash)
        return found[0], found[1] - found[0]

    def article_number(self) -> int:
        """Tells apart what stands in the page's articles."""
        digest = hashlib.blake2b(digest_size=8)
        for e in self.elements:
            if e.article:
                digest.update(e.digest.digest())
        return int.from_bytes(digest.digest(), "little", signed=True)

    def _marked(self, template: set[int], least: int, chosen: set[int]) -> None:
        """Set each element's state: None if its text goes, else the outermost article around it, or the page (0).

        Elements unwanted to the degree ``least`` go, but none around a chosen article.
        """
        around: set[int] = set()
        for e in self.elements:
            if id(e) in chosen:
                outer = e.parent
                while outer is not None and id(outer) not in around:
                    around.add(id(outer))
                    outer = outer.parent
        for e in self.elements:
            above = e.parent.state if e.parent is not None else 0
            goes = id(e) not in around and (e.unwanted >= least or (not e.kept and e.hash in template))
            e.state = None if above is None or goes else (id(e) if e.article and not above else above)

    def _sizes(self) -> dict[int, int]:
        sizes: dict[int, int] = {}
        for piece, e in self.pieces:
            state = 0 if e is None else e.state
            if state is not None and piece != "\0":
                sizes[state] = sizes.get(state, 0) + len(piece.strip())
        return sizes

    def _blocks(self, wanted: set[int]) -> str:
        blocks: list[str] = []
        current: list[str] = []
        for piece, e in self.pieces:
            if piece == "\0":
                if current:
                    blocks.append(" ".join("".join(current).split()))
                    current = []
            elif (0 if e is None else e.state) in wanted:
                current.append(piece)
        blocks.append(" ".join("".join(current).split()))
        return "\n\n".join(b for b in blocks if b)

    def text(self, template: set[int]) -> str:
        """The text of the main article: the one with most text, and those half as long.

        An article in something unwanted counts if it has more than twice the text of all others; what stands around it
        is then no reason to leave it out.  If no article has half as much text as the page outside (a teaser marked as
        one), the page counts.  If nothing were left of it, class words and forms are no reason.
        """
        outermost = {id(e) for e in self.elements if e.article and not e.inside}
        if outermost:
            self._marked(template, 1, outermost)
            hidden = {k: n for k, n in self._sizes().items() if k}
            self._marked(template, 1, set())
            sizes = self._sizes()
            outside = sizes.pop(0, 0)
            most = max(sizes.values(), default=0)
            largest = max(hidden, key=hidden.get, default=0)
            if hidden.get(largest, 0) > 2 * most:
                self._marked(template, 1, {largest})
                sizes, most = {largest: hidden[largest]}, hidden[largest]
            if most and 2 * most >= outside:
                return self._blocks({k for k, n in sizes.items() if 2 * n >= most})
        for least in (1, 2):
            self._marked(template, least, set())
            found = self._blocks({0, *(e.state for e in self.elements if e.state)})
            if found:
                return found
        return ""


def site_templates(pages: DataFrame) -> DataFrame:
    """(host, template): hashes of the subtrees that recur across the pages of a host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, numbers, hashes, insides = [], [], [], []
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                page = Page(source)
                outer, inner = page.template_hashes()
                number = int.from_bytes(hashlib.blake2b(source.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)
                for inside, counted, found in ((False, number, outer), (True, page.article_number(), inner)):
                    if inside and not page.has_article:
                        continue
                    rows: list[int | None] = [None, *found]  # the page or its article itself, and its subtrees
                    hosts += [host] * len(rows)
                    hashes += rows
                    numbers += [counted] * len(rows)
                    insides += [inside] * len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(hashes, pa.int64()), pa.array(numbers, pa.int64()), pa.array(insides, pa.bool_())],
                names=["host", "hash", "page", "inside"])

    asked = pages.select(host_of(F.col("url")).alias("host"), "html").where("host <> '' AND html IS NOT NULL")
    found = asked.mapInArrow(run, "host string, hash long, page long, inside boolean")
    counts = found.groupBy("host", "hash", "page", "inside").agg(F.lit(1).alias("one")).groupBy("host", "hash").agg(
        F.count_if("inside").alias("articles"), F.count_if(~F.col("inside")).alias("pages"))
    on_both = F.col("articles") + F.col("pages")
    counts = stored(counts.where(F.col("hash").isNull() | (on_both >= LEAST_PAGES)), "subtree-counts")
    sizes = counts.where("hash IS NULL").select("host", F.col("articles").alias("all_articles"), F.col("pages").alias("all_pages"))
    often = counts.where("hash IS NOT NULL").join(sizes, "host").where(
        (on_both >= LEAST_SHARE * F.col("all_pages"))
        | ((F.col("articles") >= LEAST_PAGES) & (F.col("articles") >= LEAST_SHARE * F.col("all_articles"))))
    return often.groupBy("host").agg(F.collect_set("hash").alias("template"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of pages (page_id, url, html)."""
    templates = stored(site_templates(pages), "site-templates")
    kind = pages.schema["page_id"].dataType.simpleString()
    host = fresh("host", pages)
    met = pages.select("page_id", "url", "html", host_of(F.col("url")).alias(host)).join(
        templates.withColumnRenamed("host", host), host, "left").select("page_id", "url", "html", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(source or "").text(set(template or ()))
                     for source, template in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return met.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def op9_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))

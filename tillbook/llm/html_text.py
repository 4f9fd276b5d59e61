"""Main text of HTML pages: structural rules and removal of site templates.

A page is read by one forgiving scan that keeps a stack of open elements. Text in menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments is left out by element, role and class.
Every remaining element subtree is hashed (place, name, texts and child subtrees); Spark counts per host in how many
different texts a hash occurs, so that copies of one page weigh once. A subtree in at least `least_pages` texts and
`least_share` of the texts of a host, well above what quoting reaches, is a template and deleted. Inside an article
this holds for boxes and lists; a single paragraph or heading there must occur at one place in `prose_pages` texts and
`prose_share` of them, because articles quote each other.

The hashes of a host that reach the share are at most subtrees per page / share, so the list that travels to
a host's pages is bounded by the pages, not by their number.

Defined cases: null or empty html gives an empty text; a null or unusable url has no host and no template;
repeated rows each give a row; broken or cut markup is read as far as it goes (a tag without its
end is dropped, an element without its end lasts as long as its parent).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.session import pin

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<[!?][^>]*+(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)*+)(>|$)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]*)))?")

# Element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
LEFT_OUT = frozenset(
    "head nav header footer aside form script style noscript template iframe object svg canvas button select textarea dialog menu title search noembed noframes xmp".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr "
    "masthead menu modal nav navbar navigation newsletter notice notification overlay pager pagination popup promo promotion related respond share sharebar "
    "sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = HEADINGS | frozenset("p pre blockquote figcaption caption summary".split())
# What an opening element ends, and what it does not look beyond.
ENDS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "tbody": "tbody thead tr td th", "tfoot": "tbody thead tr td th"}
ENDS = {k: frozenset(v.split()) for k, v in ENDS.items()}
SCOPES = frozenset("ul ol dl table".split())


class Element:
    __slots__ = ("name", "first", "parts", "links", "chars", "kept_whole", "outside", "by_name")

    def __init__(self, name: str, first: int, outside: bool, by_name: bool):
        self.name, self.first, self.outside, self.by_name = name, first, outside, by_name
        self.parts: list[bytes] = []
        self.links = self.chars = 0
        self.kept_whole = False


class Page:
    """Blocks of text of one page and its subtrees: (first block, block after the last, hash, is prose of an article)."""

    def __init__(self, source: str | None):
        self.blocks: list[str] = []
        self.in_article: list[bool] = []
        self.in_main: list[bool] = []
        self.subtrees: list[tuple[int, int, int, bool]] = []
        self.has_article = self.has_main = False
        self._stack: list[Element] = []
        self._outside = self._articles = self._mains = self._anchors = 0
        self._text: list[str] = []
        self._linked = 0
        if source:
            self._scan(source)
            self._flush()
            while self._stack:
                self._close()

    # ------------------------------------------------------------ scanning
    def _scan(self, source: str) -> None:
        at = 0
        while True:
            start = source.find("<", at)
            if start < 0:
                self._add(source[at:])
                return
            found = TOKEN.match(source, start)
            if not found:  # a bare <
                self._add(source[at : start + 1])
                at = start + 1
                continue
            self._add(source[at:start])
            at = found.end()
            name = found[2]
            if name is None or not found[4]:  # a comment, or a tag that the end of the page cuts
                continue
            name = name.lower()
            if found[1]:
                self._end(name)
            else:
                self._start(name, found[3])
                if name in RAW:
                    end = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(source, at)
                    at = end.start() if end else len(source)

    def _add(self, text: str) -> None:
        if text and not self._outside:
            self._text.append(text)
            if self._anchors:
                self._linked += len(text)

    def _flush(self) -> None:
        if not self._text:
            return
        raw = "".join(self._text)
        self._text.clear()
        linked, self._linked = self._linked, 0
        text = " ".join(html.unescape(raw).split())
        if not text:
            return
        self.blocks.append(text)
        self.in_article.append(self._articles > 0)
        self.in_main.append(self._mains > 0)
        if self._stack:
            top = self._stack[-1]
            top.parts.append(text.encode())
            top.chars += len(raw)
            top.links += linked

    # ------------------------------------------------------------ elements
    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self._add(" ")
            return
        if name in BLOCK or name == "hr":
            self._flush()
            if name not in ("html", "body"):
                self._end_implied(name)
        if name in VOID:
            return
        if name == "a":
            self._anchors = 1
        if name in ("article", "main"):
            for e in self._stack:  # a wrapper named like a sidebar that holds the article is none
                if e.outside and e.by_name:
                    e.outside = False
                    self._outside -= 1
        by_rule = name in LEFT_OUT
        by_name = not by_rule and bool(attributes) and _named_out(name, attributes)
        if by_rule and name == "header" and self._articles:
            by_rule = False  # the heading of the article itself; see _close
        if not (name in BLOCK or by_rule or by_name):
            return
        element = Element(name, len(self.blocks), by_rule or by_name, by_name)
        if element.outside:
            if name not in BLOCK:
                self._add(" ")
            self._outside += 1
        if name == "article":
            self._articles += 1
            self.has_article |= not self._outside
        if name == "main":
            self._mains += 1
            self.has_main |= not self._outside
        if name in ("article", "main"):
            for e in self._stack:
                e.kept_whole = True
            element.kept_whole = True
        self._stack.append(element)

    def _end_implied(self, name: str) -> None:
        if self._stack and any(e.name == "p" for e in self._stack[-4:]):
            for i in range(len(self._stack) - 1, -1, -1):
                if self._stack[i].name == "p":
                    self._close_to(i)
                    break
                if self._stack[i].name in BLOCK:
                    break
        ends = ENDS.get(name)
        if ends:
            lowest = None
            for i in range(len(self._stack) - 1, -1, -1):
                if self._stack[i].name in SCOPES:
                    break
                if self._stack[i].name in ends:
                    lowest = i
            if lowest is not None:
                self._close_to(lowest)

    def _end(self, name: str) -> None:
        if name == "a":
            self._anchors = 0
        if name in BLOCK:
            self._flush()
        for i in range(len(self._stack) - 1, -1, -1):
            if self._stack[i].name == name:
                if name not in BLOCK:
                    self._add(" ")
                self._close_to(i)
                return
            if name not in BLOCK and self._stack[i].name in BLOCK:
                return

    def _close_to(self, depth: int) -> None:
        self._flush()
        while len(self._stack) > depth:
            self._close()

    def _close(self) -> None:
        e = self._stack.pop()
        if e.outside:
            self._outside -= 1
        if e.name == "article":
            self._articles -= 1
        if e.name == "main":
            self._mains -= 1
        if len(self.blocks) > e.first and not e.outside:
            digest = xxhash.xxh64_digest(e.name.encode() + b"\0" + b"\0".join(e.parts))
            mostly_links = 2 * e.links >= e.chars > 0
            if not e.kept_whole:
                place = "/".join(above.name for above in self._stack).encode()
                key = int.from_bytes(xxhash.xxh64_digest(digest + place), "little", signed=True)
                prose = bool(self._articles) and e.name in PROSE and not mostly_links
                self.subtrees.append((e.first, len(self.blocks), key, prose))
            if self._stack:
                top = self._stack[-1]
                top.parts.append(digest)
                top.chars += e.chars
                top.links += e.links

    # ------------------------------------------------------------ results
    def text(self, templates: frozenset[int] = frozenset()) -> str:
        """Blocks of the article (without one, of the main element, else of the page) that are no template."""
        deleted = set()
        for first, end, digest, _ in self.subtrees:
            if digest in templates:
                deleted.update(range(first, end))
        inside = self.in_article if self.has_article else self.in_main if self.has_main else [True] * len(self.blocks)
        return "\n\n".join(b for i, (b, yes) in enumerate(zip(self.blocks, inside, strict=True)) if yes and i not in deleted)


def _named_out(name: str, attributes: str) -> bool:
    """True if role, class, id or visibility say that the element is no main text."""
    found: dict[str, str] = {}
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        found.setdefault(key.lower(), html.unescape(a or b or c).lower())
    names = " ".join((found.get("class", ""), found.get("id", ""))).split()
    if name in ("html", "body", "main"):
        return False
    if name == "article":
        return any("comment" in n for n in names)
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        return True
    if found.get("role") in ROLES:
        return True
    return any(n in ("header", "site-header", "page-header") or not NAMES.isdisjoint(re.split(r"[-_]+", n)) for n in names) and name not in HEADINGS


def host() -> Column:
    """Lower-case host of column url; empty if there is none."""
    return F.coalesce(F.regexp_extract(F.lower("url"), r"^\s*+(?:[a-z][a-z0-9+.-]*+:)?//(?:[^/?#@]*@)?([^/?#:]++)", 1), F.lit(""))


def subtree_texts(pages: DataFrame) -> DataFrame:
    """host, digest, prose, texts: in how many different texts of a host a subtree occurs; digest null counts the texts themselves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple] = set()

        def out() -> pa.RecordBatch:
            columns = zip(*found, strict=True) if found else ((),) * 4
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int64())
            names = ["host", "digest", "prose", "text"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for name, source in zip(*batch.columns, strict=True):
                site = name.as_py()
                if site:
                    page = Page(source.as_py())
                    text = int.from_bytes(xxhash.xxh64_digest(page.text().encode()), "little", signed=True)
                    found.add((site, None, False, text))
                    found.update((site, digest, prose, text) for _, _, digest, prose in page.subtrees)
            if len(found) > 200_000:
                yield out()
                found.clear()
        yield out()

    found = pages.select(host().alias("host"), "html").mapInArrow(count, "host string, digest long, prose boolean, text long")
    return found.distinct().groupBy("host", "digest", "prose").agg(F.count(F.lit(1)).alias("texts"))


def templates(pages: DataFrame, least_pages: int, least_share: float, prose_pages: int, prose_share: float) -> DataFrame:
    """host and the array of its template hashes."""
    counted = pin(subtree_texts(pages), "subtrees")
    total = counted.filter("digest is null").select("host", F.col("texts").alias("total"))
    least = F.when(F.col("prose"), prose_pages).otherwise(least_pages)
    often = counted.filter(F.col("digest").isNotNull() & (F.col("texts") >= least)).join(total, "host")
    share = F.when(F.col("prose"), prose_share).otherwise(least_share)
    return often.filter(F.col("texts") >= share * F.col("total")).groupBy("host").agg(F.collect_set("digest").alias("digests"))


def extract(
    pages: DataFrame, least_pages: int = 5, least_share: float = 0.5, prose_pages: int = 20, prose_share: float = 0.8
) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of pages(page_id, url, html)."""
    found = pin(templates(pages, least_pages, least_share, prose_pages, prose_share), "templates").select(F.col("host").alias("_host"), "digests")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, sources, digests = batch.columns
            texts = [Page(s.as_py()).text(frozenset(d.as_py() or ())) for s, d in zip(sources, digests, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [ids, urls, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host().alias("host"))
    return rows.join(found, rows["host"] == found["_host"], "left").select("page_id", "url", "html", "digests").mapInArrow(
        read, "page_id long, url string, text string, n_chars long"
    )

"""Main text of web pages: boilerplate by structure, site templates by recurrence.

Every page is read into blocks of text with the elements around them. Elements that are
never main text (menus, footers, scripts, forms, adverts, reader comments, ...) go by
tag, role or class. The rest of the elements are hashed with all they contain; Spark
counts for each host on how many different pages a subtree stands, and subtrees that
recur across many of them are deleted as parts of the site's template. Prose inside an
article is not deleted for recurring: quoted and copied passages are main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelake.session import materialize

# A subtree is template if it stands on this many different pages of a host and on this share of them.
LEAST_PAGES = 5
LEAST_SHARE = 0.2

# Element names by role.
RAW = frozenset("script style textarea title noscript iframe xmp noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul "
    "button select option svg template canvas object video audio".split()
)
BOILERPLATE = frozenset("nav aside footer form header menu dialog button select svg template canvas object video audio".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
CLASSES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising banner sponsor sponsored promo promotion cookie cookies "
    "consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup sidebar widget widgets menu nav "
    "navbar navigation breadcrumb breadcrumbs footer header masthead comment comments commentlist replies respond disqus "
    "related share sharing social toolbar pagination pager login search".split()
)
# With these beside it in a compound (site-footer, sidebar-left) a word of CLASSES still names the part itself.
# Others (has-sidebar, comments-open, related-work) tell of something else.
BESIDE = frozenset(
    "site main page post entry article blog user global primary secondary top bottom left right upper lower mobile desktop sub inner outer body thread "
    "box bar list link links container wrapper wrap block area panel group button buttons icon icons item items form posts articles stories".split()
)
COMPOUNDS = frozenset(
    "comments-section comment-section comments_section comment_section comment-content comment_content footer-content sidebar-content".split()
)
# The header of a text holds its title.
TEXTS = frozenset("post entry article page".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Parts with these words are no wrappers of a page, however much text they hold.
NEVER_WRAPS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices newsletter subscribe subscription comment comments commentlist replies respond disqus dialog alert alertdialog".split()
)
# An article of this name is a reader's comment or an advert; other names of parts are no reason to drop an article.
NO_ARTICLES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo comment comments commentlist replies respond disqus".split()
)
# Main text stands in the articles if they hold at least this share of the text of main.
ARTICLE_SHARE = 0.5
CONTAINERS = frozenset(("html", "body", "article", "main"))
# Elements whose recurrence inside an article tells of a template; paragraphs and headings do not.
BOXES = frozenset("div section ul ol dl table figure details fieldset address center".split())
# An open element of the key ends where one of the values begins.
ENDED_BY = {
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr",)),
    "td": frozenset(("td", "th", "tr")),
    "th": frozenset(("td", "th", "tr")),
    "option": frozenset(("option",)),
}
LIST_ENDS = frozenset("ul ol dl table".split())

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAME = re.compile(r"[a-z0-9]+")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.A | re.I) for name in RAW}


def part_named(token: str) -> set[str]:
    """The words of CLASSES by which a class or id names a part that is never main text."""
    parts = NAME.findall(token)
    words = CLASSES.intersection(parts)
    if token in COMPOUNDS:
        return words
    if not all(p in CLASSES or p in BESIDE or p[0].isdigit() for p in parts):
        return set()
    return set() if words == {"header"} and not TEXTS.isdisjoint(parts) else words


def marked(attributes: str) -> set[str]:
    """The words by which class, id or role name a part that is never main text."""
    found = set()
    for key, *values in ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key in ("class", "id", "role"):
            for token in "".join(values).lower().split():
                found |= ROLES & {token} if key == "role" else part_named(token)
    return found


class Element:
    """An open block element: its parts for the subtree hash, where its blocks begin, and what may exempt it."""

    __slots__ = ("at", "before", "first", "name", "parts", "place", "skipped", "tagged")

    def __init__(self, name: str, first: int, skipped: bool, tagged: bool, at: int, place: int | None, before: int):
        self.name, self.first, self.skipped, self.parts = name, first, skipped, []
        self.tagged, self.at, self.place, self.before = tagged, at, place, before


class Page:
    """Blocks of a page, and its subtrees as ``(name, first block, end, hash, inside an article)``."""

    def __init__(self, source: str):
        self.unended: set[int] = set()
        self._clear()
        self._read(source)
        # A part that never ended does not swallow the article that follows it.
        self.unended = self.around - self.ended
        if self.unended:
            self._clear()
            self._read(source)
        # What is named like a part but holds most of the text, or all that there is, wraps the page.
        wrappers = {at for at, held in self.held if 2 * held > self.seen or not self.blocks}
        if wrappers:
            self._clear(wrappers)
            self._read(source)
        within_main = sum(len(t) for t, _, m in self.blocks if m)
        within_both = sum(len(t) for t, a, m in self.blocks if a and m)
        self.has_main = within_main > 0
        self.has_article = any(a for _, a, _ in self.blocks) and within_both >= ARTICLE_SHARE * within_main

    def _clear(self, wrappers: set[int] = frozenset()) -> None:
        self.wrappers = wrappers
        self.held: list[tuple[int, int]] = []  # place of a possible wrapper, characters in it
        self.around: set[int] = set()  # places of the dropped parts that an article stands in
        self.ended: set[int] = set()  # places of the dropped parts that end with a tag of their own
        self.seen = self.tagged = 0
        self.blocks: list[tuple[str, bool, bool]] = []  # text, inside an article, inside main
        self.subtrees: list[tuple[str, int, int, int, bool]] = []
        self.stack: list[Element] = []
        self.open: Counter[str] = Counter()
        self.skipping = 0
        self.text: list[str] = []

    def _flush(self) -> None:
        if self.text:
            words = " ".join("".join(self.text).split())
            self.text = []
            if words:
                self.blocks.append((words, self.open["article"] > 0, self.open["main"] > 0))
                if self.stack:
                    self.stack[-1].parts.append(words.encode())

    def _pop(self) -> None:
        self._flush()
        done = self.stack.pop()
        inside = self.open["article"] + self.open["main"] > 0
        self.open[done.name] -= 1
        self.skipping -= done.skipped
        self.tagged -= done.tagged
        if done.place is not None and self.seen > done.before:
            self.held.append((done.place, self.seen - done.before))
        if len(self.blocks) > done.first:
            hashed = blake2b(b"\0".join([done.name.encode(), *done.parts]), digest_size=8).digest()
            self.subtrees.append((done.name, done.first, len(self.blocks), int.from_bytes(hashed, "big", signed=True), inside))
            if self.stack:
                self.stack[-1].parts.append(hashed)

    def _close(self, name: str) -> None:
        if self.open[name]:
            while self.stack[-1].name != name:
                self._pop()
            if self.stack[-1].skipped:
                self.ended.add(self.stack[-1].at)
            self._pop()

    def _start(self, name: str, attributes: str, place: int) -> None:
        self._flush()
        if name == "main":
            # There is one, and it is main text; an element before it that never ended does not swallow it.
            while self.skipping:
                self._pop()
        elif name == "article" and self.skipping:
            # Comments and teasers of other pages are articles in such parts.
            self.around |= {e.at for e in self.stack if e.skipped}
            while any(e.skipped and e.at in self.unended for e in self.stack):
                self._pop()
        if self.stack and self.stack[-1].name == "p" and name != "p":
            self._pop()
        elif name == "p" and self.open["p"]:
            # A paragraph ends an open one, unless a box was opened in between.
            for e in reversed(self.stack):
                if e.name == "p":
                    self._close("p")
                if e.name == "p" or e.name in BOXES or e.name in CONTAINERS:
                    break
        for e in reversed(self.stack):
            if name in ENDED_BY.get(e.name, ()):
                self._close(e.name)
            if name in ENDED_BY.get(e.name, ()) or e.name in LIST_ENDS:
                break
        within = self.open["article"] + self.open["main"] > 0
        tagged = name in BOILERPLATE and not (name == "header" and within)
        words = marked(attributes) & NO_ARTICLES if name == "article" else set() if name in CONTAINERS or (within and (name == "header" or name in HEADINGS)) else marked(attributes)
        if within:
            words.discard("header")
        wraps = bool(words) and not tagged and words.isdisjoint(NEVER_WRAPS)
        skipped = tagged or (bool(words) and place not in self.wrappers)
        self.stack.append(Element(name, len(self.blocks), skipped, tagged, place, place if wraps else None, self.seen))
        self.tagged += tagged
        self.open[name] += 1
        self.skipping += skipped

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            found = MARKUP.search(source, at)
            stop = found.start() if found else end
            if stop > at:
                if not self.tagged:
                    self.seen += len(source[at:stop].strip())
                if not self.skipping:
                    self.text.append(html.unescape(source[at:stop]))
            if not found:
                break
            at = found.end()
            closing, name, attributes = found[1], found[2] or found[4], found[3] or found[5] or ""
            if closing:
                closing = closing.lower()
                if closing in BLOCKS:
                    self._close(closing)
            elif name:
                name = name.lower()
                if name in RAW:
                    ending = RAW_END[name].search(source, at)
                    if not ending:
                        break
                    shut = source.find(">", ending.end())
                    at = end if shut < 0 else shut + 1
                elif name in VOID:
                    if name == "hr":
                        self._flush()
                    elif not self.skipping:
                        self.text.append(" " if name == "br" else "")
                elif name in BLOCKS:
                    self._start(name, attributes, stop)
        while self.stack:
            self._pop()
        self._flush()

    def candidates(self) -> list[tuple[int, int, int]]:
        """``(first block, end, hash)`` of the subtrees that may be deleted for recurring."""
        main = self.has_article or self.has_main
        return [
            (first, last, hashed)
            for name, first, last, hashed, inside in self.subtrees
            if name not in CONTAINERS and ((inside and name in BOXES) if main else True)
        ]

    def main_text(self, templates: frozenset[int] = frozenset()) -> str:
        gone: set[int] = set()
        if templates:
            for first, last, hashed in self.candidates():
                if hashed in templates:
                    gone.update(range(first, last))
        kept = [
            words
            for i, (words, article, main) in enumerate(self.blocks)
            if i not in gone and (article if self.has_article else main if self.has_main else True)
        ]
        return "\n\n".join(kept)


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: tuple[list, ...] = ([], [], [], [])
        for page_id, url, source in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
            page, host = Page(source or ""), host_of(url)
            like = int.from_bytes(blake2b(page.main_text().encode(), digest_size=8).digest(), "big", signed=True)
            # A row without subtree counts the page for its host.
            for hashed in (None, *{h for _, _, h in page.candidates()}):
                for column, value in zip(rows, (page_id, host, hashed, like), strict=True):
                    column.append(value)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=["page_id", "host", "subtree", "like"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("html", "templates")]
        texts = [Page(source or "").main_text(frozenset(known or ())) for source, known in zip(*columns, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def site_templates(subtrees: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """``(host, subtree)`` of the subtrees that recur on a host; pages of equal text count once."""
    counted = subtrees.groupBy("host", "subtree", "like").count().groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("pages"))
    hosts = counted.where("subtree IS NULL").select("host", F.col("pages").alias("of"))
    found = counted.where(F.col("subtree").isNotNull() & (F.col("pages") >= least_pages)).join(hosts, "host")
    return found.where(F.col("pages") >= least_share * F.col("of")).select("host", "subtree")


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """``(page_id, url, text)``, one row per row of ``pages``; text is empty where there is none.

    Where a page has articles their text is its main text, unless they hold less than half of the
    text of ``main``; articles inside comments, asides and the like, or named as comments or
    adverts, are none. NULL html is empty; a NULL or broken url belongs to the host without a name. Rows
    that share a page_id, NULL included, share the list of their templates. Other columns
    play no part.
    """
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    # Written once: the counts, the hosts' sizes and the hits all read it.
    subtrees = materialize(slim.mapInArrow(_subtrees, "page_id long, host string, subtree long, like long"), "subtrees")
    templates = materialize(site_templates(subtrees, least_pages, least_share), "templates")
    hits = subtrees.where("subtree IS NOT NULL").join(templates, ["host", "subtree"], "left_semi")
    hits = materialize(hits.groupBy(F.col("page_id").alias("_page")).agg(F.collect_set("subtree").alias("templates")), "hits")
    known = slim.join(hits, F.col("page_id").eqNullSafe(F.col("_page")), "left").select("page_id", "url", "html", "templates")
    return known.mapInArrow(_texts, "page_id long, url string, text string")

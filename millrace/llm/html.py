"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering.

The standard library's parser streams its events into lines, one per block element. A line's ratio is its
characters per tag. Lines of menus, headers, footers, sidebars, notices, adverts, forms and reader comments
count as ratio 0. The ratios are smoothed along the page; lines above a share of their standard deviation
are the content cluster. The content regions are the article and main elements that hold some of it; on a page
without such an element they are the whole page, since a threshold would drop short blocks of the article.

Inside an article or main element a class or id marks text beside the article only if one of its names says
nothing else (``related``, ``share-box``, but not ``related-work``). Elsewhere a marking word within a name will
do, but an article or main element below such an element (``layout-with-sidebar``) is still one.

A comment, declaration or tag that the page never closes is dropped with the rest of the page, which is inside
it; time is linear in the length of the page.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements whose text is never article text.
OUTSIDE = frozenset(
    "head title script style noscript template iframe object svg canvas nav menu header footer aside form button "
    "select option textarea label dialog audio video map".split()
)
#: Elements whose content the parser may read as text though it isn't shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr "
    "html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
REGION = frozenset("article main section div body td blockquote".split())
#: A start tag of the first kind ends an open element of the second.
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words in a class or id that mark text beside the article.
HINT = re.compile(
    r"(?<![a-z])(?:ads?|adverts?|advertisement|sponsor(?:ed)?|promo(?:tion)?s?|banner|nav(?:bar|igation)?|menu|breadcrumbs?|"
    r"side-?bar|footer|header|masthead|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|"
    r"login|comments?|replies|reply|disqus|share|sharing|social|related|recommended|widget|pagination|pager|toolbar)(?![a-z])"
)
#: Words that may stand beside a marking word in a name without changing what it says.
NEUTRAL = frozenset(
    "area bar block box button buttons container content form inner item items left link links list main outer page panel "
    "post posts right section site slot thread top bottom unit wrap wrapper".split()
)
#: Marked by a word within a name only (1), or by a name that says nothing else, an element or a role (2).
LOOSE, STRICT = 1, 2
SIGMA = 1.0
THRESHOLD = 0.5


@lru_cache(maxsize=4096)
def marked(value: str) -> int:
    """How the value of a class or id marks text beside the article: 0, ``LOOSE`` or ``STRICT``."""
    if not HINT.search(value):
        return 0
    for name in value.split():
        if HINT.search(name):
            rest = [word for word in re.split(r"[^a-z]+", HINT.sub(" ", name)) if word]
            if all(word in NEUTRAL for word in rest):
                return STRICT
    return LOOSE


class Lines(HTMLParser):
    """Collects [text parts, tags, beside, region] for each block of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, int]] = [("", 0, 0)]
        self.open: dict[str, int] = {}
        self.parents = [0]
        self.kinds = [""]
        self.lines: list[list] = []
        self.parts: list[str] = []
        self.tags = 0

    def cut(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                _, beside, region = self.stack[-1]
                self.lines.append([text, self.tags, beside, region])
                self.tags = 0
            self.parts = []

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            elif tag == "hr":
                self.cut()
            return
        if tag in BLOCK or tag in OUTSIDE:
            self.cut()
            if tag in ENDS and len(self.stack) > 1:
                self.end_open(ENDS[tag])
        _, beside, region = self.stack[-1]
        holds = tag == "article" or tag == "main"
        if beside == LOOSE and holds:
            beside = 0
        if beside != STRICT:
            if tag in OUTSIDE:
                beside = STRICT
            elif attrs and tag != "body" and tag != "html":
                within = holds or "article" in self.open or "main" in self.open
                for name, value in attrs:
                    value = (value or "").lower()
                    if name == "hidden" or name == "role" and value in ROLES:
                        beside = STRICT
                    elif name == "class" or name == "id":
                        mark = marked(value)
                        if mark == STRICT or mark and not within:
                            beside = max(beside, mark)
        if tag in REGION:
            self.parents.append(region)
            self.kinds.append(tag)
            region = len(self.kinds) - 1
        self.stack.append((tag, beside, region))
        self.open[tag] = self.open.get(tag, 0) + 1

    def unwind(self, depth: int) -> None:
        """Ends the open elements from ``depth`` on."""
        for tag, _, _ in self.stack[depth:]:
            self.open[tag] -= 1
            if not self.open[tag]:
                del self.open[tag]
        del self.stack[depth:]

    def end_open(self, tags) -> None:
        """Ends the innermost open element of ``tags`` if no region lies between."""
        if not any(tag in self.open for tag in tags):
            return
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[k][0]
            if tag in tags:
                self.unwind(k)
                return
            if tag in BLOCK or tag in OUTSIDE:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCK or tag in OUTSIDE:
            self.cut()
        if tag in self.open:
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k][0] == tag:
                    self.unwind(k)
                    return

    def handle_data(self, data):
        self.parts.append(data)

    def unknown_decl(self, data):
        pass

    def finish(self) -> None:
        """Ends the page. A comment, declaration or tag still open there runs to the end, and isn't text."""
        if re.match("<[!?/a-zA-Z]", self.rawdata):
            self.rawdata = ""
        self.close()
        self.cut()


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    kernel /= kernel.sum()
    return np.convolve(np.pad(ratios, reach, mode="edge"), kernel, mode="valid")


def main_text(html: str | None) -> str:
    """The article of one page, its blocks joined by one space; empty for null, empty or article-less pages."""
    if not html:
        return ""
    page = Lines()
    page.feed(html)
    page.finish()
    lines = page.lines
    if not any(not beside for _, _, beside, _ in lines):
        return ""
    chars = np.array([0 if beside else len(text) for text, _, beside, _ in lines], float)
    ratios = chars / np.array([max(1, tags) for _, tags, _, _ in lines], float)
    smooth = smoothed(ratios)
    content = (smooth >= THRESHOLD * smooth.std()) & (chars > 0)
    # An article or main element that holds part of the cluster is a region as a whole. On a page without one no
    # container is known to end the content, and all lines that aren't beside it stay.
    outer = list(range(len(page.kinds)))
    for region in range(1, len(outer)):  # a parent has a smaller number
        above = outer[page.parents[region]]
        if page.kinds[above] in ("article", "main"):
            outer[region] = above
    top = [outer[region] for _, _, _, region in lines]
    whole = {top[k] for k in np.flatnonzero(content) if page.kinds[top[k]] in ("article", "main")}
    chosen = [k for k, r in enumerate(top) if not lines[k][2] and (not whole or r in whole)]
    return " ".join(lines[k][0] for k in chosen)


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; repeated pages are extracted each."""

    def work(batches):
        for batch in batches:
            texts = [main_text(html) for html in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(work, "page_id long, url string, text string, n_chars long")

"""Main text of web pages: parser events, text-to-tag ratios per line, Gaussian smoothing, threshold clusters.

1. The events of the standard library's parser cut a page into lines: the text between two block boundaries, with the
   tags met on the way and the characters inside links. Elements that name themselves as something other than the
   article (by tag, role, class or id: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
   comments) give no lines.
2. Each line has the ratio of its text outside links to its tags. Ratios are smoothed along the page by a Gaussian;
   lines whose smoothed ratio reaches the threshold (a share of the standard deviation) are content, and neighbouring
   ones form clusters.
3. The region is the element that holds the clusters: an ``article`` or ``main`` where there is one, else the innermost
   element with nearly all clustered text. All lines of an ``article`` or ``main`` stay, whatever their ratio; of other
   regions, runs of lines between the clusters go if they are mostly links.

A page is worked on by itself in one task; pages are never grouped. Null, empty and text-free pages have an empty text,
a page without tags is one line, repeated rows are repeated, an empty table gives no rows, and columns other than the
id, the address and the page are not read.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundscope.llm.common import frames_by_bytes, type_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Width of the Gaussian in lines, its reach, and the share of the standard deviation that makes a line content.
SIGMA, REACH, THRESHOLD = 1.0, 2, 0.5
#: An unnamed element is entered while it holds this share of the clustered text.
REGION_SHARE = 0.9

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split()
)
#: Boundaries inside a line.
SPACES = frozenset("br td th".split())
CONTAINERS = frozenset("article aside blockquote body center details dialog div figure main section table td".split())
#: What an element of the key ends by its start, and the elements beyond which it ends none.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
P_ENDS = BLOCKS - {"html", "body", "caption", "legend", "option", "optgroup", "tbody", "thead", "tfoot", "tr", "li", "dt", "dd"} | {"li", "dt", "dd"}
P_SCOPE = frozenset(["table", "td", "th", "button", "caption", "html"])

#: Elements that are no part of an article.
NOISE_TAGS = frozenset(
    "aside audio button canvas datalist dialog footer iframe input map menu meter nav noscript object progress script search select style svg template textarea title video".split()
)
NOISE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status tablist toolbar".split())
#: Words of a class or id.
NOISE_WORDS = frozenset(
    "ad ads adv adslot adbox advert adverts advertisement advertisements advertising advertorial adsense adsbygoogle banner banners breadcrumb breadcrumbs "
    "comment commentary commenting commentlist comments commentform consent cookie cookiebar cookies copyright crumbs discussion disqus donate donation "
    "feedback flyout footer gdpr login masthead megamenu menu menubar menus modal nav navbar navi navigation newsletter notice notices notification "
    "notifications offcanvas outbrain overlay pager pagination paywall popover popup promo promos promotion rail recommended recommendations "
    "register related replies reply respond responses search share sharebar sharing shoutbox sidebar sidebars signin signup skip skyscraper social sponsor "
    "sponsored sponsors subnav subscribe subscription survey taboola tagcloud tags teaser teasers toolbar topbar trending tweet widget widgets".split()
)
#: Noise only outside an article, where such an element holds its headline.
PAGE_WORDS = frozenset(["header"])
#: A word after one of these says what a layout has, not what the element is.
NOT_OWN = frozenset(["has", "with", "no", "without", "is", "show", "hide"])
#: Names that end so say what state a page is in.
STATES = frozenset(["open", "opened", "closed", "enabled", "disabled"])
#: How an element is known to be no part of the article: a form, its class or id, its tag, role or style.
FORM, NAMED, TAG = 1, 2, 3
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
WORD = re.compile(r"[a-z0-9]+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def names_noise(names: str, within_article: bool) -> bool:
    """Whether a class or id list names something other than the article."""
    for name in names.split():
        words = WORD.findall(CAMEL.sub("-", name).lower())
        if words and words[-1] in STATES:
            continue
        for i, word in enumerate(words):
            if i and words[i - 1] in NOT_OWN:
                continue
            if word in NOISE_WORDS or (word in PAGE_WORDS and not within_article):
                return True
    return False


class Lines(HTMLParser):
    """Lines of a page: their text, characters in links, tags, and the elements that hold them.

    ``stack`` holds (tag, the container's number, inside the article, kind of noise or 0) of every open element;
    ``parents`` gives the container around each container, ``named`` whether it is an article.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool, int]] = [("", 0, False, 0)]
        self.parents, self.named = [-1], [False]
        self.texts: list[str] = []
        self.rows: list[tuple[int, int, int, bool]] = []  # container, characters in links, tags, headline
        self.piece: list[str] = []
        self.link_chars = self.tags = self.links = 0
        self.headline = False

    def read(self, page: str) -> None:
        self.feed(page)
        # What is left is a tag or comment that the page's end cuts off, or text.
        if re.match(r"<[!/?a-zA-Z]", self.rawdata) and not self.cdata_elem:
            self.rawdata = ""
        self.close()
        self.end_line()

    def parse_html_declaration(self, i: int) -> int:
        # Marked sections of unknown kinds are comments, as in browsers.
        return self.parse_bogus_comment(i) if self.rawdata.startswith("<![", i) else super().parse_html_declaration(i)

    def updatepos(self, i: int, j: int) -> int:
        return j  # nobody asks for line numbers

    def end_line(self) -> None:
        text = " ".join("".join(self.piece).split())
        if text:
            self.texts.append(text)
            self.rows.append((self.stack[-1][1], self.link_chars, self.tags, self.headline))
        self.piece, self.link_chars, self.tags = [], 0, 0

    def _close_to(self, at: int) -> None:
        for tag, *_ in self.stack[at:]:
            if tag == "a":
                self.links -= 1
            elif tag == "h1":
                self.headline = False
        del self.stack[at:]

    def _imply(self, ends: frozenset, scope: frozenset) -> None:
        for at in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[at][0]
            if tag in ends:
                self._close_to(at)
                return
            if tag in scope:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        block = tag in BLOCKS
        if block:
            self.end_line()
        self.tags += 1
        if tag in SPACES:
            self.piece.append(" ")
        if tag in VOID:
            return
        if tag in P_ENDS:
            self._imply(frozenset(["p"]), P_SCOPE)
        if tag in IMPLIED:
            self._imply(*IMPLIED[tag])
        _, container, inside, noise = self.stack[-1]
        named = tag == "article" or tag == "main"
        own = TAG if tag in NOISE_TAGS or (tag == "header" and not inside) else FORM if tag == "form" else 0
        for key, value in attrs:
            value = (value or "").lower() if key not in ("class", "id") else value or ""
            if key == "role":
                words = value.split()
                named = named or "main" in words or "article" in words
                own = TAG if not named and any(w in NOISE_ROLES for w in words) else own
            elif key == "itemprop":
                named = named or value == "articlebody"
            elif key == "hidden" or (key == "aria-hidden" and value == "true" and block) or (key == "style" and HIDDEN_STYLE.search(value)):
                own = TAG
            elif key in ("class", "id") and own < NAMED and tag not in ("html", "body", "main") and names_noise(value, inside):
                own = NAMED
        # A form or a layout's class around the article does not make it noise.
        if (tag == "article" and noise == FORM) or (tag == "main" and noise <= NAMED):
            noise = 0
        if tag in CONTAINERS or named:
            self.parents.append(container)
            container = len(self.parents) - 1
            self.named.append(named and not (own or noise))
        if tag == "a":
            self.links += 1
        elif tag == "h1":
            self.headline = True
        self.stack.append((tag, container, inside or named, max(own, noise)))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        # In HTML the slash means nothing, but for elements of other vocabularies.
        if tag in VOID or tag in BLOCKS:
            self.handle_starttag(tag, attrs)
        else:
            self.tags += 1

    def handle_endtag(self, tag: str) -> None:
        block = tag in BLOCKS
        if block:
            self.end_line()
        self.tags += 1
        if tag in SPACES:
            self.piece.append(" ")
        for at in range(len(self.stack) - 1, 0, -1):
            found = self.stack[at][0]
            if found == tag:
                self._close_to(at)
                return
            # An inline element or paragraph ends nothing around it, a cell or list nothing beyond its table.
            if (not block and found in BLOCKS) or (tag in ("p", "li") and found in CONTAINERS) or (found == "table" and tag != "body"):
                return

    def handle_data(self, data: str) -> None:
        if not self.stack[-1][3]:
            self.piece.append(data)
            if self.links:
                self.link_chars += len(data)


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """The ratios weighted by a Gaussian over the lines around each; at the ends the weights that remain count."""
    at = np.arange(-REACH, REACH + 1)
    weights = np.exp(-(at**2) / (2 * SIGMA**2))
    full = np.convolve(ratios, weights)[REACH : REACH + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), weights)[REACH : REACH + len(ratios)]


def content_lines(sizes: np.ndarray, link_sizes: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Which lines reach the threshold after smoothing; all, where none has text outside links."""
    ratios = np.maximum(sizes - link_sizes, 0) / np.maximum(tags, 1)
    if not ratios.any():
        return np.ones(len(ratios), dtype=bool)
    smooth = smoothed(ratios)
    return smooth >= THRESHOLD * smooth.std()


def region(parents: list[int], named: list[bool], own: np.ndarray) -> int:
    """The container that holds the clustered text ``own`` (characters directly in each container)."""
    held = own.copy()
    for c in range(len(parents) - 1, 0, -1):  # children come after their parents
        held[parents[c]] += held[c]
    total = held[0]
    candidates = [c for c in range(len(parents)) if named[c] and held[c]]
    at = max(candidates, key=lambda c: (held[c], c), default=0)
    if at:
        # A main element around a single article: the inner one, if it holds most of the text.
        inner = [c for c in candidates if c > at and 2 * held[c] > held[at] and _inside(parents, c, at)]
        return max(inner, key=lambda c: (held[c], -c)) if inner else at
    while True:
        child = [c for c in range(at + 1, len(parents)) if parents[c] == at and held[c] >= REGION_SHARE * total]
        if not child:
            return at
        at = child[0]


def _inside(parents: list[int], c: int, outer: int) -> bool:
    while c > outer:
        c = parents[c]
    return c == outer


def main_text(page: str) -> str:
    """The article's blocks, joined by line ends."""
    lines = Lines()
    lines.read(page)
    if not lines.texts:
        return ""
    sizes = np.array([len(t) for t in lines.texts], dtype=float)
    container, link_sizes, tags, headline = (np.array(c) for c in zip(*lines.rows))
    content = content_lines(sizes, np.minimum(link_sizes, sizes), tags)
    # Other lines weigh next to nothing: they decide only where no line of an article is clustered.
    own = np.bincount(container, weights=np.where(content, sizes, 1e-6 * sizes), minlength=len(lines.parents))
    at = region(lines.parents, lines.named, own)
    inside = np.array([False] * len(lines.parents))
    for c in range(at, len(lines.parents)):
        inside[c] = c == at or (c > at and inside[lines.parents[c]])
    keep = inside[container]
    if not lines.named[at]:
        # Runs of other lines between the clusters go if they are mostly links.
        begin = 0
        for end in range(1, len(content) + 1):
            if end == len(content) or content[end] != content[begin]:
                part = slice(begin, end)
                if not content[begin] and 2 * link_sizes[part].sum() > sizes[part].sum():
                    keep[part] = False
                begin = end
    around = lines.parents[at] if lines.named[at] else 0
    while around > 0 and not lines.named[around]:
        around = lines.parents[around]
    if not (keep & headline).any() and around >= 0:
        # The headline may stand beside the region, within the main element around it.
        keep |= headline & np.array([_inside(lines.parents, c, around) and (around > 0 or not lines.named[at]) for c in container])
    return "\n".join(t for t, k in zip(lines.texts, keep) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page and its length in code points."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames_by_bytes(batches, column="html"):
            texts = [main_text(page) for page in frame["html"]]
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return rows.mapInPandas(step, f"page_id {type_of(rows, 'page_id')}, url string, text string, n_chars long")

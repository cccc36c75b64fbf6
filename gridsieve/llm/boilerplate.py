"""Main text of web pages: flat blocks, features of neighbours, a small decision tree.

A page is read once, from left to right, into flat text blocks: runs of text between block-level
tags.  Each block has its word count (in scripts without spaces two signs are a word), its link density
(share of words inside links), the same of the block before and after it, and marks of the elements it
lies in: an article or main element, and elements that by tag, or by a name in class, id or role, are
menus, headers, footers, sidebars, notices, adverts, forms, comments and the like.  The leading word of a
name counts, and the last one of compounds.  An article or main element in them begins anew, but not in
comments of readers, menus, sidebars and footers.  Buttons, labels, drawings, templates and hidden elements give no text.  A decision
tree over these numbers, trained here on the labelled pages below, tells main text from the rest.
The parser forgives open tags and cut-off pages, and its work is linear in the page.

Defined results: null or empty html gives an empty text; a page without main text too; scripts,
styles, comments in the markup and the head never give text; a tag cut off by the end of the page is
left out, a cut-off character reference stays as it is; repeated rows are read each; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsieve.llm.common import map_batches

# Elements of the markup language by what they mean for text blocks.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav noscript ol "
    "option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title noframes iframe".split())
SKIPPED_TAGS = frozenset("annotation annotation-xml button label svg template".split())
BOILER_TAGS = frozenset("fieldset form header menu noscript option select".split())
LASTING_TAGS = frozenset("aside dialog footer nav".split())
MAIN_TAGS = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
CLOSED_BY_SAME = frozenset("dd dt li option p td th tr".split())
BOILER_NAMES = frozenset(
    "ad ads adv advert advertisement advertising aside banner breadcrumb breadcrumbs comment comments consent "
    "contentinfo cookie cookies copyright dialog disclaimer disqus donate footer form gdpr header hidden legal "
    "login masthead menu modal nav navbar navigation newsletter notice outbrain pager pagination popup promo promoted "
    "promotion recommended related replies reply respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe taboola tags teaser toolbar tooltip warning widget".split()
)

# Last words of compound names (post-share, mainMenu), first words that make them speak of something else
# (has-sidebar, category-legal), and first words that make a header one of the whole site.
TAIL_NAMES = frozenset(
    "ad ads advert breadcrumb breadcrumbs cookie cookies footer menu nav navbar navigation newsletter pagination popup "
    "promo related share sharing sidebar sponsor sponsored subscribe toolbar".split()
)
MODIFIERS = frozenset("category format has hide is no not show status tag type with without".split())
SITE_WORDS = frozenset("app blog global main page site top web".split())
JOINED_NAMES = frozenset("mainmenu mainnav pagefooter pageheader sitefooter siteheader topnav".split())
REPLY_NAMES = frozenset("disqus replies reply respond".split())
STATES = frozenset("allowed closed disabled enabled off on open".split())
_COMMENTS = re.compile(r"(?:post|reader|user)?comments?(?:area|body|box|container|form|item|list|section|thread|wrap|wrapper)?")
_COMMENT_ARTICLE = re.compile(r"(?:(?:reader|user)[-_]*)?(?:comment|reply)(?:[-_]*(?:body|entry|item|text|[0-9]+))?")
_INVISIBLE = re.compile(r"(?:^|[\s;\"'])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_LINK = re.compile(r"<(/?)a(?=[\s/>])", re.I)
_HREF = re.compile(r"(?:^|[\s\"'/])href\s*=", re.I)

# Scripts that are written without spaces: Thai and Lao, Burmese, Khmer, kana, ideographs.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")

# Quotes hold a value only right after an equals sign, as browsers have it; elsewhere they are signs like others.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+|(?=>))|[^>=])*+)>")
_OPEN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"""([^\s=>/]+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?""")
_NAME = re.compile(r"[a-z]+|[0-9]+")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    boiler: bool
    main: bool
    heading: bool

    @property
    def density(self) -> float:
        return self.linked / self.words


def word_count(text: str) -> int:
    """Words between spaces, and one more for every two signs of a script without spaces."""
    spaced = len(text.split())
    return spaced if text.isascii() else spaced + len(_UNSPACED.findall(text)) // 2


def _name_level(token: str, tag: str, inside: bool) -> int:
    """What one word of a class, id or role says: 0 nothing, 1 boilerplate, 2 comments of readers."""
    if tag in MAIN_TAGS:
        return 2 if _COMMENT_ARTICLE.fullmatch(token.lower()) else 0
    words = _NAME.findall(_HUMP.sub("-", token).lower())
    letters = [w for w in words if w.isalpha()]
    if not words or not letters or words[0] in MODIFIERS:
        return 0
    first, last = words[0], letters[-1]
    if (_COMMENTS.fullmatch(first) or first in REPLY_NAMES) and last in STATES:
        return 0
    if _COMMENTS.fullmatch(first) or _COMMENTS.fullmatch(last) or first in REPLY_NAMES:
        return 2
    if first in BOILER_NAMES or "".join(words) in JOINED_NAMES:
        return 1
    if last == "header":
        return int(first in SITE_WORDS)
    # A layout may be named after the sidebar beside the text, so that counts inside an article only.
    return int(last in TAIL_NAMES and (inside or last != "sidebar"))


def _marks(tag: str, attributes: str, inside: bool) -> tuple[int, bool]:
    """Level of an element (0 none, 1 an article in it begins anew, 2 for all in it), and whether it is hidden."""
    level = 2 if tag in LASTING_TAGS else int(tag in BOILER_TAGS)
    hidden = False
    if attributes:
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden":
                hidden = True
            elif name == "aria-hidden":
                hidden = hidden or value.strip().lower() == "true"
            elif name == "style":
                hidden = hidden or bool(_INVISIBLE.search(value))
            elif name in ("class", "id", "role") and tag not in ("html", "body"):
                level = max([level, *[_name_level(token, tag, inside) for token in value.split()]])
    return level, hidden


def _closings(page: str, tag: str) -> dict[int, int]:
    """Where each element of a tag that is closed begins, and the place behind its end."""
    ends: dict[int, int] = {}
    waiting: list[int] = []
    for hit in re.finditer(rf"<(/?){re.escape(tag)}(?=[\s/>])[^<>]*+>", page, re.I):
        if not hit[1]:
            if not hit[0].endswith("/>"):
                waiting.append(hit.start())
        elif waiting:
            ends[waiting.pop()] = hit.end()
    return ends


def _closed_links(page: str) -> set[int]:
    """Where links begin whose end comes before the next link."""
    hits = [(hit.start(), bool(hit[1])) for hit in _LINK.finditer(page)]
    return {at for (at, ending), (_, next_ends) in zip(hits, hits[1:]) if not ending and next_ends}


_WALLS = BLOCK_TAGS - CLOSED_BY_SAME


@dataclass
class Element:
    tag: str
    boiler: int = 0
    main: bool = False
    heading: bool = False
    hidden: bool = False


class Elements:
    """Open elements, and where those of each tag, all blocks and all walls stand among them."""

    def __init__(self) -> None:
        self.open = [Element("")]
        self.of_tag: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.walls: list[int] = []

    def _lists(self, tag: str) -> list[list[int]]:
        lists = [self.of_tag.setdefault(tag, [])]
        if tag in BLOCK_TAGS:
            lists.append(self.blocks)
        if tag in _WALLS:
            lists.append(self.walls)
        return lists

    def push(self, element: Element) -> None:
        for places in self._lists(element.tag):
            places.append(len(self.open))
        self.open.append(element)

    def close(self, tag: str, stops: list[int]) -> None:
        """End the last element of a tag and all in it, unless one of ``stops`` stands in between."""
        places = self.of_tag.get(tag)
        if not places or (stops and stops[-1] > places[-1]):
            return
        at = places[-1]
        while len(self.open) > at:
            for others in self._lists(self.open.pop().tag):
                others.pop()


def blocks_of(page: str) -> list[Block]:
    """The flat text blocks of a page in order."""
    blocks: list[Block] = []
    elements = Elements()
    parts: list[str] = []
    linked: list[str] = []
    in_link = lasting = False
    closed_links: set[int] | None = None
    closed: dict[str, dict[int, int]] = {}

    def text(piece: str) -> None:
        if piece and not elements.open[-1].hidden:
            piece = entities.unescape(piece)
            parts.append(piece)
            if in_link:
                linked.append(piece)
                linked.append(" ")

    def close() -> None:
        nonlocal in_link
        in_link = in_link and lasting
        if parts:
            whole = " ".join("".join(parts).split())
            if whole:
                around = elements.open[-1]
                words = word_count(whole)
                count = min(words, word_count("".join(linked)))
                blocks.append(Block(whole, words, count, around.boiler > 0, around.main, around.heading))
            parts.clear()
            linked.clear()

    at = 0
    while True:
        opening = page.find("<", at)
        text(page[at:opening] if opening >= 0 else page[at:])
        if opening < 0:
            break
        after = page[opening + 1 : opening + 3].lstrip("/")[:1]
        if page.startswith(("<!", "<?"), opening):
            comment = page.startswith("<!--", opening)
            end = page.find("-->" if comment else ">", opening + 2)
            if end < 0:
                break
            at = end + (3 if comment else 1)
            continue
        if not (after.isascii() and after.isalpha()):
            text("<")
            at = opening + 1
            continue
        # A quote that is never closed holds no value: such a tag ends at the next sign for it.
        found = _TAG.match(page, opening) or _OPEN_TAG.match(page, opening)
        if not found:
            break  # cut off by the end of the page
        at = found.end()
        tag, ending, attributes = found[2].lower(), bool(found[1]), found[3]
        if tag in RAW_TAGS:
            if not ending and not attributes.endswith("/"):
                shut = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
                if not shut:
                    break
                at = shut.end()
            parts.append(" ")
            continue
        if tag in SKIPPED_TAGS:
            # One that is never closed hides nothing.
            if tag not in closed:
                closed[tag] = _closings(page, tag)
            at = max(at, closed[tag].get(opening, at))
            parts.append(" ")
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            close()
        elif tag == "a":
            in_link = not ending
            if in_link:
                if closed_links is None:
                    closed_links = _closed_links(page)
                lasting = opening in closed_links and bool(_HREF.search(attributes))
            continue
        if tag in VOID_TAGS:
            continue
        if ending:
            elements.close(tag, [] if tag in BLOCK_TAGS else elements.blocks)
            continue
        if tag in CLOSED_BY_SAME:
            elements.close(tag, elements.walls)
        elif tag in BLOCK_TAGS:
            elements.close("p", elements.walls)
        if not attributes.endswith("/") or tag in BLOCK_TAGS:
            around = elements.open[-1]
            level, hidden = _marks(tag, attributes, around.main)
            inherited = 0 if tag in MAIN_TAGS and around.boiler < 2 else around.boiler
            elements.push(Element(
                tag, max(level, inherited), around.main or tag in MAIN_TAGS, around.heading or tag in HEADINGS,
                around.hidden or hidden,
            ))
    close()
    return blocks


FEATURES = (
    "words", "density", "words_before", "density_before", "words_after", "density_after",
    "in_boilerplate", "in_main", "page_has_main", "in_heading",
)


def features(blocks: list[Block]) -> np.ndarray:
    own = np.array([(b.words, b.density) for b in blocks], float).reshape(-1, 2)
    none = np.zeros((1, 2))
    marks = np.array([(b.boiler, b.main, False, b.heading) for b in blocks], float).reshape(-1, 4)
    marks[:, 2] = any(b.main for b in blocks)
    return np.hstack([own, np.vstack([none, own[:-1]])[: len(own)], np.vstack([own[1:], none])[: len(own)], marks])


class Tree:
    """A decision tree by Gini impurity, as arrays."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 7):
        self.feature, self.limit, self.low, self.high, self.value = [], [], [], [], []
        self._grow(x, y.astype(float), depth)
        self.arrays = [np.array(a) for a in (self.feature, self.limit, self.low, self.high, self.value)]

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int) -> int:
        node = len(self.feature)
        for column, value in ((self.feature, -1), (self.limit, 0.0), (self.low, node), (self.high, node), (self.value, y.mean())):
            column.append(value)
        best = None
        if depth and 0 < y.mean() < 1:
            for f in range(x.shape[1]):
                for cut in np.unique(x[:, f])[:-1]:
                    left = x[:, f] <= cut
                    p, q = y[left].mean(), y[~left].mean()
                    impurity = left.mean() * p * (1 - p) + (~left).mean() * q * (1 - q)
                    if best is None or impurity < best[0] - 1e-12:
                        above = x[~left, f].min()
                        best = (impurity, f, (cut + above) / 2)
        if best is not None:
            _, f, cut = best
            left = x[:, f] <= cut
            self.feature[node], self.limit[node] = f, cut
            self.low[node] = self._grow(x[left], y[left], depth - 1)
            self.high[node] = self._grow(x[~left], y[~left], depth - 1)
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        feature, limit, low, high, value = self.arrays
        node = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while True:
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                return value[node] > 0.5
            right = x[rows, np.maximum(f, 0)] > limit[node]
            node = np.where(inner, np.where(right, high[node], low[node]), node)


Part = tuple[str, int, int]


def _page(*parts: Part) -> tuple[Part, ...]:
    return parts


def _filled(parts: tuple[Part, ...], turn: int = 0) -> tuple[str, list[int]]:
    """A page with its labels; the word counts moved on by ``turn`` blocks."""
    counts = [n for _, n, _ in parts]
    counts = counts[turn:] + counts[:turn]
    page = "".join(m.format(" ".join(["word"] * n)) for (m, _, _), n in zip(parts, counts))
    return page, [label for _, _, label in parts]


#: The small labelled table: pages as (markup, words of the block, 1 for main text).  In pages with a
#: main element the place decides, not the length, so they stand for all turns of their word counts.
LABELLED = (
    _page(  # an article element, short paragraphs in it
        ("<nav><ul><li><a>{}</a></li>", 1, 0), ("<li><a>{}</a></li></ul></nav>", 1, 0), ("<div class=ad>{}</div>", 30, 0),
        ("<article><h1>{}</h1>", 8, 1), ("<p>{}</p>", 60, 1), ("<p>{}</p>", 1, 1), ("<p>{}</p>", 4, 1), ("<p>{}</p>", 20, 1),
        ("<p><a>{}</a></p>", 5, 1), ("<p>{}</p></article>", 2, 1), ("<footer>{}</footer>", 25, 0),
    ),
    _page(  # notices, comments and forms around and inside an article
        ("<header>{}</header>", 5, 0), ("<div id=cookie-notice>{}</div>", 40, 0), ("<main><h1>{}</h1>", 5, 1), ("<p>{}</p>", 80, 1),
        ("<aside>{}</aside>", 50, 0), ("<p>{}</p>", 15, 1), ("<div class=share><a>{}</a></div>", 3, 0), ("<p>{}</p>", 3, 1),
        ("<form>{}</form>", 10, 0), ("<section class=comments><p>{}</p>", 45, 0), ("<p>{}</p></section></main>", 2, 0),
        ("<div>{}</div>", 30, 0), ("<p>{}</p>", 4, 0), ("<footer>{}</footer>", 12, 0),
    ),
    _page(  # text beside the article does not count, however long
        ("<div>{}</div>", 70, 0), ("<p>{}</p>", 12, 0), ("<article><p>{}</p>", 7, 1), ("<h2>{}</h2>", 3, 1), ("<ul><li>{}</li>", 6, 1),
        ("<li>{}</li></ul></article>", 2, 1), ("<div><a>{}</a></div>", 6, 0), ("<div>{}</div>", 5, 0),
    ),
    _page(  # no article element: long blocks with few links, and short ones between them
        ("<div><a>{}</a></div>", 2, 0), ("<div><a>{}</a></div>", 3, 0), ("<h1>{}</h1>", 6, 1), ("<div>{}</div>", 55, 1),
        ("<div>{}</div>", 8, 1), ("<div>{}</div>", 40, 1), ("<div>{}</div>", 90, 1), ("<div class=related><a>{}</a></div>", 9, 0),
        ("<div><a>{}</a></div>", 7, 0), ("<div>{}</div>", 4, 0),
    ),
    _page(
        ("<div>{}</div>", 3, 0), ("<div><a>{}</a></div>", 1, 0), ("<div><a>{}</a></div>", 14, 0), ("<p>{}</p>", 35, 1), ("<p>{}</p>", 25, 1),
        ("<p>{}</p>", 12, 1), ("<p>{}</p>", 45, 1), ("<div class=sidebar>{}</div>", 60, 0), ("<div><a>{}</a></div>", 20, 0),
        ("<div><a>{}</a></div>", 2, 0), ("<div>{}</div>", 6, 0), ("<div><a>{}</a></div>", 2, 0),
    ),
    _page(
        ("<div class=menu>{}</div>", 5, 0), ("<p>{}</p>", 18, 1), ("<p>{}</p>", 6, 1), ("<p>{}</p>", 30, 1), ("<p><a>{}</a></p>", 4, 0),
        ("<div class=comment>{}</div>", 33, 0), ("<div class=ad>{}</div>", 9, 0), ("<footer>{}</footer>", 14, 0),
    ),
    _page(  # wrappers that speak of boilerplate without being it
        ("<header>{}</header>", 5, 0), ("<div class='layout has-sidebar'><div id=search-page><article><h1>{}</h1>", 6, 1), ("<p>{}</p>", 40, 1),
        ("<aside>{}</aside>", 12, 0), ("<p>{}</p></article></div></div>", 3, 1), ("<div class=sidebar>{}</div>", 30, 0),
    ),
    _page(("<div class='post category-legal' data-role=search><p>{}</p>", 45, 1), ("<p>{}</p></div>", 25, 1), ("<footer>{}</footer>", 8, 0)),
    _page(("<div>{}</div>", 30, 1)),
    _page(("<div>{}</div>", 120, 1), ("<div>{}</div>", 50, 1)),
    _page(("<div>{}</div>", 2, 0), ("<div>{}</div>", 70, 1), ("<div>{}</div>", 20, 1), ("<div>{}</div>", 3, 0)),
    _page(("<div>{}</div>", 3, 0), ("<div>{}</div>", 2, 0), ("<div>{}</div>", 3, 0)),
)


@lru_cache(maxsize=1)
def tree() -> Tree:
    """The tree trained on ``LABELLED``."""
    x, y = [], []
    for parts in LABELLED:
        placed = any(f"<{tag}>" in markup for markup, _, _ in parts for tag in MAIN_TAGS)
        for turn in range(len(parts) if placed else 1):
            page, labels = _filled(parts, turn)
            x.append(features(blocks_of(page)))
            y += labels
    return Tree(np.vstack(x), np.array(y))


def main_text(page: str) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    chosen = tree().predict(features(blocks))
    return "\n".join(b.text for b, main in zip(blocks, chosen) if main)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) for every row of ``pages`` (page_id, url, html)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h or "") for h in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )

    read = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return map_batches(read, work, "page_id long, url string, text string, n_chars long")

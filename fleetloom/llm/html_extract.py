"""Main text of web pages by tag-path ratios.

A page's text is cut into blocks, each with its path of tags and class names from the root. For each path the text length and the
punctuation are summed over its blocks and divided by their number, with one expected block added (PRIORS), which steadies paths of few and short
blocks. The two ratios are fused and smoothed over the page order, where a neighbour weighs by its distance and by the squared share of the path
that both have in common. What a path declares (navigation, footers, comments, adverts) lowers its score by a factor and can't do more: such a path
still wins where its ratios are high enough. Paths that reach a share of the page's best score select the content nodes. The element that holds nearly
all of their text lends its score to the paths below it that declare no other purpose, so headings and short items of an article stay.

Left out before any ratio is taken is what a browser doesn't show as text: scripts, styles, heads, hidden elements, controls of forms.

Defined results: null or empty html gives the empty text; text after an unclosed comment, script or tag is lost, as in a browser;
unclosed paragraphs end where the next block starts; a page whose only text is declared to be something else and short has none; repeated rows give a
row each; an empty table gives none; other columns are ignored. Time and memory grow with a page's length, however deep it is nested.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

#: Share of the best score that selects a path, and the least score that does.
THRESHOLD, FLOOR = 0.4, 0.15
#: Share of the selected text that the content element holds; share of its score that it lends.
COVER, LENT = 0.9, 0.7
#: Gaussian smoothing over the page order: standard deviation in blocks.
SIGMA = 1.0
#: Ratios at which text length and punctuation count half.
HALF_TEXT, HALF_MARKS = 200.0, 3.0
#: What linked characters count.
LINKED = 0.25
#: (characters, marks) of the expected block by what the path declares; what the declaration leaves of the score.
PRIORS = {"main": (200.0, 4.0), "": (30.0, 0.5), "perhaps other": (10.0, 0.1), "other": (10.0, 0.1)}
FACTORS = {"main": 1.0, "": 1.0, "perhaps other": 0.5, "other": 0.25}

_words = lambda x: frozenset(x.split())
BLOCKS = _words("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul")
CONTAINERS = _words("article main section div form table tbody center blockquote")
VOID = _words("area base br col embed hr img input link meta param source track wbr")
SPACES = _words("br td th option img")
RAW = _words("script style textarea title noscript template iframe noembed noframes svg math xmp")
UNSEEN = _words("head select button object canvas audio video datalist")
OTHER = _words("nav footer aside form dialog menu label")
OTHER_ROLES = _words("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar")
OTHER_NAMES = _words(
    "advert adverts advertisement advertisements advertising adsense sponsored cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription paywall "
    "sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead comment comments commentlist replies disqus respond pagination"
)
PERHAPS_NAMES = _words("ad ads banner banners sponsor promo promotion notice notices reply share sharing social related recommended recommendations widget toolbar pager")
# Tags whose start ends an open element of these names.
CLOSES = {"li": _words("li"), "dt": _words("dt dd"), "dd": _words("dt dd"), "tr": _words("tr td th"), "td": _words("td th"), "th": _words("td th"), "option": _words("option")}
# An element does not reach out of these when it ends others.
BARRIERS = _words("table ul ol dl td th article section div body")

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s=/"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"']+))|([^\s=/"']+)""")
_PUNCT = re.compile(r"[.,;:!?…。，、；：！？¿¡]")
_NAME = re.compile(r"[a-z]+")


class Block:
    """A run of text: its path (a number; equal paths have equal ones), that path's depth and declared purpose, and its element."""

    __slots__ = ("declared", "declares", "depth", "element", "linked", "meet", "path", "raw", "text")

    def __init__(self, path: int, depth: int, declared: str, declares: int, element: int, meet: int):
        self.path, self.depth, self.declared, self.element = path, depth, declared, element
        self.declares = declares  # how many elements around it declare another purpose
        self.meet = meet  # the depth of the deepest element that this block shares with the one before
        self.raw, self.linked, self.text = [], 0, ""


def _declared(tag: str, attrs: str, inside: bool) -> tuple[str, tuple[str, ...]]:
    """What an element says of its purpose ('unseen', 'other', 'perhaps other' or nothing) and its class names. inside: it stands in an article or main element."""
    says, classes = "", ()
    if tag in UNSEEN:
        return "unseen", classes
    if tag in OTHER or tag == "header" and not inside:
        says = "other"
    whole = tag in ("html", "body", "article", "main")
    for m in _ATTR.finditer(attrs):
        name, value = (m[1] or m[5]).lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and "display:none" in value.replace(" ", ""):
            if tag not in ("html", "body"):
                return "unseen", classes
        elif name == "role" and value in OTHER_ROLES and not whole:
            says = "other"
        elif name in ("class", "id"):
            names = value.split()
            classes = (*classes, *sorted(names)) if name == "class" else classes
            for n in () if whole else names:
                # A name speaks if all its words do: cookie-notice, but not has-sidebar.
                parts = _NAME.findall(n)
                if parts and all(p in OTHER_NAMES or p in PERHAPS_NAMES for p in parts):
                    says = "other" if says == "other" or not OTHER_NAMES.isdisjoint(parts) else "perhaps other"
    return says, classes


_RANK = {"": 0, "main": 1, "perhaps other": 2, "other": 3, "unseen": 4}


class Page:
    """A page's blocks in order, and its block elements as (tag, number of the parent, depth, how many declare another purpose up to it)."""

    def __init__(self, page: str):
        self.elements: list[tuple[str, int, int, int]] = [("#root", -1, 0, 0)]
        self.paths: dict[tuple, int] = {}
        self.blocks: list[Block] = []
        # tag, path, declared, how many declare, the innermost block element's number and depth
        self.stack: list[tuple[str, int, str, int, int, int]] = [("#root", 0, "", 0, 0, 0)]
        self.opened: dict[str, list[int]] = defaultdict(list)  # where in the stack the elements of a tag stand
        self.current: Block | None = None
        self.low = 0  # the least depth since the last block
        self._read(page)
        for b in self.blocks:
            b.text = " ".join(html.unescape("".join(b.raw)).split())
            b.raw = [len("".join(b.raw))]
        kept, low = [], math.inf
        for b in self.blocks:
            low = min(low, b.meet)
            if b.text:
                b.meet, low = low, math.inf
                kept.append(b)
        self.blocks = kept

    def _text(self, raw: str) -> None:
        _, path, declared, declares, element, depth = self.stack[-1]
        if declared == "unseen" or not raw:
            return
        if self.current is None:
            self.current = Block(path, depth, declared, declares, element, min(self.low, depth))
            self.low = depth
            self.blocks.append(self.current)
        self.current.raw.append(raw)
        if self.opened["a"]:
            self.current.linked += len(raw)

    def _push(self, tag: str, attrs: str) -> None:
        _, path, above, declares, element, depth = self.stack[-1]
        says, classes = _declared(tag, attrs, bool(self.opened["article"] or self.opened["main"]))
        declares += bool(says)
        if tag in ("article", "main") and not says:
            says = "main"
        if tag in BLOCKS:
            path = self.paths.setdefault((path, tag, classes), len(self.paths) + 1)
            self.elements.append((tag, element, depth + 1, declares))
            element, depth = len(self.elements) - 1, depth + 1
        self.opened[tag].append(len(self.stack))
        self.stack.append((tag, path, max(above, says, key=_RANK.__getitem__), declares, element, depth))

    def _pop(self) -> None:
        tag = self.stack.pop()[0]
        self.opened[tag].pop()
        if tag in BLOCKS:
            self.current = None
            self.low = min(self.low, self.stack[-1][5])

    def _end(self, names: frozenset[str], barriers: frozenset[str]) -> None:
        """Close up to the nearest open element of these names, unless a barrier stands before it."""
        at = max((self.opened[n][-1] for n in names if self.opened[n]), default=0)
        if at and at >= max((self.opened[n][-1] for n in barriers if self.opened[n]), default=0):
            while len(self.stack) > at:
                self._pop()

    def _read(self, page: str) -> None:
        at = 0
        while at < len(page):
            m = _TOKEN.search(page, at)
            if m is None:
                self._text(page[at:])
                return
            if m.start() > at:
                self._text(page[at : m.start()])
            at = m.end()
            if not m[2]:
                continue
            if not m[4]:  # the page ends within a tag
                return
            tag = m[2].lower()
            if m[1]:
                if tag in SPACES:
                    self._text(" ")
                self._end(frozenset((tag,)), frozenset() if tag in BLOCKS else BARRIERS)
                continue
            if tag in BLOCKS:
                self._end(frozenset(("p",)), BARRIERS)
                self.current = None
            if tag in CLOSES:
                self._end(CLOSES[tag], BARRIERS - CLOSES[tag])
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = close.end() if close else len(page)
                continue
            if tag in SPACES:
                self._text(" ")
            if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
                continue
            self._push(tag, m[3])


def path_ratios(blocks: list[Block]) -> dict[int, float]:
    """The fused ratio of each path: the geometric mean of its text and punctuation ratios, each as a share of the page's greatest."""
    text, marks, count, declared = defaultdict(float), defaultdict(float), defaultdict(int), {}
    for b in blocks:
        # White space and references make the raw length differ; the linked share is what counts.
        share = 1 - (1 - LINKED) * min(1.0, b.linked / max(b.raw[0], 1))
        text[b.path] += len(b.text) * share
        marks[b.path] += len(_PUNCT.findall(b.text)) * share
        count[b.path] += 1
        declared[b.path] = max(declared.get(b.path, ""), b.declared, key=_RANK.__getitem__)
    per_text = {p: (text[p] + PRIORS[declared[p]][0]) / (count[p] + 1) for p in count}
    per_mark = {p: (marks[p] + PRIORS[declared[p]][1]) / (count[p] + 1) for p in count}
    half = lambda x, h: x / (x + h)
    best_text = half(max(*per_text.values(), PRIORS[""][0] / 2), HALF_TEXT)
    best_marks = half(max(*per_mark.values(), PRIORS[""][1] / 2), HALF_MARKS)
    return {p: math.sqrt(half(per_text[p], HALF_TEXT) / best_text * half(per_mark[p], HALF_MARKS) / best_marks) for p in count}


def block_scores(blocks: list[Block]) -> list[float]:
    """The smoothed ratio of each block's path, lowered by what the path declares."""
    ratios = path_ratios(blocks)
    reach = math.ceil(2 * SIGMA)
    out = []
    for i, b in enumerate(blocks):
        total, weight = ratios[b.path], 1.0
        for step in (-1, 1):
            meet = math.inf
            for d in range(1, reach + 1):
                j = i + step * d
                if not 0 <= j < len(blocks):
                    break
                other = blocks[j]
                meet = min(meet, (b if d == 1 else blocks[j + 1]).meet if step < 0 else other.meet)
                alike = 1.0 if other.path == b.path else (meet / max(b.depth, other.depth, 1)) ** 2
                w = math.exp(-(d * d) / (2 * SIGMA * SIGMA)) * alike
                total, weight = total + w * ratios[other.path], weight + w
        out.append(total / weight * FACTORS[b.declared])
    return out


def _content_element(page: Page, selected: list[bool]) -> int:
    """The deepest container that holds COVER of the selected text, or the article or main element around it; the root if there is none."""
    held = [0] * len(page.elements)
    for b, s in zip(page.blocks, selected, strict=True):
        held[b.element] += s * len(b.text)
    for i in range(len(held) - 1, 0, -1):  # parents come before their children
        held[page.elements[i][1]] += held[i]
    holding = [i for i, (tag, *_) in enumerate(page.elements) if tag in CONTAINERS and held[i] >= COVER * held[0] > 0]
    found = max(holding, key=lambda i: page.elements[i][2], default=0)
    i = found
    while i > 0 and page.elements[i][0] not in ("article", "main"):
        i = page.elements[i][1]
    return i if i > 0 else found


def extract_text(html_text: str | None) -> str:
    """The main text of a page: its selected blocks, joined by empty lines."""
    page = Page(html_text or "")
    blocks = page.blocks
    if not blocks:
        return ""
    scores = block_scores(blocks)
    bar = max(THRESHOLD * max(scores), FLOOR)
    selected = [s >= bar for s in scores]
    content = _content_element(page, selected)
    if content:
        inside = [False] * len(page.elements)
        for i, (_, above, *_) in enumerate(page.elements):
            inside[i] = i == content or above > 0 and inside[above]
        weight = [len(b.text) * (s and inside[b.element]) for b, s in zip(blocks, selected, strict=True)]
        lent = LENT * sum(w * s for w, s in zip(weight, scores, strict=True)) / sum(weight)
        main, declares = page.elements[content][0] in ("article", "main"), page.elements[content][3]
        for k, b in enumerate(blocks):
            menu = not main and b.linked > 0.8 * b.raw[0] and page.elements[b.element][0] != "p"
            if inside[b.element] and b.declares == declares and not menu:
                scores[k] = max(scores[k], lent)
    return "\n\n".join(b.text for b, s in zip(blocks, scores, strict=True) if s >= bar)


def extract_pages(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) -> page_id, url, text, n_chars."""
    ship(pages.sparkSession)

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield b.map(extract_text)

    out = pages.select("page_id", "url", extract(F.coalesce(F.col("html"), F.lit(""))).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

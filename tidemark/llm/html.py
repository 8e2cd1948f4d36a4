"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides blocks by where they stand (menus,
headers, footers, sidebars, notices, adverts, forms and comments are boilerplate, by tag, role or
class), by link density, length and stop-word density. Blocks that these rules leave open (short ones, and those
with few links but few stop words) then take the label of the nearest decided blocks, in the same part of the page.
A page that shows next to no listed stop words goes by length and link density; where no block is found to be
content, its open blocks without many links are. A class word alone doesn't drop most of a page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import slices

#: Bytes of html that a task holds as strings at once.
SLICE_BYTES = 8 << 20

# fixed values: tags, roles and class words by their meaning in HTML and common page templates
SKIPPED = frozenset("head script style noscript template svg math iframe object canvas select textarea button datalist".split())
BOILER_TAGS = frozenset("nav footer aside dialog menu".split())
BOILER_ROLES = frozenset("navigation contentinfo complementary search alert dialog alertdialog menu menubar".split())
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies copyright disclaimer disqus footer gdpr login menu modal nav navbar navigation newsletter "
    "notice notification pager pagination paywall popup promo promoted promotion recommended related replies reply "
    "respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tagcloud teaser "
    "toolbar widget".split())
#: Of these, what may well be longer than the page's own text.
ANSWER_WORDS = frozenset("comment comments commentlist disqus related replies reply respond".split())
#: First words of classes that tell how a page is laid out ("no-sidebar").
LAYOUT_WORDS = frozenset("no not has with without".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Start tags that end an open element of the tags named, as HTML lets their end tags be left out.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "option": ("option",)}
#: Elements without a place on the page: what stands on both sides of one is one text.
UNSEEN = frozenset("script style noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Frequent words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass "
    "le la les de des et un une en que qui dans pour pas sur au par est ce il elle avec son plus ne se "
    "el los las y del se por con no su para una al lo como más o pero sus este".split())
#: Thresholds: characters of a short and of a long block, stop-word density of prose and of a page in a listed
#: language, link density of menus and of blocks that may be.
SHORT, LONG, PROSE, SOME_PROSE, LISTED, LINKS, SOME_LINKS = 70, 200, 0.30, 0.15, 0.05, 0.5, 0.2

_SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_EDGE = re.compile(r"^\W+|\W+$")
_WIDE = re.compile("[\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]+")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)


class _Blocks(HTMLParser):
    """Blocks as (text, characters inside links, boilerplate by tag or role, inside article or main, heading, elements around
    it that a class word calls boilerplate)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, bool, bool, bool, tuple[int, ...]]] = []
        self.stack: list[tuple[str, bool, bool, tuple[int, ...], bool]] = []   # tag, skipped, firmly boilerplate, by class, in main
        self.classed, self.answers = 0, set()   # elements with such a class word, those of them with an answer word
        self.parts: list[str] = []
        self.skipped = self.firm = self.main = self.link = self.heading = False
        self.by_class: tuple[int, ...] = ()
        self.linked = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append((text, self.linked, self.firm, self.main, self.heading, self.by_class))
            self.parts, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "br" or tag == "wbr":
            self.parts.append(" " if tag == "br" else "")
            return
        if tag == "a":
            self.link = any(k == "href" for k, _ in attrs)
        block = tag in BLOCK_TAGS
        if block:
            self.flush()
            self.heading = tag in HEADINGS
            if self.stack and self.stack[-1][0] == "p":
                self._pop()
            while self.stack and self.stack[-1][0] in ENDS.get(tag, ()):
                if self._pop() == tag:
                    break
        if tag == "body":
            while self.stack:
                self._pop()
        if tag in VOID or not (block or tag in SKIPPED) or tag in ("p", "hr") and not attrs:
            return
        skipped, firm, by_class, main = self.skipped, self.firm, self.by_class, self.main
        if tag in SKIPPED:
            skipped = True
        elif tag in ("article", "main"):
            if not firm and not main:
                by_class, main = (), True    # a wrapper's class says nothing about the article in it
        elif tag in BOILER_TAGS or tag == "header" and not main:
            firm = True
        named = {"form"} if tag == "form" else set()     # a form may be the whole page
        if attrs and tag not in ("html", "body"):
            for k, v in attrs:
                if k in ("class", "id") and v:
                    for name in v.split():
                        words = _SPLIT.split(_CAMEL.sub("-", name).lower())
                        if words[0] not in LAYOUT_WORDS:
                            named.update(w for w in words if w != "form")
                elif k == "role" and v and v.lower() == "form":
                    named.add("form")
                elif k == "role" and v:
                    firm = firm or v.lower() in BOILER_ROLES or v.lower() == "banner" and not main
                    main = main or v.lower() in ("main", "article")
                elif k == "hidden" or k == "style" and v and _HIDDEN.search(v):
                    skipped = True
        if "form" in named or not BOILER_WORDS.isdisjoint(named) or "header" in named and not main:
            self.classed += 1
            by_class = (*by_class, self.classed)
            if not ANSWER_WORDS.isdisjoint(named):
                self.answers.add(self.classed)
        self.stack.append((tag, self.skipped, self.firm, self.by_class, self.main))
        self.skipped, self.firm, self.by_class, self.main = skipped, firm, by_class, main

    def _pop(self) -> str:
        tag, self.skipped, self.firm, self.by_class, self.main = self.stack.pop()
        return tag

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "a":
            self.link = False
        if tag in BLOCK_TAGS or tag in SKIPPED:
            if tag not in UNSEEN:
                self.flush()
                self.heading = False
                if tag != "p":
                    self.link = False
            if any(t[0] == tag for t in self.stack):
                while self._pop() != tag:
                    pass

    def handle_data(self, data):
        if not self.skipped:
            self.parts.append(data)
            if self.link:
                self.linked += len(data.strip())


def _size(text: str) -> int:
    """Characters, those of scripts that write a word in one or two as three."""
    return len(text) if text.isascii() else len(text) + 2 * sum(map(len, _WIDE.findall(text)))


def _stop_words(text: str) -> tuple[int, int]:
    """(listed stop words, words)."""
    words = text.split()
    return sum(_EDGE.sub("", w.lower()) in STOP_WORDS for w in words), len(words)


def _decide(text: str, linked: int, main: bool, heading: bool, share: float, listed: bool) -> bool | None:
    """Content, boilerplate, or open, by density."""
    if linked > LINKS * len(text) and not (heading and main):
        return False
    if main:  # an article's own blocks are content; the short ones among them follow their neighbours
        return True if heading or len(text) >= SHORT else None
    size = _size(text)
    if size < SHORT:
        return None
    few_links = linked <= SOME_LINKS * len(text)
    if not listed:
        return True if size >= LONG and few_links else None
    if share >= PROSE:
        return True if size >= LONG else None
    if share >= SOME_PROSE and size >= LONG:
        return True
    return None if few_links else False


def _first_pass(blocks: list) -> list[bool | None]:
    stops = [(0, 0) if b[3] or _size(b[0]) < SHORT else _stop_words(b[0]) for b in blocks]
    listed = sum(k for k, _ in stops) >= LISTED * sum(n for _, n in stops)
    labels = [_decide(t, n, main, heading, k / max(1, words), listed)
              for (t, n, _, main, heading, _), (k, words) in zip(blocks, stops)]
    if True not in labels:   # no content yet: what has few links is, the short ones only if there is nothing else
        free = [i for i, b in enumerate(blocks) if labels[i] is None and b[1] <= SOME_LINKS * len(b[0])]
        some = [i for i in free if _size(blocks[i][0]) >= SHORT]
        if some or sum(_size(blocks[i][0]) for i in free) >= SHORT:
            for i in some or free:
                labels[i] = True
    return labels


def main_text(html: str | None) -> str:
    """The page's main text: its content blocks in order, joined by one space."""
    if not html:
        return ""
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    blocks = [b for b in parser.blocks if not b[2]]                      # boilerplate by tag or role goes
    size: Counter[int] = Counter()
    for text, linked, *_, by_class in blocks:
        for k in by_class:
            size[k] += len(text) - linked
    for wide in (False, True):
        total = 0 if wide else sum(len(b[0]) - b[1] for b in blocks)
        # a class word drops what is less than half of the text; if nothing stays, only what is short
        large = {k for k, n in size.items() if n >= LONG and 2 * n > total and (wide or k not in parser.answers)}
        kept = [b for b in blocks if large.issuperset(b[5])]
        text = _second_pass([b for b in kept if b[3]] or kept)           # an article, where there is one
        if text or not size:
            break
    return text


def _second_pass(blocks: list) -> str:
    labels = _first_pass(blocks)
    # nearest decided block on each side
    before, after = [None] * len(labels), [None] * len(labels)
    for order, near in ((range(len(labels)), before), (range(len(labels) - 1, -1, -1), after)):
        last = None
        for i in order:
            near[i] = last
            if labels[i] is not None:
                last = (abs(i), labels[i])
    out = []
    for i, (block, label) in enumerate(zip(blocks, labels)):
        if label is None:
            a, b = before[i], after[i]
            if a and b:
                label = a[1] if i - a[0] < b[0] - i else b[1] if b[0] - i < i - a[0] else a[1] or b[1]
            else:
                label = (a or b or (0, block[3]))[1]
        if label:
            out.append(block[0])
    return " ".join(out)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` (main text) of every page.

    ``pages``: ``page_id``, ``url``, ``html``; other columns are ignored, whatever their names. One row per input
    row; a null or empty html, or one without content, gives an empty text; null ids and urls stay null;
    repeated rows are extracted each; pages are read whole, whatever their length. An empty table gives no rows.
    """
    pages = pages.select("page_id", "url", "html")
    schema = pages.drop("html").schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, ["html"], SLICE_BYTES):
                text = pa.array([main_text(h) for h in part.column("html").to_pylist()], pa.string())
                yield pa.record_batch([part.column("page_id"), part.column("url"), text], names=["page_id", "url", "text"])

    return pages.mapInArrow(run, schema)


def op1_html(spark, sf_dir: str) -> DataFrame:
    """Main text of all pages and its length in code points."""
    from pyspark.sql import functions as F

    from tidemark.llm.common import table

    out = extract_main_text(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))

"""Main text of web pages by two passes over their blocks.

A page is read once, front to back, into blocks: runs of text between block-level tags,
with their length, words, stop words, link characters, and the section they stand in (the
page's body or one ``<article>`` / ``<main>``). Markup that never holds article text
(scripts, forms, menus, side matter, notices, comments) decides its blocks outright.

Pass one decides what its own figures allow: a block is boilerplate if most of its
characters are links, and text if it is long and rich in stop words. The rest, above all
short blocks, are ambiguous. Pass two gives those the label of their nearest decided
neighbour in the same section, text if two are equally near; inside an article,
boilerplate labels aren't handed on. Without a decided block in its section, an article's
blocks are text, and so are paragraphs and headings of a page without an article. Where
a page marks an article, only articles are its main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bursa.llm.common import sliced

LONG_CHARS = 70
STOP_DENSITY = 0.15
LINK_DENSITY = 0.5

# Frequent function words of the languages that the rules know.
STOP_WORDS = frozenset("""
a about after all also an and are as at be been but by can for from had has have he her his i if in into is it its
more my no not of on one or our out she so some than that the their them there these they this to up was we were what
when which who will with would you your
aber als am an auch auf aus bei bin bis das dass dem den der des die doch du durch ein eine einem einen einer er es
für hat ich ihr im in ist ja kann man mehr mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor
war was wenn werden wie wir wird zu zum zur
au aux avec ce ces comme dans de des du elle en est et être eux fait il ils je la le les leur lui mais ne nous on ont
ou par pas plus pour qu que qui sa se ses son sont sur tout un une vous
al como con cuando de del desde donde el ella en entre era es esta este está ha han hasta hay la las le lo los me muy
más nada ni no nos o para pero por porque que se ser si sin sobre son su sus también todo un una uno y ya yo
""".split())

# Elements of HTML by what they hold.
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
section select summary table tbody td tfoot th thead title tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg math object".split())
_SIDE = frozenset("""nav footer aside form menu dialog select button datalist fieldset label input head option audio
video canvas map""".split())
_SIDE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu".split())
_SIDE_WORDS = frozenset("""ad ads adsense advert adverts advertisement advertising aside banner breadcrumb breadcrumbs
comment comments consent cookie cookies disqus footer form gdpr header login masthead menu modal nav navbar navigation
newsletter notice pager pagination popup promo promotion recommended related replies reply respond search share
sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget""".split())
_READER_WORDS = frozenset("comment comments disqus replies reply respond".split())
_TEXT_TAGS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 dd dt li td th figcaption".split())
# An open element that a start tag ends, as far as it is open.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
         "th": ("td", "th"), "option": ("option",)}

_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<!--|<[!?/][^>]*>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[^\W\d_]+")
_NAME = re.compile(r"[a-z0-9]+")


@dataclass
class Block:
    """A run of text; ``section`` 0 is the body, others are articles in page order."""
    text: str
    section: int
    tag: str
    side: bool
    link_chars: int
    label: bool | None = None  # True: text, False: boilerplate


@dataclass
class _Open:
    tag: str
    side: str = ""  # "", "hard" (by element), "soft" (by name) or "reader" (comments)
    article: int = 0


@dataclass
class _Page:
    """Open elements and the text since the last block's end."""
    blocks: list[Block] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=list)
    counts: Counter = field(default_factory=Counter)
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    articles: int = 0

    sides: list[list[_Open]] = field(default_factory=list)  # of each block: what it stands in

    def flush(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                section = next((x.article for x in reversed(self.stack) if x.article), 0)
                tag = next((x.tag for x in reversed(self.stack) if x.tag in _BLOCK), "body")
                block = Block(text, section, tag, False,
                              len(" ".join(html.unescape(" ".join(self.linked)).split())) if self.linked else 0)
                self.blocks.append(block)
                self.sides.append([x for x in self.stack if x.side])
            self.parts, self.linked = [], []

    def close(self, tag: str) -> None:
        """End the nearest open ``tag`` and all within it; none open: nothing."""
        if self.counts[tag]:
            while True:
                top = self.stack.pop()
                self.counts[top.tag] -= 1
                if top.tag == tag:
                    return

    def close_within(self, tags: tuple[str, ...]) -> None:
        """End an open one of ``tags`` if only inline or text elements stand above it."""
        for k in range(len(self.stack) - 1, max(-1, len(self.stack) - 9), -1):
            if self.stack[k].tag in tags:
                self.close(self.stack[k].tag)
                return
            if self.stack[k].tag in _BLOCK and self.stack[k].tag not in ("p", "li", "dt", "dd", "td", "th"):
                return

    def open(self, tag: str, attributes: str) -> None:
        if tag in _BLOCK and self.counts["p"]:
            self.close_within(("p",))
        if tag in _ENDS:
            self.close_within(_ENDS[tag])
        new = _Open(tag, _side(tag, attributes))
        content = tag in ("article", "main")
        if not content and attributes:
            low = attributes.lower()
            content = "articlebody" in low or ("role" in low and "main" in low and _role(low) == "main")
        if content and new.side != "reader" and not any(x.side in ("hard", "reader") for x in self.stack):
            for x in self.stack:  # what holds an article isn't side matter, whatever its name says
                x.side = "" if x.side == "soft" else x.side
            new.side = ""
            if not any(x.article for x in self.stack):
                self.articles += 1
                new.article = self.articles
        if tag == "header" and any(x.article for x in self.stack):
            new.side = ""  # an article's own head
        self.stack.append(new)
        self.counts[tag] += 1


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _role(attributes: str) -> str:
    return _attributes(attributes).get("role", "").strip().lower()


def _side(tag: str, attributes: str) -> str:
    """Whether an element is side matter: by its kind, its role, or a word of its class or id."""
    if tag in _SIDE:
        return "hard"
    if tag == "header":
        return "soft"
    if not attributes.strip() or tag in ("html", "body", "main"):
        return ""
    own = _attributes(attributes)
    if "hidden" in own or re.search(r"display\s*:\s*none", own.get("style", "")):
        return "hard"
    names = set(_NAME.findall(f"{own.get('class', '')} {own.get('id', '')}".lower()))
    if names & _READER_WORDS:
        return "reader"
    if own.get("role", "").strip().lower() in _SIDE_ROLES:
        return "hard"
    return "soft" if names & _SIDE_WORDS and tag != "article" else ""


def blocks_of(page: str) -> list[Block]:
    """The page's non-empty blocks in order, references decoded, white space made one space."""
    state, at, n = _Page(), 0, len(page)
    no_more: set[str] = set()  # closers that don't come again: never search for them twice
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            state.parts.append(page[at:lt])
            if state.counts["a"]:
                state.linked.append(page[at:lt])
        if lt == n:
            break
        m = _TAG.match(page, lt)
        if not m:
            if page[lt + 1:lt + 2].isalpha() or page[lt + 1:lt + 2] in ("/", "!", "?"):
                break  # a tag that the page's end cuts off
            state.parts.append("<")
            at = lt + 1
            continue
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            if m[0] == "<!--":
                end = page.find("-->", lt + 2) if "-->" not in no_more else -1
                if end < 0:
                    no_more.add("-->")
                    break  # the rest is a comment
                at = end + 3
            continue
        if m[1]:
            if tag in _BLOCK:
                state.flush()
            elif tag == "a" and state.linked:
                state.linked.append(" ")
            state.close(tag)
            continue
        if tag in _RAW and not m[3].endswith("/"):
            if tag in _BLOCK:
                state.flush()
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at) if tag not in no_more else None
            if end is None:
                no_more.add(tag)
                if tag in ("script", "style", "textarea", "title", "xmp"):
                    break  # it runs to the page's end
                continue
            close = page.find(">", end.end())
            at = n if close < 0 else close + 1
            continue
        if tag == "br":
            state.parts.append(" ")
        if tag in _BLOCK:
            state.flush()
        if tag not in _VOID:
            state.open(tag, m[3])
    state.flush()
    for block, sides in zip(state.blocks, state.sides):
        block.side = any(x.side for x in sides)
    return state.blocks


def decide(blocks: list[Block], long_chars: int = LONG_CHARS, stop_density: float = STOP_DENSITY,
           link_density: float = LINK_DENSITY, stop_words: frozenset[str] = STOP_WORDS) -> None:
    """Label every block: pass one by its own figures, pass two by its neighbours."""
    marked = any(b.section for b in blocks if not b.side)
    for b in blocks:
        if b.side or (marked and not b.section) or b.link_chars > link_density * len(b.text):
            b.label = False
        elif len(b.text) >= long_chars:
            words = _WORD.findall(b.text.lower())
            if words and sum(w in stop_words for w in words) >= stop_density * len(words):
                b.label = True
    sections: dict[int, list[Block]] = {}
    for b in blocks:
        if b.label is not False or not b.section:  # links or side matter in an article say nothing of what is beside
            sections.setdefault(b.section, []).append(b)
    for number, own in sections.items():
        far = len(own) + 1
        before: list[tuple[int, bool | None]] = []
        last, label = -far, None
        for i, b in enumerate(own):
            if b.label is not None:
                last, label = i, b.label
            before.append((i - last, label))
        last, label = 2 * far, None
        for i in range(len(own) - 1, -1, -1):
            b = own[i]
            if b.label is not None:
                last, label = i, b.label
                continue
            (back, left), ahead = before[i], last - i
            if left is None and label is None:
                b.label = bool(number) or b.tag in _TEXT_TAGS
            elif back == ahead:
                b.label = bool(left or label)
            else:
                b.label = left if back < ahead else label


def main_text(page: str) -> tuple[str, int]:
    """(text, blocks): the text blocks joined by empty lines, and how many blocks the page has."""
    blocks = blocks_of(page)
    decide(blocks)
    return "\n\n".join(b.text for b in blocks if b.label), len(blocks)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points), n_blocks; one row per input row.

    A null or empty page, and one without text, has the empty text. Null ids and urls
    stay null, repeated rows give repeated results, very long pages are read whole, an
    empty table gives no row. Only page_id, url and html are read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [main_text(page or "") for page in batch.column("text").to_pylist()]
            texts = [t for t, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64()), pa.array((k for _, k in found), pa.int64())],
                ["page_id", "url", "text", "n_chars", "n_blocks"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("text"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long")

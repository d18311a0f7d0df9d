"""Main text of HTML pages by two-pass block rules.

A page is scanned into blocks of text. Parts that the markup names as furniture (navigation, forms, comments,
...) are boilerplate and taken out. In the first pass every other block is classified by itself by link density,
length and stop-word density; that it lies in an article is evidence, which moves the bounds. Short blocks and
those between the bounds stay undecided. In the second pass an undecided block takes the label of its nearest
decided neighbours: content if both sides agree on it or the nearer one is content.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import require

# Element names of the HTML standard, by their role here.
RAW = {"script", "style", "noscript", "template", "iframe", "object", "svg", "math", "canvas", "textarea", "select", "title", "noembed", "noframes", "xmp"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
#: Elements that can enclose others of their name, so that their ends must be paired.
CONTAINERS = {"div", "section", "article", "main", "span", "ul", "ol", "table", "td", "li", "blockquote", "figure", "details", "dl"}
FURNITURE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "fieldset"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar"}
#: Words of class and id attributes that mark furniture. A class of such words only is a plain mark, one among other words a weak one.
MARKS = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disclaimer disqus dropdown footer gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notices notification pagination pager popup promo promoted promotion recommended related replies respond search share sharing "
    "sidebar sidebars signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
#: Marks that inside an article name its own head.
HEADS = {"header", "banner", "masthead"}
#: First words of classes that tell a state of the layout, such as "no-sidebar".
STATES = {"no", "not", "has", "with", "without"}
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "a about all an and are as at be been but by can for from had has have he her his i in into is it its not of on or she that the "
    "their there they this to was we were which who will with would you "
    "aber als am auch auf aus bei bis das dem den der des die durch ein eine einem einen einer er es für hat ich im ist mit nach "
    "nicht noch nur oder sein sich sie sind über um und von vor war wie wir zu zum zur "
    "au aux avec ce ces dans de du elle en est et il ils je la le les leur mais ne nous ou par pas plus pour que qui sa se ses son "
    "sur un une vous "
    "al como con del el ella ese esta este fue ha las lo los más no o para pero por se ser si sin su sus una y ya".split()
)

# An attribute is a name and, after an equals sign, a value; only there do quotes enclose. One that is never closed is part of the value.
_VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+)"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*+)((?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+{_VALUE})?+|=)*+)(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(=?[^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+")
#: Marks that end a sentence, in several scripts, and characters that are words or nearly so.
_SENTENCE = re.compile(r"[.!?…;。！？；।؟։۔](?:\W|\Z)|[。！？；]")
_WIDE = re.compile(r"[぀-ヿ㐀-鿿가-힯]")

CONTENT, BOILERPLATE, SHORT, NEAR, OUTER = 1, 0, -1, -2, -3
PLAIN, WEAK = "plain", "weak"


@dataclass
class Block:
    text: str
    link_chars: int
    role: int | None  # BOILERPLATE for furniture, CONTENT inside an article or main
    heading: bool = False
    mark: int = -1  # the innermost marked element around it
    top: bool = False  # a first-level heading
    paragraph: bool = False


@dataclass
class Span:
    """A marked or naming element by the blocks it holds, from ``first`` to before ``last``."""

    kind: str
    first: int
    parent: int = -1
    last: int | None = None


@dataclass(frozen=True)
class Thresholds:
    """Bounds of the first pass, in characters and shares of characters or words."""

    link_density: float = 0.33
    link_density_named: float = 0.5
    short: int = 60
    long: int = 120
    stop_low: float = 0.12
    stop_high: float = 0.22


def _marks(value: str, in_article: bool) -> str | None:
    """The strongest mark among the tokens of a class or id."""
    found = None
    for token in value.split():
        words = [w for w in re.split(r"[^a-z]+", token) if w]
        marks = MARKS.intersection(words) - (HEADS if in_article else set())
        if marks and marks.issuperset(words):
            return PLAIN
        if marks and words[0] not in STATES:
            found = WEAK
    return found


def _role(name: str, attributes: str, in_article: bool) -> tuple[int | None, str | None]:
    """What an element's name and attributes say of its role, and its mark."""
    if name in FURNITURE or (name == "header" and not in_article):
        return BOILERPLATE, None
    mark = None
    if attributes:
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), "".join(values).lower()
            if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
                return BOILERPLATE, None
            # The body's own marks, such as "has-sidebar", say nothing of its parts.
            if key in ("class", "id") and name not in ("body", "html", "article", "main") and mark != PLAIN:
                mark = _marks(value, in_article) or mark
    if name in ("article", "main"):
        return CONTENT, None
    # A few marked words within a line are part of it unless the mark is plain.
    return None, None if mark == WEAK and name == "span" else mark


def _settle(blocks: list[Block], marks: list[Span], named: list[Span], tops: list[int], little: float = 0.25) -> None:
    """Give the role BOILERPLATE to the blocks of marked elements whose mark decides.

    A plain mark decides unless it is around an article or main of half the size of the page's largest. A weak mark decides only for
    an element without article, main or first-level heading that has at most ``little`` of the page's text.
    """
    size = [0, *accumulate(len(b.text) if b.role != BOILERPLATE else 0 for b in blocks)]

    def held(span: Span) -> int:
        return size[span.last] - size[span.first]

    texts = [n for n in named if held(n)]
    most = max(map(held, texts), default=0)
    winners = sorted(n.first for n in texts if 2 * held(n) >= most)
    starts = sorted(n.first for n in texts)

    def has(places: list[int], span: Span) -> bool:
        return bisect_left(places, span.first) < bisect_left(places, span.last)

    drops: list[bool] = []
    for m in marks:
        decides = not has(winners, m) if m.kind == PLAIN else not has(starts, m) and not has(tops, m) and held(m) <= little * size[-1]
        drops.append(decides or m.parent >= 0 and drops[m.parent])
    for b in blocks:
        if b.mark >= 0 and drops[b.mark]:
            b.role = BOILERPLATE


def blocks_of(page: str) -> list[Block]:
    """Blocks of text in page order. A tag that the page's end cuts off is dropped; a text cut off counts."""
    out: list[Block] = []
    stack: list[tuple[str, int | None, int, Span | None]] = []  # open elements that bear on their content
    marks: list[Span] = []
    named: list[Span] = []
    tops: list[int] = []  # blocks that are first-level headings
    opened: Counter[str] = Counter()
    text: list[str] = []
    links: list[str] = []  # what of it stands in links
    role: int | None = None
    mark = -1
    opened_last = ""  # the block element that the text at hand began in

    def end_block() -> None:
        words = " ".join(entities.unescape("".join(text)).split()) if text else ""
        if words:
            if opened_last == "h1" and role != BOILERPLATE:
                tops.append(len(out))
            linked = len(" ".join(entities.unescape("".join(links)).split()))
            out.append(Block(words, linked, role, opened_last in HEADINGS, mark, opened_last == "h1", opened_last == "p"))
        text.clear()
        links.clear()

    def close(name: str) -> None:
        while opened[name]:
            if stack[-1][3]:
                end_block()
                stack[-1][3].last = len(out)
            gone = stack.pop()[0]
            opened[gone] -= 1
            if gone == name:
                return

    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.search(page, at)
        upto = found.start() if found else size
        if upto > at:
            text.append(page[at:upto])
            if opened["a"]:
                links.append(text[-1])
        if not found:
            break
        at, name = found.end(), (found[1] or "").lower()
        if not name:
            continue
        if name in BLOCK or name in RAW:
            end_block()
            opened_last = "" if page[found.start() + 1] == "/" else name
        elif name in ("br", "img", "input"):
            text.append(" ")
        if page[found.start() + 1] == "/":
            close(name)
        elif name in RAW:
            if not (found[0].endswith("/>") and name in ("svg", "math")):
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else size
        elif name not in VOID:
            if name in BLOCK:
                close("p")
            inherited, around = (stack[-1][1], stack[-1][2]) if stack else (None, -1)
            own, kind = _role(name, found[2] or "", inherited == CONTENT)
            span = None
            if inherited == BOILERPLATE:
                # Named furniture stays furniture whatever is inside.
                own = kind = None
            elif kind or own == CONTENT:
                end_block()
                span = Span(kind or name, len(out), around)
                (marks if kind else named).append(span)
                around = len(marks) - 1 if kind else around
            if own is not None or kind or name == "a" or name in CONTAINERS:
                stack.append((name, inherited if own is None else own, around, span))
                opened[name] += 1
        now = (stack[-1][1], stack[-1][2]) if stack else (None, -1)
        if now != (role, mark):
            end_block()
            role, mark = now
    end_block()
    for span in (*marks, *named):
        if span.last is None:
            span.last = len(out)
    _settle(out, marks, named, tops)
    return out


def _stops(text: str) -> tuple[int, int]:
    """Stop words and all words of a text."""
    words = text.lower().split()
    return sum(w.strip(".,;:!?()\"'") in STOP_WORDS for w in words), len(words)


def foreign(blocks: list[Block], t: Thresholds = Thresholds()) -> bool:
    """Whether a page is in a language without stop words here: its longer blocks that are no links have too few."""
    found = [_stops(b.text) for b in blocks if b.role != BOILERPLATE and len(b.text) >= t.short and b.link_chars <= t.link_density * len(b.text)]
    return sum(n for n, _ in found) < t.stop_low * sum(n for _, n in found)


def classify(block: Block, t: Thresholds = Thresholds(), unknown: bool = False) -> int:
    """First pass: CONTENT, BOILERPLATE, or SHORT / NEAR for what the neighbours decide.

    Inside an article more links are borne, a paragraph that is a link is undecided, a first-level heading is content,
    and so is from ``short`` on what has ``stop_low``; nothing there is boilerplate but for its links. Without stop
    words, what ends sentences is undecided, and so are figures; on a page in an ``unknown`` language the ends of
    sentences stand for stop words. Ideographs and syllables count twice.
    """
    if block.role == BOILERPLATE:
        return BOILERPLATE
    named = block.role == CONTENT
    size = len(block.text)
    if block.link_chars > (t.link_density_named if named else t.link_density) * size:
        return NEAR if named and block.paragraph and size >= t.short else BOILERPLATE
    if named and block.top:
        return CONTENT
    size += len(_WIDE.findall(block.text))
    if size < t.short:
        return NEAR if named else SHORT
    n, words = _stops(block.text)
    spoken = unknown and _SENTENCE.search(block.text) is not None
    if named:
        return CONTENT if spoken or n >= t.stop_low * words else NEAR
    if spoken or n >= t.stop_high * words:
        return CONTENT if size >= t.long else NEAR
    if unknown or n >= t.stop_low * words:
        return NEAR
    figures = not any(c.isalpha() for c in block.text)
    return NEAR if figures or _SENTENCE.search(block.text) else BOILERPLATE


def smooth(labels: list[int], headings: list[bool] | None = None) -> list[int]:
    """Second pass: undecided blocks take the label of the nearest decided ones.

    First NEAR, then SHORT blocks: both neighbours alike give their label; of two that differ the nearer
    wins, at equal distance content for NEAR and boilerplate for SHORT; an undecided heading goes with what
    follows it. NEAR without any decided neighbour is content, SHORT is boilerplate. OUTER, a short block on a
    page that has an article elsewhere, is content only between content.
    """
    out = list(labels)
    for kind, tie in ((NEAR, CONTENT), (SHORT, BOILERPLATE), (OUTER, BOILERPLATE)):
        n = len(out)
        before, after = [(tie, n + 1)] * n, [(tie, n + 1)] * n
        last: tuple[int, int] | None = None
        for i in range(n):
            before[i] = (last[0], i - last[1]) if last else (tie, n + 1)
            last = (out[i], i) if out[i] >= 0 else last
        last = None
        for i in range(n - 1, -1, -1):
            after[i] = (last[0], last[1] - i) if last else (tie, n + 1)
            last = (out[i], i) if out[i] >= 0 else last
        for i in range(n):
            if labels[i] == kind:
                (a, da), (b, db) = before[i], after[i]
                leads = headings is not None and headings[i] and db <= n
                out[i] = b if leads else a if a == b else tie if kind == OUTER else a if da < db else b if db < da else tie
    return out


def main_text(page: str | None, t: Thresholds = Thresholds()) -> str:
    """The content blocks of a page, one line each; empty if there are none.

    Blocks that the markup names as furniture say nothing of their neighbours and are taken out first. Where
    the density rules find no content in an article (verse, a list of short items), or the page is in a language without
    stop words here, what they leave undecided there is content; and so it is on a page where they decide nothing.
    """
    blocks = [b for b in blocks_of(page or "") if b.role != BOILERPLATE]
    unknown = foreign(blocks, t)
    labels = [classify(b, t, unknown) for b in blocks]
    named = [i for i, b in enumerate(blocks) if b.role == CONTENT]
    if named:
        labels = [OUTER if x == SHORT else x for x in labels]
        if unknown or not any(labels[i] == CONTENT and not blocks[i].top for i in named):
            for i in named:
                labels[i] = CONTENT if labels[i] == NEAR else labels[i]
    if blocks and all(label in (SHORT, NEAR) for label in labels):
        # Nothing is decided, so no neighbour can tell: a page of a few short paragraphs is its own content.
        labels = [CONTENT] * len(labels)
    labels = smooth(labels, [b.heading for b in blocks])
    return "\n".join(b.text for b, label in zip(blocks, labels, strict=True) if label == CONTENT)


def extract(pages: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html).

    Null or empty html gives an empty text and 0; repeated rows are extracted each; other columns are left
    aside. Whole pages are read and nothing is shuffled.
    """
    pages = require(pages, ["page_id", "url", "html"], "extract")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [main_text(h.as_py(), t) for h in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), part.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")

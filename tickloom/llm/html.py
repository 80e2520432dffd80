"""Main text of web pages.

Method: two-pass block rules. A page is cut into blocks at block-level tags. Pass
one decides each block by link density, length and the share of stop words; blocks
that are too short to tell stay open. Pass two gives an open block the label of its
nearest decided neighbours. Markup excludes and hints: what stands in menus, page
headers and footers, sidebars, notices, adverts, forms, scripts and reader comments,
by element, role or class, is no candidate. A block inside <article> counts as good
in pass one unless it is a link list, as long as that article is no mere teaser;
<main> gives no such hint. Beside marked text, blocks outside count when they add
up to a long block.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.quality import STOP_WORDS

#: Lengths in characters, shares of words, shares of characters in links.
SHORT, LONG = 70, 200
STOPS_LOW, STOPS_HIGH = 0.08, 0.12
MAX_LINKS, MAX_LINKS_INSIDE = 0.2, 0.66
#: A heading counts with the good block that begins within so many characters after it.
HEADING_REACH = 200

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe object svg math textarea title canvas audio video".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select summary table "
    "tbody td tfoot th thead tr ul".split())
NOT_TEXT = set("head nav footer aside form menu dialog select button fieldset label datalist".split())
NOT_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar note".split())
#: Words in class and id that mark what is not the article. Fixed values.
NOT_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promoted banner "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay lightbox newsletter subscribe subscription "
    "signup login paywall sidebar sidebars aside rail menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar "
    "comment comments reply replies respond disqus discussion feedback related recommended recommendations trending popular "
    "share sharing social widget widgets toolbar pagination pager skip search form tags tagcloud disclaimer copyright legal".split())
HEADER_WORDS = {"header", "head"}
#: Words before a marker that turn it into a statement about the layout ("with-sidebar").
NEGATIONS = set("with has no without is not hide show hidden toggle open".split())
#: On the element that holds an article only these count.
ARTICLE_WORDS = set("comment comments reply replies related recommended ad ads advert advertisement promo sponsored teaser".split())

#: A tag whose quotes are closed. Possessive: a position fails at once or not at all.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
#: The start of one, whatever follows.
OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
STOPS = frozenset(STOP_WORDS)
EDGES = ".,;:!?\"'()[]«»“”…"


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    inside: bool
    article: int = 0  # number of the outermost article it stands in


def _marks(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element's own tag says that it is not the article."""
    if name in NOT_TEXT or name == "header" and not inside:
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next(filter(None, values), "").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in NOT_ROLES:
            return True
        if key == "style" and "display:none" in value.replace(" ", ""):
            return True
        if key in ("class", "id"):
            for token in value.split():
                words = [w for w in re.split(r"[^a-z]+", token) if w]
                for before, word in zip(["", *words], words):
                    if before in NEGATIONS:
                        continue
                    if word in (ARTICLE_WORDS if name == "article" else NOT_WORDS) or word in HEADER_WORDS and not inside and name != "article":
                        return True
    return False


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, without what its markup rules out."""
    out: list[Block] = []
    pieces: list[str] = []
    linked, heading = 0, False
    stack: list[tuple[str, bool, bool, int]] = []  # open elements: name, ruled out, inside what is marked, number of the article
    articles = 0
    opened: Counter = Counter()  # their names
    links = 0

    def leave(depth: int) -> None:
        opened.subtract(x[0] for x in stack[depth:])
        del stack[depth:]

    def close_block() -> None:
        nonlocal pieces, linked, heading
        text = " ".join("".join(pieces).split()) if pieces else ""
        if text:
            out.append(Block(text, min(linked, len(text)), heading, bool(stack) and stack[-1][2], stack[-1][3] if stack else 0))
        pieces, linked, heading = [], 0, False

    def add(text: str) -> None:
        nonlocal linked
        if text and not (stack and stack[-1][1]):
            text = entities.unescape(text)
            pieces.append(text)
            if links:
                linked += len(" ".join(text.split()))

    at, end = 0, len(page)
    while at < end:
        # Text up to the next tag, comment or declaration; a lone "<" is text.
        start = page.find("<", at)
        while start >= 0 and not (page[start + 1: start + 2].isascii() and page[start + 1: start + 2].isalpha() or page[start + 1: start + 2] in ("/", "!", "?")):
            start = page.find("<", start + 1)
        close = page.find(">", start) if start >= 0 else -1
        if close < 0 and not page.startswith("<!--", max(start, 0)):
            add(page[at:])
            break
        add(page[at:start])
        if page.startswith("<!--", start):
            close = page.find("-->", start + 4)
            at = close + 3 if close >= 0 else end
            continue
        found = TAG.match(page, start) or OPEN.match(page, start)
        at = found.end() if found and found.re is TAG else close + 1
        if not found:
            continue
        closing_tag, name = bool(found[1]), found[2].lower()
        attributes = found[3] if found.re is TAG else page[found.end(): close]
        if name == "br":
            pieces.append(" ")
            continue
        if name in RAW and not closing_tag:
            if name in BLOCK or not attributes.endswith("/"):
                closing = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                at = closing.end() if closing else end
            continue
        if name in BLOCK:
            close_block()
        if closing_tag:
            if name == "a":
                links = max(0, links - 1)
            for depth in range(len(stack) - 1, -1, -1) if opened[name] else ():
                if stack[depth][0] == name:
                    leave(depth)
                    break
            if name in BLOCK:
                links = 0
            continue
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            continue
        if name in BLOCK:
            # A paragraph ends where the next block begins; an item where the next item does.
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == "p" or name == stack[depth][0] and name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    leave(depth)
                    break
                if stack[depth][0] in BLOCK:
                    break
            heading = name in ("h1", "h2", "h3", "h4", "h5", "h6")
        out_before, inside, article = stack[-1][1:] if stack else (False, False, 0)
        ruled_out = out_before or _marks(name, attributes, inside)
        if not article and (name == "article" or 'itemprop="articleBody"' in attributes):
            articles += 1
            article = articles
        inside = inside or bool(article) or name == "main" or 'role="main"' in attributes
        stack.append((name, ruled_out, inside, article))
        opened[name] += 1
        if name == "a":
            links = 1
    close_block()
    return out


def _share_of_stops(text: str) -> float:
    words = text.lower().split()
    return sum(w.strip(EDGES) in STOPS for w in words) / len(words)


def _by_itself(block: Block, share: float, known: bool) -> bool | None:
    """Pass one for a block without a hint. None: open."""
    length = len(block.text)
    if block.linked > MAX_LINKS * length or "©" in block.text:
        return False
    if length < SHORT:
        return False if block.linked else None
    if not known or share >= (STOPS_HIGH if length < LONG else STOPS_LOW):
        return True
    return None if share >= STOPS_LOW or length < LONG else False


def main_text(page: str | None) -> list[str]:
    """The blocks of the article, in page order."""
    found = blocks(page or "")

    # Pass one: each block by itself, then with the hint of its article.
    shares = [_share_of_stops(b.text) for b in found]
    long_shares = [s for b, s in zip(found, shares) if len(b.text) >= SHORT]
    known = max(long_shares, default=0.0) >= STOPS_LOW  # else the language has no stop words in the list
    labels = [_by_itself(b, s, known) for b, s in zip(found, shares)]
    near = [label is None and len(b.text) >= SHORT for b, label in zip(found, labels)]
    good: Counter = Counter()  # characters that are good by themselves, by article
    for block, label in zip(found, labels):
        good[block.article] += len(block.text) if label else 0
    total = sum(good.values())
    for i, block in enumerate(found):
        # An article without good text of its own is a teaser where a long text stands elsewhere.
        if block.article and (good[block.article] or total < LONG):
            listed = block.linked > MAX_LINKS_INSIDE * len(block.text)
            labels[i] = not (listed or "©" in block.text and len(block.text) < SHORT)

    # Beside marked text, what else there is has to add up to a long block.
    marked = any(label and b.inside for b, label in zip(found, labels))
    for inside, run in groupby(range(len(found)), lambda i: found[i].inside) if marked else ():
        places = [i for i in run if labels[i]]
        if not inside and sum(len(found[i].text) for i in places) < LONG:
            for i in places:
                labels[i] = False

    # Pass two: open blocks follow their nearest decided neighbours on their side of the mark; its ends and those of the page count as no article.
    def nearest(order: range) -> list[bool]:
        out, last, side = [False] * len(labels), False, None
        for i in order:
            if marked and found[i].inside != side:
                last, side = False, found[i].inside
            out[i] = last
            if labels[i] is not None:
                last = bool(labels[i])
        return out

    before, after = nearest(range(len(labels))), nearest(range(len(labels) - 1, -1, -1))
    final = []
    for i, label in enumerate(labels):
        if label is None and found[i].heading:
            gap, label, j = 0, False, i + 1
            while j < len(labels) and gap <= HEADING_REACH and not labels[j]:
                gap, j = gap + len(found[j].text), j + 1
            if j < len(labels) and gap <= HEADING_REACH:
                label = found[i].article in (0, found[j].article)
        elif label is None:
            label = (before[i] or after[i]) if near[i] else (before[i] and after[i])
        final.append(label)
    if not any(final):  # nothing is long enough to decide: what is free of links
        final = [not b.linked and "©" not in b.text for b in found]
    return [b.text for b, kept in zip(found, final) if kept]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text (blocks joined by one line feed) and n_chars for every row.

    A null or empty html gives an empty text; so does a page without article.
    Broken markup is read as far as it goes. Rows that repeat stay; nulls in
    page_id and url stay null. Extra columns are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n".join(main_text(page)) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")

"""HTML main-text extraction by line-block distribution.

Method: the page is turned into lines, one per block of running text, with
markup, scripts, styles and comments stripped. Parts that announce themselves
as boilerplate (navigation, page headers and footers, sidebars, notices,
adverts, forms, reader comments; by element, role, or class and id words) and
link lists leave empty lines behind. A class or id that means nothing else (``ad``,
``comments``, ``cookie-notice``) says so for sure, unless a class beside it names
content. Another says so by its last meaning (``related``, ``site-search``), and
only if the element's own lines are thin: where a window of them holds ``DENSE``
characters besides links, the lines stay and are judged like others. Text lengths are summed over a sliding
window of ``WINDOW`` lines. The text surges where a window sum rises from zero
and dives where it falls back to zero; what lies between a surge and a dive is
a segment. A dropped element inside a container that goes on parts no segment.
The segments from the first to the last whose window sums reach ``SURGE``
characters are kept, and the one right before and after them; if none reaches
it, the longest segment (in an article, all). On pages with article or main
elements only those count, and of several the one with most text and those at
least a ``TEASER``-th as long. Lines at the end that are a copyright notice go.

Scale: a page is one row; an Arrow-batched function of the html column, no
shuffle, linear in the page.

Defined results: null and empty pages, and pages without text, give an empty
text of 0 characters; unclosed elements end where an enclosing element, an
article or the page ends; a cut-off tag at the end is dropped; text outside
any element is a block like another; repeated rows repeat; extra columns are
not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
SURGE = 86  # characters in a window that make a segment main text on pages without an article
DENSE = WINDOW * SURGE  # characters in a window that no element with a mark in its class or id loses
TEASER = 4  # an article with less than this part of the main one's characters is a pointer to another page
_GAP = [("", 0)] * WINDOW

# HTML element names by role, and words that mark boilerplate in class, id or role.
_RAW = "script style noscript template iframe textarea title xmp noembed noframes".split()
_DROP = frozenset("head nav aside form button select option datalist dialog menu svg math canvas audio video object embed applet".split())
_BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NESTS = _BLOCK - _VOID - {"p", "h1", "h2", "h3", "h4", "h5", "h6", "body", "html", "tr", "td", "th", "li", "dt", "dd", "option"}
_SIBLINGS = frozenset("li dt dd option td th tr".split())
_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation "
    "breadcrumb breadcrumbs sidebar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended comment comments commentlist disqus respond reply "
    "replies toolbar pagination pager widget skip search dialog complementary contentinfo masthead".split()
)
# Of these, the words that leave no doubt when a class or id means nothing else.
_SURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsored promo banner nav navbar navigation breadcrumb breadcrumbs sidebar "
    "cookie cookies consent gdpr notice notices newsletter subscribe subscription signup login comment comments commentlist disqus respond "
    "replies toolbar pagination pager".split()
)
# Classes that name content, whatever stands beside them.
_CONTENT = frozenset("article content entry main post story text".split())
# Words before a mark that deny it, and words after it that say only what kind of part it marks.
_DENIED = frozenset("has have no non not with without".split())
_PARTS = frozenset(
    "area bar block body bottom box btn button buttons container default form group icon icons inner item items left link links list "
    "media outer panel post posts right section slot stories top unit wrap wrapper".split()
)
_COPYRIGHT = re.compile(r"(?:©|\(c\)|copyright\b).{0,120}", re.I | re.S)
_PAGE_WORDS = frozenset("header footer".split())  # boilerplate outside an article only
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/a-zA-Z][^>]*(?:>|\Z)", re.S
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_RAW_END = {n: re.compile(rf"</{n}\b[^>]*(?:>|\Z)", re.I) for n in _RAW}
_SPLIT = re.compile(r"[^a-z0-9]+")


_SURE, _LIKELY = 2, 1


def _meant(token: str) -> str:
    """What a class or id is about: its last word that says more than the kind of part."""
    words = [w for w in _SPLIT.split(token) if w and not w.isdigit()]
    if len(words) > 1 and words[0] in _DENIED:
        return ""
    while len(words) > 1 and words[-1] in _PARTS:
        words.pop()
    return words[-1] if words else ""


def _only_marks(token: str, in_article: bool) -> bool:
    """Whether a class or id means boilerplate and nothing else; a footer does outside an article."""
    words = [w for w in _SPLIT.split(token) if w and not w.isdigit()]
    sure = _SURE_WORDS if in_article else _SURE_WORDS | {"footer"}
    return any(w in sure for w in words) and all(w in sure or w in _PARTS or w in ("site", "page") for w in words)


def _marked(name: str, attrs: str, in_article: bool) -> int:
    """Whether an element announces itself as boilerplate: for sure, or by the words of its class or id."""
    if name in _DROP or (name in _PAGE_WORDS and not (in_article and name == "header")):
        return _SURE
    if not attrs or name in ("html", "body", "main") or name == "article" and not in_article:
        return 0
    found = 0
    sure = content = False
    for m in _ATTR.finditer(attrs):
        key, value = m.group(1).lower(), (m.group(2) or "").strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value.strip() == "true":
            return _SURE
        if key not in ("class", "id", "role"):
            continue
        for token in value.split():
            word = _meant(token)
            sure |= _only_marks(token, in_article)
            content |= token in _CONTENT
            if word in _WORDS or (word in _PAGE_WORDS and not in_article):
                if key == "role":
                    return _SURE
                found = _LIKELY
    if sure and not content:
        return _SURE
    return 0 if name == "article" else found


def lines(html: str) -> tuple[list[tuple[str, int]], bool]:
    """The page's lines (text, characters; boilerplate as empty lines) and whether it has an article with text.

    With such an article, lines outside it are empty.
    """
    inside: list[tuple[str, int]] = []
    outside: list[tuple[str, int]] = []
    parts: list[str] = []
    linked = 0  # characters of the block that are link text
    links = articles = 0
    tops: list[int] = []  # where the outermost articles begin and end
    stack: list[str] = []
    opened: Counter[str] = Counter()
    dropped_at: int | None = None  # stack height at which a dropped element began
    dropped_by = ""
    back = -1  # where an element dropped for its class or id begins, else -1
    links_before = lines_before = 0
    sure_at: int | None = None  # stack height of an element in it that is dropped anyhow
    own: list[int] = []  # characters besides links in the lines of that element
    likely: list[tuple[int, int, int]] = []  # elements in it, itself included, that are dropped likewise: tag, line, stack height
    kept: set[int] = set()  # tags whose elements have proved dense
    dense = False
    at = 0

    def close_block() -> None:
        nonlocal linked, dense
        if not parts:
            return
        text = " ".join(unescape("".join(parts)).split())
        parts.clear()
        if text and dropped_at is not None:
            own.append(0 if linked * 10 >= len(text) * 9 else len(text))
            if sum(own[-WINDOW:]) >= DENSE:
                first = next(k for k in range(len(own) - 1, -1, -1) if sum(own[k:]) >= DENSE)
                kept.update(tag for tag, line, _ in likely if line <= first)
                dense = True
        elif text:
            # A block that is nothing but links is a menu.
            menu = not articles and linked * 10 >= len(text) * 9
            outside.append(("", 0) if menu else (text, len(text)))
            inside.append((text, len(text)) if articles else ("", 0))
        linked = 0

    def gap() -> None:
        close_block()
        outside.extend(_GAP)
        inside.extend(_GAP)

    def part() -> None:
        """A dropped element begins or ends: a gap, unless a container goes on around it."""
        if stack:
            close_block()
        else:
            gap()

    def end_drop() -> bool:
        """Ends the dropped element, the stack being as at its start; False if it is to be read again as a part of the page."""
        nonlocal dropped_at, sure_at, back, links, linked, dense, at
        close_block()
        parts.clear()
        again = dense
        if again:
            at = back
            del inside[lines_before:], outside[lines_before:]
        dropped_at, sure_at, back, dense = None, None, -1, False
        links, linked = links_before, 0
        own.clear()
        likely.clear()
        if not again:
            part()
        return not again

    def unwind() -> bool:
        while len(stack) > dropped_at:
            opened[stack.pop()] -= 1
        return end_drop()

    def push(name: str) -> None:
        stack.append(name)
        opened[name] += 1

    def pop_to(name: str) -> None:
        nonlocal articles, sure_at
        while stack:
            top = stack.pop()
            opened[top] -= 1
            if top in ("article", "main") and not (dropped_at is not None and len(stack) >= dropped_at):
                articles -= 1
                if not articles:
                    tops.append(len(inside))
            if dropped_at is not None:
                if len(stack) <= dropped_at:
                    if not end_drop():
                        return
                else:
                    if sure_at is not None and len(stack) <= sure_at:
                        sure_at = None
                    while likely[1:] and likely[-1][2] >= len(stack):
                        likely.pop()
            if top == name:
                return

    n = len(html)
    while at < n or dropped_at is not None:
        if at >= n or dense:
            unwind()
            continue
        m = _TAG.search(html, at)
        text = html[at : m.start() if m else n]
        read = dropped_at is None or back >= 0 and sure_at is None
        if text and read:
            parts.append(text)
            if links:
                linked += len(text.strip())
        if not m:
            at = n
            continue
        at = m.end()
        name = (m.group("name") or "").lower()
        if not name:
            continue
        if m.group("end"):
            if name == "a":
                links = max(0, links - 1)
            if name in _BLOCK and read:
                close_block()
                if dense:
                    continue
            if opened[name]:
                pop_to(name)
            continue
        if name in _RAW_END:
            end = _RAW_END[name].search(html, at)
            at = end.end() if end else n
            continue
        if dropped_at is not None:
            over = name in ("article", "main") and dropped_by not in ("article", "main") or dropped_by == "p" and name in _BLOCK
            if over or (name == dropped_by and name in _SIBLINGS):
                if not unwind():
                    continue
            else:
                marked = 0
                if back >= 0 and sure_at is None:
                    if name in _BLOCK:
                        close_block()
                    links += name == "a"
                    marked = 0 if name in _VOID else _marked(name, m.group("attrs"), articles > 0)
                if marked == _SURE:
                    sure_at = len(stack)
                elif marked == _LIKELY and name in _NESTS:
                    likely.append((m.start(), len(own), len(stack)))
                if name in _NESTS or marked == _SURE or name == dropped_by and name not in _VOID:
                    push(name)
                continue
        if name in _BLOCK:
            close_block()
        marked = 0 if name in _VOID else _marked(name, m.group("attrs"), articles > 0)
        if marked == _SURE or marked == _LIKELY and m.start() not in kept:
            close_block()
            links_before, lines_before = links, len(outside)
            part()
            links += name == "a"
            dropped_at, dropped_by = len(stack), name
            if marked == _LIKELY:
                back = m.start()
                likely.append((back, 0, dropped_at))
            push(name)
            continue
        links += name == "a"
        if name in ("article", "main"):
            gap()
            articles += 1
            if articles == 1:
                tops.append(len(inside))
        if name in _NESTS:
            push(name)
    close_block()
    if any(size for _, size in inside):
        bounds = [*tops, len(inside)] if len(tops) % 2 else tops
        sums = [sum(size for _, size in inside[a:z]) for a, z in zip(bounds[::2], bounds[1::2], strict=True)]
        for a, z, total in zip(bounds[::2], bounds[1::2], sums, strict=True):
            if total * TEASER < max(sums):
                inside[a:z] = [("", 0)] * (z - a)
        return inside, True
    return outside, False


def main_text(html: str | None) -> str:
    """The page's main text: its blocks between surges and dives, one per line."""
    if not html:
        return ""
    rows, article = lines(html)
    sizes = [0] * (WINDOW - 1) + [size for _, size in rows] + [0] * (WINDOW - 1)
    window = sum(sizes[:WINDOW])
    segments: list[tuple[int, int, list[str]]] = []  # highest window, characters, blocks
    high = total = 0
    held: list[str] = []
    for i in range(len(sizes) - WINDOW + 1):
        if i:
            window += sizes[i + WINDOW - 1] - sizes[i - 1]
        if window:  # between a surge and a dive; the window's last line has just come in
            line = rows[i][0] if i < len(rows) else ""
            if line:
                held.append(line)
                total += len(line)
            high = max(high, window)
        elif held:
            segments.append((high, total, held))
            high, total, held = 0, 0, []
    if held:
        segments.append((high, total, held))
    if not segments:
        return ""
    surged = [i for i, s in enumerate(segments) if s[0] >= SURGE]
    if surged:
        kept = segments[max(0, surged[0] - 1) : surged[-1] + 2]
    else:
        kept = segments if article else [max(segments, key=lambda s: s[1])]
    blocks = [x for _, _, blocks in kept for x in blocks]
    while not article and len(blocks) > 1 and _COPYRIGHT.fullmatch(blocks[-1]):
        blocks.pop()
    return "\n".join(blocks)


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every page row."""

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for html in batches:
            yield pd.Series([main_text(x) for x in html], dtype=object)

    text = pages.select("page_id", "url", extract(F.col("html")).alias("text"))
    return text.withColumn("n_chars", F.length("text").cast("long"))

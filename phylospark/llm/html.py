"""Main text of web pages by line-block distribution.

Markup is stripped to lines: each start and end of a block element ends one, so that there are empty
lines where blocks end together.  The lengths of the lines' text outside of links are summed over
sliding windows: where the sum surges a block of text begins, where it dives to nothing it ends.  The
fullest block is the main text, with others that come near it; lines that the page itself marks as
furniture have no length, and a marked article only says which lesser blocks belong to the fullest one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .common import runs_of, small_batches

_BATCH_BYTES = 4 << 20
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_RAW = frozenset("script style noscript template textarea iframe svg math object canvas audio video head title".split())
_FURNITURE = frozenset("nav header footer aside form button select menu dialog fieldset input label".split())
_HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
#: words of class, id or role that mark page furniture
_MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus "
    "footer header login masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo promoted promotion related reply replies "
    "respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget alert dialog complementary contentinfo".split()
)
_WORD = re.compile(r"[a-z]+")
#: white space that browsers and readers see as such
_SPACE = re.compile(r"\s+")


def _is_furniture(name: str, attrs: str) -> bool:
    if name in _FURNITURE:
        return True
    if not attrs or name in ("html", "body"):
        return False
    for key, value in _ATTR.findall(attrs):
        key = key.lower()
        if key == "hidden" or key == "aria-hidden" and "true" in value.lower():
            return True
        if key in ("class", "id", "role") and not _MARKS.isdisjoint(_WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())):
            return True
    return False


class Line(NamedTuple):
    """A line: its text, characters outside of links, number of the enclosing article (0: none), furniture or not."""

    text: str
    length: int
    article: int
    furniture: bool


def lines_of(page: str) -> list[Line]:
    """Lines of a page in order, empty ones too."""
    lines: list[Line] = []
    parts: list[str] = []
    linked: list[str] = []
    skip, depth, article, articles, inside, headline, link = "", 0, 0, 0, 0, False, False
    at, n, low = 0, len(page), None

    def said(texts: list[str]) -> str:
        return _SPACE.sub(" ", unescape("".join(texts))).strip()

    def flush() -> None:
        text = said(parts)
        lines.append(Line(text, len(text) - len(said(linked)) if text else 0, article if inside else 0, bool(skip) and not headline))
        parts.clear()
        linked.clear()

    def add(text: str) -> None:
        parts.append(text)
        if link:
            linked.append(text)

    while at < n:
        m = _TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attrs = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name == "a":
            link = not closing
        if not closing and name in _RAW and not attrs.endswith("/"):
            flush()
            low = low if low is not None else page.lower()
            if name == "head":  # up to the end of the head, or the body where that is missing
                ends = [e for e in (low.find("</head", at), low.find("<body", at)) if e >= 0]
                end = min(ends, default=-1)
                at = end if end >= 0 else at
                continue
            end = low.find(f"</{name}", at)
            if end < 0:
                at = n if name in ("script", "style") else at
                continue
            at = low.find(">", end) + 1 or n
            continue
        if skip == "header" and inside and name in _HEADS:  # an article's headline is its text
            flush()
            headline = not closing
            continue
        if skip:
            if name == skip and name not in _VOID:
                depth += -1 if closing else 1
                if not depth:
                    flush()
                    skip, headline = "", False
                    continue
            elif closing and name in ("article", "main", "body", "html"):  # furniture that was never closed
                flush()
                skip, depth, headline = "", 0, False
        elif not closing and name not in _VOID and _is_furniture(name, attrs):
            flush()
            skip, depth = name, 1
            continue
        if name in _BLOCK:
            flush()
        if name in ("article", "main") and not skip:
            if closing:
                inside = max(0, inside - 1)
            else:
                inside += 1
                if inside == 1:
                    articles += 1
                    article = articles
    flush()
    return lines


def blocks(lengths: np.ndarray, window: int = 2) -> list[tuple[int, int, int]]:
    """First and last line (exclusive) and characters of each block: what lies between a surge of the window sums
    from nothing and the dive to nothing."""
    if not len(lengths):
        return []
    sums = np.convolve(lengths, np.ones(window, int), "full")  # sums[i]: lines i-window+1 .. i
    begins, ends = runs_of(sums > 0)
    upto = np.concatenate(([0], np.cumsum(lengths)))
    out = []
    for begin, end in zip(begins.tolist(), ends.tolist()):  # its lines are those with a length
        some = begin + np.flatnonzero(lengths[begin : min(end, len(lengths))])
        out.append((int(some[0]), int(some[-1]) + 1, int(upto[some[-1] + 1] - upto[some[0]])))
    return out


def main_text(page: str | None, window: int = 2, near: float = 0.3) -> str:
    """Main text of one page: lines in page order, joined by one space.

    Of the :func:`blocks` between surges and dives the fullest one is kept (the first of equals), and those
    that have at least the share ``near`` of its characters.  If the fullest block is in a marked article, that
    article's other lines are kept, and blocks outside of it are not.  Furniture that the page marks (its lines
    have no length) is left out everywhere.  A page whose text is all in links is taken whole.  No page,
    or one without text, gives an empty text; pages of any length are read whole.
    """
    lines = lines_of(page or "")
    lengths = np.array([0 if x.furniture else x.length for x in lines])
    if not lengths.any():
        lengths = np.array([0 if x.furniture else len(x.text) for x in lines])
    found = blocks(lengths, window)
    if not found:
        return ""
    most = max(n for _, _, n in found)
    first, last = next((a, b) for a, b, n in found if n == most)
    own: dict[int, int] = {}
    for x in lines[first:last]:
        own[x.article] = own.get(x.article, 0) + (0 if x.furniture else x.length)
    article = max(own, key=lambda k: (own[k], -k))
    if article:
        kept = [x for x in lines if x.article == article]
    else:
        kept = [x for a, b, n in found if n >= near * most for x in lines[a:b] if not x.article]
    return " ".join(x.text for x in kept if x.text and not x.furniture)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` without ``html`` and with ``text``, each page's main text (null page: empty).

    Rows stay as they are, repeated ones too; a column that is named like ``text`` is replaced.
    """
    kept = pages.drop(*[c for c in pages.columns if c == text and c != html])
    rest = [c for c in kept.columns if c != html]
    schema = StructType([kept.schema[c] for c in rest]).add(text, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, html, _BATCH_BYTES):
            found = [main_text(p) for p in batch.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(found, pa.string())], names=[*rest, text])

    return kept.mapInArrow(run, schema)

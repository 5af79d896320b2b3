"""Main text of web pages: the region of highest score, found by one scan.

A page is read as a row of texts and tags. Words score by where they stand (in a link or
not; inside an article or main element, outside of one, or on a page without any), tags by
their name. The weights are log odds of standing in the content, learned from the
labelled pages of ``page_labels``: words in running text come out positive, tags are kept
below zero. A linear scan finds the contiguous run with the greatest sum, which then is
widened to whole blocks. Elements that hold no content by their kind (scripts, menus,
forms, adverts, comments of readers and the like) are left out of the scan and the text,
unless the page's article or main element is in them. What a class or id says in part only
lowers the weight of all in the element.

Each page is a row of its own: no shuffle, and memory for one page at a time beside
Spark's batches.

Defined results for odd input: a null or empty page has an empty text, and so has one
without any word in running text; unclosed elements end with their parents, and a tag cut
off at the end of the page is dropped; of regions with equal sums the first counts. Equal
rows get equal results. Other columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame

from chorale.llm.page_labels import PAGES
from chorale.session import ship_package

# Elements by kind.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template", "svg", "math"}
DRAWN = {"svg", "math"}
DROPPED = RAW | {
    "head", "nav", "footer", "aside", "form", "button", "select", "input", "menu", "dialog", "object",
    "audio", "video", "canvas", "map", "fieldset", "option", "datalist", "header",
}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "div",
    "dl", "dt", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
    "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td",
    "tfoot", "th", "thead", "tr", "ul",
}
#: An opening tag of the key ends an open element of these names right above it.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
# Words in class, id and role that say what an element is for.
KINDS = {
    "ad", "ads", "advert", "advertisement", "adverts", "advertising", "alert", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies",
    "dialog", "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar",
    "navigation", "newsletter", "notice", "notices", "notification", "overlay", "pager", "pagination",
    "popup", "promo", "promotion", "related", "recommended", "replies", "reply", "respond", "search",
    "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe",
    "subscription", "toc", "toolbar", "topbar", "widget", "header",
}
# Words that go with a kind and leave it one (``ad-slot``, ``nav-left``).
FRAMES = {
    "area", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "col", "column", "container",
    "content", "desktop", "fixed", "floating", "form", "global", "group", "holder", "icon", "icons", "inline",
    "inner", "item", "items", "large", "left", "link", "links", "list", "main", "media", "mobile", "outer", "page",
    "panel", "primary", "right", "row", "secondary", "section", "site", "slot", "small", "space", "sticky", "text",
    "title", "top", "unit", "wide", "wrap", "wrapper", "zone",
}
CONTENT = {"article", "main"}
# Elements whose id may be an anchor to their text, and those that part content.
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SECTIONS = {"section", "div", "p", "li", "dt", "dd", "td", "th", "tr", "a", "span", "figure", "blockquote", "pre", "table"}
#: What elements count whose class or id says in part what they are for.
LOWERED = 0.1
OWN_HEADER = {"article", "content", "entry", "post", "story"}

_TAG = re.compile(
    r"<!--(?P<note>.*?)(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z](?:[^>]*>|[^>]*\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_NONE = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_CAMEL = re.compile(r"([a-z])([A-Z])")
_PARTS = re.compile(r"[a-z]+")


@dataclass
class Piece:
    """A text or a tag outside of dropped elements. ``kind`` is what its weight goes by."""

    kind: str
    text: str = ""
    block: bool = False
    labelled: bool = False
    share: float = 1.0


def _attributes(rest: str) -> dict[str, str]:
    """The first value of each attribute, by its name in lower case."""
    found: dict[str, str] = {}
    for match in _ATTRIBUTE.finditer(rest):
        found.setdefault(match[1].lower(), (match[2] or "").strip("\"'"))
    return found


def _kind(name: str, rest: str, inside: bool) -> str:
    """``dropped`` for what is no content by its class, id or role, or hidden; ``lowered``
    where a part of these says so; else empty.

    A class or id is of a kind if that is its first word and all others are kinds or frames of
    one: ``ad-slot`` is an advert, ``has-sidebar`` no sidebar, and ``share-price`` is about
    prices. In content, an id is an anchor unless it is a kind.
    """
    found = _attributes(rest)
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _NONE.search(found.get("style", "")):
        return "dropped"
    lowered = False
    for key in ("class", "id", "role"):
        tokens = [_PARTS.findall(_CAMEL.sub(r"\1 \2", t).lower()) for t in found.get(key, "").split()]
        own_header = inside or any(OWN_HEADER.intersection(t) for t in tokens)
        for token in tokens:
            kinds = KINDS.intersection(token)
            if not kinds or (kinds == {"header"} and own_header):
                continue
            anchor = key == "id" and (name in HEADINGS or name == "section" and inside)
            anchor = anchor or (key == "id" and name in SECTIONS and inside and len(token) > 1)
            if anchor:
                continue
            own = token[0] == "header" and own_header
            if token[0] in KINDS and not own and all(t in KINDS or t in FRAMES for t in token):
                return "dropped"
            lowered = True
    return "lowered" if lowered else ""


def _is_dropped(name: str, inside: bool) -> bool:
    return name in DROPPED and not (name == "header" and inside)


class _Open:
    """The open elements, and how many of each name there are."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.count: Counter[str] = Counter()

    def push(self, name: str) -> None:
        self.names.append(name)
        self.count[name] += 1

    def pop(self) -> str:
        name = self.names.pop()
        self.count[name] -= 1
        return name

    def close(self, name: str) -> None:
        """Ends the innermost element of that name and all inside it."""
        if self.count[name]:
            while self.pop() != name:
                pass

    def in_content(self) -> bool:
        return any(self.count[x] for x in CONTENT)


def _implied(stack: _Open, name: str) -> None:
    """Ends the elements that an opening tag of ``name`` ends."""
    if name == "a":
        stack.close("a")
    while stack.names and (
        stack.names[-1] in ENDS.get(name, ()) or (name in BLOCKS and stack.names[-1] == "p")
    ):
        stack.pop()


def _after_raw(page: str, name: str, rest: str, at: int) -> int:
    """Where a raw element whose tag ends at ``at`` ends.

    Drawings and formulas that close themselves, or never close, end at once. Others that
    close themselves do so unless an end tag follows before another one opens.
    """
    again = re.compile(rf"<(/?){re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE)
    closed = rest.endswith("/")
    if closed:
        following = again.search(page, at)
        return following.end() if following and following[1] and name not in DRAWN else at
    end = next((m for m in again.finditer(page, at) if m[1]), None)
    return end.end() if end else at if name in DRAWN else len(page)


def _with_content(page: str) -> dict[int, bool]:
    """The places of the tags that open an element with an article or main element in it, and
    whether all of the page's are in it. Articles of a kind, such as comments, don't count."""
    stack = _Open()
    opened: list[tuple[int, int]] = []  # place, and contents before it
    found: dict[int, int] = {}
    contents = 0
    at = 0

    def cut() -> None:
        while len(opened) > len(stack.names):
            place, before = opened.pop()
            if contents > before:
                found[place] = contents - before

    while match := _TAG.search(page, at):
        at = match.end()
        if not match["name"]:
            continue
        name, rest = match["name"].lower(), match["rest"] or ""
        if match["end"]:
            stack.close(name)
            cut()
            continue
        if name in RAW:
            at = _after_raw(page, name, rest, at)
            continue
        _implied(stack, name)
        cut()
        if name not in VOID and not rest.endswith("/"):
            stack.push(name)
            opened.append((match.start(), contents + 1 if name in CONTENT else contents))
            if name == "main" or (name == "article" and _kind(name, rest, False) != "dropped"):
                contents += 1
    stack.names.clear()
    cut()
    return {place: n == contents for place, n in found.items()}


def pieces(page: str) -> list[Piece]:
    """The page's texts and tags in order, without those of dropped elements."""
    with_content = _with_content(page)
    shares: list[tuple[int, float]] = []  # open elements whose parts count less, by depth
    out: list[Piece] = []
    stack = _Open()
    dropped_at: int | None = None
    labelled = False
    at = 0

    def text(value: str) -> None:
        if value and dropped_at is None:
            place = "in" if stack.in_content() else "out"
            kind = f"{place}/{'link' if stack.count['a'] else 'text'}"
            out.append(Piece(kind, html.unescape(value), labelled=labelled, share=share()))

    def share() -> float:
        while shares and len(stack.names) <= shares[-1][0]:
            shares.pop()
        return shares[-1][1] if shares else 1.0

    while match := _TAG.search(page, at):
        text(page[at : match.start()])
        at = match.end()
        if match["note"] in ("[", "]"):
            labelled = match["note"] == "["
        if not match["name"]:
            continue
        name, rest = match["name"].lower(), match["rest"] or ""
        if match["end"]:
            stack.close(name)
            if dropped_at is not None and len(stack.names) <= dropped_at:
                dropped_at = None
            elif dropped_at is None:
                out.append(Piece(f"/{name}", block=name in BLOCKS, labelled=labelled, share=share()))
            continue
        if name in RAW:
            at = _after_raw(page, name, rest, at)
            if dropped_at is None:
                out.append(Piece("dropped", labelled=labelled, share=share()))
            continue
        _implied(stack, name)
        if dropped_at is not None and len(stack.names) <= dropped_at:
            dropped_at = None
        drops = lowers = False
        if dropped_at is None:
            share()  # forgets what has ended
            inside = stack.in_content()
            by_name = _is_dropped(name, inside)
            kind = _kind(name, rest, inside) if rest and name not in ("html", "body", "article", "main") else ""
            all_content = with_content.get(match.start())
            # Asides and the like may show other articles; only those of the page save them.
            drops = (by_name and not all_content) or (kind == "dropped" and all_content is None)
            lowers = not drops and (by_name or (kind == "dropped") or (kind == "lowered" and all_content is None))
        share_here = share()
        if drops:
            out.append(Piece("dropped", block=name in BLOCKS, labelled=labelled, share=share()))
            if name not in VOID:
                dropped_at = len(stack.names)
        elif dropped_at is None:
            if name == "br":
                text(" ")
            out.append(Piece(name, block=name in BLOCKS, labelled=labelled, share=share_here))
        if name not in VOID and not rest.endswith("/"):
            if lowers:
                shares.append((len(stack.names), LOWERED))
            stack.push(name)
        elif dropped_at == len(stack.names):
            dropped_at = None
    text(page[at:])
    if not any(p.kind in CONTENT for p in out):
        for piece in out:
            piece.kind = piece.kind.replace("out/", "none/")
    return out


@cache
def weights() -> dict[str, float]:
    """Log odds of the labelled pages' words and tags; words of running text in content are
    above zero, tags below. Kinds that no labelled page has get the mean weight of tags."""
    inside: Counter[str] = Counter()
    outside: Counter[str] = Counter()
    for page in PAGES:
        for piece in pieces(page):
            n = len(piece.text.split()) if "/" in piece.kind[1:] else 1
            (inside if piece.labelled else outside)[piece.kind] += n
    kinds = set(inside) | set(outside)
    total_in, total_out = sum(inside.values()), sum(outside.values())
    found = {}
    for kind in kinds:
        odds = math.log((inside[kind] + 1) / (total_in + len(kinds)))
        odds -= math.log((outside[kind] + 1) / (total_out + len(kinds)))
        is_word = "/" in kind[1:]
        found[kind] = odds if is_word else min(odds, -0.05)
    for kind in ("in/text", "none/text"):
        found[kind] = max(found.get(kind, 0.0), 0.5)
    tags = [w for k, w in found.items() if "/" not in k[1:]]
    # What is dropped leaves no text behind, so crossing it costs no more than a tag of text.
    return found | {"dropped": -0.05, "": sum(tags) / len(tags)}


def best_region(scores: list[float]) -> tuple[int, int]:
    """The run with the greatest sum above zero, as (first, past the last)."""
    best, begin, end = 0.0, 0, 0
    total, start = 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, begin, end = total, start, k + 1
    return begin, end


def main_text(page: str | None) -> str:
    """The page's content: blocks with single spaces, joined by empty lines."""
    found = pieces(page or "")
    weight = weights()
    scores = [
        p.share * weight.get(p.kind, weight[""]) * (len(p.text.split()) if "/" in p.kind[1:] else 1)
        for p in found
    ]
    begin, end = best_region(scores)
    if begin == end:
        return ""
    while begin > 0 and not found[begin - 1].block:
        begin -= 1
    while end < len(found) and not found[end].block:
        end += 1
    blocks, current = [], []
    for piece in found[begin:end]:
        if piece.block:
            blocks.append("".join(current))
            current = []
        current.append(piece.text)
    blocks.append("".join(current))
    return "\n\n".join(b for b in (" ".join(block.split()) for block in blocks) if b)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    ship_package(pages.sparkSession)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(page) for page in batch["html"]]
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"],
                    "url": batch["url"],
                    "text": texts,
                    "n_chars": [len(t) for t in texts],
                }
            )

    id_type = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInPandas(
        extract, f"page_id {id_type}, url string, text string, n_chars long"
    )

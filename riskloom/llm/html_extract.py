"""Main text of web pages by line-block distribution.

Markup is stripped to a list of lines, one per block element, with empty lines where containers
begin or end and where stripped parts (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, reader comments) stood. Text lengths are summed over sliding windows of `WINDOW`
lines, links not counted. Text surges where a window's sum reaches the threshold and dives where
the windows have run empty; the lines between are kept. Pages with `article` or `main` bound the
lines by it, and any text in it counts as a surge.

One pass over the rows, whole pages, no shuffle. Defined results: a null or empty page has an empty
text. Broken markup (elements never closed, tags left out) ends where the page or the next such
element begins, never in lost text. A form, or an element whose class, id or role names it as boilerplate,
stays where it holds nearly all text of the page; a compound name counts by its last words
(`related-work` and `with-sidebar` name no boilerplate). Quoted attribute values may have any length.
Repeated rows stay; other columns stay, a column with a new column's name is replaced.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from .arrow import add_columns

WINDOW = 3
#: Window sum at which text surges, for pages without `article` or `main`.
SURGE = 80
#: Share of the page's other text that an `article` or `main` must hold to bound it.
CONTAINER_SHARE = 0.2

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
    r"((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^<>])*+)>|<[!?][^<>]*>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

#: Fixed element names.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "canvas"}
DROPPED = RAW | {
    "head", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "audio", "video", "datalist",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CONTAINERS = {"article", "main"}
BLOCKS = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hgroup", "hr", "html", "legend", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody",
    "tfoot", "thead", "tr", "ul", "aside", "option", "title",
}
#: Blocks whose edges set parts of a page apart.
PARTS_OF_PAGE = {"article", "body", "div", "footer", "header", "main", "nav", "section", "table", "aside", "form"}
SPACES = {"br", "td", "th", "img", "input"}

#: Fixed words of class names, ids and roles that mark what is not the article.
DROPPED_WORDS = set(
    """
    ad ads adv advert advertisement advertising adsense adslot banner breadcrumb breadcrumbs comment comments
    complementary consent contentinfo cookie cookies copyright disqus footer gdpr masthead menu modal nav navbar
    navigation newsletter notice notices overlay pager pagination popup promo promoted related recommended
    recommendations reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe
    subscription teaser toolbar widget widgets login alert disclaimer discussion dialog
    """.split()
)
PAGE_WORDS = DROPPED_WORDS | {"header"}
#: Fixed words that may follow one of these in a name and leave its sense: `ad-slot`, `sidebar-left`, not `related-work`.
NEUTRAL = set(
    """
    area articles bar block body bottom box btn button buttons center column container content count desktop dismiss
    expanded fixed float footer form group header heading holder icon icons inline inner item items label large left
    line link links list main message mobile module more outer page pages panel policy post posts primary region right
    root row secondary section site slot small sticky stories strip stub text thread title to toggle top unit wrap
    wrapper zone
    """.split()
)
#: Words before one of these that say what a part of the page has, not what it is: `with-sidebar`.
HAVING = {"with", "has", "no", "without", "non"}
#: Share of the page's text from which a form, or a part so named, is the page itself.
WHOLE_SHARE = 0.9
COMMENT_NAMES = {"comment", "comments", "reply", "teaser", "ad", "advert", "promo", "user-comment", "reader-comment"}


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in ATTRIBUTE.finditer(text)}


def _marks(names: str, marked: set[str]) -> bool:
    """Whether a class name, id or role means one of the marked words."""
    for one in names.split():
        parts = [w.lower() for w in PARTS.findall(one)]
        at = max((i for i, w in enumerate(parts) if w in marked), default=-1)
        if at < 0 or not HAVING.isdisjoint(parts[:at]):
            continue
        if all(w in NEUTRAL or w.isdigit() or len(w) == 1 for w in parts[at + 1 :]):
            return True
    return False


def _dropped(name: str, attributes: str, inside: bool) -> str:
    """Why an element is not part of the article, "" if it is; `inside`: it stands in `article` or `main`.

    "named" ones, and forms, are so by their name alone, and stay where they hold nearly the whole page.
    """
    if name in DROPPED or (name == "header" and not inside):
        return "named" if name == "form" else "element"
    if name in ("html", "body", "main") or not attributes:
        return ""
    of = _attributes(attributes)
    if not of:
        return ""
    if "hidden" in of or of.get("aria-hidden", "").lower() == "true":
        return "hidden"
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", of.get("style", ""), re.I):
        return "hidden"
    if of.get("role", "").lower() in ("navigation", "banner", "search", "alert", "dialog", "form", "menu"):
        return "" if inside and of["role"].lower() == "banner" else "named"
    names = f"{of.get('class', '')} {of.get('id', '')} {of.get('role', '')}"
    if name in CONTAINERS:
        return "" if COMMENT_NAMES.isdisjoint(names.lower().split()) else "named"
    return "named" if _marks(names, DROPPED_WORDS if inside else PAGE_WORDS) else ""


def lines_of(page: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Lines of a page, their lengths without links, and whether each stands in `article` or `main`."""
    tokens, at, low = [], 0, None
    while found := TOKEN.search(page, at):
        at = found.end()
        name = (found[2] or "").lower()
        tokens.append((found.start(), at, name, bool(found[1]), found[3] or ""))
        if name in RAW and not found[1] and not (found[3] or "").endswith("/"):
            low = page.lower() if low is None else low
            if len(low) == len(page) and (stop := low.find(f"</{name}", at)) >= 0:
                at = stop
    # where each element ends: the matching tag, or nowhere
    ends, opened, containers = {}, {}, []
    for i, (_, _, name, closing, rest) in enumerate(tokens):
        if not name or name in VOID or rest.endswith("/"):
            continue
        if not closing:
            opened.setdefault(name, []).append(i)
        elif opened.get(name):
            ends[opened[name].pop()] = i
    for name in CONTAINERS:
        for i in opened.get(name, ()):
            ends[i] = len(tokens)
        containers += [i for i, t in enumerate(tokens) if t[2] == name and not t[3]]
    containers.sort()

    texts: list[int] = []

    def whole(first, last):
        """Whether these elements hold nearly all text of the page; sizes are taken once, when first asked."""
        if not texts:
            texts.append(0)
            for (_, end, name, closing, _), after in zip(tokens, [*tokens[1:], (len(page),)]):
                size = 0 if not closing and name in DROPPED - {"form"} else len(page[end : after[0]].strip())
                texts.append(texts[-1] + size)
        return texts[last] - texts[first] >= WHOLE_SHARE * texts[-1]

    lines, plain, within = [], [], []
    words, count = [], 0

    def close(bounded):
        nonlocal words, count
        line = " ".join(entities.unescape("".join(words)).split())
        if line:
            lines.append(line)
            plain.append(count)
            within.append(bounded)
        words, count = [], 0

    def gap():
        lines.append("")
        plain.append(0)
        within.append(False)

    skip_to, bound_to, links, last = -1, -1, 0, 0
    for i in range(len(tokens) + 1):
        start, end, name, closing, rest = tokens[i] if i < len(tokens) else (len(page), len(page), "html", True, "")
        inside = i <= bound_to
        if i > skip_to and start > last:
            text = page[last:start]
            words.append(text)
            if not links:
                count += len(text.strip())
        last = end
        if i <= skip_to:
            if i == skip_to:
                gap()
            continue
        why = _dropped(name, rest, inside) if not closing and name not in VOID and i in ends else ""
        if why and not (why == "named" and whole(i, ends[i])):
            after = bisect_left(containers, i + 1)
            holds = after < len(containers) and containers[after] < ends[i]
            if name in RAW or not holds or name in CONTAINERS:
                if name in BLOCKS or name in DROPPED - {"button", "select"}:
                    close(inside)
                    gap()
                skip_to = ends[i]
                continue
        if name == "a":
            links = max(0, links + (-1 if closing else 1))
        if name in SPACES:
            words.append(" ")
        elif name in BLOCKS:
            close(inside)
            links = 0
            if name in PARTS_OF_PAGE:
                gap()
        if name in CONTAINERS and not closing and i in ends:
            bound_to = max(bound_to, ends[i])
    close(False)
    return lines, np.array(plain, dtype=np.int64), np.array(within, dtype=bool)


def kept_lines(lengths: np.ndarray, surge: int, window: int = WINDOW) -> np.ndarray:
    """Which lines stand between a surge and the dive after it."""
    n = len(lengths)
    kept = np.zeros(n, dtype=bool)
    if not n:
        return kept
    sums = np.concatenate([[0], np.cumsum(lengths)])
    windows = sums[np.minimum(np.arange(n) + window, n)] - sums[:n]
    at = 0
    while at < n:
        rising = np.flatnonzero(windows[at:] >= surge)
        if not len(rising):
            break
        first = at + int(rising[0])
        empty = np.flatnonzero(windows[first:] == 0)
        dive = first + int(empty[0]) if len(empty) else n
        kept[first:dive] = True
        at = dive + 1
    return kept


def extract(page: str | None) -> str:
    """The article of one page, its blocks one per line."""
    if not page:
        return ""
    lines, lengths, within = lines_of(page)
    whole = np.array([len(x) for x in lines], dtype=np.int64)
    if within.any() and whole[within].sum() >= CONTAINER_SHARE * whole[~within].sum():
        # a window looks ahead of the container
        kept = kept_lines(np.where(within, whole, 0), 1) & within
    else:
        kept = kept_lines(lengths, SURGE)
        if not kept.any():  # nowhere enough text in a row: all that is not stripped
            kept = kept_lines(lengths, 1)
    return "\n".join(line for line, k in zip(lines, kept) if k and line)


def main_text(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """Add the article of every page."""

    def make():
        return lambda batch: [pa.array([extract(h) for h in batch.column(html).to_pylist()], pa.string())]

    return add_columns(pages, [StructField(text, StringType())], make)


def digest(pages: DataFrame) -> DataFrame:
    """The contract's columns."""
    return main_text(pages.select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )

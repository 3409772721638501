"""Main text of web pages by line-block distribution.

Markup is stripped to one line per block element; lines of menus, forms,
adverts and the like are blank, and if a page marks its article, so are lines outside of it.
The text lengths of every few lines in a row are summed. Where that sum leaves nothing
the text surges, where it falls to nothing the text dives, and what lies between is kept.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renown.llm.frames import text_of

WINDOW = 3
#: Characters in a window from which text surges, on pages that mark no article.
SURGE = 60

_RAW = "script|style|noscript|template|textarea|title|svg|math|iframe|object|select|button"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    rf"|<(?P<raw>{_RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-z][^>]*>",
    re.S | re.I,
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hr html li main nav ol p pre section summary table tbody tfoot"
    " thead tr ul".split()
)
SPACES = frozenset("br td th wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNWANTED = frozenset("nav footer aside form head dialog menu".split())
NAMED = re.compile(
    r"(?<![a-z])(?:ads?|adverts?|advertisement|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|"
    r"masthead|menu|modal|nav|navbar|navigation|newsletter|notice|popup|promo|related|respond|share|sharing|"
    r"sidebar|sponsor|sponsored|social|subscribe|toolbar|widget)(?![a-z])",
    re.I,
)
LABELS = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)


def _unwanted(name: str, attributes: str, in_article: bool) -> bool:
    if name in UNWANTED or name == "header" and not in_article:
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return bool(attributes and name == "article" and re.search("comment", attributes, re.I))
    return any(map(NAMED.search, LABELS.findall(attributes))) or bool(HIDDEN.search(attributes))


def _closings(tags: list[tuple[int, str, bool]]) -> dict[int, int]:
    """For each opening tag the place of the tag that closes it, where there is one."""
    open_at: dict[str, list[int]] = {}
    closed = {}
    for at, name, closing in tags:
        if closing:
            if open_at.get(name):
                closed[open_at[name].pop()] = at
        elif name not in VOID:
            open_at.setdefault(name, []).append(at)
    return closed


def lines_of(page: str) -> tuple[list[tuple[str, int, str]], set[str]]:
    """Lines as text, length of what is no link, and the container (article, main or none); the containers seen."""
    found = list(TOKEN.finditer(page))
    tags = [(i, m["name"].lower(), bool(m["close"])) for i, m in enumerate(found) if m["name"]]
    closed = _closings(tags)
    lines: list[tuple[str, int, str]] = []
    held: list[str] = []
    plain, link, at, skip_to = 0, 0, 0, -1
    inside = {"article": 0, "main": 0}

    def end_line():
        nonlocal plain
        text = " ".join("".join(held).split())
        place = "article" if inside["article"] else "main" if inside["main"] else ""
        lines.append((text, min(plain, len(text)), place))
        held.clear()
        plain = 0

    seen = set()
    for i, m in enumerate(found):
        if i > skip_to and m.start() > at:
            text = html.unescape(page[at : m.start()])
            held.append(text)
            plain += 0 if link else len(text.strip())
        at = m.end()
        if i <= skip_to or not m["name"]:
            continue
        name, closing = m["name"].lower(), bool(m["close"])
        if name in BLOCKS:
            end_line()
        elif name in SPACES:
            held.append(" ")
        if name == "a":
            link = int(not closing)
        if not closing and i in closed and _unwanted(name, m["attributes"], bool(inside["article"])):
            end_line()
            lines.append(("", 0, ""))
            skip_to, link = closed[i], 0
        elif name in inside:
            inside[name] = max(0, inside[name] + (-1 if closing else 1))
            seen |= {name}
    if at < len(page):
        held.append(html.unescape(page[at:]))
        plain += len(page) - at
    end_line()
    return lines, seen


def main_text(page: str | None, window: int = WINDOW, surge: int = SURGE) -> str:
    """The kept lines of a page, blank lines between them; empty for null, empty and textless pages."""
    if not page:
        return ""
    lines, seen = lines_of(page)
    marked = next((c for c in ("article", "main") if any(p == c and t for t, _, p in lines)), None)
    if marked:
        # a mark says where text is: any of it surges
        places = ("article",) if marked == "article" else ("article", "main")
        lines = [(t, len(t)) if p in places else ("", 0) for t, _, p in lines]
        surge = 1
    else:
        lines = [(t, n) for t, n, _ in lines]
    size = [n for _, n in lines]
    total, sums = sum(size[: window - 1]), []
    for i in range(len(size)):
        total += size[i + window - 1] if i + window - 1 < len(size) else 0
        sums.append(total)
        total -= size[i]
    least = min(surge, max(sums, default=0))
    kept, i = [], 0
    while i < len(sums):
        if not sums[i] or not size[i]:
            i += 1
            continue
        j = i
        while j < len(sums) and sums[j]:
            j += 1
        if max(sums[i:j]) >= least:
            kept += [t for t, _ in lines[i:j] if t]
        i = j
    return "\n\n".join(kept)


def extract(pages: DataFrame, html_col: str = "html", window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """All rows and columns of ``pages`` with a new last column ``main_text``.

    Null and empty pages have an empty text; rows stay as they are, repeated or
    with nulls; a column of that name is replaced; an empty table gives none.
    """

    @F.pandas_udf("string")
    def texts(column):
        return column.map(lambda page: main_text(page, window, surge))

    return pages.withColumn("main_text", texts(text_of(html_col)))

"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped to lines, one per block element, without menus, footers, adverts and
the like that are known by element or by name. A line weighs the characters of its text
outside links; where a page marks articles, their lines weigh a surge more and others a
quarter. The weights are summed over a sliding window of lines: a text begins at a surge
of the sums and ends where they dive or a marked article begins or ends, and all lines
between are kept, whatever their links.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from bazaarlake.llm.common import text_slices, texts_of

# Lines a window spans, and the least sum that counts as text.
WINDOW = 3
SURGE = 80
# What a line outside the marked articles of a page weighs less.
OUTSIDE = 4

# Elements by what they mean for the text.
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "object", "svg", "math",
       "canvas", "audio", "video", "select", "title")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data dfn del em font i img ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup td th time tt u var wbr".split()
)
# Elements without an end tag, by what closes them.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES = {
    "p": frozenset(("p",)), "li": frozenset(("p", "li")), "option": frozenset(("option",)),
    "tr": frozenset(("p", "tr")), **dict.fromkeys(("dt", "dd"), frozenset(("p", "dt", "dd"))),
    **dict.fromkeys(HEADINGS, HEADINGS | {"p"}),
}
BOILERPLATE = frozenset("head nav aside footer form button menu dialog fieldset".split())
ARTICLE = frozenset(("article", "main"))
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs "
    "comment comments commentlist respond replies reply disqus cookie cookies consent gdpr notice "
    "notices alert popup modal overlay menu menus nav navbar navigation pagination pager sidebar "
    "sidebars widget widgets related recommended sponsor sponsored sponsors promo promotion share "
    "sharing social newsletter subscribe signup login toolbar skip copyright".split()
)
# Those that an article may hold without being part of its text: adverts and comments.
INNER_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox sponsor sponsored sponsors promo "
    "comment comments commentlist disqus".split()
)
# More names that mean boilerplate around an article.
OUTER_NAMES = frozenset("header footer masthead topbar".split())
# Words beside a name that leave its meaning: a class or an id counts as a whole.
FILLERS = frozenset(
    "box bar list wrapper wrap container section area block left right top bottom primary secondary "
    "main site page post posts item items link links button buttons icons inner outer has".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert dialog menu menubar".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-z][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Line(NamedTuple):
    text: str
    weight: int  # characters outside links
    article: int  # number of the marked article it lies in; 0 for none


class _Open(NamedTuple):
    tag: str
    boilerplate: bool
    article: int


def _boilerplate(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in BOILERPLATE or (tag == "header" and not in_article):
        return True
    if tag in ("html", "body") or not attrs:
        return False
    for name, value in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
        elif name == "role":
            if value.lower() in ROLES:
                return True
        elif tag not in ARTICLE or not in_article:
            known = INNER_NAMES if in_article else NAMES | OUTER_NAMES
            for token in value.split():
                words = {word.lower() for word in _NAME.findall(token)}
                if words & known and words <= known | FILLERS:
                    return True
    return False


def lines_of(page: str) -> list[Line]:
    """The page's text by blocks, in page order, without empty and boilerplate ones."""
    lines: list[Line] = []
    stack: list[_Open] = []
    # How many of each element are open: an end tag without any looks no further.
    opened: Counter[str] = Counter()
    parts: list[str] = []
    articles = link = linked = 0

    def close_line() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            top = stack[-1] if stack else _Open("", False, 0)
            if not top.boilerplate:
                # A line of an article may be a link.
                counts = len(text) if top.article else len(text) - linked
                lines.append(Line(text, max(0, counts), top.article))
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if link:
            linked += len(html.unescape(text).strip())

    def open_element(tag: str, boilerplate: bool, article: int) -> None:
        stack.append(_Open(tag, boilerplate, article))
        opened[tag] += 1

    def close_element() -> str:
        tag = stack.pop().tag
        opened[tag] -= 1
        return tag

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        block = tag not in INLINE
        if block:
            close_line()
            link = 0
        elif tag in ("br", "td", "th"):
            parts.append(" ")
        if token["end"]:
            if tag == "a":
                link = max(0, link - 1)
            while opened[tag] and close_element() != tag:
                pass
            continue
        if tag == "a":
            link += 1
        while stack and stack[-1].tag in CLOSES.get(tag, ()):
            close_element()
        if tag in VOID or token["attrs"].endswith("/"):
            continue
        above = stack[-1] if stack else _Open("", False, 0)
        boilerplate = above.boilerplate or _boilerplate(tag, token["attrs"], above.article > 0)
        article = above.article
        if tag in ARTICLE and not article and not boilerplate:
            articles += 1
            article = articles
        if block:
            open_element(tag, boilerplate, article)
        elif boilerplate and not above.boilerplate:
            close_line()
            open_element(tag, True, article)
    if at < len(page):
        add(page[at:])
    close_line()
    return lines


def text_ranges(
    weights: list[int], parts: list[int], surge: int, window: int = WINDOW
) -> list[tuple[int, int]]:
    """Ranges of lines between the dives of the window sums to nothing, that hold a surge.

    A range also ends where the lines' ``parts`` change.
    """
    ranges: list[tuple[int, int]] = []
    for i, weight in enumerate(weights):
        if not weight:
            continue
        if ranges and i - ranges[-1][1] < window and len(set(parts[ranges[-1][1] - 1 : i + 1])) == 1:
            ranges[-1] = (ranges[-1][0], i + 1)
        else:
            ranges.append((i, i + 1))
    return [
        (start, end)
        for start, end in ranges
        if max(sum(weights[i : min(i + window, end)]) for i in range(start, end)) >= surge
    ]


def main_text(page: str) -> str:
    """The blocks of the page's texts, one per line; empty if there is none."""
    lines = lines_of(page)
    marked = any(line.article for line in lines)
    weights = []
    for line in lines:
        if line.article:
            weights.append(line.weight + SURGE)
        elif 3 * line.weight > len(line.text):
            weights.append(line.weight // OUTSIDE if marked else line.weight)
        else:
            # A line of mostly links begins or ends no text.
            weights.append(0)
    parts = [line.article for line in lines]
    # A page of little text has no surge.
    ranges = text_ranges(weights, parts, SURGE) or text_ranges(weights, parts, 1)
    return "\n".join(lines[i].text for start, end in ranges for i in range(start, end))


def extract(pages: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of every page with ``text`` and its code points ``n_chars``.

    A null page counts as empty; an empty page, or one without an article, gives the empty
    text. Repeated pages are each extracted; broken markup ends at the next tag or at the
    end of the page. Other columns are not read; an empty table gives no rows.
    """
    kept = pages.select(*columns, "html")
    keys = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "html"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "html"):
            texts = [main_text(page) for page in texts_of(batch.column("html"))]
            arrays = [batch.column(name) for name in columns]
            arrays += [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "text", "n_chars"])

    return kept.mapInArrow(run, ", ".join([*keys, "text string", "n_chars long"]))

"""Main text of web pages by two passes of block rules.

The first pass looks at each long block of text by itself: the density of its stop words and of
its link text decide it, or leave it open. A container such as ``article`` moves the limits of the
blocks in it; it keeps the rest of the page out only if text that is good by its densities lies in
it, and not much more outside. Short blocks are open. In the second pass an open block takes the
label of the nearest decided block of its container.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetmeter.workers import map_batches

SHORT = 70  # characters; a shorter block is left open
STOP_DENSITY = 0.08  # of words; from it on a long block is good, below it open
LINK_DENSITY = 0.5  # of characters; above it a long block is furniture
# The same limits in a container.
STOP_DENSITY_INSIDE = 0.02
LINK_DENSITY_INSIDE = 0.8
# Good text outside of containers may be so many times that inside before it counts too.
MOST_OUTSIDE = 3

# Frequent words of the languages of the corpus.
STOP_WORDS = frozenset(
    """a an and are as at be but by for from had has have he her his i in is it its not of on or
    she that the they this to was were what which with you
    als am auch auf aus bei das dass dem den der des die ein eine einen einer er es für ich im ist
    mit nicht sich sie sind so über und von war werden wie wird zu zum zur
    au aux avec ce ces dans de du elle en est et il ils je la le les leur mais ne nous ou par pas
    plus pour qu que qui sa se ses son sont sur un une vous
    al como con del el ella entre esta este fue ha la las lo los más mi muy no o para pero por se
    ser si sin su sus también tiene una unas uno y""".split()
)

# Elements and names of page furniture and of content.
RAW = frozenset("script style noscript template textarea title iframe svg math object".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp
    rt s samp small span strike strong sub sup time tt u var wbr img input""".split()
)
FURNITURE = frozenset("nav footer aside form menu dialog button select fieldset head".split())
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu".split()
)
FURNITURE_NAMES = frozenset(
    """ad ads advert adverts advertisement banner sponsor sponsored promo sidebar aside widget nav
    navbar navigation menu breadcrumb breadcrumbs header masthead footer cookie cookies consent
    notice notices notification alert popup modal overlay newsletter subscribe subscription signup
    login share sharing social related recommended comment comments reply replies respond disqus
    pagination pager toolbar copyright legal disclaimer skip""".split()
)
# Of these, names that layouts of whole pages are called after too, such as layout-sidebar.
LAYOUT_NAMES = frozenset(
    "sidebar aside widget nav navbar navigation menu header masthead footer banner overlay".split()
)
# As part of a longer name, such as cookiebar, but not of hassidebar or commentary.
FURNITURE_PARTS = re.compile(
    r"(?<!has)(?<!with)(?<!without)(?<!\bno)"
    "(?:advert|sponsor|sidebar|comment(?!ar|at)|cookie|newsletter|breadcrumb|navbar)"
)
# What follows these in a name is about something else inside, or missing, as in has-sidebar.
ABOUT = frozenset("has with without no".split())
CONTENT = frozenset("article main".split())
CONTENT_NAMES = frozenset("article content post entry story main".split())

_PIECE = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)"
    # A quote that never ends is an ordinary character.
    r"(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+(?=>)|[^>]*)>"
    r"|<[!?/][^>]*>"
    r"|[^<]+|<",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"\b(class|id|role|hidden|style|aria-hidden)\b\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?",
    re.I,
)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_NAME = re.compile("[a-z]+")
_WORD = re.compile(r"[^\W\d_]+")


class Block(NamedTuple):
    text: str
    link_chars: int
    furniture: bool
    container: int  # number of the content container, 0 outside of any
    heading: bool
    named: int = 0  # elements around it that are furniture by their names only
    foreign: bool = False  # one of these has more than the name of a layout


class _Element(NamedTuple):
    name: str
    furniture: bool  # by its element or role
    container: int
    named: int = 0
    foreign: bool = False


class _Role(NamedTuple):
    furniture: bool
    content: bool
    named: bool = False
    foreign: bool = False
    main: bool = False


def _names(value: str) -> Iterator[str]:
    """The words of a class or id, without those that are about something inside."""
    for name in value.split():
        for word in _NAME.findall(name):
            if word in ABOUT:
                break
            yield word


def _role(name: str, rest: str, inside: int) -> _Role:
    """Whether an element is page furniture, by itself or by name only, and whether it is a
    container of content."""
    furniture = name in FURNITURE or name == "header" and not inside
    content, main = name in CONTENT, name == "main"
    if "=" not in rest and "hidden" not in rest.lower():
        return _Role(furniture, content, main=main)
    names: set[str] = set()
    for key, value in _ATTRIBUTE.findall(rest):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id"):
            names.update(_names(value))
        elif key == "role":
            furniture |= value in FURNITURE_ROLES
            content |= value in CONTENT
            main |= value == "main"
        elif key == "hidden" or key == "aria-hidden" and value == "true":
            furniture = True
        elif key == "style":
            furniture |= bool(_HIDDEN.search(value))
    if name == "body" or name == "html":
        return _Role(False, False)
    if inside:
        names.discard("header")
    named = not names.isdisjoint(FURNITURE_NAMES) or any(map(FURNITURE_PARTS.search, names))
    if name in CONTENT:  # a name such as with-sidebar says nothing of the main element itself
        named = "comment" in names or "comments" in names
    free = not furniture and not named
    foreign = named and any(
        x not in LAYOUT_NAMES and (x in FURNITURE_NAMES or FURNITURE_PARTS.search(x)) for x in names
    )
    content = free and (content or not names.isdisjoint(CONTENT_NAMES))
    return _Role(furniture, content, named, foreign, main and free)


def blocks_of(page: str) -> list[Block]:
    """The blocks of text in page order, white space collapsed, references decoded."""
    blocks: list[Block] = []
    stack = [_Element("", False, 0)]
    opened: dict[str, int] = {}
    last_end = page.rfind(">")
    parts: list[str] = []
    links, in_link, heading, containers, at, skip = 0, 0, False, 0, 0, ""

    def close() -> None:
        nonlocal links, heading
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            top = stack[-1]
            furniture = top.furniture or top.named > 0
            blocks.append(
                Block(
                    text,
                    links,
                    furniture,
                    top.container,
                    heading,
                    0 if top.furniture else top.named,
                    top.foreign,
                )
            )
        parts.clear()
        links, heading = 0, False

    def pop() -> str:
        name = stack.pop().name
        opened[name] -= 1
        return name

    while at <= last_end and (piece := _PIECE.search(page, at)):
        at = piece.end()
        name = piece["name"]
        if name is None:
            text = piece[0]
            if text[0] != "<" or text == "<":
                parts.append(text)
                if in_link:
                    links += len(text.strip())
            continue
        name = name.lower()
        if name in RAW:
            if not piece["end"] and not piece["rest"].endswith("/"):
                stop = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, at)
                # Without an end tag all that follows is raw, as in browsers.
                at = stop.end() if stop else len(page)
            continue
        if name == "a":
            in_link = 0 if piece["end"] else 1
            continue
        if name in INLINE:
            continue
        close()
        if piece["end"]:
            if opened.get(name):
                while pop() != name:
                    pass
            in_link = 0
            continue
        if name in VOID:
            continue
        if name == "body":  # ends a head without end tag
            while opened.get("head"):
                pop()
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack[-1].name == name:
            pop()
        above = stack[-1]
        role = _role(name, piece["rest"], above.container)
        containers += role.content
        stack.append(
            _Element(
                name,
                above.furniture or role.furniture,
                containers if role.content and not above.container else above.container,
                # A page has one main part, whatever the wrappers around it are called.
                0 if role.main else above.named + role.named,
                not role.main and (above.foreign or role.foreign),
            )
        )
        opened[name] = opened.get(name, 0) + 1
        heading = len(name) == 2 and name[0] == "h" and name[1] in "123456"
    if at < len(page) and not page.startswith("<!--", at):
        parts.append(page[at:])
    close()
    return blocks


def _stop_density(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def by_density(block: Block, inside: bool) -> bool | None:
    """What the densities of a block say: good, furniture, or nothing (None), as for all short
    blocks and headings."""
    links = LINK_DENSITY_INSIDE if inside else LINK_DENSITY
    if len(block.text) < SHORT:
        return False if not inside and block.link_chars > links * len(block.text) else None
    if block.link_chars > links * len(block.text):
        return False
    if block.heading or _stop_density(block.text) < (STOP_DENSITY_INSIDE if inside else STOP_DENSITY):
        return None
    return True


def _contained(blocks: list[Block]) -> list[Block]:
    """The blocks as they are if their containers hold the main text; else without containers."""
    inside = outside = 0
    for b in blocks:
        if not b.furniture and len(b.text) >= SHORT and by_density(b, bool(b.container)):
            inside += len(b.text) * bool(b.container)
            outside += len(b.text) * (not b.container)
    if inside * MOST_OUTSIDE >= outside and (inside or any(b.container and not b.furniture for b in blocks)):
        return blocks
    return [b._replace(container=0) for b in blocks]


def _unwrapped(blocks: list[Block]) -> list[Block]:
    """The blocks of a page whose main text lies in a wrapper that is called like furniture: up
    to as many such names as the text has around it do not count. That is the case if no
    container is free of them, but long text in one outweighs all free text; or if no text at
    all is free, and long text has only names of layouts around it."""
    if not any(b.named for b in blocks) or any(b.container and not b.furniture for b in blocks):
        return blocks

    def weight(chosen: list[Block]) -> int:
        return sum(
            len(b.text)
            for b in chosen
            if len(b.text) >= SHORT
            and b.link_chars <= LINK_DENSITY * len(b.text)
            and _stop_density(b.text) >= STOP_DENSITY
        )

    free = [b for b in blocks if not b.furniture]
    least = weight(free)
    wrapped = [b for b in blocks if b.named and b.container and not (b.foreign and least)]
    if not weight(wrapped) > least:
        wrapped = [] if free else [b for b in blocks if b.named and not b.foreign]
        least = 0
    for depth in sorted({b.named for b in wrapped}):
        if weight([b for b in wrapped if b.named == depth]) > least:
            return [
                b._replace(furniture=False) if 0 < b.named <= depth else b for b in blocks
            ]
    return blocks


def labels_of(blocks: list[Block]) -> list[bool]:
    """Whether each block is main text."""
    blocks = _contained(_unwrapped(blocks))
    contained = any(b.container and not b.furniture for b in blocks)
    first: list[bool | None] = []
    for b in blocks:
        if b.furniture or contained and not b.container:
            first.append(False)
        else:
            first.append(by_density(b, bool(b.container)))
    open_ = [i for i, x in enumerate(first) if x is None]
    if not open_:
        return [bool(x) for x in first]
    if not any(first):  # nothing is long enough to decide: what is left is the text
        return [x is None for x in first]

    def decided(order: range, edge: int) -> list[int | None]:
        """The nearest decided block of the same container, seen in one direction. Outside of
        containers the edge of the page counts as furniture, as menus and notes lie there."""
        found: list[int | None] = [None] * len(blocks)
        last: dict[int, int] = {0: edge}
        for i in order:
            found[i] = last.get(blocks[i].container)
            if first[i] is not None and not (blocks[i].furniture and blocks[i].container):
                last[blocks[i].container] = i
        return found

    n = len(blocks)
    before, after = decided(range(n), -1), decided(range(n - 1, -1, -1), n)
    result = [bool(x) for x in first]
    for i in open_:
        near = [
            (abs(i - j), not (0 <= j < n and first[j]))
            for j in (before[i], after[i])
            if j is not None
        ]
        # Of two equally near ones, main text counts. A heading belongs to what follows it.
        if blocks[i].heading and after[i] is not None and after[i] < n:
            result[i] = bool(first[after[i]])
        elif near:
            result[i] = not min(near)[1]
        else:
            result[i] = True
    return result


def main_text(page: str | None) -> str:
    """The blocks of main text joined by spaces; empty for a null or empty page."""
    blocks = blocks_of(page or "")
    return " ".join(b.text for b, good in zip(blocks, labels_of(blocks)) if good)


def extracted(pages: DataFrame, html_column: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text of each row in place of its html, as the last column. A
    column that already has the name of the result is replaced. Ids, urls and all other
    columns may be null or repeated; each row is judged by itself."""
    kept = [c for c in pages.columns if c not in (html_column, text)]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(html_column)]
            columns = [*(batch.column(c) for c in kept), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, text])

    fields = [pages.schema[c] for c in kept]
    schema = T.StructType([*fields, T.StructField(text, T.StringType())])
    return map_batches(pages.select(*kept, html_column), extract, schema)

"""HTML text into leaf blocks with their ancestors."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# Fixed values of the HTML language.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td "
    "textarea tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT_TAGS = frozenset("script style noscript template iframe object svg annotation annotation-xml head title audio video canvas".split())
HEAD_TAGS = frozenset("base link meta title style script noscript template".split())  # start tags that leave a head open
RAW_TAGS = frozenset("script style title textarea iframe noscript".split())  # no markup inside
CLOSED_BY_BLOCK = frozenset("p".split())
SIBLINGS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
SCOPES = frozenset("ul ol table dl select article section main body html".split())

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^'">]++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)""", re.S)
NAMES = re.compile(r"""(class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    """Text of a leaf block, its ancestors from the outside in, the words of their names, and its text in links."""

    text: str
    tags: tuple[str, ...]
    names: tuple[tuple[str, ...], ...]  # per ancestor: words of class, id, role and label
    link_chars: int


def name_words(attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return ()
    return tuple(w.lower() for m in NAMES.finditer(attributes) for w in WORD.findall(m[2]))


def blocks(source: str | None) -> list[Block]:
    """Leaf blocks with text, in page order. Comments, scripts, styles and the head have none.

    Forgiving like a browser: open paragraphs, items and cells close at the next one, end tags without a
    start are ignored, a head ends at the first thing that may not stand in it, a tag cut off by the end of the page is no text. A line break is white space.
    Nothing inside a drawing (svg) ends the block around it.
    """
    out: list[Block] = []
    tags: list[str] = []
    names: list[tuple[str, ...]] = []
    words: list[str] = []
    linked = 0
    silent = 0

    def flush() -> None:
        nonlocal linked
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            if text:
                out.append(Block(text, tuple(tags), tuple(names), min(linked, len(text))))
            words.clear()
            linked = 0

    def pop_to(depth: int) -> None:
        nonlocal silent
        silent -= sum(t in SILENT_TAGS for t in tags[depth:])
        del tags[depth:], names[depth:]

    def end_head() -> None:
        """Close an open head, unless the place is inside a template of it."""
        if "head" in tags and "template" not in tags:
            pop_to(tags.index("head"))

    def add(text: str) -> None:
        nonlocal linked
        if silent and tags[-1] == "head" and text.strip():
            end_head()
        if text and not silent:
            words.append(text)
            if "a" in tags:
                linked += len(text.strip())

    source = source or ""
    at = 0
    while at < len(source):
        m = MARKUP.search(source, at)
        if m is None:
            add(source[at:])
            break
        add(source[at:m.start()])
        at = m.end()
        slash, tag, attributes = m.group(1, 2, 3) if m[2] else m.group(4, 5, 6)
        if not tag:
            if m[0].startswith("<![CDATA["):
                add(html.escape(m[0][9:].removesuffix("]]>"), quote=False))
            continue
        if not m[0].endswith(">"):
            break
        tag = tag.lower()
        if not slash and tag not in HEAD_TAGS:
            end_head()
        drawn = "svg" in tags and (not slash or tag in tags[tags.index("svg"):])
        if tag in BLOCK_TAGS and not drawn:
            flush()
        elif tag == "br":
            add(" ")
        if slash:
            if tag in tags:
                pop_to(len(tags) - 1 - tags[::-1].index(tag))
            continue
        if tag in BLOCK_TAGS and not drawn:
            if "p" in tags and tag not in ("option", "button"):
                pop_to(len(tags) - 1 - tags[::-1].index("p"))
            if tag in SIBLINGS:
                for depth in range(len(tags) - 1, -1, -1):
                    if tags[depth] in SIBLINGS[tag].split():
                        pop_to(depth)
                        break
                    if tags[depth] in SCOPES:
                        break
            if tag == "body":  # a head left open ends here
                pop_to(0)
        if tag in VOID_TAGS or attributes.rstrip().endswith("/") and tag not in BLOCK_TAGS:
            continue
        if tag in RAW_TAGS:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
            if tag == "textarea":
                tags.append(tag)
                names.append(name_words(attributes))
                add(source[at:end.start() if end else len(source)].replace("<", "&lt;"))
                flush()
                pop_to(len(tags) - 1)
            at = end.end() if end else len(source)
            continue
        tags.append(tag)
        names.append(name_words(attributes))
        silent += tag in SILENT_TAGS
    flush()
    return out

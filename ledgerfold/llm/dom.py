"""A small tolerant HTML reader: blocks of text with the element path they stand in."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
    |<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>[^>"']*(?:(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))[^>"']*)*)(?:>|\Z)""", re.S | re.X)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
NUMBERS = re.compile(r"\d{3,}")
NAMES = re.compile(r"[A-Za-z]+")
SPACES = re.compile(r"\s+")

# Fixed values of the HTML standard: elements without content, raw text, hidden, inline, and tags
# that close an open element of the same kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("script style title head template noscript iframe noembed noframes object svg math canvas audio video map".split())
FORM = frozenset("form button select option textarea datalist fieldset".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output progress q rp rt
    ruby s samp small span strike strong sub sup time tt u var wbr""".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}, "thead": {"tbody", "thead"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
SCOPES = frozenset("table ul ol dl td th tr body html article section div main aside nav header footer form blockquote".split())
DEEPEST = 64
NO_NAMES: frozenset = frozenset()


@dataclass
class Node:
    """An element: its place in the style tree (path) and what its own tag says."""

    tag: str
    path: str
    parent: int
    names: frozenset
    hidden: bool
    children: list


def style_name(tag: str, attributes: dict) -> str:
    """How an element looks in a path: tag, and class and id without long numbers."""
    look = sorted(NUMBERS.sub("", attributes.get("class", "")).lower().split())
    ident = NUMBERS.sub("", attributes.get("id", "")).lower().strip("-_ ")
    return tag + "".join("." + c for c in look if c) + ("#" + ident if ident else "")


def read_page(html: str) -> tuple[list[Node], list[tuple[int, str, int]]]:
    """(nodes, blocks): elements in page order, node 0 the root; a block is (node, text, characters
    in links), its text decoded, white space runs one space, trimmed, never empty.

    Inline elements are part of their block, a line break is white space. Elements deeper than
    ``DEEPEST`` have the path of their ancestor at that depth. Unclosed and wrongly closed tags are accepted,
    a paragraph ends where another block starts.
    """
    nodes = [Node("", "", -1, frozenset(), False, [])]
    blocks: list[tuple[int, str, int]] = []
    stack = [0]
    words: list[str] = []
    linked = links = 0

    def flush():
        nonlocal linked
        if words:
            text = SPACES.sub(" ", "".join(words)).strip()
            if text and not nodes[stack[-1]].hidden:
                blocks.append((stack[-1], text, min(linked, len(text))))
            words.clear()
            linked = 0

    def say(raw: str):
        nonlocal linked
        if raw:
            text = unescape(raw) if "&" in raw else raw
            words.append(text)
            if links:
                linked += len(text)

    at, end = 0, len(html)
    while at < end:
        m = TOKEN.search(html, at)
        if m is None:
            say(html[at:])
            break
        say(html[at:m.start()])
        at = m.end()
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if m["close"]:
            if tag == "a":
                links = 0
            if tag in INLINE or tag in VOID:
                continue
            flush()
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag == tag:
                    del stack[k:]
                    break
                if tag in ("p", "li", "dd", "dt", "td", "th", "tr") and nodes[stack[k]].tag in SCOPES - {tag, "tr", "td", "th"}:
                    break
            continue
        if tag == "a":
            links = 1
        if tag in INLINE:
            continue
        if tag in VOID:
            if tag == "br" or tag == "hr":
                words.append(" ")
            continue
        flush()
        if nodes[stack[-1]].tag == "p":
            stack.pop()
        shut = CLOSED_BY.get(tag)
        if shut:
            for k in range(len(stack) - 1, 0, -1):
                here = nodes[stack[k]].tag
                if here in shut:
                    del stack[k:]
                    break
                if here in SCOPES and here not in shut and here not in ("tr", "td", "th"):
                    break
        attributes = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(m["attrs"])} if "=" in m["attrs"] else {}
        above = nodes[stack[-1]]
        hidden = (above.hidden or tag in HIDDEN or "display:none" in attributes.get("style", "").replace(" ", "").lower()
                  or attributes.get("aria-hidden", "").lower() == "true")
        names = frozenset(NAMES.findall(" ".join(attributes.get(k, "") for k in ("class", "id", "role", "itemprop")).lower())) if attributes else NO_NAMES
        path = f"{above.path}/{style_name(tag, attributes) if attributes else tag}" if len(stack) < DEEPEST else above.path
        nodes.append(Node(tag, path, stack[-1], names, hidden, []))
        above.children.append(tag)
        stack.append(len(nodes) - 1)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
            raw = html[at:close.start() if close else end]
            if tag == "textarea" and not hidden:
                say(raw)
                flush()
            at = close.start() if close else end
    flush()
    return nodes, blocks

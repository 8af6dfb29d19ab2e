"""Web pages as sequences of leaf blocks: each block's text, its tag path and how much of it is links.

A tolerant reader for broken markup: unclosed and wrongly nested elements, attributes with ``>`` in
quotes, raw-text elements, pages cut anywhere.  Elements are numbered per page and point to their
parent, so a deep path costs no more than a flat one."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

#: Fixed values of HTML: elements that start a block of their own, that have no content, and whose
#: content is no text of the page.
BLOCK = frozenset(
    "html body div p ul ol li dl dt dd table thead tbody tfoot tr td th caption article section main nav aside header "
    "footer form fieldset legend h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption address hr details summary dialog "
    "center menu search select option optgroup textarea button label hgroup".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style template noscript iframe noframes noembed object svg math title head".split())
#: An opening tag of the key closes an open element named in the value.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "body": {"head"}}
#: Elements that end the search for an element to close.
SCOPE = frozenset("ul ol table dl select div article section main aside nav header footer form td th body html".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))|</[^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|itemprop|hidden|aria-hidden|style|type)(?=[\s=>/]|$)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_NAME = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*|[0-9]+|[^\W\d_a-zA-Z]+")


@dataclass
class Page:
    """``elements``: (parent, name tokens), the first being the page itself; ``blocks``: (element,
    text, characters inside links)."""

    elements: list[tuple[int, tuple[str, ...]]] = field(default_factory=lambda: [(-1, ())])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


_names: dict[tuple[str, str], tuple[str, ...]] = {}


def element_names(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag, and the words of its class, id, role and the like; ``@hidden`` for hidden elements."""
    key = (tag, attributes)
    if key not in _names:
        out = [tag]
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                out.append("@hidden")
            elif name == "style":
                if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    out.append("@hidden")
            elif name in ("class", "id", "role", "itemprop"):
                out += ["." + w.lower() for w in _NAME.findall(value)]
                # Names of several words also count whole: sideBar, side-bar and sidebar are one.
                out += ["." + re.sub(r"[\W_]+", "", w).lower() for w in value.split() if len(_NAME.findall(w)) > 1]
        if len(_names) > 50_000:
            _names.clear()
        _names[key] = tuple(dict.fromkeys(out))
    return _names[key]


def page_blocks(html: str) -> Page:
    page = Page()
    elements, blocks = page.elements, page.blocks
    stack: list[tuple[str, int]] = [("", 0)]
    pieces: list[str] = []
    link_from, linked, at, end = 0, 0, 0, len(html)

    def flush():
        nonlocal linked
        text = " ".join("".join(pieces).split())
        if text:
            blocks.append((stack[-1][1], text, min(linked, len(text))))
        pieces.clear()
        linked = 0

    def close(depth: int):
        nonlocal link_from
        del stack[depth:]
        if link_from > len(stack):
            link_from = 0

    def words(a: int, b: int):
        nonlocal linked
        if a < b:
            piece = html[a:b]
            piece = unescape(piece) if "&" in piece else piece
            pieces.append(piece)
            if link_from:
                linked += len(piece.strip())

    while at < end:
        m = _TAG.search(html, at)
        if not m:
            words(at, end)
            break
        words(at, m.start())
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                link_from = 0
            elif tag == "p" or tag in BLOCK:
                flush()
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == tag:
                        close(depth)
                        break
        elif tag in RAW:
            if tag == "head":
                continue  # what is inside it is either raw or starts the body
            past = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
            at = past.end() if past else end
        elif tag == "br":
            pieces.append(" ")
        elif tag == "a":
            link_from = len(stack)
        elif tag in BLOCK:
            flush()
            if tag != "label" and tag != "button" and stack[-1][0] == "p":
                close(len(stack) - 1)
            if tag in CLOSES:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in CLOSES[tag]:
                        close(depth)
                        if tag != "tr" or stack[-1][0] != "tr":
                            break
                    elif stack[depth][0] in SCOPE:
                        break
            if tag not in VOID and not m[3].endswith("/>"):
                elements.append((stack[-1][1], element_names(tag, m[3].rstrip(">"))))
                stack.append((tag, len(elements) - 1))
    flush()
    return page

"""The text blocks of a web page: leaf runs of text with the path of elements above them."""

from __future__ import annotations

import functools
import html
import re
from dataclasses import dataclass

# Element names of HTML.
BLOCK_ELEMENTS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td textarea tfoot th thead tr ul".split()
)
# An element of the first kind ends open ones of the second, up to one of the third.
_TABLE = frozenset(["table"])
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), _TABLE),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
}
_NO_P = (frozenset(["p"]), frozenset(["td", "th", "button"]))
# Elements whose content is hidden. Whatever else may stand in a head has no content.
_HIDDEN = frozenset("iframe math noscript object script style svg template title".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN_ENDS = {name: re.compile(rf"(?i)</{name}(?=[\s/>])[^>]*+>") for name in _HIDDEN}
_MARKUP = re.compile(
    r"""(?is)<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(/?)([a-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-z][^\s/>]*+)[^>]*+>"""
)
# A slash at the end of a value without quotes is part of the value.
_OPEN_VALUE = re.compile(r"""=\s*[^\s"'>/][^\s"'>]*/$""")
_ATTRIBUTE = re.compile(r"""(?i)\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_NAME = re.compile(r"[a-z]+")
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
# Words at the beginning or end of a class that tells a state of the page, not what the element is.
_STATE = re.compile(r"(?:has|no|with|without|is|show|hide|js|theme|layout)[-_]|.*[-_](?:on|off|open|closed|active|enabled|disabled)$")
# An element that the page does not show.
_UNSEEN = re.compile(r"""(?i)\shidden(?=[\s=/]|$)|\saria-hidden\s*=\s*["']?true|\sstyle\s*=\s*(?:"[^"]*|'[^']*|\S*)display\s*:\s*none""")
_UNSEEN_MARK = "?unseen"


@dataclass(slots=True)
class Block:
    path: tuple[tuple[str, ...], ...]  # per open element: its name, then words of its class, id and role
    text: str
    linked: float  # share of characters inside links


@functools.lru_cache(20_000)
def _element(name: str, attributes: str) -> tuple[str, ...]:
    """The element's name and the words of its class, id and role.

    Those of html and body say something about the page, not about a block.
    """
    unseen = (_UNSEEN_MARK,) if _UNSEEN.search(" " + attributes) else ()
    if name in ("html", "body"):
        return (name, *unseen)
    words = [
        word
        for found in _ATTRIBUTE.finditer(attributes)
        for part in html.unescape(found[2] or found[3] or found[4] or "").split()
        if not _STATE.match(part.lower())
        for word in _NAME.findall(_HUMP.sub("-", part).lower())
    ]
    return (name, *unseen, *("." + word for word in words))


def blocks(page: str | None) -> list[Block]:
    """The blocks of a page in order, with references decoded and white space as single spaces.

    Comments and elements that show no text are left out, and so are those hidden
    by an attribute (``hidden``, ``aria-hidden``, ``display:none``). Open elements end
    where HTML lets them end without a tag; the head ends before the first text
    or element that cannot stand in it, so nothing but its hidden elements is
    left out. Of a hidden element without an end tag only the tag is left out; a
    self-closed svg or math element is empty.
    """
    page = page or ""
    found: list[Block] = []
    stack: list[tuple[str, ...]] = []
    parts: list[str] = []
    in_link, linked = False, 0
    at = 0
    unclosed: set[str] = set()

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join(html.unescape(raw).split())
            if text and not any(_UNSEEN_MARK in element for element in stack):
                found.append(Block(tuple(stack), text, min(1.0, linked / len(raw))))
            parts.clear()
        linked = 0

    def end(names: frozenset[str], border: frozenset[str]) -> None:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                del stack[k:]
                return
            if stack[k][0] in border:
                return

    while tag := _MARKUP.search(page, at):
        if at < tag.start():
            piece = page[at : tag.start()]
            parts.append(piece)
            linked += len(piece) * in_link
        at = tag.end()
        name = (tag[2] or tag[5] or "").lower()
        if name in _HIDDEN:
            attributes = tag[3] or ""
            empty = name in ("svg", "math") and attributes.endswith("/") and not _OPEN_VALUE.search(attributes)
            if not (tag[1] or tag[4] or empty or name in unclosed):
                closing = _HIDDEN_ENDS[name].search(page, at)
                if closing:
                    at = closing.end()
                else:
                    unclosed.add(name)
            continue
        if not tag[2]:
            continue
        if not tag[1] and name not in BLOCK_ELEMENTS and name not in _VOID and _UNSEEN.search(tag[3]):
            closing = re.compile(rf"(?i)</{re.escape(name)}(?=[\s/>])[^>]*+>").search(page, at)
            if closing:
                at = closing.end()
            continue
        if name == "a":
            in_link = not tag[1]
        elif name == "br":
            parts.append(" ")
        elif name in BLOCK_ELEMENTS:
            flush()
            if tag[1]:
                end(frozenset([name]), frozenset())
                continue
            end(*_NO_P)
            if name in ENDS:
                end(*ENDS[name])
            if name != "hr":
                stack.append(_element(name, tag[3]))
    parts.append(page[at:])
    flush()
    return found

"""Leaf blocks of an HTML page: the text between block boundaries with its tag path."""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their contents are no markup of the page; they end at their own close tag.
RAW = frozenset("script style textarea title noscript template iframe".split())
#: Controls and drawings inside a line of text: skipped with their contents if they close within the block.
CONTROLS = frozenset("button select svg".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn em i img ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var del ruby rt rp wbr nobr font math mi mn mo ms mrow msup msub mfrac msqrt mtext bdo meter output "
    "progress object".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements that an opening tag of the same group closes, up to the nearest container.
CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
          "tr": ("tr td th", ("table", "tbody", "thead", "tfoot")), "td": ("td th", ("tr",)), "th": ("td th", ("tr",)),
          "option": ("option", ("select",))}
# Quotes delimit a value only after an equals sign; other values end at white space or ">".
_TAG = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))*+)>|<[!?/][^>]*>""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|aria-label|itemprop|style|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_PART = re.compile(r"[a-z]+|\d+")
_CLOSE = {name: re.compile(rf"</{name}(?![^\s/>])[^>]*>", re.I) for name in RAW | CONTROLS}


def _control_end(html: str, name: str, at: int) -> int | None:
    """Where a control that starts at ``at`` has closed, if no block begins or ends before."""
    m = _CLOSE[name].search(html, at)
    if m is None:
        return None
    for tag in _TAG.finditer(html, at, m.start()):
        inner = (tag.group(2) or "").lower()
        if inner in BLOCKS:
            return None
    return m.end()


class Block(NamedTuple):
    text: str
    path: tuple[str, ...]
    link_chars: int


def _marks(name: str, attrs: str) -> tuple[str, ...]:
    """The element and the words of its class, id and role."""
    out = [f"<{name}>"]
    if attrs:
        for m in _ATTR.finditer(attrs):
            key = m.group(1).lower()
            value = (m.group(2) or m.group(3) or m.group(4) or "").lower()
            if key == "style":
                if "display:none" in value.replace(" ", ""):
                    out.append("@hidden")
            elif key == "hidden":
                out.append("@hidden")
            else:
                out.extend(f"@{w}" for w in _PART.findall(value))
    return tuple(out)


def leaf_blocks(html: str | None) -> list[Block]:
    """Blocks in page order. Unclosed, misnested and unknown tags are taken as browsers do in the
    common cases; the contents of scripts, styles and comments, and of controls that close within
    their block, are no text. An element that never closes takes no text of the page with it."""
    if not html:
        return []
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []  # element and the path down to it
    pieces: list[str] = []
    links = anchor = 0

    def flush():
        nonlocal links
        if pieces:
            text = "".join(pieces)
            text = " ".join((unescape(text) if "&" in text else text).split())
            if text:
                blocks.append(Block(text, stack[-1][1] if stack else (), links))
            pieces.clear()
        links = 0

    def add(text: str):
        nonlocal links
        if text:
            pieces.append(text)
            if anchor:
                links += len(text)

    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at:m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        name = name.lower()
        if m.group(1):
            if name == "a":
                anchor = max(0, anchor - 1)
            if name in INLINE or name in CONTROLS:
                continue
            if any(x == name for x, _ in stack):
                flush()
                anchor = 0
                while stack.pop()[0] != name:
                    pass
            elif name == "p":
                flush()
            continue
        if name in RAW:
            end = None if m.group(3).endswith("/") and name != "script" else _CLOSE[name].search(html, at)
            if end:
                at = end.end()
            elif name in ("script", "style"):
                # Never closed: what stands before the next tag is code, the page goes on after it.
                after = _TAG.search(html, at)
                at = after.start() if after else n
            pieces.append(" ")
            continue
        if name in CONTROLS:
            at = _control_end(html, name, at) or at
            pieces.append(" ")
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name == "a":
            anchor += 1
        if name in INLINE:
            continue
        flush()
        if name in VOID:
            continue
        if name in CLOSES:
            same, stop = CLOSES[name]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in stop:
                    break
                if stack[k][0] in same.split():
                    del stack[k:]
                    break
        while stack and stack[-1][0] == "p":
            stack.pop()
        above = stack[-1][1] if stack else ()
        stack.append((name, above + tuple(x for x in _marks(name, m.group(3)) if x not in above)))
    flush()
    return blocks

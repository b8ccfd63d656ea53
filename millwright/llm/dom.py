"""A page as a tree of block elements and the text blocks in them, read in one pass that forgives broken markup.

Only elements that start a block are nodes; the text of inline elements belongs to the block around them. White space in a
block, line breaks included, becomes one space; character references are decoded. Scripts, styles, the head and other
contents that are never text are left out. Elements deeper than ``DEPTH`` hang on the element of that depth.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# HTML's elements that start a block, and among them those whose start ends an open paragraph.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th"
    " thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is markup of another kind, or never shown as text.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SILENT = frozenset("head noscript template svg object canvas audio video datalist".split())
#: What the start of an element ends, if it is the innermost open block.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "td": ("td", "th"), "th": ("td", "th"), "tr": ("td", "th", "tr"), "tbody": ("td", "th", "tr", "thead", "tbody"),
    "thead": ("td", "th", "tr", "tbody"), "tfoot": ("td", "th", "tr", "tbody", "thead"),
}
DEPTH = 400

TOKEN = re.compile(
    r"<(?:!--(?:-?>|(?:(?!--!?>).)*+(?:--!?>|\Z))"
    r"|[!?][^>]*+(?:>|\Z)"
    r"|/(?![a-zA-Z])[^>]*+(?:>|\Z)"
    r"|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>[^>=]*+(?:=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?[^>=]*+)*+)(?:>|\Z))",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+))")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Page:
    """Nodes in page order; node 0 is the page itself. A text block is a node without a tag."""

    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    tag: list[str] = field(default_factory=lambda: ["#page"])
    names: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    mark: list[str | None] = field(default_factory=lambda: [None])
    text: list[str] = field(default_factory=lambda: [""])
    linked: list[int] = field(default_factory=lambda: [0])


def names_of(rest: str) -> tuple[tuple[str, ...], str | None]:
    """Lower-case words of class, id and role, and the value of ``data-main``, by which examples are labelled."""
    words, mark = [], None
    for name, *values in ATTRIBUTE.findall(rest):
        name, value = name.lower(), next((v for v in values if v), "")
        if name in ("class", "id", "role", "itemprop"):
            words += [w.lower() for w in WORD.findall(unescape(value))]
        elif name == "data-main":
            mark = value
    return tuple(dict.fromkeys(words[:64])), mark


def parse(html: str) -> Page:
    page, stack, tags = Page(), [0], {}
    pieces: list[tuple[str, bool]] = []
    link = 0

    def flush() -> None:
        nonlocal pieces
        if not pieces:
            return
        text = " ".join("".join(t for t, _ in pieces).split())
        if text:
            add("", (), None)
            page.text[-1] = text
            page.linked[-1] = sum(len("".join(t.split())) for t, linked in pieces if linked)
        pieces = []

    def add(tag: str, names: tuple[str, ...], mark: str | None) -> None:
        page.parent.append(stack[-1])
        page.depth.append(page.depth[stack[-1]] + 1)
        page.tag.append(tag)
        page.names.append(names)
        page.mark.append(mark)
        page.text.append("")
        page.linked.append(0)

    def pop() -> str:
        nonlocal link
        flush()
        link = 0
        name = page.tag[stack.pop()]
        tags[name] -= 1
        return name

    at, end = 0, len(html)
    while at < end:
        found = TOKEN.search(html, at)
        to = found.start() if found else end
        if to > at:
            segment = html[at:to]
            pieces.append((unescape(segment) if "&" in segment else segment, link > 0))
        if not found:
            break
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if found["close"]:
            if name == "a":
                link = max(0, link - 1)
            elif name in BLOCKS:
                flush()
                if tags.get(name):
                    while pop() != name:
                        pass
            continue
        if name in RAW or name in SILENT:
            if not found["rest"].endswith("/") or name in RAW:
                shut = re.compile(rf"</{name}(?=[\s/>])[^>]*>?" + (r"|<body(?=[\s/>])" if name == "head" else ""), re.IGNORECASE).search(html, at)
                at = end if shut is None and name in RAW else at if shut is None else shut.start() if shut[0][1] != "/" else shut.end()
            if name == "textarea":
                flush()
        elif name == "br":
            pieces.append((" ", False))
        elif name in BLOCKS:
            flush()
            if page.tag[stack[-1]] == "p":
                pop()
            for ended in ENDS.get(name, ()):
                if page.tag[stack[-1]] == ended:
                    pop()
            if name in VOID or name in ("html", "body") and tags.get(name):
                continue
            names, mark = names_of(found["rest"])
            add(name, names, mark)
            if len(stack) < DEPTH:
                stack.append(len(page.parent) - 1)
                tags[name] = tags.get(name, 0) + 1
        elif name == "a":
            link += 1
    flush()
    return page

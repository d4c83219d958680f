"""A forgiving HTML reader: block elements and text blocks as one flat tree."""

from __future__ import annotations

import html
import re

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
TOKEN = re.compile(r"[a-zA-Z]+")

# Element names, as the HTML standard groups them.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr input picture source track".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_ITSELF = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}


class Node:
    """A block element, or a text block where ``tag`` is ``#text``."""

    __slots__ = ("tag", "tokens", "parent", "depth", "text", "link_chars", "children")

    def __init__(self, tag: str, tokens: frozenset[str], parent: int, depth: int):
        self.tag, self.tokens, self.parent, self.depth = tag, tokens, parent, depth
        self.text = ""
        self.link_chars = 0
        self.children: list[int] = []


def tokens_of(attributes: str) -> frozenset[str]:
    """Words of class, id and role, split at anything but letters and at inner capitals."""
    if "=" not in attributes:
        return frozenset()
    found = set()
    for groups in ATTRIBUTE.findall(attributes):
        value = re.sub(r"([a-z])([A-Z])", r"\1 \2", next((g for g in groups if g), ""))
        found.update(t.lower() for t in TOKEN.findall(value))
    return frozenset(found)


def parse(source: str) -> list[Node]:
    """Nodes in page order; node 0 is the root. White space in a text block is
    one space, references are decoded, empty blocks are left out."""
    nodes = [Node("#root", frozenset(), -1, 0)]
    stack = [0]
    # Where in the stack the open elements of each name are, so that no tag walks it.
    places: dict[str, list[int]] = {}
    run: list[tuple[str, bool]] = []
    link = False

    def add(tag: str, tokens: frozenset[str] = frozenset()) -> int:
        parent = stack[-1]
        nodes.append(Node(tag, tokens, parent, nodes[parent].depth + 1))
        nodes[parent].children.append(len(nodes) - 1)
        return len(nodes) - 1

    def end_block() -> None:
        if run:
            text = " ".join("".join(html.unescape(t) for t, _ in run).split())
            if text:
                block = nodes[add("#text")]
                block.text = text
                block.link_chars = sum(len(t.strip()) for t, linked in run if linked)
            run.clear()

    def last(names: tuple[str, ...]) -> int:
        return max((places[name][-1] for name in names if places.get(name)), default=0)

    def close(names: tuple[str, ...], scope: tuple[str, ...] = ()) -> None:
        at = last(names)
        if at > last(scope):
            for i in range(len(stack) - 1, at - 1, -1):
                places[nodes[stack[i]].tag].pop()
            del stack[at:]

    at, size = 0, len(source)
    while at < size:
        lt = source.find("<", at)
        if lt < 0:
            run.append((source[at:], link))
            break
        if lt > at:
            run.append((source[at:lt], link))
        after = source[lt + 1 : lt + 2]
        if source.startswith("<!--", lt):
            end = source.find("-->", lt + 4)
            at = size if end < 0 else end + 3
            continue
        if after in ("!", "?") or (after == "/" and not source[lt + 2 : lt + 3].isalpha()):
            end = source.find(">", lt)
            at = size if end < 0 else end + 1
            continue
        if not (after.isascii() and after.isalpha()) and after != "/":
            run.append(("<", link))
            at = lt + 1
            continue
        match = TAG.match(source, lt)
        if match:
            closing, name, attributes, at = match[1], match[2].lower(), match[3], match.end()
        else:
            end = source.find(">", lt)
            if end < 0:  # a tag cut off by the end of the page
                break
            inside = source[lt + 1 : end]
            closing = "/" if inside.startswith("/") else ""
            name, _, attributes = inside.lstrip("/").partition(" ")
            name, at = name.lower(), end + 1
        if name == "br":
            run.append((" ", link))
        elif name in INLINE:
            if name == "a":
                link = not closing
        elif closing:
            if name == "p" or places.get(name):
                end_block()
                link = False
                close((name,))
        elif name in RAW:
            if name != "title":
                run.append((" ", link))
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(source, at)
            at = end.end() if end else size
        else:
            end_block()
            link = False
            close(("p",), ("table", "td", "th", "button", "object"))
            if name in CLOSES_ITSELF:
                close(CLOSES_ITSELF[name], SCOPES[name])
            node = add(name, tokens_of(attributes))
            if name not in VOID and not attributes.endswith("/"):
                places.setdefault(name, []).append(len(stack))
                stack.append(node)
    end_block()
    return nodes

"""A small DOM of a page: block elements and the runs of text in them, with what the features need."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass, field

#: Elements that begin and end a block. Fixed values.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements without content. Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content holds no tags. Fixed values.
RAW = frozenset("script style title textarea iframe noscript noembed noframes xmp".split())
#: Elements whose text is never that of the page. Fixed values.
HIDDEN = frozenset("button datalist head object option select svg template math canvas audio video".split())
CONTROLS = frozenset("input textarea select button label option".split())
#: What a new element of a kind ends if it is open, up to the nearest of the elements after it. Fixed values.
ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
}
_ATTRIBUTES = r"(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+"
_MARKUP = re.compile(rf"<(?:!--.*?(?:-->|\Z)|[!?][^>]*+(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)({_ATTRIBUTES})(?:>|\Z))", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>|</{tag}\Z", re.I) for tag in RAW}


@dataclass
class Node:
    """A block element, or a run of text (tag ''). begin, end: its place among the runs."""

    tag: str
    parent: int
    depth: int
    tokens: list[str] = field(default_factory=list)
    text: str = ""
    link: int = 0
    links: int = 0
    controls: int = 0
    elements: int = 0
    last: int = 0


def _tokens(attributes: str) -> list[str]:
    found = []
    for groups in _NAMES.findall(attributes):
        found += [t.lower() for t in _TOKEN.findall("".join(groups))]
    return found


def parse(page: str) -> list[Node]:
    """The nodes of a page in page order, the first one the page itself. node.last: the last node of its subtree."""
    nodes = [Node("", -1, 0)]
    nodes[0].tag = "page"
    stack = [0]  # open blocks
    places: defaultdict[str, list[int]] = defaultdict(list)  # where in the stack blocks of a tag are, so that nothing walks it
    pieces: list[str] = []
    link_chars = link_count = controls = inline = 0
    in_link = False
    hidden: list[str] = []
    at = 0

    def flush() -> None:
        nonlocal link_chars, link_count, controls, inline
        text = " ".join("".join(pieces).split()) if pieces else ""
        pieces.clear()
        here = nodes[stack[-1]]
        if text:
            nodes.append(Node("", stack[-1], here.depth + 1, [], text, min(link_chars, len(text)), link_count, controls, inline))
        else:
            here.links += link_count
            here.controls += controls
            here.elements += inline
        link_chars = link_count = controls = inline = 0

    def close_to(depth: int) -> None:
        flush()
        while len(stack) > depth:
            closed = nodes[stack.pop()]
            closed.last = len(nodes) - 1
            if stack:
                places[closed.tag].pop()

    def nearest(tags: frozenset[str]) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=0)

    def add(raw: str) -> None:
        nonlocal link_chars
        if raw and not hidden:
            text = html.unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if in_link:
                link_chars += len(text.strip())

    n = len(page)
    while at < n:
        mark = page.find("<", at)
        if mark < 0:
            add(page[at:])
            break
        found = _MARKUP.match(page, mark)
        if found is None:
            add(page[at : mark + 1])
            at = mark + 1
            continue
        add(page[at:mark])
        at = found.end()
        closing, tag, attributes = found.groups()
        if tag is None or page[at - 1] != ">":
            continue
        tag = tag.lower()
        if hidden:
            if tag == hidden[-1] and closing:
                hidden.pop()
            elif tag in HIDDEN and not closing and not attributes.endswith("/") and tag != "head":
                hidden.append(tag)
            elif tag == "body" and hidden == ["head"]:
                hidden.clear()
            else:
                if tag in RAW and not closing:
                    end = _RAW_END[tag].search(page, at)
                    at = end.end() if end else n
                continue
            if tag != "body":
                continue
        if closing:
            if tag == "a":
                in_link = False
            elif tag in BLOCKS:
                if places[tag]:
                    close_to(places[tag][-1])
                else:
                    flush()
            elif tag == "br":
                pieces.append(" ")
            continue
        inline += 1
        if tag in CONTROLS:
            controls += 1
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else n
        elif tag == "a":
            in_link = True
            link_count += 1
        elif tag in ("br", "img", "wbr"):
            if tag == "br":
                pieces.append(" ")
        elif tag in HIDDEN:
            if not attributes.endswith("/"):
                hidden.append(tag)
                if tag == "head":
                    flush()
        elif tag in BLOCKS:
            flush()
            if tag in ENDS:
                ended, bound = ENDS[tag]
                at_ended = nearest(ended)
                if at_ended > nearest(bound):
                    close_to(at_ended)
            elif nodes[stack[-1]].tag == "p":
                close_to(len(stack) - 1)
            elif tag[0] == "h" and tag[1:].isdigit() and nodes[stack[-1]].tag[1:].isdigit():
                close_to(len(stack) - 1)
            own = _tokens(attributes) if attributes else []
            if tag in ("html", "body"):
                nodes[0].tokens += own
            elif tag != "hr":
                nodes.append(Node(tag, stack[-1], nodes[stack[-1]].depth + 1, own))
                places[tag].append(len(stack))
                stack.append(len(nodes) - 1)
    close_to(0)
    return nodes

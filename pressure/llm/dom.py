"""Pages as trees of block elements with text blocks as leaves. Lenient towards broken markup."""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass, field

FEATURES = 1 << 14

# A comment or declaration, or a tag with its attributes (quoted values may hold a greater-than sign).
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|=)*)(?:>|\Z)", re.DOTALL
)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s\"'>]+))|([^\s=\"'/]+)")
NAME_PART = re.compile(r"[a-z]+|[0-9]+")
SPACE = re.compile(r"\s+")

# Elements nested deeper than this become siblings at this depth; their text stays, and their end tags close nothing else.
DEEPEST = 512
# Elements whose content is no text of the page, and whose end is their own end tag only: without one they reach to the end.
RAW = frozenset("script style noscript iframe textarea title".split())
# Elements whose content is no text of the page either; without an end tag, the start tag is as good as absent.
SKIPPED = frozenset("template object svg audio video canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html head body address article aside blockquote button center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol optgroup option p pre search section select summary table tbody "
    "td tfoot th thead tr ul caption".split()
)
# A start tag of the key ends an open element of the first entry, unless one of the second is nearer.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)), "body": (("head",), ()),
}
MAIN = frozenset(("article", "main"))
P_SCOPE = ("td", "th", "button", "table", "caption")
NAMED = ("class", "id", "role", "itemprop", "aria-label", "data-role")

_SLOTS: dict[str, int] = {}


def slot(feature: str) -> int:
    """Place of a feature in the weights."""
    found = _SLOTS.get(feature)
    if found is None:
        if len(_SLOTS) > 200_000:
            _SLOTS.clear()
        found = _SLOTS[feature] = zlib.crc32(feature.encode("utf-8", "replace")) % FEATURES
    return found


@dataclass
class Page:
    """Nodes in page order, parents first. A leaf has a text, an element has none."""

    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    features: list[list[int]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)

    def add(self, parent: int, features: list[int], text: str | None = None) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.features.append(features)
        self.text.append(text)
        return len(self.parent) - 1


def _bucket(n: int) -> int:
    return min(n.bit_length(), 8)


def _amounts(kind: str, words: int, linked: int) -> list[int]:
    share = 0 if not linked else 1 if 3 * linked < words else 2 if linked < words else 3
    return [slot(f"{kind}words {_bucket(words)}"), slot(f"{kind}linked {share}"), slot(f"{kind}both {_bucket(words)} {share}")]


def _element(tag: str, above: str, inside: str, attributes: str) -> list[int]:
    """above: tag of the element around it; inside: "article" if one is around it."""
    found = [slot("element"), slot(f"tag {tag}"), slot(f"tag {tag} in {above}"), slot(f"tag {tag} inside {inside}")]
    if attributes and "=" in attributes or "hidden" in attributes:
        for name, *values, alone in ATTRIBUTE.findall(attributes):
            name, value = (name or alone).lower(), next(filter(None, values), "").lower()
            if name in NAMED:
                found += [slot(f"name {part}") for part in dict.fromkeys(NAME_PART.findall(html.unescape(value)))]
            elif name == "hidden" or name == "style" and "display:none" in value.replace(" ", ""):
                found.append(slot("hidden"))
    return found


def parse(source: str) -> Page:
    page = Page()
    page.add(-1, [slot("root")])
    stack: list[tuple[str, int]] = [("", 0)]  # open elements: tag, node of the nearest block
    total, linked = [0], [0]  # words, and words inside links, below each node
    pieces: list[str] = []  # text of the block that is being read, and whether it is inside a link
    in_link: list[bool] = []
    page_tag = {0: "root"}
    links = 0
    unopened: dict[str, int] = {}  # elements below the deepest that have not ended yet
    endless: set[str] = set()  # skipped elements of which no end tag follows

    def flush() -> None:
        if not pieces:
            return
        text = SPACE.sub(" ", html.unescape("".join(pieces))).strip()
        if text:
            node = stack[-1][1]
            words = text.count(" ") + 1
            own = sum(len(p.split()) for p, a in zip(pieces, in_link, strict=True) if a)
            around = page_tag[node]
            inside = "article" if any(t in MAIN for t, _ in stack) else "page"
            marks = [slot("leaf"), slot(f"leaf in {around}"), slot(f"leaf in {around} inside {inside}"), *_amounts("leaf ", words, own)]
            marks.append(slot(f"leaf ends {text[-1] in '.!?…:;'}"))
            if "©" in text or "All rights" in text:
                marks.append(slot("leaf rights"))
            page.add(node, marks, text)
            total.append(0)
            linked.append(0)
            total[node] += words
            linked[node] += own
        pieces.clear()
        in_link.clear()

    def close(upto: int) -> None:
        """Closes open elements down to that place in the stack."""
        nonlocal links
        unopened.clear()  # what lies deeper ends with them
        for tag, node in stack[: upto - 1 : -1]:
            if tag in BLOCK:
                flush()
                page.features[node] += _amounts("below ", total[node], linked[node])
                if (up := page.parent[node]) >= 0:
                    total[up] += total[node]
                    linked[up] += linked[node]
            elif tag == "a":
                links -= 1
            stack.pop()

    def last(tags: tuple[str, ...], stop: tuple[str, ...] = ()) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in tags:
                return i
            if stack[i][0] in stop:
                break
        return 0

    at, end = 0, len(source)
    while at < end:
        found = TOKEN.search(source, at)
        start = found.start() if found else end
        if start > at:
            pieces.append(source[at:start])
            in_link.append(links > 0)
        if not found:
            break
        at = found.end()
        closing, tag, attributes = found.groups()
        if not tag:
            continue  # a comment or declaration
        tag = tag.lower()
        if closing:
            if unopened.get(tag):
                unopened[tag] -= 1
                if tag in BLOCK:
                    flush()
                continue
            place = last((tag,))
            if place:
                close(place)
            elif tag in BLOCK:
                flush()
            continue
        if (tag in RAW or tag in SKIPPED) and not attributes.endswith("/") and tag not in endless:
            stop = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(source, at)
            if stop:
                at = stop.end()
            elif tag in RAW:
                at = end
            else:
                endless.add(tag)
        if tag in RAW or tag in SKIPPED:
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                pieces.append(" " if tag in ("br", "img", "input", "embed") else "")
                in_link.append(False)
            continue
        if tag in BLOCK:
            flush()
            if place := last(("p",), P_SCOPE):
                close(place)  # no block lies inside a paragraph
            if tag in IMPLIED and (place := last(*IMPLIED[tag])):
                close(place)
            inside = "article" if any(t in MAIN for t, _ in stack) else "page"
            node = page.add(stack[-1][1], _element(tag, page_tag[stack[-1][1]], inside, attributes))
            page_tag[node] = tag
            total.append(0)
            linked.append(0)
            if len(stack) < DEEPEST:
                stack.append((tag, node))
            else:
                unopened[tag] = unopened.get(tag, 0) + 1
        elif not attributes.endswith("/"):
            if len(stack) < DEEPEST:
                links += tag == "a"
                stack.append((tag, stack[-1][1]))
            else:
                unopened[tag] = unopened.get(tag, 0) + 1
    flush()
    close(1)
    page.features[0] += _amounts("below ", total[0], linked[0])
    return page

"""A tolerant reader of HTML: a flat tree of its block elements with their texts, in page order."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from itertools import chain

# What the markup language says of its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SILENT = frozenset(
    "head script style noscript template textarea title iframe object svg annotation annotation-xml "
    "select datalist option button label audio video canvas xmp noembed noframes".split()
)
BLOCK = frozenset(
    "html body address article aside blockquote center details dialog dd div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup li main menu nav ol p pre "
    "search section summary table tbody td tfoot th thead tr ul".split()
) | SILENT
CLOSES_P = BLOCK - SILENT - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot"} | {"hr"}
# A start tag ends open elements of these kinds, up to the nearest of the scope.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, {"html"}),
}
# End of fixed values.

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
# The slash that closes a start tag at once; one at the end of a value without quotes belongs to it.
_AT_ONCE = re.compile(r"(?:^|[\s\"']|(?:^|\s)[^\s=\"']+)/\Z")
FOREIGN = frozenset(("svg", "math"))  # only elements of other languages may end so
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


class Page:
    """Block elements as parallel lists; element 0 is the root and a parent precedes its children.

    `segments` are (element, text, in a link) in page order, and (element, None, False) wherever a block
    begins or ends.
    """

    def __init__(self, html: str) -> None:
        self.tag, self.attributes, self.parent = ["#root"], [""], [-1]
        self.inline = [0]  # inline elements right inside
        self.open: Counter[str] = Counter()  # elements on the stack by tag
        self.segments: list[tuple[int, str | None, bool]] = []
        self.stack = [0]
        self.links = 0
        self.silent = 0
        self._read(html)

    def _read(self, html: str) -> None:
        at, end = 0, len(html)
        lower = None
        while at < end:
            found = _TAG.search(html, at)
            self._text(html[at : found.start() if found else end])
            if not found:
                return
            at = found.end()
            name = found[2] or found[5]
            if not name:
                continue
            name = name.lower()
            if found[1] or found[4]:
                self._close(name)
                continue
            attributes = found[3] or found[6] or ""
            if name in FOREIGN and _AT_ONCE.search(attributes):
                continue
            self._open(name, attributes)
            if name in RAW:
                lower = html.lower() if lower is None else lower
                stop = lower.find(f"</{name}", at)
                if len(lower) != end:  # lower-casing moved offsets
                    match = re.compile(f"</{name}", re.IGNORECASE).search(html, at)
                    stop = match.start() if match else -1
                at = end if stop < 0 else stop

    def _text(self, text: str) -> None:
        if text and not self.silent:
            if "&" in text:
                text = unescape(text)
            self.segments.append((self.stack[-1], text, self.links > 0))

    def _break(self) -> None:
        self.segments.append((self.stack[-1], None, False))

    def _open(self, name: str, attributes: str) -> None:
        if name in CLOSES_P and self.tag[self.stack[-1]] == "p":
            self._pop()
        if name in ENDS:
            kinds, scope = ENDS[name]
            self._end(kinds, scope)
        if name in BLOCK:
            if name in ("html", "body") and name in self.tag:
                return
            self._break()
            self.tag.append(name)
            self.attributes.append(attributes)
            self.parent.append(self.stack[-1])
            self.inline.append(0)
            self.stack.append(len(self.tag) - 1)
            self.open[name] += 1
            self.silent += name in SILENT
            self.links = 0
        else:
            self.inline[self.stack[-1]] += 1
            if name == "br" or name == "hr":
                self._break()
            elif name == "a":
                self.links += 1

    def _end(self, kinds: set[str], scope: set[str]) -> None:
        """Pop up to the outermost open element of `kinds` above the nearest of `scope`."""
        if not any(self.open[kind] for kind in kinds):
            return
        for place in range(len(self.stack) - 1, 0, -1):
            tag = self.tag[self.stack[place]]
            if tag in scope:
                return
            if tag in kinds and not self._open_kind_below(place, kinds, scope):
                while len(self.stack) > place:
                    self._pop()
                return

    def _open_kind_below(self, place: int, kinds: set[str], scope: set[str]) -> bool:
        for lower in range(place - 1, 0, -1):
            tag = self.tag[self.stack[lower]]
            if tag in scope:
                return False
            if tag in kinds:
                return True
        return False

    def _pop(self) -> None:
        self._break()
        name = self.tag[self.stack.pop()]
        self.open[name] -= 1
        self.silent -= name in SILENT
        self.links = 0

    def _close(self, name: str) -> None:
        if name == "a":
            self.links = max(0, self.links - 1)
        elif name == "br":
            self._break()
        elif self.open[name]:
            for place in range(len(self.stack) - 1, 0, -1):
                if self.tag[self.stack[place]] == name:
                    while len(self.stack) > place:
                        self._pop()
                    return

    def text(self, keep: list[bool]) -> str:
        """The text of the kept elements: blocks in page order, joined by single spaces."""
        blocks, current = [], []
        for element, text, _ in chain(self.segments, [(0, None, False)]):
            if text is None:
                if current:
                    blocks += "".join(current).split()
                    current = []
            elif keep[element]:
                current.append(text)
        return " ".join(blocks)


def attribute_words(attributes: str) -> tuple[list[str], bool]:
    """Words of class, id, role and similar attributes, and whether the element is hidden."""
    words, hidden = [], False
    for match in _ATTRIBUTE.finditer(attributes):
        name = match[1].lower()
        value = (match[2] or match[3] or match[4] or "").lower()
        if name in ("class", "id", "role", "itemprop", "aria-label", "data-role", "data-type"):
            words += re.split(r"[^a-z]+", value)
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            hidden = True
    return words, hidden

"""A small tolerant HTML reader: the element tree of a page, with the text of each node."""

from __future__ import annotations

import html
import re

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|[^<]+|<",
    re.S,
)
#: A tag with an odd number of quotes ends at the next bracket.
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Element names by what HTML says of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object select".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html li main menu nav ol p "
    "pre section summary table tbody td tfoot th thead tr ul".split()
)
#: All that may stand in a head; anything else ends it, said or not.
HEAD = frozenset(
    "base basefont bgsound head html link meta noframes noscript script style template title".split()
)
#: Elements without text of their own that other elements may follow; one that is never
#: closed takes nothing else with it.
OPEN_ENDED = frozenset("svg math object select noscript template".split())
#: A start tag that ends an open element, and up to which ancestor it is looked for.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
NO_TEXT = RAW | {"head", "button", "label", "input"}


class Page:
    """Elements in page order; 0 is a root above all of them.

    tag, parent, depth and attrs (class, id and role in lower case) are per element. text
    has (element, string) in page order, raw elements left out.
    """

    def __init__(self, source: str):
        self.tag, self.parent, self.depth, self.attrs = ["#root"], [-1], [0], [""]
        self.text: list[tuple[int, str]] = []
        self._open = [0]
        self._read(source)

    def _close(self, names: tuple[str, ...], stop: tuple[str, ...]) -> None:
        for i in range(len(self._open) - 1, 0, -1):
            name = self.tag[self._open[i]]
            if name in names:
                del self._open[i:]
                return
            if name in stop:
                return

    def _start(self, name: str, attributes: str) -> None:
        if name not in HEAD:
            self._close(("head",), ("body",))
        if name in BLOCK:
            self._close(("p",), ("button", "td", "th", "article", "section", "div", "li"))
        if name in ENDS:
            self._close(*ENDS[name])
        marks = ""
        if attributes:
            found = [
                (a or b or c).lower()
                for k, a, b, c in ATTRIBUTE.findall(attributes)
                if k.lower() in ("class", "id", "role", "itemprop", "aria-label")
            ]
            marks = " ".join(found)
        self.tag.append(name)
        self.parent.append(self._open[-1])
        self.depth.append(len(self._open))
        self.attrs.append(marks)
        if name in BLOCK:
            self.text.append((len(self.tag) - 1, ""))
        elif name in ("br", "hr"):
            self.text.append((self._open[-1], " "))

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            m = TOKEN.match(source, at)
            if m.group() == "<":
                m = LOOSE.match(source, at) or m
            at = m.end()
            name = m.group(2) if m.re is LOOSE or m.lastindex else None
            if name is None:
                piece = m.group()
                if piece[0] != "<" or piece == "<":
                    if self.tag[self._open[-1]] == "head" and piece.strip():
                        self._open.pop()
                    self.text.append((self._open[-1], piece))
                continue
            name = name.lower()
            if m.group(1):
                for i in range(len(self._open) - 1, 0, -1):
                    if self.tag[self._open[i]] == name:
                        del self._open[i:]
                        break
                continue
            self._start(name, m.group(3))
            if name in VOID or (m.group(3).endswith("/") and name in RAW):
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = end.end() if end else at if name in OPEN_ENDED else n
                continue
            self._open.append(len(self.tag) - 1)

    def blocks(self, keep: list[bool]) -> str:
        """The text of kept elements: white space inside a block becomes one space, blocks
        are joined by a line feed."""
        block = list(range(len(self.tag)))
        for i in range(1, len(self.tag)):
            if self.tag[i] not in BLOCK:
                block[i] = block[self.parent[i]]
        out: list[tuple[int, list[str]]] = []
        for node, piece in self.text:
            home = block[node] if keep[node] else -1
            if not out or out[-1][0] != home:
                out.append((home, []))
            if keep[node]:
                out[-1][1].append(html.unescape(piece))
        lines = (" ".join("".join(parts).split()) for _, parts in out)
        return "\n".join(x for x in lines if x)

"""Leaf blocks of an HTML page: their text, tag path and share of link text."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)(?:>|\Z)",
    re.DOTALL,
)
_NAMING = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")

# Fixed values of the HTML standard: elements without content, elements whose content is no
# text of the page, elements that stand as blocks, and which start tags end an open element.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset("script style template title textarea noscript iframe svg math object canvas select".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead "
    "tr ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"datalist"}),
}
#: Start tags that end an open paragraph.
ENDS_P = BLOCKS - {"body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "legend"}


@dataclass
class Block:
    """Words of a leaf, the tags and names on its path, and characters within links."""

    words: list[str]
    path: list[str]
    linked: int = 0
    text: str = field(default="")


def _names(rest: str) -> list[str]:
    found = []
    for match in _NAMING.finditer(rest):
        found += ["." + part for part in _PART.findall((match[1] or match[2] or match[3] or "").lower())]
    return found


class _Reader:
    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.open: list[tuple[str, list[str]]] = []
        self.pieces: list[str] = []
        self.path: list[str] = []
        self.linked = self.links = 0

    def text(self, raw: str) -> None:
        if not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if not self.path and not text.isspace():
            self.path = [name for _, names in self.open for name in names]
        self.pieces.append(text)
        if self.links:
            self.linked += len(text)

    def flush(self) -> None:
        if self.pieces:
            words = "".join(self.pieces).split()
            if words:
                self.blocks.append(Block(words, self.path, self.linked, " ".join(words)))
            self.pieces, self.path, self.linked = [], [], 0

    def pop_to(self, index: int) -> None:
        self.links -= sum(name == "a" for name, _ in self.open[index:])
        del self.open[index:]

    def close(self, names: set[str] | frozenset[str], until: set[str]) -> None:
        """End the outermost open element of `names` within the innermost one of `until`."""
        found = None
        for index in range(len(self.open) - 1, -1, -1):
            name = self.open[index][0]
            if name in until:
                break
            if name in names:
                found = index
        if found is not None:
            self.pop_to(found)

    def start(self, name: str, rest: str) -> None:
        if name in BLOCKS:
            self.flush()
            if name in ENDS_P:
                self.close({"p"}, {"table", "td", "th", "button"})
            if name in CLOSES:
                self.close(*CLOSES[name])
        if name == "br":
            self.pieces.append(" ")
        elif name not in VOID and not (rest.endswith("/") and name not in BLOCKS):
            self.links += name == "a"
            self.open.append((name, [name, *_names(rest)] if "=" in rest else [name]))

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.flush()
        for index in range(len(self.open) - 1, -1, -1):
            if self.open[index][0] == name:
                self.pop_to(index)
                return
            # A stray inline end tag doesn't end blocks around it.
            if name not in BLOCKS and self.open[index][0] in BLOCKS:
                return


def blocks_of(page: str | None) -> list[Block]:
    """Blocks in page order; a run of text between tags of block elements is one block."""
    if not page:
        return []
    reader = _Reader()
    place = 0
    while match := _MARKUP.search(page, place):
        reader.text(page[place : match.start()])
        place = match.end()
        name = match["name"]
        if name is None:
            continue
        name = name.lower()
        if match["end"]:
            reader.end(name)
        elif name in UNSEEN:
            if not match["rest"].endswith("/") or name in ("script", "style", "title", "textarea"):
                after = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(page, place)
                place = after.start() if after else len(page)
        else:
            reader.start(name, match["rest"])
    reader.text(page[place:])
    reader.flush()
    return reader.blocks

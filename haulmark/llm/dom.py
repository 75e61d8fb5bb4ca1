"""HTML as a tree of block elements and the runs of text in them.

Inline elements are part of the run that they stand in. Scripts, styles,
controls of forms and embedded objects are left out. Missing end tags are
supplied as browsers do for paragraphs, list items, table cells and whatever is
open when an outer element ends; end tags without a start are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

# Elements by the way HTML lays them out.
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
BLOCKS = frozenset(
    "html body article main section div p ul ol dl li dt dd nav header footer aside form fieldset table caption thead tbody"
    " tfoot tr td th blockquote pre figure figcaption address details summary center dialog hgroup search menu legend".split()
    + list(HEADINGS)
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "head script style title noscript template svg math iframe object canvas audio video select option datalist textarea"
    " button label noembed noframes applet map".split()
)
# an open element of the first kind ends where one of the second starts, up to an element of the third
SUPPLIED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
}
TEXT = "#text"
NAMED = ("class", "id", "role", "aria-label", "itemprop")
SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
LABEL = "data-content"
# a quote counts only after an equals sign; nothing here is read twice
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')|=)*+)>""")
UNFINISHED = re.compile(r"</?[a-zA-Z]")
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
RAW = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in ("script", "style", "title", "textarea", "iframe", "noembed")}


class Page:
    """Nodes in the order of the page; parents come before their children."""

    def __init__(self) -> None:
        self.parent: list[int] = [-1]
        self.tag: list[str] = [""]
        self.names: list[tuple[str, ...]] = [()]
        self.hidden: list[bool] = [False]
        self.labelled: list[bool] = [False]
        self.text: list[str] = [""]
        self.linked: list[int] = [0]  # characters of the text that stand in links
        self.controls: list[int] = [0]

    def add(self, parent: int, tag: str, names: tuple[str, ...] = (), hidden: bool = False, labelled: bool = False) -> int:
        columns = (self.parent, self.tag, self.names, self.hidden, self.labelled, self.text, self.linked, self.controls)
        for column, value in zip(columns, (parent, tag, names, hidden, labelled, "", 0, 0), strict=True):
            column.append(value)
        return len(self.tag) - 1

    def merged(self) -> Page:
        """An element whose only child is a run of text holds the text itself."""
        children = Counter(self.parent)
        page, place = Page(), [0] * len(self.tag)
        for i in range(1, len(self.tag)):
            up = self.parent[i]
            if self.tag[i] == TEXT and up and children[up] == 1:
                place[i] = place[up]
            else:
                place[i] = page.add(place[up], self.tag[i], self.names[i], self.hidden[i], self.labelled[i])
            at = place[i]
            page.text[at] = page.text[at] or self.text[i]
            page.linked[at] += self.linked[i]
            page.controls[at] += self.controls[i]
        page.controls[0] = self.controls[0]
        return page


def attributes_of(source: str) -> dict[str, str]:
    return {name.lower(): unescape(a or b or c) for name, a, b, c in ATTRIBUTE.findall(source)}


def words_of_names(attributes: dict[str, str]) -> tuple[str, ...]:
    return tuple(word.lower() for key in NAMED if key in attributes for word in SPLIT.split(attributes[key]) if word)


class _Builder:
    def __init__(self) -> None:
        self.page = Page()
        self.open: list[tuple[str, int]] = [("", 0)]
        self.counts: Counter = Counter()
        self.pieces: list[str] = []
        self.in_link = False
        self.link_depth = 0  # open blocks where the link started
        self.linked = 0
        self.dropped = ""  # the element that is being left out
        self.inside: Counter = Counter()  # what opened in it

    def flush(self) -> None:
        if not self.pieces:
            return
        text = " ".join("".join(self.pieces).split())
        if text:
            at = self.page.add(self.open[-1][1], TEXT)
            self.page.text[at] = text
            self.page.linked[at] = min(self.linked, len(text))
        self.pieces.clear()
        self.linked = 0

    def pop(self, depth: int) -> None:
        """Close the open elements from this depth on."""
        self.flush()
        for tag, _ in self.open[depth:]:
            self.counts[tag] -= 1
        del self.open[depth:]
        if self.link_depth > depth:
            self.in_link = False

    def nearest(self, tags: tuple[str, ...], walls: tuple[str, ...]) -> int | None:
        if not any(self.counts[t] for t in tags):
            return None
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth][0] in tags:
                return depth
            if self.open[depth][0] in walls:
                return None
        return None

    def start(self, tag: str, source: str) -> None:
        if self.dropped == "head" and tag in BLOCKS:
            self.dropped = ""
        if self.dropped:
            self.inside[tag] += tag not in VOID
        elif tag in DROPPED:
            self.page.controls[self.open[-1][1]] += tag in ("button", "select", "textarea", "label")
            self.dropped, self.inside = tag, Counter()
        elif tag in VOID:
            if tag == "hr":
                self.flush()
            elif tag == "br":
                self.pieces.append(" ")
            elif tag == "input":
                self.page.controls[self.open[-1][1]] += attributes_of(source).get("type", "").lower() != "hidden"
        elif tag in BLOCKS:
            self.start_block(tag, attributes_of(source) if source else {})
        elif tag == "a" and "href" in source.lower():
            self.in_link, self.link_depth = True, len(self.open)

    def start_block(self, tag: str, attributes: dict[str, str]) -> None:
        self.flush()
        if self.open[-1][0] == "p":
            self.pop(len(self.open) - 1)
        if tag in SUPPLIED and (depth := self.nearest(*SUPPLIED[tag])):
            self.pop(depth)
        if tag in ("html", "body") and self.counts[tag]:
            return
        style = attributes.get("style", "").replace(" ", "").lower()
        hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in style
        node = self.page.add(self.open[-1][1], tag, words_of_names(attributes), hidden, LABEL in attributes)
        self.open.append((tag, node))
        self.counts[tag] += 1

    def end(self, tag: str) -> None:
        if self.dropped:
            if self.inside[tag]:
                self.inside[tag] -= 1
                return
            if tag == self.dropped:
                self.dropped = ""
                return
            if tag not in BLOCKS or not self.counts[tag]:
                return
            self.dropped = ""  # the element around it ends
        if tag == "a":
            self.in_link = False
        elif tag in BLOCKS and self.counts[tag] and (depth := self.nearest((tag,), ())):
            self.pop(depth)

    def data(self, text: str) -> None:
        if text and not self.dropped:
            text = unescape(text) if "&" in text else text
            self.pieces.append(text)
            if self.in_link:
                self.linked += len(text.strip())

    def read(self, html: str) -> None:
        at = 0
        while (tag := html.find("<", at)) >= 0:
            self.data(html[at:tag])
            if found := TAG.match(html, tag):
                closing, name, source = found.groups()
                name, at = name.lower(), found.end()
                if closing:
                    self.end(name)
                    continue
                self.start(name, source)
                if name in RAW:
                    end = RAW[name].search(html, at)
                    at = end.start() if end else len(html)
            elif UNFINISHED.match(html, tag):
                return  # the page ends inside a tag
            elif html.startswith(("<!", "<?", "</"), tag):
                comment = html.startswith("<!--", tag)
                end = html.find("-->" if comment else ">", tag + 2)
                if end < 0:
                    return
                at = end + (3 if comment else 1)
            else:
                self.data("<")
                at = tag + 1
        self.data(html[at:])


def parse(html: str) -> Page:
    """The page's tree; node 0 is the document itself."""
    builder = _Builder()
    builder.read(html)
    builder.flush()
    return builder.page.merged()

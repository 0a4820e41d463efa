"""HTML pages as flat node tables: one pass over the tags, no tree objects."""

from __future__ import annotations

import html
import re

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript svg math iframe object title textarea".split())
SILENT = RAW - {"textarea"}  # their content is never text
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot th thead tr ul".split()
)
#: an opening tag first closes these, up to the container
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: blocks that end an open paragraph
ENDS_P = BLOCK - {"body", "html", "button", "option", "select", "textarea", "caption", "legend", "summary", "td", "th", "tr", "tbody", "thead", "tfoot"}
SCOPE = frozenset("button td th caption table body object".split())
MARKS = ("class", "id", "role", "itemprop", "aria-label", "data-role", "name")
WORDS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Page:
    """Nodes in document order: tag, parent, end (one past the last node below), depth, marks, hidden.

    ``texts`` are (node, block, text) in page order, character references decoded; texts of one
    block number belong to one block.
    """

    def __init__(self, source: str):
        self.tag, self.parent, self.end, self.depth = ["#page"], [-1], [0], [0]
        self.marks: list[list[str]] = [[]]
        self.hidden = [False]
        self.texts: list[tuple[int, int, str]] = []
        self._stack = [0]
        self._block = 0
        self._read(source)
        while self._stack:
            self._close()

    def _close(self) -> None:
        node = self._stack.pop()
        self.end[node] = len(self.tag)
        if self.tag[node] in BLOCK:
            self._block += 1

    def _open(self, tag: str, attributes: str) -> None:
        if tag in ENDS_P:
            for k in range(len(self._stack) - 1, 0, -1):
                name = self.tag[self._stack[k]]
                if name == "p":
                    while len(self._stack) > k:
                        self._close()
                    break
                if name in SCOPE or name in ENDS_P:
                    break
        if tag in CLOSES:
            names, stop = CLOSES[tag]
            for k in range(len(self._stack) - 1, 0, -1):
                name = self.tag[self._stack[k]]
                if name in stop:
                    break
                if name in names:
                    while len(self._stack) > k:
                        self._close()
                    if tag not in ("tbody", "tfoot", "tr"):
                        break
        if tag in BLOCK:
            self._block += 1
        marks: list[str] = []
        hidden = False
        if attributes.strip(" /"):
            for name, *values in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), "".join(values)
                if name in MARKS:
                    marks += WORDS.findall(CAMEL.sub(" ", value).lower())
                elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                    hidden = True
                elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    hidden = True
        self.parent.append(self._stack[-1])
        self.depth.append(len(self._stack))
        self.tag.append(tag)
        self.end.append(len(self.tag))
        self.marks.append(marks)
        self.hidden.append(hidden)
        self._stack.append(len(self.tag) - 1)

    def _shut(self, tag: str) -> None:
        for k in range(len(self._stack) - 1, 0, -1):
            if self.tag[self._stack[k]] == tag:
                while len(self._stack) > k:
                    self._close()
                return
            if tag not in BLOCK and self.tag[self._stack[k]] in BLOCK:
                return  # an inline end tag doesn't end a block

    def _text(self, raw: str) -> None:
        if raw and not raw.isspace():
            self.texts.append((self._stack[-1], self._block, html.unescape(raw) if "&" in raw else raw))
        elif raw and self.texts and self.texts[-1][1] == self._block:
            node, block, text = self.texts[-1]
            self.texts[-1] = (node, block, text + " ")

    def _read(self, source: str) -> None:
        at = 0
        while True:
            m = TAG.search(source, at)
            if m is None:
                self._text(source[at:])
                return
            self._text(source[at : m.start()])
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<![CDATA["):
                    self._text(m[0][9:].removesuffix("]]>"))
                continue
            tag = m[2].lower()
            if m[1]:
                self._shut(tag)
            elif tag in VOID:
                if tag in ("br", "hr"):
                    self._text(" ")
                    self._block += tag == "hr"
            elif m[3].endswith("/") and tag in SILENT:
                pass
            else:
                self._open(tag, m[3])
                if tag in RAW:
                    close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(source, at)
                    inner = source[at : close.start() if close else len(source)]
                    at = close.end() if close else len(source)
                    if tag not in SILENT:
                        self._text(inner)
                    self._close()


def blocks(page: Page, keep) -> str:
    """The texts of kept nodes: white space made one blank, blocks joined by an empty line."""
    out: list[str] = []
    last, parts = -1, []
    for node, block, text in page.texts:
        if not keep[node]:
            continue
        if block != last:
            out.append(" ".join("".join(parts).split()))
            last, parts = block, []
        parts.append(text)
    out.append(" ".join("".join(parts).split()))
    return "\n\n".join(b for b in out if b)

"""Outline of one HTML page: its tables and the text blocks holding wanted labels.

Keeps just the tree rules that tables depend on: an end tag closes everything
opened since its start tag, void tags never stay open, and a row or cell belongs
to every table or row still open around it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from html import unescape

# Tags without content, tags whose text is not page text, label blocks.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("script style template rt rp".split())
BLOCK_TAGS = frozenset("p div h1 h2 h3".split())

_TOKEN = re.compile(
    r"<(?:"
    r"/([a-zA-Z][^\s/>]*)[^>]*>"                                           # 1 end tag
    r"|(script|style)(?=[\s/>])[^>]*(?<!/)>.*?(?:</\2(?=[\s/>])[^>]*>|\Z)"       # 2 raw text, never shown
    r"|([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"               # 3 start tag, 4 attributes
    r"|!\[CDATA\[(.*?)(?:\]\]>|\Z)"                                       # 5 character data
    r"|!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)"                                # comment, declaration
    r")", re.S | re.I)


class PageOutline:
    """Text nodes in order; tables, rows, cells and blocks as spans over them."""

    def __init__(self, html: str):
        self.texts: list[str] = []
        self.tables: list[list[list]] = []   # table -> rows -> cells [first text, end text, tag]
        self.blocks: list[list] = []         # [first text, end text]
        self._open: list[tuple[str, list | None]] = []
        self._counts: dict[str, int] = {}
        self._hidden = 0
        at = 0
        for token in _TOKEN.finditer(html):
            begin = token.start()
            if begin > at:
                self._text(unescape(html[at:begin]))
            at = token.end()
            kind = token.lastindex
            if kind == 4:
                tag = token[3].lower()
                self._start(tag)
                if token[4][-1:] == "/":
                    self._end(tag)
            elif kind == 1:
                self._end(token[1].lower())
            elif kind == 5:
                self._text(token[5])
        if at < len(html):
            self._text(unescape(html[at:]))
        while self._open:
            self._pop()

    def _text(self, text: str):
        if not self._hidden:
            text = text.strip()
            if text:
                self.texts.append(text.replace("\xa0", " ").replace("&nbsp;", " "))

    def _start(self, tag: str):
        if tag in VOID_TAGS:
            return
        item = None
        if tag == "td" or tag == "th":
            item = [len(self.texts), None, tag]
            self._give("tr", item)
        elif tag == "tr":
            item = []
            self._give("table", item)
        elif tag == "table":
            item = []
            self.tables.append(item)
        elif tag in BLOCK_TAGS:
            item = [len(self.texts), None]
            self.blocks.append(item)
        elif tag in HIDDEN_TAGS:
            self._hidden += 1
        self._open.append((tag, item))
        self._counts[tag] = self._counts.get(tag, 0) + 1

    def _give(self, holder: str, item: list):
        if self._counts.get(holder):
            for name, children in self._open:
                if name == holder:
                    children.append(item)

    def _end(self, tag: str):
        if self._counts.get(tag):
            while self._pop() != tag:
                pass

    def _pop(self) -> str:
        tag, item = self._open.pop()
        self._counts[tag] -= 1
        if item is None:
            self._hidden -= tag in HIDDEN_TAGS
        elif tag != "table" and tag != "tr":
            item[1] = len(self.texts)
        return tag

    def text(self, span) -> str:
        return " ".join(self.texts[span[0]:span[1]]).strip()

    def labelled(self, labels) -> dict[str, str]:
        """Per label, the text of the first block that contains it."""
        if not self.blocks:
            return {}
        whole = " ".join(self.texts)
        starts, at = [], 0
        for t in self.texts:
            starts.append(at)
            at += len(t) + 1
        starts.append(at)
        found = {}
        for label in labels:
            hits, pos = [], whole.find(label)
            while pos >= 0:
                hits.append(pos)
                pos = whole.find(label, pos + 1)
            for block in self.blocks if hits else ():
                i = bisect_left(hits, starts[block[0]])
                if i < len(hits) and hits[i] + len(label) < starts[block[1]]:
                    found[label] = self.text(block)
                    break
        return found

"""Readable text of HTML pages."""

from __future__ import annotations

import html.entities
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import patterns as P

# Elements that never have content or an end tag, and elements whose text is not reading text.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem", "meta", "param",
        "source", "track", "wbr", "basefont", "bgsound", "command", "frame", "image", "isindex", "nextid", "spacer"}
SIDE_TEXT = {"template", "rt", "rp"}


class _TextNodes(HTMLParser):
    """Collects text nodes outside of skipped elements.

    The stack of open elements decides what an unclosed element contains: it ends when an enclosing
    element ends.  An end tag without open element is ignored.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.open: list[str] = []
        self.muted = 0
        self.nodes: list[str] = []
        self.node: list[str] = []

    def updatepos(self, i, j):
        """Lines aren't counted: nobody asks for a tag's position."""
        return j

    def _end_node(self) -> None:
        if self.node:
            self.nodes.append("".join(self.node))
            self.node = []

    def _text(self, data: str) -> None:
        if not self.muted:
            self.node.append(data)

    def handle_starttag(self, tag, attrs):
        self._end_node()
        if tag not in VOID:
            self.open.append(tag)
            self.muted += tag in P.SKIPPED_TAGS or tag in SIDE_TEXT

    def handle_startendtag(self, tag, attrs):
        self._end_node()

    def handle_endtag(self, tag):
        self._end_node()
        if tag in self.open:
            while True:
                closed = self.open.pop()
                self.muted -= closed in P.SKIPPED_TAGS or closed in SIDE_TEXT
                if closed == tag:
                    break

    def handle_data(self, data):
        self._text(data)

    def handle_entityref(self, name):
        self._text(html.entities.html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        self._text(html.unescape(f"&#{name};"))

    def handle_comment(self, data):
        self._end_node()

    def handle_decl(self, decl):
        self._end_node()

    def handle_pi(self, data):
        self._end_node()

    def unknown_decl(self, data):
        self._end_node()
        if data.upper().startswith("CDATA["):
            self._text(data[len("CDATA[") :])
            self._end_node()


def page_lines(page: str | None) -> str | None:
    """The non-blank lines of a page's text nodes."""
    if page is None:
        return None
    parser = _TextNodes()
    parser.feed(page)
    parser.close()
    parser._end_node()
    lines = (line.strip() for line in "\n".join(parser.nodes).splitlines())
    return "\n".join(line for line in lines if line)


@F.arrow_udf(T.StringType())
def html_lines(pages: pa.Array) -> pa.Array:
    """Arrow-batched, one page at a time; NULL stays NULL at no cost, so callers pass NULL for rows that are not HTML."""
    parts = [pa.array([page_lines(page.as_py()) for page in pages.slice(at, 256)], pa.string()) for at in range(0, len(pages), 256)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

"""Lenient HTML to text, by the same rules of blocks, rows and cells as tagged documents."""

from __future__ import annotations

from html.parser import HTMLParser

from ..operators.parse import BLOCK, CELL, DROP, _squeezed, _tidy


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.dropped = 0
        self.cells: list[list[str]] = []  # of each open row, its cells' texts
        self.open_cells: list[list[str]] = []

    def _put(self, text: str) -> None:
        (self.open_cells[-1] if self.open_cells else self.parts).append(text)

    def handle_starttag(self, tag, attrs):
        if tag in DROP:
            self.dropped += 1
        elif tag == "tr":
            self.cells.append([])
        elif tag in CELL and self.cells:
            self.open_cells.append([])
        elif tag in BLOCK:
            self._put("\n")

    def handle_endtag(self, tag):
        if tag in DROP:
            self.dropped = max(0, self.dropped - 1)
        elif tag in CELL and self.open_cells and self.cells:
            if text := _squeezed("".join(self.open_cells.pop())):
                self.cells[-1].append(text)
        elif tag == "tr" and self.cells:
            row = self.cells.pop()
            self._put("\n" + " | ".join(row) + "\n")
        elif tag in BLOCK:
            self._put("\n")

    def handle_data(self, data):
        if not self.dropped:
            self._put(data)


def render_html(html: str | None) -> str | None:
    if html is None:
        return None
    r = _Reader()
    r.feed(html)
    r.close()
    return _tidy(r.parts)

"""What a page's HTML holds: title, lines of the article, headings, link density, a lone link, cells of recipe boxes.

The page is parsed once per row, by the standard library's tolerant parser.
"""

from __future__ import annotations

import json
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCKS = frozenset("address article aside blockquote br div dd dl dt figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td th thead tr ul".split())
_HIDDEN = frozenset(["script", "style", "template", "noscript", "svg"])
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Where pages have their content, recipe boxes, their cells, an icon's name, and a scene's notes.
CONTENT_ID, RECIPES, BOX, GRID, ICON, SCENE, NOTE = "page-content", "recipe-container", "recipeBoxLayout", "ingredient-box", "aria-description", "data-scene-in-world-annotations", "contentTemplateId"


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title, self.lines, self.headings, self.links = "", [], [], []
        self.line: list[str] = []
        self.text: list[str] = []
        self.inside = self.hidden = 0
        self.seen = False
        self.heading: tuple[int, list[str]] | None = None
        self.link: tuple[str, list[str]] | None = None
        self.in_title = False
        self.all_lines: list[str] = []
        self.content: list[str] = []
        self.open: list[tuple[str, str | None]] = []  # open elements below the article, with what begins at them
        self.template: tuple[str, list[str]] | None = None
        self.templates: dict[str, str] = {}

    def _in(self, what: str) -> bool:
        return any(w == what for _, w in self.open)

    def _end_line(self) -> None:
        joined = " ".join("".join(self.line).split())
        if joined:
            self._add(joined)
        self.line = []

    def _add(self, line: str | tuple) -> None:
        self.all_lines.append(line)
        if self.inside:
            self.lines.append(line)
            if self._in("content"):
                self.content.append(line)

    def filled(self, lines: list) -> list[str]:
        """Lines with the notes of scenes in their places; templates may stand anywhere on the page."""
        out = []
        for x in lines:
            out += [t for i in x if (t := self.templates.get(i))] if isinstance(x, tuple) else [x]
        return out

    def _begin(self, tag: str, attrs: dict[str, str | None]) -> None:
        classes = (attrs.get("class") or "").split()
        if SCENE in attrs and self.inside:
            self._end_line()
            try:
                notes = json.loads(attrs[SCENE] or "")
            except ValueError:
                notes = []
            ids = tuple(n.get(NOTE) for n in notes if isinstance(n, dict)) if isinstance(notes, list) else ()
            if ids:
                self._add(ids)
        if tag == "template":
            self.template = (attrs.get("id") or "", [])
        if self.inside and tag not in _VOID:
            begins = "content" if attrs.get("id") == CONTENT_ID else "recipes" if RECIPES in classes else None
            self.open.append((tag, begins))
            self.hidden += begins == "recipes"

    def _finish(self, tag: str) -> None:
        if tag == "template" and self.template:
            name, parts = self.template
            if name:
                self.templates[name] = " ".join(" ".join(parts).split())
            self.template = None
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                for _, begins in self.open[i:]:
                    self.hidden -= begins == "recipes"
                del self.open[i:]
                break

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _HIDDEN:
            self.hidden += 1
        elif tag == "title":
            self.in_title = True
        if tag in _BLOCKS:
            self._end_line()
        self._begin(tag, dict(attrs))
        if tag == "article":
            self.inside += not self.seen or self.inside > 0
            self.seen = True
        elif tag in ("h1", "h2", "h3") and self.inside:
            self.heading = (int(tag[1]), [])
        elif tag == "a" and self.inside:
            self.link = (dict(attrs).get("href") or "", [])

    def handle_endtag(self, tag: str) -> None:
        if tag in _HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        elif tag == "title":
            self.in_title = False
        if tag == "a" and self.link:
            self.links.append((self.link[0], " ".join("".join(self.link[1]).split())))
            self.link = None
        if tag in ("h1", "h2", "h3") and self.heading:
            if text := " ".join("".join(self.heading[1]).split()):
                self.headings.append((self.heading[0], text))
            self.heading = None
        if tag in _BLOCKS:
            self._end_line()
        self._finish(tag)
        if tag == "article":
            self.inside = max(0, self.inside - 1)

    def handle_data(self, data: str) -> None:
        if self.template:
            self.template[1].append(data)
        if self.hidden:
            return
        if self.in_title:
            self.title += data
            return
        self.line.append(data)
        if self.inside:
            self.text.append(data)
            if self.heading:
                self.heading[1].append(data)
            if self.link:
                self.link[1].append(data)


SCHEMA = "title string, text string, headings array<struct<level: int, text: string>>, link_density double, redirect_to string"
#: Fixed value: the text of a page that only points to another one, besides the link.
MARKER = "See"


def read_page(html: str | None) -> tuple:
    """(title, text, headings, link density, redirect target) of a page, of its first article where there is one.

    The text is that of the content element in the article if there is one, without recipe boxes; a scene's notes,
    which templates elsewhere hold, stand as lines where the scene is.

    Density is the length of the links' text over that of the whole. A page whose article, headings aside, is ``See``
    and one link points to another. Null gives nulls.
    """
    if html is None:
        return None, None, [], None, None
    r = _Reader()
    r.feed(html)
    r.close()
    r._end_line()
    whole = " ".join("".join(r.text).split())
    linked = sum(len(t) for _, t in r.links)
    lines = r.filled(r.content or r.lines or r.all_lines)
    heads = {t for level, t in r.headings if level == 1}
    words = [w for x in r.lines if isinstance(x, str) and x not in heads for w in x.split()]
    target = r.links[0][0] if len(r.links) == 1 and words == [*MARKER.split(), *r.links[0][1].split()] else None
    return " ".join(r.title.split()) or None, "\n".join(lines), r.headings, linked / len(whole) if whole else 0.0, target


def page_parts(html: str) -> Column:
    """``read_page`` for a column, as a struct."""

    def parts(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read_page(x) for x in pages], columns=["title", "text", "headings", "link_density", "redirect_to"])

    return F.pandas_udf(parts, SCHEMA)(html)


CELLS = "array<struct<box: int, part: int, cell: int, slot: string, grid: int, icon: string, text: string, pos: int>>"


class _Boxes(HTMLParser):
    """A row for each part of each recipe box, and for each icon and text in it, with where it stands."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple] = []
        self.open: list[str] = []
        self.base = None
        self.box = self.part = self.cell = self.grid = -1
        self.slot = ""
        self.in_article = 0

    def _row(self, icon: str | None, text: str | None) -> None:
        self.rows.append((self.box, self.part, self.cell, self.slot, self.grid, icon, text, len(self.rows)))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = dict(attrs)
        classes = (a.get("class") or "").split()
        self.in_article += tag == "article"
        if tag not in _VOID:
            self.open.append(tag)
        depth = len(self.open) + (tag in _VOID)
        if self.base is None:
            if self.in_article and BOX in classes and tag not in _VOID:
                self.base, self.box, self.part = depth, self.box + 1, -1
            return
        if depth == self.base + 1:
            self.part, self.cell, self.grid, self.slot = self.part + 1, -1, -1, ""
            self._row(None, None)
        elif depth == self.base + 2:
            self.cell, self.slot = self.cell + 1, (classes[0].rpartition("-")[2] if classes else "")
        if GRID in classes:
            self.grid += 1
        if tag == "img" and a.get(ICON):
            self._row(a[ICON], None)

    def handle_endtag(self, tag: str) -> None:
        self.in_article -= tag == "article" and self.in_article > 0
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i] == tag:
                del self.open[i:]
                break
        if self.base is not None and len(self.open) < self.base:
            self.base = None

    def handle_data(self, data: str) -> None:
        if self.base is not None and self.part >= 0 and data.strip():
            self._row(None, " ".join(data.split()))


def recipe_cells(html: str) -> Column:
    """The cells of a page's recipe boxes."""

    def cells(pages: pd.Series) -> pd.Series:
        out = []
        for x in pages:
            b = _Boxes()
            b.feed(x or "")
            out.append([dict(zip(("box", "part", "cell", "slot", "grid", "icon", "text", "pos"), r)) for r in b.rows])
        return pd.Series(out)

    return F.pandas_udf(cells, CELLS)(html)

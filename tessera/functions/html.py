"""HTML table functions on the standard parser, as Arrow functions over batches of pages."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import escape
from html.parser import HTMLParser
from urllib.parse import unquote, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "p": {"p"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
_SCOPES = {"li": ("ul", "ol"), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "p": ("div", "td", "li", "section"), "option": ("select",), "dt": ("dl",), "dd": ("dl",)}
# The largest spans of the HTML standard.
_MOST = {"rowspan": 65_534, "colspan": 1_000}


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)

    def walk(self):
        """The nodes below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            if node.children:
                stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def find_all(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags]

    def text(self, *, breaks: bool = False) -> str:
        """The text, with single spaces; with ``breaks`` line breaks and blocks keep their line ends."""
        parts: list[str] = []
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                parts.append(item)
                continue
            if item.tag in ("script", "style"):
                continue
            if breaks and item.tag in ("br", "p", "div", "li", "tr"):
                parts.append("\n")
            stack += reversed(item.children)
        text = "".join(parts)
        if breaks:
            return "\n".join(x for x in (" ".join(line.split()) for line in text.split("\n")) if x)
        return " ".join(text.split())

    def raw(self, without: tuple[str, ...] = ()) -> str:
        """The text as it stands, without that of elements below of some tags."""
        parts: list[str] = []
        stack: list[Node | str] = list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                parts.append(item)
            elif item.tag not in without and item.tag not in ("script", "style"):
                stack += reversed(item.children)
                if item.tag == "br":
                    parts.append("\n")
        return "".join(parts)

    def html(self) -> str:
        """The element's content as HTML again."""
        out = []
        for c in self.children:
            if isinstance(c, str):
                out.append(escape(c, quote=False))
            else:
                attrs = "".join(f' {k}="{escape(v)}"' for k, v in c.attrs.items())
                out.append(f"<{c.tag}{attrs}>" + ("" if c.tag in _VOID else f"{c.html()}</{c.tag}>"))
        return "".join(out)

    @property
    def classes(self) -> frozenset[str]:
        return frozenset(self.attrs.get("class", "").split())

    def rows(self) -> list[Node]:
        """A table's own rows; those at any depth where it has none of its own."""
        own = [r for part in self.children if isinstance(part, Node) for r in ([part] if part.tag == "tr" else part.direct("tr") if part.tag in ("thead", "tbody", "tfoot") else [])]
        return own or self.find_all("tr")

    def direct(self, *tags: str) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node) and c.tag in tags]


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("document")
        self.open = [self.root]

    def updatepos(self, i, j):
        return j  # lines are not counted: nobody asks where a tag stands

    def handle_starttag(self, tag, attrs):
        if tag in _CLOSES:  # an open element of the same kind ends here, within its scope
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i].tag in _SCOPES[tag]:
                    break
                if self.open[i].tag in _CLOSES[tag]:
                    del self.open[i:]
                    break
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str | None) -> Node:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def _span(node: Node, name: str) -> int:
    value = node.attrs.get(name, "1").strip()
    return min(int(value), _MOST[name]) if value.isdecimal() and int(value) > 0 else 1


def expand_grid(table: Node, *, nested: bool = False, even: bool = False) -> list[dict]:
    """A table as a grid: cells repeated over their spans. Rows: ``index``, ``class``, ``cells``, ``html`` of the cells.

    ``nested`` takes rows at any depth, not only the table's own; ``even`` pads all rows to the widest. Spans
    are at most those of the HTML standard.
    """
    rows = table.find_all("tr") if nested else [r for part in [table, *table.direct("thead", "tbody", "tfoot")] for r in part.direct("tr")]
    held: dict[int, list] = {}  # column -> [rows left, text, html]
    out = []
    for index, row in enumerate(rows):
        cells: list[tuple[str, str]] = []

        def fill(cells=cells):
            while len(cells) in held:
                left = held[len(cells)]
                column = len(cells)
                cells.append((left[1], left[2]))
                left[0] -= 1
                if not left[0]:
                    del held[column]

        for cell in row.direct("td", "th"):
            fill()
            text, down = (cell.text(breaks=nested), cell.html()), _span(cell, "rowspan")
            for _ in range(_span(cell, "colspan")):
                if down > 1:
                    held[len(cells)] = [down - 1, *text]
                cells.append(text)
        fill()
        for column in sorted(held):  # beyond a gap
            if column >= len(cells):
                cells += [("", "")] * (column - len(cells))
                fill()
        out.append({"index": index, "class": row.attrs.get("class", ""), "cells": [t for t, _ in cells], "html": [h for _, h in cells]})
    if even:
        width = max((len(r["cells"]) for r in out), default=0)
        for r in out:
            for c in ("cells", "html"):
                r[c] += [""] * (width - len(r[c]))
    return out


def header_columns(rows: list[list[str]], wanted: dict[str, str], exact: list[str], *, within: int = 6) -> dict[str, int] | None:
    """Places of columns by a header among the first rows: ``wanted`` by a part of the label, ``exact`` by the whole (the last that matches)."""
    for cells in rows[:within]:
        found = {name: next((i for i, c in enumerate(cells) if part in c), None) for name, part in wanted.items()}
        found |= {label: max((i for i, c in enumerate(cells) if c.strip() == label), default=None) for label in exact}
        places = list(found.values())
        days = [found[label] for label in exact]
        if None not in places and len(set(days)) == len(days):
            return found
    return None


def tables(html: str | None) -> list[dict]:
    """All tables of a page as grids: (table, index, class, cells) rows."""
    return [{"table": t, **row} for t, node in enumerate(parse(html).find_all("table")) for row in expand_grid(node)]


def links(html: str | None, base: str | None = None) -> list[dict]:
    """Distinct (text, href) of a page's anchors, addresses made absolute, in order."""
    out: dict[tuple[str, str], dict] = {}
    for a in parse(html).find_all("a"):
        if href := a.attrs.get("href", "").strip():
            row = {"text": a.text(), "href": urljoin(base or "", href)}
            out.setdefault((row["text"], row["href"]), row)
    return list(out.values())


def cards(html: str | None) -> list[dict]:
    """Names and addresses of a card list: an anchor's title, its text, or the alternative text of its picture."""
    out: dict[tuple[str, str], dict] = {}
    for a in parse(html).find_all("a"):
        images = a.find_all("img")
        name = (a.attrs.get("title") or a.text() or next((i.attrs.get("alt", "") for i in images), "")).strip()
        href = a.attrs.get("href", "").strip()
        if name and href:
            out.setdefault((name, href), {"name": name, "href": href})
    return sorted(out.values(), key=lambda r: (r["name"], r["href"]))


# How a card names its item, as a label or by its picture's file.
_CARD_LABEL = re.compile(r"(?:No\.\s*)?0*(\d{1,4})\s*[:：]\s*(.+)")
_CARD_PICTURE = re.compile(r"(?:weapon)?0*(\d{1,4})[a-z]?\.(?:png|jpe?g|webp)", re.IGNORECASE)


def item_cards(html: str | None, base: str | None = None) -> list[dict]:
    """(id, name, href, state) of a catalog page's cards, by id; the first address of an id is taken, another one is a conflict."""
    first: dict[int, dict] = {}
    clashes: dict[tuple[int, str], dict] = {}
    for a in parse(html).find_all("a"):
        href = a.attrs.get("href", "").strip()
        said = [a.attrs.get("title", ""), a.attrs.get("aria-label", ""), a.text()]
        said += [i.attrs.get(k, "") for i in a.find_all("img") for k in ("alt", "title", "src", "data-src")]
        found = next((m for x in said for m in (_CARD_LABEL.search(x), _CARD_PICTURE.search(x)) if m), None)
        address = urljoin(base or "", href)
        page = unquote(urlsplit(address).path).rstrip("/").rpartition("/")[2]
        if not href or not found or not page:
            continue
        label = " ".join(found[2].split()) if found.re is _CARD_LABEL else ""
        row = {"id": int(found[1]), "name": label or page, "href": address, "state": "first"}
        if first.setdefault(row["id"], row)["href"] != address:
            clashes.setdefault((row["id"], address), row | {"state": "conflict"})
    return sorted([*first.values(), *clashes.values()], key=lambda r: (r["id"], r["state"] != "first", r["href"]))


def _udf(function, kind: str):
    @F.pandas_udf(kind)
    def apply(values: pd.Series) -> pd.Series:
        return values.map(function)

    return apply


def table_grids(column: Column) -> Column:
    return _udf(tables, "array<struct<table:int,index:int,class:string,cells:array<string>,html:array<string>>>")(column)


def page_links(html: Column, base: Column) -> Column:
    @F.pandas_udf("array<struct<text:string,href:string>>")
    def apply(pages: pd.Series, bases: pd.Series) -> pd.Series:
        return pd.Series([links(h, b) for h, b in zip(pages, bases)], dtype=object)

    return apply(html, base)


def card_list(column: Column) -> Column:
    return _udf(cards, "array<struct<name:string,href:string>>")(column)


def page_cards(html: Column, base: Column) -> Column:
    @F.pandas_udf("array<struct<id:int,name:string,href:string,state:string>>")
    def apply(pages: pd.Series, bases: pd.Series) -> pd.Series:
        return pd.Series([item_cards(h, b) for h, b in zip(pages, bases)], dtype=object)

    return apply(html, base)


# Labels of an effect table.
LEVEL_LABELS = tuple(f"★{i}" for i in range(1, 11))


def effect_levels(html: str | None, *, prefer: str = "単一") -> list[dict]:
    """(level, name, value, conditional) of the first table headed by ten levels, one labelled ``prefer`` first."""
    grids = [g for g in (expand_grid(t) for t in parse(html).find_all("table")) if g and tuple(c.strip() for c in g[0]["cells"][1:11]) == LEVEL_LABELS]
    chosen = next((g for g in grids if prefer in g[0]["cells"][0]), grids[0] if grids else [])
    return [{"level": i + 1, "name": row["cells"][0], "value": v, "conditional": "rbonus-row" in row["class"].split()} for row in chosen[1:] for i, v in enumerate(row["cells"][1:11]) if v]


def page_effects(column: Column) -> Column:
    return _udf(effect_levels, "array<struct<level:int,name:string,value:string,conditional:boolean>>")(column)

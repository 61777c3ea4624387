"""Recipe pages as flat rows: resources, stages with their materials, upgrades, and assistants with their days.

A page's resource table is read row by row, each by what its header says; names stay text, for the catalogs to
resolve by joins.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.html import Node, parse

# Row labels and what they stand for.
STAGES = {"0 ～ 5": (0, 5), "6 ～ 9": (6, 9)}
LAST = "MAX"
RESTRICTED = re.compile(r"二番艦[：:]\s*(.+?)\s*限定$")

_ROW = "array<struct<pos:int,action:string,group:string,first:int,last:int,costs:array<int>,materials:array<struct<name:string,count:int>>,only:string,target:string,target_level:int>>"


def name_and_count(text: str) -> tuple[str, int]:
    """A name and its final number, 0 without one; a condition on the assistant is cut off."""
    found = re.match(r"^(.+?)(?:\s*×\s*)?(\d+)?$", text.split("二番艦")[0].strip())
    return (found[1].strip(), int(found[2] or 0)) if found else ("", 0)


def _has(node: Node, *classes: str) -> bool:
    return set(classes) <= set(node.attrs.get("class", "").split())


def _numbers(cells: list[Node]) -> list[int]:
    return [int(x) for c in cells for x in re.findall(r"\d+", c.text())]


def _titled(node: Node) -> list[Node]:
    return [n for n in node.walk() if n.attrs.get("title")]


def _material(cell: Node) -> list[dict]:
    own = Node(cell.tag, cell.attrs, [])
    for child in cell.children:  # what follows a condition belongs to the alternative
        if isinstance(child, Node) and _has(child, "sub"):
            break
        own.children.append(child)
    text = own.text()
    if text in ("", "-"):
        return []
    name, count = name_and_count(text)
    return [{"name": name, "count": count}]


def _alternatives(cell: Node) -> list[tuple[str, list[dict]]]:
    """(assistants, materials) of the alternatives that only some assistants have."""
    nodes = [c for c in cell.children if isinstance(c, Node)]
    out = []
    for node, after in zip(nodes, nodes[1:]):
        found = RESTRICTED.search(node.text()) if _has(node, "sub") else None
        if found:
            name, count = name_and_count(after.text())
            titled = [after] if after.attrs.get("title") else _titled(after)
            out.append((found[1], [{"name": name or (titled[0].attrs["title"] if titled else ""), "count": count}]))
    return out


def recipe_rows(html: str | None) -> list[dict]:
    root = parse(html)
    table = next((t for d in root.find_all("div") if _has(d, "resource-table") for t in d.direct("table")), None)
    if table is None:
        return []
    rows = [r for part in [table, *table.direct("tbody")] for r in part.direct("tr")][2:]
    out: list[dict] = []

    def emit(action: str, *, group="", first=None, last=None, costs=(), materials=(), only=None, target=None, level=None) -> None:
        out.append({"pos": len(out), "action": action, "group": group, "first": first, "last": last, "costs": list(costs), "materials": list(materials), "only": only, "target": target, "target_level": level})

    def upgrade(i: int, group: str) -> int:
        head = next((h for h in rows[i].direct("th")), None) if i < len(rows) else None
        if head is None or "rowspan" not in head.attrs:
            return i + 1  # there is nothing to upgrade to
        cells = rows[i].direct("td")
        materials = []
        if len(cells) > 2:
            captions = [n.text() for n in cells[2].walk() if n.tag == "figcaption"]
            for node, caption in zip(_titled(cells[2]), captions):
                found = re.search(r"(\d+)\s*$", caption)
                materials.append({"name": re.sub(r"^\d+:\s*", "", node.attrs["title"]), "count": int(found[1]) if found else 0})
        titled = [d for c in rows[i + 1].direct("td") for n in _titled(c) for d in [n, *n.find_all("div")]] if i + 1 < len(rows) else []
        found = re.match(r"^([^★]+?)\s*(?:★(\d+))?$", titled[-1].text()) if titled and titled[-1].text() else None
        emit("upgrade", group=group, first=10, last=10, costs=_numbers(cells[:2]), materials=materials, target=found[1].strip() if found else None, level=int(found[2] or 0) if found else None)
        return i + 2

    def stage(i: int, label: str) -> int:
        first, last = STAGES.get(label, (-1, -1))
        cells = rows[i].direct("td")
        costs, base = _numbers(cells[:2]), _material(cells[2]) if len(cells) > 2 else []
        several = "rowspan" in next(h for h in rows[i].direct("th")).attrs
        extra: dict[int, list[dict]] = {}
        if several and i + 1 < len(rows):  # some levels need an item more, told in the next row
            spans = rows[i + 1].find_all("span")
            for at, span in enumerate(spans):
                found = re.search(r"(\d+)", span.text()) if not span.attrs.get("class") else None
                gap = next((s for s in spans[at + 1 :] if _has(s, "s-gap")), None)
                if found:
                    anchor = next((a for a in gap.find_all("a") if a.attrs.get("title")), None) if gap else None
                    count = re.search(r"(\d+)", anchor.text()) if anchor else None
                    extra[int(found[1])] = [{"name": re.sub(r"^\d+:\s*", "", anchor.attrs["title"]), "count": int(count[1]) if count else 0}] if anchor else []
        if extra:
            for level in [*range(first, min(extra)), *sorted(extra)]:
                emit("improve", first=level, last=level, costs=costs, materials=base + extra.get(level, []))
        else:
            emit("improve", first=first, last=last, costs=costs, materials=base)
        for only, materials in _alternatives(cells[2]) if len(cells) > 2 else []:
            emit("improve", first=first, last=last, costs=costs, materials=materials, only=only)
        return i + 1 + several

    i = 0
    while i < len(rows):
        heads = rows[i].direct("th")
        marked = next((h for h in heads if _has(h, "border-right")), None)
        if marked is not None:
            label = marked.text()
            i = upgrade(i, "") if label == LAST else stage(i, label)
        elif any(_has(s, "remodel-info") for s in rows[i].find_all("span")):
            group = next((c for h in heads for c in h.attrs.get("class", "").split() if c.startswith("kind")), "")
            i = upgrade(i + 1, group)
        elif any(_has(h, "title", "resource-title") for h in rows[i].find_all("th")):
            if i + 1 < len(rows):
                emit("resource", costs=[int(s.text()) for c in rows[i + 1].direct("td") for s in c.direct("span") if s.text().isdecimal()])
            i += 2
        else:
            i += 1
    return out


def assistant_rows(html: str | None) -> list[dict]:
    """(source_order, group, name, picture, mask) of a page's assistants; ``-`` is a name of nobody."""
    out = []
    for node in parse(html).find_all("div"):
        if not _has(node, "support-ship"):
            continue
        boxes = node.direct("div")
        group = next((c for b in boxes[:1] for c in b.attrs.get("class", "").split() if c.startswith("kind")), "")
        texts = [c.strip() for c in node.children if isinstance(c, str) and c.strip()]
        picture = next((i.attrs.get("data-src") or i.attrs.get("src") for i in node.direct("img")), None)
        mask = sum(_has(s, "enable") << k for k, s in enumerate(s for b in boxes for s in b.direct("span")))
        out.append({"source_order": len(out), "group": group, "name": texts[-1] if texts and texts[-1] != "-" else None, "picture": picture, "mask": mask})
    return out


def recipes(html: Column) -> Column:
    @F.pandas_udf(_ROW)
    def apply(pages: pd.Series) -> pd.Series:
        return pages.map(recipe_rows)

    return apply(html)


def assistants(html: Column) -> Column:
    @F.pandas_udf("array<struct<source_order:int,group:string,name:string,picture:string,mask:int>>")
    def apply(pages: pd.Series) -> pd.Series:
        return pages.map(assistant_rows)

    return apply(html)

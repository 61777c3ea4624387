"""Records of item pages: identifier, flag of the info box, methods with their kinds and availability, coverage.

A page becomes one struct in one Arrow pass; what follows (issues, counts, accepted records) is relational.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.evidence import Vocabulary, node_text, read_blocks, read_section
from tessera.functions.html import Node, expand_grid, header_columns, parse

# Labels and patterns of the pages' language.
NOTES = "備考"
NOT_DEVELOPED = "開発不可"
DEVELOPED = re.compile(r"開発(?:実装|解禁)日|開発可(?:能)?")
PAGE_ID = re.compile(r"(?<!\d)No\.\s*0*(\d+)(?!\d)", re.IGNORECASE)
ITEM_HEADER, ASSISTANT_HEADER = "改修する装備", "二番艦"
WEEKDAYS = ("日", "月", "火", "水", "木", "金", "土")
MARKED = re.compile("[◯○〇△]")

_FATAL = frozenset(("id-mismatch", "missing-id", "flag-unresolved"))
_RECORD = (
    "struct<page_id:bigint,flag:boolean,marker:string,scope:string,coverage:string,accepted:boolean,issues:array<string>,current:array<string>,historical:array<string>,"
    "methods:array<struct<pos:int,kinds:array<string>,availability:string,text:string,context:string>>>"
)


def page_id(root: Node, expected: int | None) -> int | None:
    """The identifier that a page gives: the expected one if it is among them, else the first."""
    found = [int(x) for n in [root, *root.walk()] for c in n.children if isinstance(c, str) and "." in c for x in PAGE_ID.findall(c)]
    return expected if expected in found else next(iter(found), None)


def notes_of(root: Node, expected: int | None) -> str | None:
    """The notes cell of the info box: the one in a table that names the expected id, or the only one of such a page."""
    found = []
    for table in root.find_all("table"):
        rows = table.find_all("tr")
        for i, row in enumerate(rows):
            if any(node_text(h) == NOTES for h in row.direct("th")):
                values = [x for x in map(node_text, row.direct("td")) if x]
                text = " ".join(values) or (node_text(rows[i + 1]) if i + 1 < len(rows) else "")
                ids = [int(x) for h in table.find_all("th")[:3] for x in PAGE_ID.findall(h.text())]
                found.append((ids, text))
    own = [t for ids, t in found if expected in ids]
    if own:
        return own[0]
    return found[0][1] if len(found) == 1 and expected is not None and page_id(root, expected) == expected else None


def development_flag(notes: str | None) -> tuple[bool | None, str | None]:
    """(flag, marker) of a notes cell: not at all without one, false by its own marker or without any."""
    if notes is None:
        return None, None
    if NOT_DEVELOPED in notes:
        return False, NOT_DEVELOPED
    found = DEVELOPED.search(notes)
    return (True, found[0]) if found else (False, "no-marker")


def page_record(html: str | None, expected: int | None, name: str = "", *, base: str = "", words: Vocabulary | None = None) -> dict:
    root = parse(html)
    flag, marker = development_flag(notes_of(root, expected))
    found = page_id(root, expected)
    issues = [] if flag is not None else ["flag-unresolved"]
    if found is None:
        issues.append("missing-id")
    elif found != expected:
        issues.append("id-mismatch")
    heading, scope, methods = read_section(root, name or "", base=base, words=words)
    if heading is None:
        issues.append("missing-section")
    elif not methods:
        issues.append("empty-section")
    other = any(m["kinds"] == ["other"] for m in methods)
    accepted = not _FATAL & set(issues)
    if not accepted:
        coverage = "rejected"
    elif not methods:
        coverage = "missing-section" if heading is None else "empty-section"
    elif scope == "page-fallback":
        coverage = "fallback-partial" if other else "fallback"
    else:
        coverage = "partial" if other else "parsed"
    of = lambda *states: sorted({k for m in methods if m["availability"] in states for k in m["kinds"]})
    return {
        "page_id": found, "flag": flag, "marker": marker, "scope": scope, "coverage": coverage, "accepted": accepted, "issues": issues,
        "current": of("current", "current-or-summary", "mixed-summary"), "historical": of("historical", "mixed-summary"), "methods": methods,
    }


def page_records(html: Column, expected: Column, name: Column | None = None, *, base: str = "", words: Vocabulary | None = None) -> Column:
    @F.pandas_udf(_RECORD)
    def apply(pages: pd.Series, ids: pd.Series, names: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([page_record(h, None if pd.isna(i) else int(i), n, base=base, words=words) for h, i, n in zip(pages, ids, names)])

    return apply(html, expected, F.lit("") if name is None else name)


def page_units(html: Column, base: str = "", *, words: Vocabulary | None = None) -> Column:
    """Units of evidence of a whole page, in document order."""

    @F.pandas_udf("array<struct<pos:int,kind:string,kinds:array<string>,availability:string,text:string,context:string,links:array<struct<text:string,href:string>>>>")
    def apply(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: read_blocks(h, base=base, words=words))

    return apply(html)


def coverage_metrics(records: DataFrame) -> DataFrame:
    """Counts of records by coverage and of methods by kind: (metric, value)."""
    by_state = records.groupBy(F.concat(F.lit("coverage."), "record.coverage").alias("metric")).agg(F.count("*").alias("value"))
    kinds = records.select(F.explode("record.methods").alias("m")).select(F.explode("m.kinds").alias("k"))
    return by_state.union(kinds.groupBy(F.concat(F.lit("methods."), "k").alias("metric")).agg(F.count("*").alias("value")))


def weekday_facts(html: str | None) -> list[dict]:
    """(item, assistant, mask) of the tables whose header names items, assistants and seven weekdays.

    An assistant cell lists names line by line, without footnotes, each once; ``-`` stands for none.
    """
    out = []
    for table in parse(html).find_all("table"):
        grid = [r["cells"] for r in expand_grid(table, nested=True, even=True)]
        columns = header_columns(grid, {"item": ITEM_HEADER, "assistant": ASSISTANT_HEADER}, list(WEEKDAYS))
        if columns is None:
            continue
        for cells in grid:
            item = cells[columns["item"]].strip()
            if not item or ITEM_HEADER in item:
                continue
            mask = sum(bool(MARKED.search(cells[columns[d]])) << i for i, d in enumerate(WEEKDAYS))
            names = [re.sub(r"\s*(?:\*\d+|※.*)$", "", x).strip() for x in cells[columns["assistant"]].split("\n")]
            names = list(dict.fromkeys(x for x in names if x and x != "-")) or [None]
            out += [{"item": item, "assistant": n, "mask": mask} for n in names]
    return out


def weekday_tables(html: Column) -> Column:
    @F.pandas_udf("array<struct<item:string,assistant:string,mask:int>>")
    def apply(pages: pd.Series) -> pd.Series:
        return pages.map(weekday_facts)

    return apply(html)

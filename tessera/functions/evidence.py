"""Evidence of how an item is obtained, read from a page's section: units of text with kinds, availability and context.

A reader goes through the blocks of a section once. What earlier blocks say of later ones (a heading, a label, a fold's
summary, a marker that all below is past) is a scope that is handed on: to what is inside a block, and from a block
to its next siblings. The page's language is in the fixed values; further wording is a ``Vocabulary``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from urllib.parse import unquote, urljoin, urlparse

from tessera.functions.html import Node, parse
from tessera.functions.text import exact_text, plain_text, sentences

# Labels and patterns of the pages' language, which decide what a text is taken for.
HEADING = re.compile(r"入手方法(?:について)?")
OVERVIEW = "ゲームにおいて"
METHOD_COLUMN = "入手方法"
METHODS = {
    "development": r"開発",
    "ship": r"初期装備|持参|牧場|所持艦|装備艦",
    "quest": r"任務",
    "improvement": r"改修更新|改修.*更新|更新先|★max.*更新|からの入手|(?:から|より)の更新|更新で入手|改修で入手|改修による入手",
    "ranking": r"ランキング|作戦報酬|ランカー|聯合報酬",
    "event": r"イベント|海域クリア報酬|突破報酬|期間限定海域",
    "construction": r"建造",
    "purchase": r"購入|アイテム屋",
    "exchange": r"交換|選択報酬|選択式報酬",
}
PAST = r"過去の入手方法|これまでの入手方法|以前は|かつて|先行実装|配布された|報酬だった|報酬として実装された|現在は入手不可|入手不能|終了済"
PRESENT = r"現在(?:は|も)?|現時点|恒常|入手可能|入手できる|建造可能|開発可能|更新可能|継続中|実装中"
PAST_MARKER = r"過去の入手方法|これまでの入手方法|以前の入手方法|終了した.*(?:配布状況|入手方法)|これまでの.*配布状況"
FACT = r"入手(?:可能|できる|出来る|手段)|(?:報酬|褒賞)(?:として|で|[:：、。]|$)|初期装備|持参"
TABLE_OF_SHIPS = r"初期装備艦|持参艦|初期装備.*下表|所持艦.*下表"
TABLE_OF_REWARDS = r"(?:海域|イベント).*(?:突破|報酬)"
REWARD, QUEST_PAGE, IMPROVED = "報酬", "任務", ("改修", "改修更新")
SHIPS_CONTEXT, COMPARISON_CONTEXT = "initial-equipment-ships", "comparison-table"
SUMMARY = "current-or-summary"
SKIPPED = frozenset(("fold-summary", "caption-flybox", "default-advertisement", "pc-caption-ad-container"))
FOLD, FOLD_SUMMARY, FOLD_CONTENT = "fold-container", "fold-summary", "fold-content"

_METHODS = {k: re.compile(p) for k, p in METHODS.items()}
_PAST, _PRESENT, _PAST_MARKER = map(re.compile, (PAST, PRESENT, PAST_MARKER))
_ANY_METHOD = re.compile("|".join(METHODS.values()))
_INNER = ("ul", "ol", "table", "div")
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_SINGLE = frozenset(("quest", "ranking", "event"))


@dataclass(frozen=True)
class Vocabulary:
    """Accepted wording beside the fixed values: headings of single pages, labels, markers, ignored texts, replacements."""

    headings: dict[tuple[str, str], str] = field(default_factory=dict)
    labels: dict[str, str] = field(default_factory=dict)
    label_prefixes: dict[str, str] = field(default_factory=dict)
    markers: frozenset[str] = frozenset()
    ignored: frozenset[str] = frozenset()
    literals: dict[str, str] = field(default_factory=dict)
    blanked: dict[str, str] = field(default_factory=dict)

    def label(self, text: str) -> str | None:
        """What a label stands for; longer prefixes first; a closing colon may be left away."""
        for form in dict.fromkeys((text, text.rstrip(":："))):
            if form in self.labels:
                return self.labels[form]
            for prefix in sorted(self.label_prefixes, key=lambda p: (-len(p), p)):
                if form and form.startswith(prefix):
                    return self.label_prefixes[prefix]
        return None

    def canonical(self, text: str) -> str:
        for table in (self.blanked, self.literals):
            for raw in sorted(table, key=lambda r: (-len(r), r)):
                text = text.replace(raw, table[raw])
        return text


def kinds_of(text: str, words: Vocabulary = Vocabulary()) -> list[str]:
    compact = words.canonical(plain_text(text))
    return [k for k, p in _METHODS.items() if p.search(compact)] if _ANY_METHOD.search(compact) else ["other"]


def availability_of(text: str, inherited: str = SUMMARY) -> str:
    past, present = bool(_PAST.search(text)), bool(_PRESENT.search(text))
    return "mixed-summary" if past and present else "historical" if past else "current" if present else inherited


def node_text(node: Node) -> str:
    return plain_text(node.raw())


def own_text(node: Node, without: tuple[str, ...] = _INNER) -> str:
    """The text of a node without that of its lists, tables and blocks."""
    return plain_text(node.raw(without))


def links_of(node: Node, base: str) -> list[dict]:
    """Links within a node, addresses absolute, each text and address once."""
    found = {}
    for a in node.find_all("a"):
        if href := a.attrs.get("href", "").strip():
            found.setdefault((node_text(a), urljoin(base, href)))
    return [{"text": t, "href": h} for t, h in found]


@dataclass(frozen=True)
class Scope:
    """What blocks before or around say of a text: its availability, kinds and context; ``strict``: only texts that name a method count."""

    availability: str = SUMMARY
    kinds: tuple[str, ...] = ()
    context: str | None = None
    strict: bool = False


class Reader:
    """Units of a page in document order, each (text, availability, kinds, context) once."""

    def __init__(self, base: str = "", words: Vocabulary | None = None):
        self.base, self.words = base, words or Vocabulary()
        self.units: dict[tuple, dict] = {}

    # --- what a text is ----------------------------------------------------------------------

    def named(self, text: str) -> tuple[str, ...]:
        """Kinds that a heading, label or header names."""
        return tuple(k for k in kinds_of(self.words.label(text) or text, self.words) if k != "other") if text else ()

    def is_label(self, text: str) -> bool:
        return bool(text) and self.words.label(text) is not None

    def is_past_marker(self, text: str) -> bool:
        lines = [x for x in map(plain_text, text.split("\n")) if x]
        return bool(lines) and all(x in self.words.markers or _PAST_MARKER.fullmatch(x) for x in lines)

    def speaks(self, text: str) -> bool:
        """Whether a text says anything of when or how."""
        return any(p.search(text) for p in (_PAST, _PRESENT, _ANY_METHOD))

    def by_links(self, text: str, links: list[dict]) -> tuple[str, ...]:
        pages = (unquote(urlparse(x["href"]).path).lstrip("/").partition("/")[2] for x in links)
        return ("quest",) if REWARD in text and any(p.startswith(QUEST_PAGE) for p in pages) else ()

    def emit(self, node: Node, text: str, scope: Scope, kind: str, *, split: bool = True) -> bool:
        """Units of a text; whether any was new."""
        before, text = len(self.units), plain_text(text)
        if not text or text in self.words.ignored:
            return False
        links = links_of(node, self.base)
        for unit in sentences(text) if split else [text]:
            if unit in self.words.ignored or self.is_past_marker(unit):
                continue
            own = (*scope.kinds, *kinds_of(unit, self.words), *self.by_links(unit, links))
            kinds = tuple(dict.fromkeys(k for k in own if k != "other")) or ("other",)
            if scope.strict and kinds == ("other",):
                continue
            key = (unit, availability_of(unit, scope.availability), kinds, scope.context)
            self.units.setdefault(key, {"pos": len(self.units), "kind": kind, "kinds": list(kinds), "availability": key[1], "text": unit, "context": scope.context, "links": links})
        return len(self.units) > before

    # --- blocks ------------------------------------------------------------------------------

    def blocks(self, node: Node, scope: Scope) -> None:
        """The blocks of a container, a fold's content under what its summary says."""
        if FOLD in node.classes:
            parts = {name: next((c for c in node.direct("div") if name in c.classes), None) for name in (FOLD_SUMMARY, FOLD_CONTENT)}
            if parts[FOLD_CONTENT] is not None:
                said = node_text(parts[FOLD_SUMMARY]) if parts[FOLD_SUMMARY] else ""
                past = self.is_past_marker(said) or re.search(PAST, said)
                self.blocks(parts[FOLD_CONTENT], replace(scope, availability="historical" if past else availability_of(said, scope.availability), kinds=self.named(said) or scope.kinds, context=said or scope.context))
            return
        at, nodes = scope, [c for c in node.children if isinstance(c, Node)]
        for child, after in zip(nodes, [*nodes[1:], None]):
            at = self.block(child, at, scope, after)

    def block(self, node: Node, at: Scope, outer: Scope, after: Node | None) -> Scope:
        """One block; the scope of those after it."""
        if node.tag in _HEADINGS:
            said = node_text(node)
            return replace(at, availability=availability_of(said, at.availability), kinds=self.named(said), context=said or at.context)
        if node.tag == "div":
            if FOLD in node.classes or not SKIPPED & node.classes:
                self.blocks(node, at)
        elif node.tag in ("ul", "ol"):
            self.items(node, at)
            if after is not None and after.tag == "table":
                return self.before_table(node, at)
        elif node.tag == "table":
            self.rows(node, at)
            if at.context and (at.context == SHIPS_CONTEXT or re.search(TABLE_OF_REWARDS, at.context)):
                return replace(at, kinds=outer.kinds, context=outer.context)  # it was said of this table only
        elif node.tag in ("p", "blockquote", "li", "dt", "dd", "dl", "section"):
            if node.tag in ("dl", "section"):
                self.blocks(node, at)
                return at
            said = own_text(node)
            if self.is_past_marker(said):
                return replace(at, availability="historical")
            if self.is_label(said):
                return replace(at, kinds=self.named(said), context=said)
            kinds = tuple(dict.fromkeys((*at.kinds, *self.named(said))))
            self.emit(node, said, replace(at, kinds=kinds, strict=at.strict and not kinds), "paragraph")
        return at

    def before_table(self, node: Node, at: Scope) -> Scope:
        """What a list says of the table that follows it."""
        if re.search(TABLE_OF_SHIPS, node_text(node)):
            return replace(at, kinds=("ship",), context=SHIPS_CONTEXT)
        items = node.direct("li")
        said = own_text(items[-1]) if items else ""
        kinds = self.named(said)
        return replace(at, kinds=kinds, context=said) if kinds and (self.is_label(said) or re.search(TABLE_OF_REWARDS, said)) else at

    def rows(self, table: Node, scope: Scope) -> None:
        rows = [(r, r.direct("th", "td")) for r in table.rows()]
        texts = [[x for x in map(node_text, cells) if x] for _, cells in rows]
        for said in (" | ".join(t) for t in texts):
            if kinds := self.named(said):
                scope = replace(scope, kinds=tuple(dict.fromkeys((*scope.kinds, *kinds))), context=said)
                break
        scope = replace(scope, strict=scope.strict and not scope.kinds)
        for (row, cells), text in zip(rows, texts):
            said = " | ".join(text)
            if said and not all(c.tag == "th" for c in cells) and not self.is_label(said):
                self.emit(row, said, scope, "table-row", split=False)

    def items(self, node: Node, scope: Scope) -> None:
        """The items of a list; a marker or a label speaks of the items after it."""
        at = scope
        for item in node.direct("li"):
            said, inner = own_text(item), [c for c in item.children if isinstance(c, Node) and c.tag in _INNER]
            marker, named = self.is_past_marker(said), self.named(said)
            label = bool(inner) and self.is_label(said)
            own = replace(at, availability="historical" if marker else availability_of(said, at.availability))
            kinds = at.kinds if label else tuple(dict.fromkeys((*at.kinds, *named)))
            told = False
            if said and not marker and not label and (not at.strict or kinds or self.speaks(said)):
                told = self.emit(item, said, replace(own, kinds=kinds, strict=at.strict and not kinds), "list-item", split=at.strict)
            below = replace(own, kinds=named if label else at.kinds, context=said if label else at.context)
            for child in inner:
                if child.tag in ("ul", "ol"):
                    # what stands below a single quest, ranking or event is its conditions
                    if not (told and _SINGLE & set(below.kinds)):
                        self.items(child, replace(below, strict=at.strict or told))
                elif child.tag == "table":
                    self.rows(child, below)
                elif not SKIPPED & child.classes:
                    self.blocks(child, below)
            if marker:
                at = replace(at, availability="historical")
            elif label and named:
                at = replace(at, kinds=named, context=said or at.context)

    # --- pages without a section -------------------------------------------------------------

    def comparison(self, root: Node, name: str) -> None:
        """Cells of comparison tables: the method column of the item's own row."""
        fold = lambda x: "".join(exact_text(plain_text(x)).split()).casefold()
        for table in root.find_all("table"):
            rows = [r.direct("th", "td") for r in table.rows()]
            column = next((i for cells in rows for i, c in enumerate(cells) if METHOD_COLUMN in node_text(c)), None)
            for cells in rows if column is not None else []:
                if column < len(cells) and any(fold(node_text(c)) == fold(name) for c in cells):
                    said = node_text(cells[column])
                    if said != METHOD_COLUMN:
                        kinds = ("improvement",) if self.words.canonical(said).strip() in IMPROVED else ()
                        self.emit(cells[column], said, Scope(kinds=kinds, context=COMPARISON_CONTEXT, strict=True), "summary-table-cell", split=False)

    def overview(self, root: Node) -> None:
        """Only what clearly speaks of a method, in the first blocks of the overview."""
        for heading, nodes in sections(root, lambda h: "".join(node_text(h).split()) == OVERVIEW):
            scope = Scope(context=node_text(heading), strict=True)
            for node in nodes:
                if node.tag in _HEADINGS:
                    break
                for item in node.direct("li") if node.tag in ("ul", "ol") else []:
                    said = own_text(item)
                    if self.is_label(said):
                        below = Scope(kinds=self.named(said), context=said, strict=True)
                        for child in item.direct("ul", "ol", "table"):
                            self.rows(child, below) if child.tag == "table" else self.items(child, below)
                        continue
                    if not said:
                        continue
                    if self.speaks(said):
                        self.emit(item, said, scope, "page-fallback")
                    for deep in item.find_all("li"):
                        if re.search(FACT, own_text(deep)):
                            self.emit(deep, own_text(deep), scope, "nested-page-fallback")
                if node.tag in ("p", "blockquote") and self.speaks(own_text(node)):
                    self.emit(node, own_text(node), scope, "page-fallback")


def sections(root: Node, wanted) -> list[tuple[Node, list[Node]]]:
    """(heading, the siblings after it up to the next of its level or above) of the headings that are wanted, in document order."""
    out = []
    for parent in [root, *root.walk()]:
        nodes = [c for c in parent.children if isinstance(c, Node)]
        for i, node in enumerate(nodes):
            if node.tag in _HEADINGS[1:] and wanted(node):
                stop = next((j for j in range(i + 1, len(nodes)) if nodes[j].tag in _HEADINGS and nodes[j].tag <= node.tag), len(nodes))
                out.append((node, nodes[i + 1 : stop]))
    return out


def read_section(html: str | Node | None, name: str = "", *, base: str = "", words: Vocabulary | None = None) -> tuple[str | None, str, list[dict]]:
    """(heading, scope, units): of the acquisition section, or where it gives nothing of the rest of the page."""
    root = html if isinstance(html, Node) else parse(html)
    reader = Reader(base, words)

    def wanted(node: Node) -> bool:
        said = "".join(node_text(node).split())
        return bool(HEADING.fullmatch(reader.words.headings.get((name, said), said)))

    found = next(iter(sections(root, wanted)), None)
    if found:
        reader.blocks(Node("div", {}, list(found[1])), Scope())
    if reader.units:
        return node_text(found[0]), "section", list(reader.units.values())
    reader.comparison(root, name)
    reader.overview(root)
    return node_text(found[0]) if found else None, "page-fallback", list(reader.units.values())


def read_blocks(html: str | None, *, base: str = "", words: Vocabulary | None = None) -> list[dict]:
    """Units of a whole page or fragment, whatever its headings."""
    reader, root = Reader(base, words), parse(html)
    while len(inner := [c for c in root.children if isinstance(c, Node)]) == 1 and inner[0].tag in ("html", "body"):
        root = inner[0]
    body = next((n for n in root.find_all("body")), root)
    reader.blocks(body, Scope())
    return list(reader.units.values())

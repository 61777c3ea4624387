"""Scalar text functions: normalizers, splitters, classifiers, keys.

Where Spark has built-ins (white space, trimming, numbers, labels) these are used; Unicode folding, bracket-aware
splitting and sorted-key JSON are Arrow functions over whole batches.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- width and Unicode folding -------------------------------------------------------------------


@functools.cache
def _narrow_table() -> dict[int, str]:
    """Full width to half width: ASCII, space, and kana with their marks, from the characters' own decompositions."""
    table = {0xFF01 + i: chr(0x21 + i) for i in range(94)} | {0x3000: " "}
    half = {unicodedata.normalize("NFKC", chr(c)): chr(c) for c in range(0xFF61, 0xFFA0)}
    marks = {"゙": "ﾞ", "゚": "ﾟ"}
    for full, narrow in half.items():
        table[ord(full[0])] = narrow
    for c in range(0x30A1, 0x30FB):
        base, *mark = unicodedata.normalize("NFD", chr(c))
        if mark and base in half:
            table[c] = half[base] + marks[mark[0]]
    return table


def narrow_name(value: str | None) -> str:
    """Half width, without ``*``, ``?`` and white space, lower case."""
    text = str(value or "").translate(_narrow_table()).replace("*", "").lower()
    return re.sub(r"[\s?]+", "", text)


def catalog_name(value: str | None) -> str:
    """As ``narrow_name``, after cutting a trailing footnote mark."""
    return narrow_name(re.sub(r"\s*(?:\*\d+|※\d*|\[\d+\])\s*$", "", str(value or "").strip()))


# What the reference-name form leaves out.
_QUOTES = str.maketrans({"’": "'", "`": "'"})
_BRACKETS = "「」『』【】[]〈〉《》"
_LEFT_OUT = " ・･,，、:：;；。.!！?？-‐‑–—~〜～_/"


def reference_name(value: str | None) -> str:
    """NFKC, quotes folded, without brackets, punctuation, dashes and ``*``, case-folded."""
    text = unicodedata.normalize("NFKC", str(value or "")).translate(_QUOTES)
    return "".join(c for c in text if c not in _BRACKETS and c not in _LEFT_OUT and c != "*" and not c.isspace()).casefold()


def exact_text(value: str | None) -> str:
    """NFKC with single spaces; punctuation stays."""
    return " ".join(unicodedata.normalize("NFKC", str(value or "")).split())


def page_name_form(value: str | None) -> str:
    """NFKC, trimmed: how names of owners are compared."""
    return unicodedata.normalize("NFKC", str(value or "")).strip()


def lookup_name(value: str | None) -> str:
    """NFKC without any white space, case-folded: how a page's cells are compared with an item's name."""
    return re.sub(r"\s+", "", unicodedata.normalize("NFKC", plain_text(value))).casefold()


_BLANKS, _LINE_ENDS = re.compile(r"[ \t\r\f\v\xa0]+"), re.compile(r" *\n *")


def plain_text(value: str | None) -> str:
    """Blanks as one space, none at line ends; line ends stay."""
    text = _BLANKS.sub(" ", str(value or ""))
    return (_LINE_ENDS.sub("\n", text) if "\n" in text else text).strip()


# Brackets within which no sentence ends, and what ends one.
_OPENING = {"「": "」", "『": "』", "【": "】", "（": "）", "(": ")", "[": "]", "〈": "〉", "《": "》"}
_STOPS = "。！？\n"


def sentences(value: str | None) -> list[str]:
    """Units that end at a full stop, mark or line end outside of brackets; an end without its beginning counts for nothing."""
    out, inside, begin = [], [], 0
    text = plain_text(value)
    for at, c in enumerate(text):
        if c in _OPENING:
            inside.append(_OPENING[c])
        elif inside and c == inside[-1]:
            inside.pop()
        elif not inside and c in _STOPS:
            out.append(text[begin : at + 1])
            begin = at + 1
    return [x for x in map(plain_text, [*out, text[begin:]]) if x]


def pruned(value):
    """A JSON value without the entries of objects that are null; lists keep theirs."""
    if isinstance(value, dict):
        return {k: pruned(v) for k, v in value.items() if v is not None}
    return [pruned(v) for v in value] if isinstance(value, list) else value


def prune_nulls_text(value: str | None) -> str | None:
    """JSON text without null entries at any depth; null for no JSON, and for a null."""
    try:
        found = pruned(json.loads(value)) if value is not None else None
    except ValueError:
        return None
    return None if found is None else json.dumps(found, ensure_ascii=False, separators=(",", ":"))


def canonical_json(value: str | None, *, drop: tuple[str, ...] = (), newline: bool = False) -> str | None:
    """JSON text with sorted keys and without spaces; top-level ``metadata`` keys in ``drop`` are left out."""
    if value is None:
        return None
    try:
        found = json.loads(value)
    except ValueError:
        return None
    if isinstance(found, dict) and isinstance(found.get("metadata"), dict):
        found = found | {"metadata": {k: v for k, v in found["metadata"].items() if k not in drop}}
    return json.dumps(found, sort_keys=True, separators=(",", ":"), ensure_ascii=False) + "\n" * newline


# Metadata that does not belong to a list's content.
VOLATILE = ("dataVersion", "generatedAt", "shipMasterVersion", "contentDigest")


def _series(function, kind: str):
    @F.pandas_udf(kind)
    def apply(values: pd.Series) -> pd.Series:
        return values.map(function)

    return apply


def normalize_name(column: Column) -> Column:
    return _series(narrow_name, "string")(column)


def normalize_catalog_name(column: Column) -> Column:
    return _series(catalog_name, "string")(column)


def normalize_reference_name(column: Column) -> Column:
    return _series(reference_name, "string")(column)


def normalize_exact(column: Column) -> Column:
    return _series(exact_text, "string")(column)


def split_sentences(column: Column) -> Column:
    return _series(sentences, "array<string>")(column)


def normalize_page_name(column: Column) -> Column:
    return _series(page_name_form, "string")(column)


def normalize_lookup(column: Column) -> Column:
    return _series(lookup_name, "string")(column)


def prune_nulls(column: Column) -> Column:
    return _series(prune_nulls_text, "string")(column)


def to_canonical_json(column: Column) -> Column:
    return _series(canonical_json, "string")(column)


def content_digest(column: Column) -> Column:
    """sha256 of the canonical JSON without volatile metadata."""
    return F.sha2(_series(functools.partial(canonical_json, drop=VOLATILE, newline=True), "string")(column), 256)


def digest_is_declared(column: Column, path: str = "$.metadata.contentDigest") -> Column:
    """Whether a document's declared digest is that of its content, with the name of the hash before it or without."""
    declared = F.get_json_object(column, path)
    return F.coalesce(F.regexp_replace(declared, "^sha256:", "") == content_digest(column), F.lit(False))


# --- built-ins -----------------------------------------------------------------------------------


def collapse(column: Column) -> Column:
    """Any Unicode white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(column, F.lit("")), r"(?U)\s+", " "))


def compact_ref(column: Column) -> Column:
    """Trimmed, backslashes as slashes, single spaces, lower case."""
    return F.lower(collapse(F.replace(column, F.lit("\\"), F.lit("/"))))


def safe_positive_int(column: Column) -> Column:
    number = column.try_cast("int")
    return F.when(number > 0, number)


def name_and_count(column: Column) -> tuple[Column, Column]:
    """A name and the number that ends it, after a multiplication sign or not; 0 without one."""
    pattern = r"(?U)^(.+?)(?:\s*×\s*)?(\d+)?$"
    text = F.trim(F.split_part(column, F.lit("二番艦"), F.lit(1)))
    return F.trim(F.regexp_extract(text, pattern, 1)), F.coalesce(F.regexp_extract(text, pattern, 2).try_cast("int"), F.lit(0))


def level_label(level: Column) -> Column:
    return F.when(level >= 10, F.lit("★MAX")).otherwise(F.concat(F.lit("★"), level.cast("string")))


def day_mark(column: Column) -> Column:
    """Whether a day cell is marked; circles and triangles win over crosses."""
    return F.coalesce(column, F.lit("")).rlike("[◯○〇△]")


def typed_cell(column: Column) -> tuple[Column, Column]:
    """(value, unit) of a cell that is a number or a percentage as a whole; null otherwise."""
    text = F.trim(column)
    number = r"^[+-]?\d+(?:\.\d+)?%?$"
    value = F.when(text.rlike(number), F.regexp_replace(text, "[+%]", "").try_cast("double"))
    return value, F.when(value.isNotNull() & text.endswith("%"), "%")


def classify(column: Column, patterns: dict[str, str], *, other: str = "other") -> Column:
    """Names of all patterns that are found, in their order, or ``other``."""
    found = F.array_compact(F.array(*(F.when(column.rlike(p), F.lit(name)) for name, p in patterns.items())))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(other)))


def availability(column: Column, *, past: str, present: str, inherited: str = "inherited") -> Column:
    """current, historical, mixed-summary where both are said, inherited where neither is."""
    was, now = column.rlike(past), column.rlike(present)
    return F.when(was & now, "mixed-summary").when(was, "historical").when(now, "current").otherwise(inherited)


def apply_replacements(column: Column, literals: dict[str, str], blacklist: dict[str, list[str]] | None = None) -> Column:
    """Literal replacements, longest first, after blanking out listed phrases."""
    for replacement, values in (blacklist or {}).items():
        for v in sorted(values, key=lambda x: (-len(x), x)):
            column = F.replace(column, F.lit(v), F.lit(replacement))
    for raw in sorted(literals, key=lambda x: (-len(x), x)):
        column = F.replace(column, F.lit(raw), F.lit(literals[raw]))
    return column


def page_name(url: Column, marker: str) -> Column:
    """The decoded path of a URL after a marker folder; empty if it isn't there."""
    path = F.try_url_decode(F.regexp_replace(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), r"\+", "%2B"))
    at = F.instr(path, marker)
    return F.when(at > 0, F.regexp_replace(F.substring(path, at + len(marker), F.length(path)), "^/+|/+$", "")).otherwise("")


def page_url(base: str, name: Column) -> Column:
    """The address of a page by its name: all but unreserved characters as escapes."""
    return F.concat(F.lit(base), F.replace(F.replace(F.url_encode(name), F.lit("+"), F.lit("%20")), F.lit("%7E"), F.lit("~")))


def page_name_candidates(name: Column) -> Column:
    """Names under which an item may have its page: as it is, with the other plus sign, without spaces; each once."""
    clean = collapse(name)
    forms = F.array(clean, F.replace(clean, F.lit("+"), F.lit("＋")), F.replace(clean, F.lit("＋"), F.lit("+")), F.replace(clean, F.lit(" "), F.lit("")))
    return F.filter(F.array_distinct(forms), lambda x: x != "")


# The table of the asset codes' formula.
_ASSET_CODES = (
    6657, 5699, 3371, 8909, 7719, 6229, 5449, 8561, 2987, 5501, 3127, 9319, 4365, 9811, 9927, 2423, 3439, 1865, 5925, 4409,
    5509, 1517, 9695, 9255, 5325, 3691, 5519, 6949, 5607, 9539, 4133, 7795, 5465, 2659, 6381, 6875, 4019, 9195, 5645, 2887,
    1213, 1815, 8671, 3015, 3147, 2991, 7977, 7045, 1619, 7909, 4451, 6573, 4545, 8251, 5983, 2849, 7249, 7449, 9477, 5963,
    2711, 9019, 7375, 2201, 5631, 4893, 7653, 3719, 8819, 5839, 1853, 9843, 9119, 7023, 5681, 2345, 9873, 6349, 9315, 3795,
    9737, 4633, 4173, 7549, 7171, 6147, 4723, 5039, 2723, 7815, 6201, 5999, 5339, 4431, 2911, 4435, 3611, 4423, 9517, 3243,
)


def asset_code(item: Column, kind: str) -> Column:
    """The four digits that a picture's address has beside an item's number, by the kind of picture."""
    at = (F.lit(sum(map(ord, kind))) + item * len(kind)) % len(_ASSET_CODES)
    return (F.lit(17) * (item + 7) * F.get(F.array(*map(F.lit, _ASSET_CODES)), at.cast("int")) % 8973 + 1000).cast("string")


def cache_key(url: Column) -> Column:
    """Host and path of a URL as a file path: folders get ``index.html``, names without an ending ``.html``."""
    host, path = F.try_parse_url(url, F.lit("HOST")), F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    full = F.concat(host, F.when(path == "", "/").otherwise(path))
    return F.when(full.endswith("/"), F.concat(full, F.lit("index.html"))).when(~F.element_at(F.split(full, "/"), -1).contains("."), F.concat(full, F.lit(".html"))).otherwise(full)


def route_id(kind: Column, ids: Column, detail: Column) -> Column:
    """``kind:ids or all:first twelve digits of the sha1 of the detail``."""
    listed = F.when(F.size(ids) > 0, F.array_join(ids.cast("array<string>"), "-")).otherwise("all")
    return F.concat_ws(":", kind, listed, F.substring(F.sha1(detail.cast("binary")), 1, 12))


def bump(version: Column, part: str) -> Column:
    """The next major, minor or patch version of ``x.y.z``; null if it is no such version."""
    numbers = F.transform(F.split(version, r"\."), lambda x: x.try_cast("int"))
    sound = version.rlike(r"^(0|[1-9]\d*)\.(0|[1-9]\d*)\.(0|[1-9]\d*)$")
    n = [numbers[i] for i in range(3)]
    zero = F.lit(0)
    new = {"major": (n[0] + 1, zero, zero), "minor": (n[0], n[1] + 1, zero), "patch": (n[0], n[1], n[2] + 1)}[part]
    return F.when(sound, F.concat_ws(".", *(x.cast("string") for x in new)))

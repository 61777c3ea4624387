"""Secret scanning: three base patterns, and literals found by assignment-aware lexing.

The lexer starts at every ``=``, ``:``, ``:=`` or ``=>`` of a text, reads the target name before it (dotted
paths, subscripts, quoted keys, annotated names) and the expression after it (quoted strings, joined strings,
bare configuration values, names). Names assigned to literals are constants of the document; a target that is
assigned a name takes the constant's literal, through chains of any length. A literal is reported when its
target names (its own, and those it is propagated to) are sensitive enough and it looks like a value and not
like a placeholder. Literals that a base span overlaps are not reported again.

Each row is handled alone, on UTF-8 bytes; spans are code points, end exclusive. The operator is one narrow
Arrow stage without a shuffle.

Defined cases: null and empty texts have no spans; repeated rows and ids are handled row by row; texts, names,
annotations and literals may have any length, and each is read in time in proportion to it; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices, text_buffer

# Fixed values of the contract.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "lex")

THRESHOLD = 0.5
#: How much a word of a target name speaks for a secret; pairs are of adjacent words.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "passcode": 0.9, "pwd": 0.9, "secret": 1.0, "secrets": 0.9,
    "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "authtoken": 1.0,
    "api key": 1.0, "access key": 0.9, "private key": 1.0, "secret key": 1.0, "signing key": 0.9,
    "encryption key": 0.9, "auth key": 0.9, "session key": 0.8, "client secret": 1.0, "shared key": 0.8,
    "account key": 0.8, "master key": 0.9, "connection string": 0.7,
}
#: Words that make a name speak of something about a secret, not of the secret.
DAMPING = frozenset("count counts length len size max min limit type name names file path dir url uri regex pattern field label prompt hint id index policy expiry expires ttl lifetime enabled required".split())
PLACEHOLDERS = re.compile(r"^(?:none|null|nil|true|false|undefined|todo|tbd|changeme|change[-_]me|example|test|dummy|sample|redacted|password|secret|token|x+|\*+|\.+|-+|_+|0+|your.*|my[-_].*|<.*>|\$\{.*\}|\$\(.*\)|\{\{.*\}\}|%\(.*|\$[A-Za-z_]\w*)$", re.IGNORECASE)

_OPERATOR = re.compile(rb"(?<![=!<>:+\-*/%&|^~])(?::=|=>|=(?![=~])|:(?![:/=]))")
# What stands before an operator, read backwards from it, byte by byte: blanks, an annotation, the name.
_SEGMENT = rb"[\w$]*[A-Za-z_$]"
_PATH = rb"(?P<path>" + _SEGMENT + rb"(?:[.\-]" + _SEGMENT + rb")*)"
_NAME_BACK = re.compile(rb"[ \t]*+(?:\]\s*+[\"']?(?P<key>[\w.\-]++)[\"']?\s*+\[\s*+" + _PATH.replace(b"path", b"owner") + rb"|(?P<q>[\"'])(?P<quoted>[\w.\- ]++)(?P=q)|" + _PATH + rb")")
_NOTE_BACK = re.compile(rb"[ \t]*+[\w.\[\], |]*[A-Za-z_][ \t]*+:")
_BLANKS = re.compile(rb"[ \t]*+")
_ASSIGNED = re.compile(rb"=(?![=~])")
_QUOTED = re.compile(rb"""[rRbBuUfF@]{0,2}(?:"((?:[^"\\\n]|\\.)*+)"|'((?:[^'\\\n]|\\.)*+)'|`([^`]*+)`)""", re.DOTALL)
#: What may stand between the line's begin and the name of a bare configuration value.
_LEADS = (b"export", b"set", b"-", b"ENV", b"const", b"let", b"var", b"final", b"{", b",")
_JOIN = re.compile(rb"[ \t]*+(?:(?:\+|\.{1,2}|\\\n)[ \t]*+)?+(?:\n[ \t]*+)?+(?=[rRbBuUfF@]{0,2}[\"'`])")
_BARE = re.compile(rb"""[^\s"'`,;(){}\[\]<>]+""")
_IDENTIFIER = re.compile(rb"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)*\Z")
_WORDS = re.compile(r"[A-Z]+(?=[A-Z][a-z])|[A-Z]?[a-z]+|[A-Z]+|\d+")


def name_score(name: str) -> float:
    """How sensitive a target name is, 0 to 1, by its words in any of the usual spellings."""
    words = [w.lower() for w in _WORDS.findall(name)]
    pairs = [*words, *(f"{a} {b}" for a, b in zip(words, words[1:])), *(a + b for a, b in zip(words, words[1:]))]
    best = max((SENSITIVE.get(w, 0.0) for w in pairs), default=0.0)
    return best * (0.3 if words and words[-1] in DAMPING else 1.0)


def literal_score(value: str) -> float:
    """How much a literal looks like a value that is kept secret, 0 to 1."""
    if len(value) < 6 or any(c.isspace() for c in value.strip()) and len(value.split()) > 4 or PLACEHOLDERS.match(value.strip()):
        return 0.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", r"\d", r"[^\w\s]"))
    return min(1.0, 0.25 + 0.05 * min(n, 16) / 2 + 0.1 * min(entropy, 4.0) - 0.1 + 0.1 * (kinds - 1))


def _leads(text: bytes, start: int) -> bool:
    """Whether a name begins its line, but for a word that may stand before it."""

    def blank(end: int) -> int:
        """Where the blanks that end here begin; -1 if only they are in the line."""
        at = end
        while at and text[at - 1] in b" \t\r\f\v":
            at -= 1
        return -1 if not at or text[at - 1] == 10 else at

    at = blank(start)
    return at < 0 or any(text.endswith(word, 0, at) and blank(at - len(word)) < 0 for word in _LEADS)


def _targets(text: bytes) -> Iterator[tuple[str, int, bool]]:
    """(target name, where its value begins, whether the name begins a line) of each assignment."""
    back, n = text[::-1], len(text)
    for found in _OPERATOR.finditer(text):
        at = n - found.start()
        note = _NOTE_BACK.match(back, at)
        name = _NAME_BACK.match(back, note.end()) if note else None
        if name and found.group() == b":":
            continue  # the name before is that of another pair
        name = name or _NAME_BACK.match(back, at)
        if name:
            raw = (name["key"] or name["path"] or name["quoted"])[::-1]
            yield raw.decode("utf-8", "replace"), _BLANKS.match(text, found.end()).end(), _leads(text, n - name.end())


def _value(text: bytes, at: int, bare: bool) -> tuple[int, int, str | None, str | None]:
    """(start, end, literal, name referred to) of the expression at a place."""
    found = _QUOTED.match(text, at)
    if found:
        group = next(k for k in (1, 2, 3) if found[k] is not None)
        parts, start, end = [found[group]], found.start(group), found.end(group)
        while (join := _JOIN.match(text, found.end())) and (join.group().strip() or b"\n" not in join.group()) and (more := _QUOTED.match(text, join.end())):
            group = next(k for k in (1, 2, 3) if more[k] is not None)
            parts.append(more[group])
            end, found = more.end(group), more
        return start, end, b"".join(parts).decode("utf-8", "replace"), None
    found = _BARE.match(text, at)
    if not found:
        return at, at, None, None
    word = found.group().rstrip(b".,:")
    after = _BLANKS.match(text, found.end()).end()
    # a call, or the annotation of a name, is no literal
    value = text[found.end() : found.end() + 1] not in (b"(", b"[") and not _ASSIGNED.match(text, after)
    if _IDENTIFIER.match(word):
        return at, at + len(word), word.decode() if bare and value else None, word.decode() if value else None
    return at, at + len(word), word.decode("utf-8", "replace") if bare and value else None, None


def lex(text: bytes) -> list[tuple[int, int]]:
    """Byte spans of the literals of a text that are assigned, directly or through constants, to sensitive names."""
    literals: dict[str, tuple[int, int, str]] = {}
    refers: list[tuple[str, str, tuple[int, int, str] | None]] = []
    targets: dict[tuple[int, int, str], set[str]] = {}
    for name, at, bare in _targets(text):
        start, end, literal, other = _value(text, at, bare)
        if other is not None:
            refers.append((name, other, None if literal is None else (start, end, literal)))
        elif literal is not None:
            literals[name] = (start, end, literal)
            targets.setdefault((start, end, literal), set()).add(name)
    # constants go through chains of names: a name that gets a literal settles those that wait for it, each once
    waits: dict[str, list[int]] = {}
    settled = [False] * len(refers)

    def settle(first: int) -> None:
        queue = [first]
        while queue:
            k = queue.pop()
            name, other, _ = refers[k]
            source = literals.get(other) or literals.get(other.rpartition(".")[2])
            if settled[k] or source is None:
                continue
            settled[k] = True
            targets.setdefault(source, set()).add(name)
            if name not in literals:
                literals[name] = source
                queue += waits.pop(name, ())

    for k, (_, other, _) in enumerate(refers):
        for key in {other, other.rpartition(".")[2]}:
            waits.setdefault(key, []).append(k)
    for k in range(len(refers)):
        settle(k)
    for k, (name, _, own) in enumerate(refers):  # names of nothing known: bare configuration values
        if own is not None and not settled[k]:
            targets.setdefault(own, set()).add(name)
    found = []
    for (start, end, literal), names in targets.items():
        sensitive = max(map(name_score, names))
        if sensitive and sensitive * literal_score(literal) >= THRESHOLD:
            found.append((start, end))
    return sorted(found)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        raw, offsets = text_buffer(batch.column("text"))
        n = batch.num_rows
        # one scan of all rows: a zero byte, which no pattern has, stands between them
        joined = np.zeros(len(raw) + n, np.uint8)
        joined[np.arange(len(raw)) + np.repeat(np.arange(n), np.diff(offsets))] = raw
        begins = offsets[:-1] + np.arange(n)
        data = joined.tobytes()
        spans: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
        for kind, pattern in enumerate((ASSIGN, ACCESS, HEX)):
            for found in pattern.finditer(data):
                a, b = found.span()
                if kind == 0 and len(found[2]) < 6 or kind == 1 and b - a < 20:
                    continue
                row = int(np.searchsorted(begins, a, "right")) - 1
                spans[row].append((a - int(begins[row]), kind, b - int(begins[row])))
        marks = np.flatnonzero((raw == 0x3D) | (raw == 0x3A))
        for row in np.unique(np.searchsorted(offsets, marks, "right") - 1).tolist():
            base = list(spans[row])
            for a, b in lex(data[int(begins[row]) : int(begins[row] + offsets[row + 1] - offsets[row])]):
                if not any(a < y and x < b for x, _, y in base):
                    spans[row].append((a, 3, b))
        out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
        for row, own in enumerate(spans):
            own.sort()
            if own:
                wide = (raw[offsets[row] : offsets[row + 1]] & 0xC0) != 0x80
                if not wide.all():  # byte places to code points
                    place = np.concatenate([[0], np.cumsum(wide)])
                    own = [(int(place[a]), k, int(place[b])) for a, k, b in own]
            text = [f"{KINDS[k]}:{a}:{b}" for a, k, b in own]
            for kind in range(3):
                out[("n_assign", "n_access", "n_hex")[kind]].append(sum(k == kind for _, k, _ in own))
            out["base_sha256"].append(hashlib.sha256(",".join(t for t, (_, k, _) in zip(text, own) if k < 3).encode()).hexdigest())
            out["spans"].append(",".join(text))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(out[k], pa.int64()) for k in ("n_assign", "n_access", "n_hex")), pa.array(out["base_sha256"], pa.string()), pa.array(out["spans"], pa.string())],
            names=["doc_id", *out],
        )


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row for each document: counts of the base kinds, a digest of the base spans, and all spans as ``kind:start:end``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(_scan, schema)


def secret_spans(docs: DataFrame) -> DataFrame:
    """The spans as rows: (doc_id, kind, start, end)."""
    each = find_secrets(docs).where("spans <> ''").select("doc_id", F.explode(F.split("spans", ",")).alias("span"))
    part = F.split("span", ":")
    return each.select("doc_id", part[0].alias("kind"), part[1].cast("long").alias("start"), part[2].cast("long").alias("end"))

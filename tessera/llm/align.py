"""Alignment of two tokenizers' tokens of the same texts.

Both encode a space and the text: A, a byte-level vocabulary, as it is; B, a piece vocabulary, the text, before which it puts the
space itself. A token covers the bytes that it stands for. Places where tokens of A and of B both end cut the tokens into
groups; a token of A and one of B whose bytes end together are linked.

In each Arrow partition DuckDB aligns the tokens: two interval tables on one axis of bytes, as-of joins that find the
first and last token of B that a token of A overlaps, the range between them joined with B, and window sums over the shared ends that number
the groups. Each document's distinct pairs are kept beside it in the shared folder; their counts are added up in each task first and
merged in Spark. The table of pairs has a bound that only the two vocabularies set: of tokens that end together one is a suffix of the other, so
there are no more pairs than bytes in the two vocabularies (times the names that B has for one byte). Every task can have it whole.

Texts are taken apart before spaces that follow other than white space. Neither tokenizer joins anything across such a place (A's
rules begin a part there; no piece of B has its space mark after another character), which is looked up in
their rules, so a stretch that occurs again is aligned once and remembered by its bytes, in a table of bounded size, and new
stretches are encoded many at a time. Tokenizers with other rules get whole texts.

Defined cases: null and empty texts, texts that aren't valid UTF-8, and those whose tokens' bytes are not the text's (B has no piece
for a character, or changes it) have no tokens and zeros, and add nothing to the counts; rows of one id are handled row by row and each
counts; texts may have any length; ties for a token's best partner are all best; an empty table gives an empty result; other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise, set_threads, slices, small_batches, text_buffer
from tessera.llm.words import fingerprints, same_bytes

MEMO = 500_000  # stretches remembered
MEMO_LINKS = 5_000_000
AT_ONCE = 500  # stretches encoded together
# Fixed value: the mark that stands for a space in B's pieces.
_MARK = "▁"
# ASCII white space and what counts as such; bytes that end other white space, by the two bytes before or the one.
_WHITE = np.zeros(256, bool)
_WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_WIDE = {c.encode()[:-1]: [x.encode()[-1] for x in map(chr, range(0x80, 0x3001)) if x.isspace() and x.encode()[:-1] == c.encode()[:-1]] for c in map(chr, range(0x80, 0x3001)) if c.isspace()}


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_of_letter() -> dict[str, int]:
    """The byte-level alphabet: printable bytes of Latin-1 stand for themselves, the others are numbered from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and whether stretches can be encoded alone."""

    def __init__(self, byte_path: str, piece_path: str):
        set_threads()
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True  # their strings are text
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        letters = _byte_of_letter()
        words = {i: bytes(letters[c] for c in word) for word, i in self.a.get_vocab(with_added_tokens=False).items() if all(c in letters for c in word)}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        #: By side and id the bytes of a token, and how many there are.
        self.bytes = [[words.get(i, b"") for i in range(max(words) + 1)], [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]]
        self.sizes = [np.array([len(x) for x in side], np.int64) for side in self.bytes]
        rules = json.loads(self.a.to_str())
        parts = rules.get("pre_tokenizer") or {}
        by_words = not rules.get("normalizer") and parts.get("type") == "ByteLevel" and parts.get("use_regex") and not parts.get("add_prefix_space") and not rules["model"].get("ignore_merges")
        self.local = bool(by_words) and not any(_MARK in self.b.id_to_piece(i).lstrip(_MARK) for i in range(self.b.get_piece_size())) and self._plain()

    def _plain(self) -> bool:
        """Whether B takes texts as they are, but for the space before them."""
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        model.ParseFromString(self.b.serialized_model_proto())
        rule = model.normalizer_spec
        return not rule.precompiled_charsmap and not rule.remove_extra_whitespaces and rule.add_dummy_prefix and not model.trainer_spec.treat_whitespace_as_suffix

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides of texts that begin with a space."""
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)], self.b.encode([x[1:] for x in texts], num_threads=1)


def _after_wide(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the byte before each place ends a white space character beyond ASCII."""
    out = np.zeros(len(at), bool)
    for lead, lasts in _WIDE.items():
        n = len(lead)
        own = np.flatnonzero(at > n)
        here = np.isin(text[at[own] - 1], lasts)
        for k, byte in enumerate(lead):
            here &= text[at[own] - 1 - n + k] == byte
        out[own] |= here
    return out


def cut(text: np.ndarray, rows: np.ndarray, local: bool) -> np.ndarray:
    """Where the stretches of texts begin that each begin with a space, at ``rows``."""
    if not local:
        return rows
    space = np.flatnonzero(text == 0x20)
    # not before a text's last byte: B puts no space before an empty text
    space = np.setdiff1d(space[space > 0], np.append(rows[1:], len(text)) - 1, assume_unique=True)
    space = space[~_WHITE[text[space - 1]]]
    space = space[~_after_wide(text, space)]
    return np.union1d(rows, space)


_ALIGN = """
create or replace temp table spans as
  select a.k as ak, a.u, a.e, a.id as a_id, unnest(range(first.k, last.k + 1)) as bk
  from a asof join b first on a.s >= first.s asof join b last on a.e > last.s;
create or replace temp table links as
  select ak, bk, a_id, b.id as b_id, spans.u from spans join b on b.k = bk where spans.e = b.e;
create or replace temp table ga as
  select a.k, a.u, a.id, coalesce(sum((ak is not null)::int) over (order by a.k rows between unbounded preceding and 1 preceding), 0)::bigint as g from a left join links on ak = a.k;
create or replace temp table gb as
  select b.k, b.u, b.id, coalesce(sum((bk is not null)::int) over (order by b.k rows between unbounded preceding and 1 preceding), 0)::bigint as g from b left join links on bk = b.k
"""


def _joined(ids: np.ndarray, group: np.ndarray, count: int) -> list[str]:
    """The ids of each group, joined by commas."""
    names, n = list(map(str, ids.tolist())), np.bincount(group, minlength=count)
    at = (np.cumsum(n) - n).tolist()
    return [names[i] if k == 1 else ",".join(names[i : i + k]) for i, k in zip(at, n.tolist())]


class Aligner:
    """Stretches of texts with their alignments, each done once and numbered; what is remembered is bounded by ``full``."""

    def __init__(self, byte_path: str, piece_path: str):
        import duckdb

        self.tokenizers = Tokenizers(byte_path, piece_path)
        self.duck = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "512MB", "preserve_insertion_order": False})
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.groups: list[str] = []
        self.sizes = np.zeros((0, 4), np.int64)  # tokens of A and of B, groups, links; none where the tokens' bytes are not the stretch's
        self.links = np.zeros(1, np.int64)  # where each stretch's links begin
        self.pairs = np.zeros(0, np.int64)  # id of A times 2^32, plus id of B

    @property
    def full(self) -> bool:
        return len(self.groups) > MEMO or len(self.pairs) > MEMO_LINKS

    def _encoded(self, stretches: list[bytes]) -> tuple[list[int], tuple[list, list]]:
        """Which stretches have tokens, and the ids of these end to end for either side."""
        t = self.tokenizers
        texts = {}
        for k, x in enumerate(stretches):
            try:
                texts[k] = x.decode()
            except UnicodeDecodeError:
                pass
        # a stretch that ends in white space would change what follows it
        together = [k for k, x in texts.items() if t.local and not x[-1].isspace()]
        parts = [together[k : k + AT_ONCE] for k in range(0, len(together), AT_ONCE)]
        parts += [[k] for k in sorted(texts.keys() - set(together))]
        sound: list[int] = []
        flat: tuple[list, list] = ([], [])
        while parts:
            found = t.encode(["".join(texts[k] for k in part) for part in parts])
            again = []
            for part, *ids in zip(parts, *found):
                raw = b"".join(stretches[k] for k in part)
                if all(b"".join([names[i] for i in own]) == raw for names, own in zip(t.bytes, ids)):
                    sound += part
                    flat[0].append(np.array(ids[0], np.int64))
                    flat[1].append(np.array(ids[1], np.int64))
                elif len(part) > 1:  # one of them has no tokens: which?
                    again += [[k] for k in part]
            parts = again
        return sound, flat

    def learn(self, stretches: list[bytes]) -> None:
        """Align stretches not met before."""
        n = len(stretches)
        sound, flat = self._encoded(stretches)
        sizes, texts, links, pairs = np.zeros((n, 4), np.int64), [""] * n, np.zeros(n, np.int64), np.zeros(0, np.int64)
        if sound:
            ends = np.cumsum([len(stretches[k]) for k in sound])
            order = np.array(sound, np.int64)
            ids = [np.concatenate(x) for x in flat]
            for name, side in (("a", 0), ("b", 1)):
                end = np.cumsum(self.tokenizers.sizes[side][ids[side]])
                self.duck.register(name, pa.table({"k": np.arange(len(end)), "u": np.searchsorted(ends, end), "s": np.concatenate([[0], end[:-1]]), "e": end, "id": ids[side]}))
            self.duck.execute(_ALIGN)
            sides = [self.duck.execute(f"select u, id, g from {x} order by k").fetchnumpy() for x in ("ga", "gb")]
            count = int(sides[0]["g"][-1]) + 1
            joined = [a + "|" + b for a, b in zip(*(_joined(x["id"], x["g"], count) for x in sides))]
            owner = np.zeros(count, np.int64)
            owner[sides[0]["g"]] = sides[0]["u"]
            n_groups = np.bincount(owner, minlength=len(sound))
            at = np.cumsum(n_groups) - n_groups
            for k, i, m in zip(sound, at.tolist(), n_groups.tolist()):
                texts[k] = joined[i] if m == 1 else ";".join(joined[i : i + m])
            linked = self.duck.execute("select u, a_id, b_id from links order by ak").fetchnumpy()
            n_links = np.bincount(linked["u"], minlength=len(sound))
            sizes[order] = np.column_stack([*(np.bincount(x["u"], minlength=len(sound)) for x in sides), n_groups, n_links])
            links[order] = n_links
            # links are in the order of the sound stretches; they are put in the order of all
            own = (np.asarray(linked["a_id"], np.int64) << 32) | np.asarray(linked["b_id"], np.int64)
            pairs = own[np.argsort(order[linked["u"]], kind="stable")]
        self.number.update(zip(stretches, range(len(self.groups), len(self.groups) + n)))
        self.groups += texts
        self.sizes = np.concatenate([self.sizes, sizes])
        self.links = np.concatenate([self.links, self.links[-1] + np.cumsum(links)])
        self.pairs = np.concatenate([self.pairs, pairs])

    def read(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the stretches of all texts, where each text's begin); a text without tokens has none."""
        raw, offsets = text_buffer(column)
        n = len(offsets) - 1
        filled = np.flatnonzero(np.diff(offsets))
        rows = offsets[filled] + np.arange(len(filled))  # a space before each text that isn't empty
        text = np.full(len(raw) + len(filled), 0x20, np.uint8)
        text[np.arange(len(raw)) + np.repeat(np.arange(1, len(filled) + 1), np.diff(offsets)[filled])] = raw
        starts = cut(text, rows, self.tokenizers.local)
        ends = np.append(starts[1:], len(text))[: len(starts)]
        first, inverse = np.unique(fingerprints(text, starts, ends), return_index=True, return_inverse=True)[1:]
        inverse = inverse.ravel()
        if not same_bytes(text, starts, ends - starts, first[inverse]):
            first = inverse = np.arange(len(starts))
        data = text.tobytes()
        distinct = [data[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        new = list(dict.fromkeys(x for x in distinct if x not in self.number))
        if new:
            self.learn(new)
        numbers = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))[inverse]
        counts = np.zeros(n, np.int64)
        counts[filled] = np.diff(np.append(np.searchsorted(starts, rows), len(starts)))
        begins = np.concatenate([[0], np.cumsum(counts)])
        bad = np.repeat(np.arange(n), counts)[self.sizes[numbers, 0] == 0]
        if len(bad):
            keep = np.ones(n, bool)
            keep[bad] = False
            numbers = numbers[np.repeat(keep, counts)]
            begins = np.concatenate([[0], np.cumsum(np.where(keep, counts, 0))])
        return numbers, begins


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(paths: tuple[str, str]) -> Aligner:
    """The worker's aligner, with what it remembers."""
    if paths not in _aligners:
        _aligners[paths] = Aligner(*paths)
    return _aligners[paths]


def _texts(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


_ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def align_texts(docs: DataFrame, *, paths: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every row: its distinct pairs, sorted, and how many links each has."""
    paths = paths or tokenizer_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            aligner = _aligner(paths)
            if aligner.full:
                aligner.clear()
            numbers, begins = aligner.read(batch.column("text"))
            n = batch.num_rows
            sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(aligner.sizes[numbers], axis=0)])
            totals = sums[begins[1:]] - sums[begins[:-1]]
            text = aligner.groups.__getitem__
            spans = list(zip(begins.tolist(), begins[1:].tolist()))
            digests = [hashlib.sha256(";".join(map(text, numbers[a:b].tolist())).encode()).hexdigest() if b > a else "" for a, b in spans]
            many = aligner.sizes[numbers, 3]
            at = np.repeat(aligner.links[numbers] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            pairs, row = aligner.pairs[at], np.repeat(np.arange(n), totals[:, 3])
            order = np.lexsort((pairs, row))
            pairs, row = pairs[order], row[order]
            head = np.append(True, (pairs[1:] != pairs[:-1]) | (row[1:] != row[:-1]))[: len(pairs)]
            place = np.flatnonzero(head)
            times = np.diff(np.append(place, len(pairs))).astype("<u4")
            ends = np.searchsorted(row[place], np.arange(n + 1))
            kept = pairs[place].astype("<i8")
            own = [(kept[a:b].tobytes(), times[a:b].tobytes()) for a, b in zip(ends.tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(totals[:, k]) for k in range(4)), pa.array(digests, pa.string()), *(pa.array([x[k] for x in own], pa.binary()) for k in (0, 1))],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
            )

    return _texts(docs).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_ALIGNED}")


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, times, begins) of the rows of a batch."""
    pairs = [np.frombuffer(x, "<i8") for x in batch.column("pairs").to_pylist()]
    times = [np.frombuffer(x, "<u4") for x in batch.column("times").to_pylist()]
    nothing = np.zeros(0, np.int64)
    return np.concatenate([*pairs, nothing]), np.concatenate([*times, nothing]).astype(np.int64), np.concatenate([[0], np.cumsum([len(x) for x in pairs])]).astype(np.int64)


def _added(pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, inverse = np.unique(pairs, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, inverse.ravel(), n)
    return distinct, total


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a_id, b_id, n): how many links of the corpus each pair has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            pairs, times, _ = _unpacked(batch)
            known, n = _added(np.concatenate([known, pairs]), np.concatenate([n, times]))
        yield pa.RecordBatch.from_arrays([pa.array(known >> 32), pa.array(known & 0xFFFFFFFF), pa.array(n)], names=["a_id", "b_id", "n"])

    return aligned.select("pairs", "times").mapInArrow(run, "a_id long, b_id long, n long").groupBy("a_id", "b_id").agg(F.sum("n").alias("n"))


def best_pairs(counts: DataFrame) -> DataFrame:
    """The counts with ``best``: whether no pair of that id of B has a higher one."""
    return counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b_id")))


def align(docs: DataFrame, *, paths: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    aligned = materialise(align_texts(docs, paths=paths), "aligned")
    # bounded by the vocabularies, see above
    table = best_pairs(pair_counts(aligned)).toArrow()
    keys = (table.column("a_id").to_numpy() << 32) | table.column("b_id").to_numpy()
    order = np.argsort(keys)
    shared = docs.sparkSession.sparkContext.broadcast((keys[order], table.column("n").to_numpy()[order], np.asarray(table.column("best"))[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            pairs, times, begins = _unpacked(batch)
            at = np.searchsorted(known, pairs)
            sums = [np.concatenate([[0], np.cumsum(times * x[at])]) for x in (best, n)]
            arrays = {c: batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
            arrays |= {c: pa.array(x[begins[1:]] - x[begins[:-1]]) for c, x in zip(("n_best", "count_sum"), sums)}
            arrays["groups_sha256"] = batch.column("groups_sha256")
            yield pa.RecordBatch.from_arrays([*arrays.values()], names=[*arrays])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return aligned.mapInArrow(run, schema)


def groups(docs: DataFrame, *, paths: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, place, a_ids, b_ids): the groups of every text as rows, in order."""
    paths = paths or tokenizer_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            aligner = _aligner(paths)
            if aligner.full:
                aligner.clear()
            numbers, begins = aligner.read(batch.column("text"))
            found = [[g for k in numbers[a:b].tolist() for g in aligner.groups[k].split(";")] for a, b in zip(begins.tolist(), begins[1:].tolist())]
            sides = [[[list(map(int, ids.split(","))) for ids in g.split("|")] for g in own] for own in found]
            rows = np.repeat(np.arange(len(found)), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows)), pa.array([k for own in found for k in range(len(own))], pa.int64()), *(pa.array([g[s] for own in sides for g in own], pa.list_(pa.int64())) for s in (0, 1))],
                names=["doc_id", "place", "a_ids", "b_ids"],
            )

    return _texts(docs).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, place long, a_ids array<long>, b_ids array<long>")

"""Benchmark decontamination by suffix arrays of the training text.

The benchmark is written once to the shared folder, in blocks of about ``block_bytes`` of text: its vocabulary, its
items as word numbers, and for each window size the sorted fingerprints of its windows. Workers memory-map the
blocks (and read them where the folder is no local path, once for a task as far as memory goes).

Each slice of the documents is a shard. Its suffix array holds all suffixes of its texts, in the order of all words that
follow up to one that the benchmark lacks, by prefix doubling. It is binary-searched for every test suffix whose beginning has the fingerprint
of a window of the shard, as no other can be in it; that gives its verbatim occurrences and their places, and
neighbouring ones make up the longest matches.
No row leaves its partition, and each is judged alone: there is no shuffle and no join, however large the benchmark.

Defined cases: null and empty texts have no words, are never hit and never contaminate; items without words
are ignored; repeated items count once for each id; repeated documents are judged row by row; a null item id
is named ``null``; an empty table gives an empty result; other columns of either table are not looked at.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keep_rows, load_shared, local_path, make_shared, open_shared, scratch_path, slices, text_buffer
from tessera.llm.words import ALNUM, Words, mix, split

WINDOW = 13
BLOCK_BYTES = 16_000_000  # building a block takes some 35 bytes of memory for each of its bytes
KEPT_BYTES = 128_000_000  # of the index, that a task keeps where it has to read it
_KINDS = {"vocabulary": "<u8", "numbers": "<u4", "begins": "<i8", "names": "u1", "name_ends": "<i8"}


def _window_prints(numbers: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of the windows of ``size`` numbers that begin at places."""
    out = np.full(len(starts), size, np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + numbers[starts + k].astype(np.uint64))
    return out


def _keys(numbers: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int, fill: int = 0) -> np.ndarray:
    """The numbers from each place on, as byte strings that sort as they do; beyond its size a row is filled up."""
    step = np.arange(width)
    rows = numbers[np.minimum(starts[:, None] + step, len(numbers) - 1)].astype(np.int64)
    rows[step[None, :] >= sizes[:, None]] = fill
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * width}").ravel()


def suffix_array(numbers: np.ndarray) -> np.ndarray:
    """Places in the order of the suffixes that begin there, each up to the next 0, by prefix doubling.

    The first order is of as many numbers as 63 bits hold; then only suffixes are ordered again that some other is still like.
    """
    n = len(numbers)
    numbers = numbers.astype(np.int64)
    ends = np.append(np.flatnonzero(numbers == 0), n)
    left = np.repeat(ends, np.diff(ends, prepend=-1))[:n] - np.arange(n)  # numbers up to the next 0
    width = max(int(numbers.max(initial=0)).bit_length(), 1)
    reach = max(63 // width, 1)
    key = numbers.copy()
    for k in range(1, min(reach, n)):
        key <<= width
        key[: n - k] |= np.where(left[: n - k] > k, numbers[k:], 0)
    order = np.argsort(key)
    rank, at, key = np.empty(n, np.int64), np.arange(n), key[order]  # at: where in the order those stand that are ordered again
    while len(at):
        new = np.ones(len(at), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(at)))
        rank[order[at]] = np.repeat(at[first], size)
        alike = (size > 1) & (np.maximum.reduceat(left[order[at]], first) > reach)
        at = at[np.repeat(alike, size)]
        place = order[at]
        key = rank[place] * (n + 1)
        far = np.flatnonzero(left[place] > reach)
        key[far] += rank[place[far] + reach] + 1
        again = np.argsort(key)
        order[at], key = place[again], key[again]
        reach *= 2
    return order


@dataclass
class Block:
    """A block of the benchmark: files under one name, and the window sizes that it has."""

    file: str
    sizes: list[int]
    window: int
    arrays: dict[str, np.ndarray] = field(default_factory=dict)

    def __getstate__(self):
        return (self.file, self.sizes, self.window)

    def __setstate__(self, state):
        self.file, self.sizes, self.window = state
        self.arrays = {}

    def get(self, kind: str) -> np.ndarray:
        if kind not in self.arrays:
            self.arrays[kind] = load_shared(f"{self.file}.{kind}", _KINDS.get(kind, "<u8" if kind.startswith("prints") else "<i8"))
        return self.arrays[kind]

    def release(self, blocks: list[Block]) -> None:
        """Forget what has been read, where it isn't memory-mapped and a task's blocks hold more than ``KEPT_BYTES``."""
        if local_path(self.file) is None and sum(x.nbytes for b in blocks for x in b.arrays.values()) > KEPT_BYTES:
            self.arrays.clear()

    @property
    def seen(self) -> np.ndarray:
        if "seen" not in self.arrays:
            self.arrays["seen"] = np.zeros(1 << 20, bool)
            self.arrays["seen"][(np.asarray(self.get("vocabulary")) >> np.uint64(44)).astype(np.int64)] = True
        return self.arrays["seen"]

    def numbers_of(self, prints: np.ndarray) -> np.ndarray:
        """Vocabulary numbers of words, 0 for words that no item has."""
        vocabulary = self.get("vocabulary")
        out = np.zeros(len(prints), np.int64)
        maybe = np.flatnonzero(self.seen[(prints >> np.uint64(44)).astype(np.int64)])
        at = np.searchsorted(vocabulary, prints[maybe])
        at[at == len(vocabulary)] = 0
        found = vocabulary[at] == prints[maybe]
        out[maybe[found]] = at[found] + 1
        return out

    def search(self, words: Words, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """Occurrences as (word place, number of the window); for each window its places in the items, and its size."""
        nothing = np.zeros(0, np.int64), np.zeros(0, np.int64), [], np.zeros(0, np.int64)
        number = self.numbers_of(prints)
        stop = number == 0
        ends = np.unique(np.concatenate([np.flatnonzero(stop), words.offsets[1:]]))
        place = np.flatnonzero(~stop)
        run = ends[np.searchsorted(ends, place, "right")] - place  # vocabulary words from here on, within the document
        # which test suffixes are worth a search: those whose beginning has the fingerprint of a window of the shard
        tests, sizes = [], []
        for size in self.sizes:
            starts = place[run >= size]
            own = _window_prints(number, starts, size)
            known = self.get(f"prints{size}")
            at = np.searchsorted(known, own)
            at[at == len(known)] = 0
            hit = known[at] == own if len(known) else np.zeros(len(own), bool)
            wanted = np.unique(at[hit])
            last = np.searchsorted(known, known[wanted], "right")
            test = self.get(f"places{size}")
            tests += [np.asarray(test[a:b]) for a, b in zip(wanted.tolist(), last.tolist())]
            sizes += [size] * len(wanted)
        if not tests:
            return nothing
        # the suffix array of the shard: all its words that the benchmark has, a 0 where others stand between them
        turn = np.concatenate([[0], np.cumsum(np.diff(np.searchsorted(ends, place, "right")) > 0)])
        text = np.zeros(len(place) + int(turn[-1]) + 1, np.int64)
        at = np.arange(len(place)) + turn
        text[at] = number[place]
        word = np.full(len(text), -1)
        word[at] = place
        order = suffix_array(text)
        order = order[text[order] > 0]
        left = np.append(np.flatnonzero(text == 0), len(text))
        left = left[np.searchsorted(left, order)] - order
        # no window is in a suffix that is shorter than all of them
        order, left = order[left >= min(sizes)], left[left >= min(sizes)]
        sorted_keys = _keys(text, order, left, self.window)
        # binary search of every test suffix up to its window's size
        size = np.array(sizes, np.int64)
        first = np.array([t[0] for t in tests], np.int64)
        items = self.get("numbers")
        low = np.searchsorted(sorted_keys, _keys(items, first, size, self.window), "left")
        high = np.searchsorted(sorted_keys, _keys(items, first, size, self.window, 0xFFFFFFFF), "right")
        count = high - low
        which = np.repeat(np.arange(len(count)), count)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        return word[order[low[which] + inside]], which, tests, size

    def items_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.get("begins"), places, "right") - 1

    def name(self, item: int) -> str:
        ends = self.get("name_ends")
        return self.get("names")[int(ends[item]) : int(ends[item + 1])].tobytes().decode("utf-8", "replace")


def _build(folder: str, window: int):
    """The items of a partition as a block: its files, and a line that names them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(whole) if (whole := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        words = split(*text_buffer(table.column("text")), ALNUM)
        if not len(words):
            return
        file = f"{folder}/{uuid.uuid4().hex}"
        vocabulary, number = np.unique(words.fingerprints(), return_inverse=True)
        counts = np.diff(words.offsets)
        begins = words.offsets + np.arange(len(words.offsets))  # a 0 stands after each item
        numbers = np.zeros(len(words) + len(counts), np.uint32)
        numbers[np.arange(len(words)) + words.rows] = number.ravel() + 1
        names, name_ends = text_buffer(table.column("name"))
        arrays = {"vocabulary": vocabulary, "numbers": numbers, "begins": begins, "names": names, "name_ends": name_ends}
        sizes = sorted(set(np.minimum(counts[counts > 0], window).tolist()))
        for size in sizes:
            of = np.flatnonzero(counts >= window) if size == window else np.flatnonzero(counts == size)
            n = counts[of] - size + 1
            starts = np.repeat(begins[of] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            own = _window_prints(numbers, starts, size)
            order = np.argsort(own, kind="stable")
            arrays |= {f"prints{size}": own[order], f"places{size}": starts[order]}
        for kind, values in arrays.items():
            with open_shared(f"{file}.{kind}", "wb") as out:
                out.write(np.ascontiguousarray(values.astype(_KINDS.get(kind, "<u8" if kind.startswith("prints") else "<i8"))).tobytes())
        yield pa.RecordBatch.from_pydict({"file": [file], "sizes": [sizes]}, schema=pa.schema([("file", pa.string()), ("sizes", pa.list_(pa.int32()))]))

    return run


def index(benchmark: DataFrame, *, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> list[Block]:
    """Write the benchmark's blocks; the driver gets a line for each."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    count = int((items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes) + 1
    folder = make_shared(spark, scratch_path(spark, "benchmark"))
    # one block has a proven bound; more are dealt out by rows
    dealt = items.coalesce(1) if count == 1 else items.repartition(count)
    return [Block(r["file"], list(r["sizes"]), window) for r in sorted(dealt.mapInArrow(_build(folder, window), "file string, sizes array<int>").collect())]


def _rows_of(words: Words, position: np.ndarray) -> np.ndarray:
    return np.searchsorted(words.offsets, position, "right") - 1


def _cover(words: Words, position: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which words lie in a match."""
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, position, 1)
    np.add.at(depth, position + size, -1)
    return np.cumsum(depth[:-1]) > 0


def _hits(words: Words, blocks: list[Block], names: list[set[str]] | None = None) -> np.ndarray:
    """Which words of a shard lie in an occurrence of a window of any block; ``names`` gets each row's items."""
    hit = np.zeros(len(words), bool)
    prints = words.fingerprints() if len(words) else np.zeros(0, np.uint64)
    for block in blocks if len(words) else []:
        position, which, tests, size = block.search(words, prints)
        if len(which):
            hit |= _cover(words, position, size[which])
            if names is not None:
                pairs = np.unique(np.column_stack([_rows_of(words, position), which]), axis=0)
                owners = [np.unique(block.items_of(t)) for t in tests]
                for r, w in pairs.tolist():
                    names[r].update(map(block.name, owners[w].tolist()))
        block.release(blocks)
    return hit


def _spans(words: Words, hit: np.ndarray) -> list[list[int]]:
    """First and end word of the stretches of hit words of each row."""
    spans: list[list[int]] = [[] for _ in range(len(words.offsets) - 1)]
    first = hit.copy()
    first[1:] &= ~hit[:-1]
    begin = words.offsets[:-1][words.offsets[:-1] < words.offsets[1:]]
    first[begin] = hit[begin]
    first = np.flatnonzero(first)
    row = _rows_of(words, first)
    stop = np.append(np.flatnonzero(~hit), len(words))
    last = np.minimum(stop[np.searchsorted(stop, first)], words.offsets[row + 1])
    for r, a, b in zip(row.tolist(), (first - words.offsets[row]).tolist(), (last - words.offsets[row]).tolist()):
        spans[r] += [a, b]
    return spans


_OUT = "doc_id {}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>, spans array<int>"


def _per_row(words: Words, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, hit words, contaminated) of each row."""
    before = np.concatenate([[0], np.cumsum(hit)])
    n_hit, n_words = before[words.offsets[1:]] - before[words.offsets[:-1]], np.diff(words.offsets)
    return n_words, n_hit, (n_hit > 0) & (20 * n_hit >= n_words)


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each document: its words, how many lie in an occurrence of a benchmark window, which items, where.

    ``spans`` lists first and end word of each hit stretch. A document is contaminated if a twentieth of its
    words or more are hit.
    """
    blocks = index(benchmark, window=window, block_bytes=block_bytes)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = split(*text_buffer(batch.column("text")), ALNUM)
            names: list[set[str]] = [set() for _ in range(batch.num_rows)]
            hit = _hits(words, blocks, names)
            n_words, n_hit, bad = _per_row(words, hit)
            listed = [sorted(x) for x in names]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array([len(x) for x in listed], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in listed], pa.string()),
                    pa.array(bad),
                    pa.array(listed, pa.list_(pa.string())),
                    pa.array(_spans(words, hit), pa.list_(pa.int32())),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "spans"],
            )

    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, _OUT.format(id_type))


def longest_matches(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The longest verbatim matches and their places: (doc_id, item_id, doc_word, item_word, n_words), words from 0."""
    blocks = index(benchmark, window=window, block_bytes=block_bytes)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def matches(batch: pa.RecordBatch, words: Words, prints: np.ndarray, block: Block) -> pa.RecordBatch:
        position, which, tests, size = block.search(words, prints)
        many = np.array([len(t) for t in tests], np.int64)[which] if len(which) else np.zeros(0, np.int64)
        begin, length = np.repeat(position, many), np.repeat(size[which], many)
        places = np.concatenate([tests[w] for w in which.tolist()]) if len(which) else np.zeros(0, np.int64)
        row = _rows_of(words, begin)
        # an occurrence that goes on from the one a word before, in text and item, is part of the same match
        order = np.lexsort((begin, begin - places, row))
        row, places, begin, length = (x[order] for x in (row, places, begin, length))
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (begin[1:] != begin[:-1] + 1) | (places[1:] != places[:-1] + 1)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(row))[: len(head)] - 1
        item = block.items_of(places[head])
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(row[head])),
                pa.array([block.name(i) for i in item.tolist()], pa.string()),
                pa.array(begin[head] - words.offsets[row[head]], pa.int64()),
                pa.array(places[head] - np.asarray(block.get("begins"))[item], pa.int64()),
                pa.array(begin[tail] - begin[head] + length[tail], pa.int64()),
            ],
            names=["doc_id", "item_id", "doc_word", "item_word", "n_words"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = split(*text_buffer(batch.column("text")), ALNUM)
            if len(words):
                prints = words.fingerprints()
                for block in blocks:
                    yield matches(batch, words, prints, block)
                    block.release(blocks)

    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, f"doc_id {id_type}, item_id string, doc_word long, item_word long, n_words long")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that are not contaminated, with all their columns; each row is judged by its own text."""
    blocks = index(benchmark, window=window, block_bytes=block_bytes)

    def judge(batch: pa.RecordBatch) -> np.ndarray:
        words = split(*text_buffer(batch.column("text")), ALNUM)
        return ~_per_row(words, _hits(words, blocks))[2]

    return keep_rows(docs, judge)

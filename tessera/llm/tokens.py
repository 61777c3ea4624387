"""Token ids in flat binary files.

A dataset is one folder in the shared folder with three files for each range of ids: ``.bin``, the token ids
of all its documents end to end as unsigned integers (16 bits if the vocabulary allows, else 32, little
endian); ``.off``, unsigned 64-bit offsets of its documents in it, one more than documents; ``.ids``, the
64-bit document ids, then a byte for each that is 0 where the id is null. Ranges are in ascending order of the
ids; where a range begins in the whole dataset comes from prefix sums over the ranges' counts. Readers
memory-map the files where the folder is a local path and read them whole otherwise.

A tokenizer whose own rules take texts apart in the way known here (they are compared at the start) is given each
part once, and the ids of parts are remembered in a table of bounded size; what a rule might join or change across
parts (words with other bytes, texts with the marker of a special token) goes to it whole. Any other tokenizer is given
whole texts.

Each task writes to names of its own and the manifest lists the files of the tasks that ended well, so tasks can
be run again. Defined cases: null and empty texts have the end id only; null ids come first; rows of one id
stand in order of a hash of their text, then of the text; an empty table gives an empty dataset; other columns are not looked at.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import load_shared, make_shared, open_shared, scratch_path, set_threads, slices, text_buffer
from tessera.llm.words import NOT_SPACE, Words, eights, fingerprints, mix, same_bytes, sealed, split

END_ID = 2
SLOT_BITS, WIDTH, KEPT = 20, 10, 24  # of the memory: places for parts, ids and bytes of a part at most
_LETTER, _DIGIT, _MARK, _ODD = 1, 2, 3, 4
_KIND = np.full(256, _ODD, np.uint8)
_KIND[33:127] = _MARK
_KIND[48:58] = _DIGIT
_KIND[97:123] = _LETTER
_KIND[0x27] = _ODD  # an apostrophe may begin a contraction
# The tokenizer's own rules of normalisation and of parts, for which `Encoder` knows the parts.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _ends_of_parts(tokenizer) -> np.ndarray | None:
    """Which ids end a part, if the tokenizer takes texts apart by the rules known here; else None."""
    rules = json.loads(tokenizer.to_str())
    parts = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    model = rules["model"]
    suffix = model.get("end_of_word_suffix")
    known = rules.get("normalizer") == _NORMALIZER and len(parts) == 2 and parts[0].get("pattern") == {"Regex": _PATTERN} and parts[0].get("behavior") == "Removed" and parts[0].get("invert")
    known = known and parts[1].get("type") == "ByteLevel" and not parts[1].get("add_prefix_space") and not parts[1].get("use_regex")
    if not known or model.get("type") != "BPE" or not suffix or model.get("dropout") or model.get("ignore_merges"):
        return None
    out = np.zeros(tokenizer.get_vocab_size(), bool)
    out[[i for word, i in tokenizer.get_vocab().items() if word.endswith(suffix)]] = True
    return out


def _prints(units: Words, length: np.ndarray) -> np.ndarray:
    """Fingerprints of parts: of up to eight bytes from these as one number, of longer ones as of any word."""
    prints = sealed(mix(eights(units.text, units.starts, length)), length)
    long = np.flatnonzero(length > 8)
    prints[long] = fingerprints(units.text, units.starts[long], units.ends[long])
    return prints


class Encoder:
    """A tokenizer with a memory of parts: runs of letters (ASCII and Latin-1), digits, runs of other ASCII, odd words.

    The memory has a place for each value of some bits of a part's fingerprint; a new part takes the place of the old.
    Parts are taken for the same only if their bytes are.
    """

    def __init__(self, path: str):
        set_threads()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends = _ends_of_parts(self.tokenizer)
        self.prints = np.zeros(1 << SLOT_BITS, np.uint64)
        self.sizes = np.zeros(1 << SLOT_BITS, np.int8)
        self.parts = np.zeros((1 << SLOT_BITS, KEPT), np.uint8)
        self.lengths = np.zeros(1 << SLOT_BITS, np.int8)
        self.ids = np.zeros((1 << SLOT_BITS, WIDTH), np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _units(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
        """The parts of a slice, words with odd bytes in one piece, and which of them are such words."""
        words = split(raw, offsets, NOT_SPACE)
        text = words.text
        kind = _KIND[text]
        lead = np.flatnonzero(text == 0xC3)
        lead = lead[lead + 1 < len(text)]
        after = text[lead + 1]
        lead = lead[(after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)]
        kind[lead] = kind[lead + 1] = _LETTER
        odd = np.concatenate([[0], np.cumsum(kind == _ODD)])
        strange = odd[words.ends] > odd[words.starts]
        cut = np.zeros(len(text) + 1, bool)
        cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        within = np.zeros(len(text) + 1, np.int32)  # place by place, whether it lies in a plain word after its first byte
        plain = np.flatnonzero(~strange)
        within[words.starts[plain] + 1] += 1
        within[words.ends[plain]] -= 1
        inner = np.flatnonzero(cut & (np.cumsum(within) > 0))
        starts = np.sort(np.concatenate([words.starts, inner]))
        ends = np.sort(np.concatenate([words.ends, inner]))
        is_odd = np.zeros(len(text) + 1, bool)
        is_odd[words.starts[strange]] = True
        return Words(text, starts, ends, np.searchsorted(starts, offsets)), is_odd[starts]

    def _new(self, data: bytes, starts: list[int], ends: list[int], odd: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts not in the memory, end to end, and how many each has."""
        pieces = [data[a:b].decode("utf-8", "replace") for a, b in zip(starts, ends)]
        plain = [p for p, o in zip(pieces, odd) if not o]
        lines = [" ".join(plain[k : k + 500]) for k in range(0, len(plain), 500)]
        own = np.concatenate([np.array(e.ids, np.int64) for e in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)] or [np.zeros(0, np.int64)])
        bounds = np.concatenate([[0], np.flatnonzero(self.ends[own]) + 1])
        if len(bounds) != len(plain) + 1 or bounds[-1] != len(own):
            raise ValueError("the tokenizer's parts are not those of its rules")
        if len(plain) == len(pieces):
            return own.astype(np.uint32), np.diff(bounds)
        known = iter(np.split(own, bounds[1:-1]))
        found = [self.whole(p) if o else next(known) for p, o in zip(pieces, odd)]
        return np.concatenate([np.asarray(x, np.uint32) for x in found]), np.array([len(x) for x in found])

    def _texts(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts, each encoded by itself."""
        texts = [raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:])]
        found = [np.array([*e.ids, END_ID], np.uint32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return np.concatenate([*found, np.zeros(0, np.uint32)]), np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)])

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a slice, each with the end id, and their offsets."""
        n = len(offsets) - 1
        if self.ends is None:
            return self._texts(raw, offsets)
        units, odd = self._units(raw, offsets)
        length = units.ends - units.starts
        prints, first, inverse = np.unique(_prints(units, length), return_index=True, return_inverse=True)
        if not same_bytes(units.text, units.starts, length, first[inverse.ravel()]):
            return self._texts(raw, offsets)
        slot = (prints >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        length = length[first]
        step = np.arange(KEPT)
        parts = units.text[np.minimum(units.starts[first][:, None] + step, max(len(units.text) - 1, 0))] if len(first) else np.zeros((0, KEPT), np.uint8)
        parts[step >= length[:, None]] = 0
        have = (self.prints[slot] == prints) & (self.sizes[slot] > 0) & (self.lengths[slot] == length) & (self.parts[slot] == parts).all(axis=1)
        old, new = np.flatnonzero(have), np.flatnonzero(~have)
        sizes = np.zeros(len(prints), np.int64)
        sizes[old] = self.sizes[slot[old]]
        known = self.ids[slot[old]][np.arange(WIDTH)[None, :] < sizes[old][:, None]]
        flat, sizes[new] = self._new(units.text.tobytes(), units.starts[first[new]].tolist(), units.ends[first[new]].tolist(), odd[first[new]].tolist()) if len(new) else (np.zeros(0, np.uint32), 0)
        begin = np.zeros(len(prints), np.int64)
        begin[old] = np.cumsum(sizes[old]) - sizes[old]
        begin[new] = len(known) + np.cumsum(sizes[new]) - sizes[new]
        pool = np.concatenate([known, flat])
        short = new[(sizes[new] <= WIDTH) & (sizes[new] > 0) & (length[new] <= KEPT)]
        self.prints[slot[short]] = prints[short]
        # where several new parts have one place, the last of them has taken it
        short = short[self.prints[slot[short]] == prints[short]]
        self.sizes[slot[short]], self.lengths[slot[short]], self.parts[slot[short]] = sizes[short], length[short], parts[short]
        for k in range(WIDTH):
            longer = short[sizes[short] > k]
            self.ids[slot[longer], k] = pool[begin[longer] + k]
        inverse = inverse.ravel()
        before = np.concatenate([[0], np.cumsum(sizes[inverse])])
        at = np.repeat(begin[inverse] - before[:-1], sizes[inverse]) + np.arange(before[-1])
        bounds = before[units.offsets] + np.arange(n + 1)  # with an end id for each row before
        out = np.full(int(before[-1]) + n, END_ID, np.uint32)
        row = np.repeat(np.arange(n), np.diff(before[units.offsets]))
        out[np.arange(before[-1]) + row] = pool[at]
        # the lower-cased words of texts with a marker might hide a special token
        marked = np.flatnonzero((raw[:-1] == 0x3C) & (raw[1:] == 0x7C)) if len(raw) > 1 else np.zeros(0, np.int64)
        if len(marked):
            pieces = np.split(out, bounds[1:-1])
            for r in np.unique(np.searchsorted(offsets, marked, "right") - 1).tolist():
                text = raw[offsets[r] : offsets[r + 1]].tobytes().decode("utf-8", "replace")
                pieces[r] = np.array([*self.whole(text), END_ID], np.uint32)
            out = np.concatenate(pieces)
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        return out, bounds


@dataclass
class Dataset:
    """The manifest: files in order with their documents and tokens, and the totals before each."""

    dtype: str
    files: list[str] = field(default_factory=list)
    documents: list[int] = field(default_factory=list)
    tokens: list[int] = field(default_factory=list)

    @property
    def bases(self) -> list[int]:
        return np.concatenate([[0], np.cumsum(self.tokens)])[:-1].astype(int).tolist() if self.tokens else []

    def document(self, file: int, k: int) -> np.ndarray:
        """The ids of one document, read in place."""
        offsets = load_shared(self.files[file] + ".off", "<u8")
        return load_shared(self.files[file] + ".bin", self.dtype)[int(offsets[k]) : int(offsets[k + 1])]


def write(docs: DataFrame, *, path: str | None = None, vocabulary: str | None = None, partitions: int | None = None) -> Dataset:
    """Encode every text and write the dataset; the manifest has a line for each partition."""
    spark = docs.sparkSession
    vocabulary = vocabulary or tokenizer_path()
    folder = make_shared(spark, path or scratch_path(spark, "tokens"))
    from tokenizers import Tokenizer

    dtype = "<u2" if Tokenizer.from_file(vocabulary).get_vocab_size() <= 1 << 16 else "<u4"
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # the hash shares out the rows of an id that has very many
    order = ["doc_id", F.xxhash64("text"), "text"]
    ordered = ordered.repartitionByRange(n, *order[:2]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        name = f"{folder}/{part:06d}-{uuid.uuid4().hex}"
        encoder, bounds, ids, known, total = None, [np.zeros(1, np.uint64)], [], [], 0
        with open_shared(name + ".bin", "wb") as file:
            for batch in slices(batches, "text"):
                encoder = encoder or _encoder(vocabulary)
                tokens, offsets = encoder.encode(*text_buffer(batch.column("text")))
                file.write(tokens.astype(dtype).tobytes())
                bounds.append(offsets[1:].astype(np.uint64) + np.uint64(total))
                total += len(tokens)
                ids.append(np.asarray(batch.column("doc_id").fill_null(0)))
                known.append(np.asarray(batch.column("doc_id").is_valid()).astype(np.uint8))
        count = sum(map(len, ids))
        if count:
            with open_shared(name + ".off", "wb") as file:
                file.write(np.concatenate(bounds).astype("<u8").tobytes())
            with open_shared(name + ".ids", "wb") as file:
                file.write(np.concatenate(ids).astype("<i8").tobytes() + np.concatenate(known).tobytes())
        yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "documents": [count], "tokens": [total]})

    rows = sorted(r for r in ordered.mapInArrow(run, "part long, file string, documents long, tokens long").collect() if r["documents"])
    return Dataset(dtype, *([r[k] for r in rows] for k in ("file", "documents", "tokens")))


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def read_back(spark: SparkSession, dataset: Dataset) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    files, bases, dtype = dataset.files, dataset.bases, dataset.dtype
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not files:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("id").to_pylist():
                offsets = load_shared(files[k] + ".off", "<u8").astype(np.int64)
                tokens, n = load_shared(files[k] + ".bin", dtype), len(offsets) - 1
                raw = load_shared(files[k] + ".ids", "u1")
                ids, known = np.frombuffer(raw[: 8 * n].tobytes(), "<i8"), np.asarray(raw[8 * n :]) == 1
                for at in range(0, n, 1000):
                    stop = min(at + 1000, n)
                    sums = [zlib.crc32(tokens[a:b].astype("<u4").tobytes()) for a, b in zip(offsets[at:stop], offsets[at + 1 : stop + 1])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at:stop], pa.int64(), mask=~known[at:stop]), pa.array(offsets[at:stop] + bases[k]), pa.array(np.diff(offsets[at : stop + 1])), pa.array(sums, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return spark.range(0, len(files), 1, len(files)).mapInArrow(run, schema)


def encode_and_read(docs: DataFrame, **options) -> DataFrame:
    """Write the dataset in the shared folder and describe its documents from its files."""
    return read_back(docs.sparkSession, write(docs, **options))

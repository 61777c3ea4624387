"""Language-model scoring by deleted interpolation of n-grams.

The probability of a token is a mixture of its maximum-likelihood estimates after 0, 1, ... order - 1 tokens
of context and of a uniform one. The mixture weights depend on how often the longest context was seen (a
bucket for each power of two) and are learned by expectation-maximisation on held-out counts: a part of the
training texts (``dev``) is left out of the counts for that, and what its tokens' estimates are under the
counts of the others is gathered over all of it. The final counts are of all training texts.

Counting moves no token, only distinct n-grams. Texts are tokenised into chunks of bounded size, kept as files in
the shared folder with their tokens as numbers within the chunk. Order by order, each chunk sends its distinct
n-grams with their counts, sorted and packed, to the buckets of a hash; a bucket adds them up and sends each chunk
the totals in the order in which it asked. An n-gram of which a part occurs once in all texts, as the order
before has told, occurs once itself: it is known without asking. Frequent n-grams are counted within the chunk
first, so none is hot. A chunk's totals are files beside it, so that only questions and answers are shuffled.

Defined cases: null and empty texts have one token, the end; texts of any length may span no chunk: a text is
always whole in one; repeated rows and ids count each; with no training rows the model is uniform and N and V
are 0; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod_py, make_shared, materialise, open_shared, return_memory, scratch_path, slices, text_buffer
from tessera.llm.words import NOT_SPACE, mix, split, stream

ORDER = 3
CHUNK_TOKENS = 1_000_000
BUCKET_TOKENS = 4_000_000
BUCKETS = 16  # of context frequencies
ROUNDS = 12
END, BEGIN = stream(2, 99)
_MAIN, _DEV, _HELD = 0, 1, 2
#: Estimates are gathered for the EM by their logarithm to base 2, in steps of a quarter.
_STEP, _FLOOR = 4, 160


def _pack(values: np.ndarray) -> bytes:
    return zlib.compress(values.tobytes(), 1)


def _unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype)


def _pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences, byte plane by byte plane: the upper planes are nearly constant."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    return _pack(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T))


def _unpack_sorted(data: bytes) -> np.ndarray:
    planes = _unpack(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _role(doc_id: int | None, held_modulus: int, held: int, dev: int) -> int:
    rest = crc_mod_py(doc_id, held_modulus)
    return _HELD if rest == held else _DEV if rest == dev else _MAIN


def _chunks(folder: str, held_modulus: int, held: int, dev: int, chunk_tokens: int):
    """Chunks of whole texts of one role, as files: (chunk, role, n, texts, file)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        waiting: list[list] = [[], [], []]  # ids, sizes, tokens of each role

        def flush(role: int) -> pa.RecordBatch:
            nonlocal made
            own, waiting[role] = waiting[role], []
            ids = [i for x, _, _ in own for i in x]
            sizes = np.concatenate([s for _, s, _ in own])
            vocabulary, tokens = np.unique(np.concatenate([t for _, _, t in own]), return_inverse=True)
            made += 1
            small = tokens.ravel().astype(np.uint32)
            file = f"{folder}/{uuid.uuid4().hex}"
            planes = np.ascontiguousarray(small.view(np.uint8).reshape(-1, 4).T)
            _save(file, ids=pa.array([ids], pa.list_(pa.int64())), sizes=_pack(sizes.astype(np.int64)), vocabulary=_pack_sorted(vocabulary), tokens=_pack(planes))
            return pa.RecordBatch.from_pydict({"chunk": [(part << 32) + made], "role": [role], "n": [len(small)], "texts": [len(ids)], "file": [file]}, schema=_schema(_CHUNK))

        for batch in slices(batches, "text"):
            words = split(*text_buffer(batch.column("text")), NOT_SPACE)
            prints = words.fingerprints()
            ids = batch.column("doc_id").to_pylist()
            roles = np.array([_role(i, held_modulus, held, dev) for i in ids])
            counts = np.diff(words.offsets)
            tokens = np.full(len(prints) + len(ids), END, np.uint64)
            tokens[np.arange(len(prints)) + words.rows] = prints
            owner = np.repeat(np.arange(len(ids)), counts + 1)
            for role in (_MAIN, _DEV, _HELD):
                mine = np.flatnonzero(roles == role)
                if len(mine):
                    waiting[role].append(([ids[k] for k in mine.tolist()], counts[mine] + 1, tokens[roles[owner] == role]))
                    if sum(len(t) for _, _, t in waiting[role]) >= chunk_tokens:
                        yield flush(role)
        for role in (_MAIN, _DEV, _HELD):
            if waiting[role]:
                yield flush(role)

    return run


_CHUNK = "chunk long, role int, n long, texts long, file string"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def _save(file: str, **columns) -> None:
    """One row of packed arrays as a file of the shared folder."""
    batch = pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array([v], pa.binary()) for v in columns.values()], names=[*columns])
    with open_shared(file, "wb") as out, pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)


def _fetch(file: str) -> dict:
    with open_shared(file, "rb") as data, pa.ipc.open_stream(data.read()) as reader:
        return reader.read_next_batch().to_pylist()[0]


class Chunk:
    """A chunk's n-grams: for each order the distinct keys, sorted, and each token's place among them."""

    def __init__(self, file: str, order: int):
        stored = _fetch(file)
        self.ids, self.sizes = stored["ids"], _unpack(stored["sizes"], np.int64)
        planes = _unpack(stored["tokens"], np.uint8).reshape(4, -1)
        places = np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)
        words = _unpack_sorted(stored["vocabulary"])
        self.keys, self.places = [words], [places]
        begin = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.since = np.arange(len(places)) - begin[self.row]  # tokens before it in its text
        prints = words[places]
        key = prints
        for back in range(1, order):
            # the token `back` places before, or the begin mark: a text has as many of them as needed
            before = np.full(len(prints), BEGIN, np.uint64)
            before[back:] = np.where(self.since[back:] >= back, prints[:-back], BEGIN)
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + before + np.uint64(back))
            distinct, place = np.unique(key, return_inverse=True)
            self.keys.append(distinct)
            self.places.append(place.ravel())

    def unsure(self, k: int, often: np.ndarray) -> np.ndarray:
        """Of the distinct n-grams of order k + 1 those whose parts all occur twice or more, by the order before."""
        own = often[self.places[k - 1]]  # whether what ends at a token occurs twice
        first = np.ones(len(own), bool)  # and what ends before it; marks only are taken for it
        first[1:] = own[:-1] | (self.since[1:] == 0)
        out = np.zeros(len(self.keys[k]), bool)
        out[self.places[k]] = own & first
        return out

    def counts(self, k: int) -> np.ndarray:
        return np.bincount(self.places[k], minlength=len(self.keys[k]))


def _bucket_cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where the sorted keys' hash ranges begin, one range for each bucket."""
    return np.searchsorted(keys >> np.uint64(1), (np.arange(buckets + 1).astype(object) * ((1 << 63) // buckets)).astype(np.uint64))


_ASK = "bucket int, chunk long, role int, file string, states string, keys binary, counts binary"
_ANSWER = "bucket int, chunk long, role int, file string, states string, train binary, dev binary, often binary, distinct long, total long"


def _ask(chunk: Chunk, k: int, some: np.ndarray | None, buckets: int, row: tuple) -> pa.RecordBatch:
    """A chunk's distinct n-grams of order k + 1, or some of them, by bucket; one empty question if there is none."""
    keys, counts = chunk.keys[k], chunk.counts(k).astype(np.uint32)
    if some is not None:
        keys, counts = keys[some], counts[some]
    cuts = _bucket_cuts(keys, buckets)
    full = np.flatnonzero(np.diff(cuts))
    full = full if len(full) else np.zeros(1, np.int64)
    n = len(full)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(full, pa.int32()),
            *(pa.array([x] * n, kind) for x, kind in zip(row, (pa.int64(), pa.int32(), pa.string(), pa.string()))),
            pa.array([_pack_sorted(keys[cuts[b] : cuts[b + 1]]) for b in full], pa.binary()),
            pa.array([_pack(counts[cuts[b] : cuts[b + 1]]) for b in full], pa.binary()),
        ],
        schema=_schema(_ASK),
    )


def _first(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield _ask(Chunk(r["file"], 1), 0, None, buckets, (r["chunk"], r["role"], r["file"], ""))

    return run


def _answer(group: pa.Table) -> pa.Table:
    """A bucket's totals, for each chunk in the order of its keys; with the first, how many distinct training n-grams it has."""
    keys = [_unpack_sorted(x) for x in group.column("keys").to_pylist()]
    counts = [_unpack(x, np.uint32) for x in group.column("counts").to_pylist()]
    roles = group.column("role").to_pylist()
    all_keys, place = np.unique(np.concatenate(keys), return_inverse=True)
    place = np.split(place.ravel(), np.cumsum([len(x) for x in keys])[:-1])
    total = np.zeros((3, len(all_keys)), np.int64)
    for p, c, role in zip(place, counts, roles):
        total[role][p] += c
    seen, often = total[_MAIN] + total[_DEV], total.sum(axis=0) > 1
    n = len(keys)
    return pa.table(
        {
            **{c: group.column(c) for c in ("bucket", "chunk", "role", "file", "states")},
            "train": pa.array([_pack(seen[p].astype(np.uint32)) for p in place], pa.binary()),
            # only a dev chunk looks at the counts without dev
            "dev": pa.array([_pack(total[_DEV][p].astype(np.uint32)) if role == _DEV else b"" for p, role in zip(place, roles)], pa.binary()),
            "often": pa.array([_pack(np.packbits(often[p])) for p in place], pa.binary()),
            "distinct": pa.array([int((seen > 0).sum())] + [0] * (n - 1), pa.int64()),
            "total": pa.array([int(seen.sum())] + [0] * (n - 1), pa.int64()),
        }
    )


def _state(file: str, role: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(training count, of these in dev, whether it occurs twice) of a chunk's n-grams of one order."""
    stored = _fetch(file)
    train = _unpack(stored["train"], np.uint32).astype(np.int64)
    dev = _unpack(stored["dev"], np.uint32).astype(np.int64) if role == _DEV else np.zeros(len(train), np.int64)
    return train, dev, np.unpackbits(_unpack(stored["often"], np.uint8), count=len(train)).astype(bool)


def _next(k: int, order: int, buckets: int, folder: str):
    """What a chunk does with the answers of order k + 1: keep all its totals as a file, and ask for the order after."""

    def run(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["bucket"])
        at = rows[0]
        role, states = at["role"], [x for x in at["states"].split(",") if x]
        chunk = Chunk(at["file"], min(k + 2, order))
        some = chunk.unsure(k, _state(states[-1], role)[2]) if k else np.ones(len(chunk.keys[0]), bool)
        # what was not asked occurs once, here
        train = np.full(len(some), int(role != _HELD), np.uint32)
        dev = np.full(len(some), int(role == _DEV), np.uint32)
        often = np.zeros(len(some), bool)
        answer = [_unpack(r["train"], np.uint32) for r in rows]
        train[some] = np.concatenate(answer)
        if role == _DEV:
            dev[some] = np.concatenate([_unpack(r["dev"], np.uint32) for r in rows])
        often[some] = np.concatenate([np.unpackbits(_unpack(r["often"], np.uint8), count=len(x)).astype(bool) for r, x in zip(rows, answer)])
        file = f"{folder}/{uuid.uuid4().hex}"
        _save(file, train=_pack(train), dev=_pack(dev) if role == _DEV else b"", often=_pack(np.packbits(often)))
        row = (at["chunk"], role, at["file"], ",".join([*states, file]))
        if k + 1 < order:
            return pa.Table.from_batches([_ask(chunk, k + 1, chunk.unsure(k + 1, often), buckets, row)])
        return pa.table({c: pa.array([x], kind) for c, x, kind in zip(("chunk", "role", "file", "states"), row, (pa.int64(), pa.int32(), pa.string(), pa.string()))})

    return run


class Counted:
    """A chunk with the totals of its n-grams."""

    def __init__(self, row: dict, order: int):
        self.chunk, self.role = Chunk(row["file"], order), row["role"]
        self.ids = self.chunk.ids
        states = [_state(file, self.role) for file in row["states"].split(",")]
        self.train, self.dev = [s[0] for s in states], [s[1] for s in states]

    def estimates(self, with_dev: bool, tokens: int, texts: int, distinct: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context bucket, estimates by order, counts of the token) of each token; the uniform estimate comes first."""
        chunk, order = self.chunk, len(self.train)
        totals = [t if with_dev else t - d for t, d in zip(self.train, self.dev)]
        own = [t[p] for t, p in zip(totals, chunk.places)]
        n = len(chunk.row)
        out = np.zeros((order + 1, n))
        out[0] = 1 / (distinct + 1)
        out[1] = own[0] / tokens if tokens else 0
        context = np.full(n, tokens)
        for k in range(1, order):
            # a context's count is that of the k tokens before, or of texts where they are marks only
            context = np.empty(n, np.int64)
            context[:1] = texts
            context[1:] = own[k - 1][:-1]
            context[chunk.since == 0] = texts
            # without its context an estimate is that of the next lower order, so what its weight stands for isn't lost
            out[k + 1] = np.divide(own[k], context, out=out[k].copy(), where=context > 0)
        bucket = np.where(context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)
        return bucket, out, own[0]


def learn(events: DataFrame, order: int, uniform: float, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights by context bucket from held-out events (bucket, q1.., n), each estimate 2 ** (-q / _STEP).

    Every round is one aggregation to a row for each bucket.
    """
    weights = np.full((BUCKETS, order + 1), 1 / (order + 1))
    names = [f"q{k}" for k in range(1, order + 1)]
    value = [F.lit(uniform)] + [F.when(F.col(q) >= _FLOOR, 0.0).otherwise(F.pow(F.lit(2.0), F.col(q) / F.lit(-float(_STEP)))) for q in names]
    for _ in range(rounds):
        table = [[float(w) for w in weights[:, k]] for k in range(order + 1)]
        parts = [F.get(F.array(*map(F.lit, table[k])), F.col("bucket")) * value[k] for k in range(order + 1)]
        whole = parts[0]
        for p in parts[1:]:
            whole = whole + p
        rows = events.groupBy("bucket").agg(*(F.sum(F.col("n") * p / whole).alias(f"e{k}") for k, p in enumerate(parts))).collect()
        for r in rows:
            gain = np.array([r[f"e{k}"] for k in range(order + 1)])
            # a bucket with few events stays near the start
            weights[r["bucket"]] = (gain + 1 / (order + 1)) / (gain.sum() + 1)
    return weights


def score(docs: DataFrame, *, order: int = ORDER, held_modulus: int = 7, held: int = 2, dev: int = 3, chunk_tokens: int = CHUNK_TOKENS, bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = make_shared(spark, scratch_path(spark, "lm-files"))
    chunks = materialise(texts.mapInArrow(_chunks(folder, held_modulus, held, dev, chunk_tokens), _CHUNK), "lm-chunks")
    sums = {r["role"]: r for r in chunks.groupBy("role").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts")).collect()}
    total = sum(r["n"] for r in sums.values())
    main_tokens, main_texts = (sums[_MAIN][c] if _MAIN in sums else 0 for c in ("n", "texts"))
    texts_seen = sum(sums[r]["texts"] for r in (_MAIN, _DEV) if r in sums)
    buckets = max(1, -(-int(total) // bucket_tokens))
    asked = chunks.mapInArrow(_first(buckets), _ASK)
    distinct = tokens = 0
    for k in range(order):
        answers = materialise(asked.groupBy("bucket").applyInArrow(lambda t: _answer(t), _ANSWER), "lm-answers")
        if not k:
            seen = answers.agg(F.sum("distinct").alias("v"), F.sum("total").alias("n")).first()
            distinct, tokens = int(seen["v"] or 0), int(seen["n"] or 0)
        last = k + 1 == order
        narrow = answers.drop("distinct", "total").groupBy("chunk").applyInArrow(_next(k, order, buckets, folder), "chunk long, role int, file string, states string" if last else _ASK)
        asked = materialise(narrow, "lm-counted") if last else narrow
    counted = asked
    uniform = 1 / (distinct + 1)
    names = ["bucket", *(f"q{k}" for k in range(1, order + 1)), "n"]

    def events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the tokens of a dev chunk have under the counts without dev, as a histogram."""
        for r in (r for batch in batches for r in batch.to_pylist()):
            bucket, estimate, _ = Counted(r, order).estimates(False, main_tokens, main_texts, distinct)
            with np.errstate(divide="ignore"):
                places = np.minimum(np.round(-np.log2(estimate[1:]) * _STEP), _FLOOR).astype(np.int64)
            packed = bucket
            for p in places:
                packed = packed * (_FLOOR + 1) + p
            packed, n = np.unique(packed, return_counts=True)
            columns = []
            for _ in range(order):
                packed, q = np.divmod(packed, _FLOOR + 1)
                columns.insert(0, pa.array(q, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.int32()), *columns, pa.array(n, pa.int64())], names=names)

    fields = ", ".join(f"{q} int" for q in names[1:-1])
    gathered = counted.where(F.col("role") == _DEV).repartition(n, "chunk").mapInArrow(events, f"bucket int, {fields}, n long")
    weights = learn(materialise(gathered.groupBy(*names[:-1]).agg(F.sum("n").alias("n")), "lm-events"), order, uniform)
    if not tokens:
        weights[:] = np.eye(order + 1)[0]

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in (r for batch in batches for r in batch.to_pylist()):
            counted = Counted(r, order)
            bucket, estimate, known = counted.estimates(True, tokens, texts_seen, distinct)
            probability = (weights[bucket].T * estimate).sum(axis=0)
            row, n = counted.chunk.row, len(counted.ids)
            add = lambda x: np.bincount(row, x, n)  # noqa: B023, E731
            out = {
                "doc_id": pa.array(counted.ids, pa.int64()),
                "held_out": pa.array([counted.role == _HELD] * n, pa.bool_()),
                "n_tokens": pa.array(counted.chunk.sizes),
                "n_known": pa.array(add(known > 0).astype(np.int64)),
                "train_tokens": pa.array([tokens] * n, pa.int64()),
                "base_score": pa.array(add(np.log10((known + 1) / (tokens + distinct + 1)))),
                "score": pa.array(add(np.log10(probability))),
            }
            yield pa.RecordBatch.from_arrays([*out.values()], names=[*out])
            return_memory()

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return counted.repartition(n, "chunk").mapInArrow(scores, schema)

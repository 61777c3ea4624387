"""Containment join: which aliases of a catalog of any size occur in texts, the longest first, occurrences that lie over an accepted one left out.

An inverted index of rare grams finds the places worth a look (a gram: eight bytes, fewer for aliases that are shorter). Of every
window of some grams of a long alias the least by a mixed order is taken. A first pass over the texts counts the grams that some alias
has, and each alias is looked for by the one of its grams that is rarest in the texts. A second pass finds the places of those grams, with the
bytes about them as far as an alias with that gram may reach; every place is verified against these bytes, and by the text itself
where an alias reaches farther than ``PIECE``. In both passes a table of bits, of bounded size, tells most places that no alias has a gram for;
what it lets through is joined exactly. Both sides stay distributed; the driver gets those bits.

Which occurrences count is decided text by text in one sorted pass that remembers the accepted stretches only.
"""

from __future__ import annotations

import atexit
import bisect
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Of aliases of at least so many bytes the bytes of a gram and the grams of a window; the first that fits.
CLASSES = ((23, 8, 16), (8, 8, 1), (4, 4, 1), (3, 3, 1), (2, 2, 1), (1, 1, 1))
PIECE = 1024  # bytes before a gram, and from it on, that go along with its place
FILTER_BITS = 25  # a table has a power of two of places, of this exponent at most
_STEP = 1 << 19  # places looked at together
_AT_ONCE = 1 << 16  # places of texts looked at together: they fit a core's cache
_HELD = 1 << 20  # grams that a task counts together
_SLICE = 1 << 20  # bytes of texts handled together
_ROWS = 1 << 13  # places that leave a task together
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PART = 16  # a table goes to the driver in parts of two to this power


def scratch(spark: SparkSession) -> str:
    """A fresh place in the shared folder of the session; what is there is removed when the driver ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        shared = f"file://{tempfile.mkdtemp(prefix='tessera-')}"
        atexit.register(shutil.rmtree, shared[7:], ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", shared)
    path = f"{shared.rstrip('/')}/tessera-table-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """The table written to the shared folder of the session and read again, which survives lost executors."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_written: list[tuple] = []


def clear_written() -> None:
    """Remove the tables written so far; results that still read them must have been written before."""
    while _written:
        spark, path = _written.pop()
        try:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # the session may have ended
            if path.startswith("file:"):
                shutil.rmtree(path[5:].replace("//", "/", 1), ignore_errors=True)


atexit.register(clear_written)


def sampled_grams(data: np.ndarray, offsets: np.ndarray, size: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, grams) of the least gram of each window within a row, for rows of bytes end to end."""
    places, reach = [], size + window - 1
    for start in range(0, len(data), _STEP):
        part = data[start : start + _STEP + reach - 1].astype(np.uint64)
        if len(part) < reach:
            break
        gram = np.zeros(len(part) - size + 1, np.uint64)
        for k in range(size):
            gram |= part[k : k + len(gram)] << np.uint64(8 * k)
        order = gram * np.uint64(0x9E3779B97F4A7C15)
        order = (order ^ (order >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        first = np.arange(len(order) - window + 1)
        row_end = offsets[np.searchsorted(offsets, start + first, "right")]
        inside = np.flatnonzero(start + first + reach <= row_end)
        least = np.lib.stride_tricks.sliding_window_view(order, window)[inside].argmin(axis=1)
        places.append(np.unique(first[inside] + least) + start)
    found = np.unique(np.concatenate(places)) if places else np.zeros(0, np.int64)
    grams = np.zeros(len(found), np.uint64)
    for k in range(size):
        grams |= data[found + k].astype(np.uint64) << np.uint64(8 * k)
    return found, grams.view(np.int64)


def _rows_of_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _alias_grams(aliases: DataFrame) -> DataFrame:
    """(alias, size, gram, place) of the grams that an alias may be looked for by; ``size``: the bytes of the gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                data, offsets = _rows_of_bytes(part.column("_t"))
                length = np.diff(offsets)
                fits = np.array([next(c for c, (least, _, _) in enumerate(CLASSES) if n >= least) if n else -1 for n in length.tolist()])
                for c in sorted(set(fits.tolist()) - {-1}):
                    places, grams = sampled_grams(data, offsets, *CLASSES[c][1:])
                    row = np.searchsorted(offsets, places, "right") - 1
                    places, grams, row = (x[fits[row] == c] for x in (places, grams, row))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("alias").take(pa.array(row)), pa.array(np.full(len(row), CLASSES[c][1], np.int32)), pa.array(grams), pa.array(places - offsets[row])],
                        names=["alias", "size", "gram", "place"],
                    )

    return aliases.select("alias", F.col("alias").cast("binary").alias("_t")).mapInArrow(run, "alias string, size int, gram long, place long")


def _slots(grams: np.ndarray, bits: int) -> np.ndarray:
    return ((grams * _MIX) >> np.uint64(64 - bits)).view(np.int64)


def _tables(grams: DataFrame) -> dict[int, tuple[int, bytes, np.ndarray]]:
    """Of each size of grams (size, gram, before, after): exponent, which places of the table have grams, and how far their aliases reach.

    Some 16 places for each gram, up to ``FILTER_BITS``; the reaches are the greatest of each of 65,536 parts.
    """
    rows = grams.groupBy("size").agg(F.count("*").alias("n")).collect()
    bits = {r["size"]: min(max((16 * r["n"]).bit_length(), _PART), FILTER_BITS) for r in rows}

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gram = batch.column("size").to_numpy(), batch.column("gram").to_numpy().view(np.uint64)
            slot = np.zeros(len(gram), np.int64)
            for one in np.unique(size).tolist():
                slot[size == one] = _slots(gram[size == one], bits[one])
            yield pa.RecordBatch.from_arrays([batch.column("size"), pa.array(slot), batch.column("before"), batch.column("after")], names=["size", "slot", "before", "after"])

    def packed(group: pa.Table) -> pa.Table:
        slot = group.column("slot").to_numpy()
        size, part = int(group.column("size")[0].as_py()), int(group.column("part")[0].as_py())
        have = np.zeros(1 << _PART, bool)
        have[slot & (len(have) - 1)] = True
        shift = bits[size] - _PART
        reach = np.zeros((2, 1 << (_PART - shift)), np.int32)
        for k, name in enumerate(("before", "after")):
            np.maximum.at(reach[k], (slot & (len(have) - 1)) >> shift, group.column(name).to_numpy().astype(np.int32))
        return pa.table({"size": pa.array([size], pa.int32()), "part": pa.array([part], pa.int64()), "have": [np.packbits(have).tobytes()], "reach": [reach.tobytes()]})

    slots = grams.select("size", "gram", "before", "after").mapInArrow(placed, "size int, slot long, before int, after int")
    slots = slots.groupBy("size", "slot").agg(F.max("before").alias("before"), F.max("after").alias("after")).withColumn("part", F.shiftright("slot", _PART))
    parts = slots.groupBy("size", "part").applyInArrow(packed, "size int, part long, have binary, reach binary").collect()
    out = {}
    for size, n in bits.items():
        have, reach = np.zeros((1 << (n - _PART), 1 << (_PART - 3)), np.uint8), np.zeros((2, 1 << (n - _PART), 1 << (2 * _PART - n)), np.int32)
        for r in parts:
            if r["size"] == size:
                have[r["part"]] = np.frombuffer(r["have"], np.uint8)
                reach[:, r["part"]] = np.frombuffer(r["reach"], np.int32).reshape(2, -1)
        out[size] = n, have.tobytes(), reach.reshape(2, -1)
    return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Some rows at a time with the bytes of their texts and the offsets."""
    for batch in batches:
        data, offsets = _rows_of_bytes(batch.column("_t"))
        at = 0
        while at < batch.num_rows:
            stop = min(max(int(np.searchsorted(offsets, offsets[at] + _SLICE, "right")) - 1, at + 1), batch.num_rows)
            yield batch.slice(at, stop - at), data[offsets[at] : offsets[stop]], offsets[at : stop + 1] - offsets[at]
            at = stop


def _met(data: np.ndarray, offsets: np.ndarray, tables: dict[int, tuple[int, np.ndarray]]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(size, places, grams, rows) of the grams within a row for which the table of their size has a place."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    for start in range(0, len(data), _AT_ONCE):
        n = min(_AT_ONCE, len(data) - start)
        eight = np.ndarray((n,), "<u8", padded, start, (1,)).copy()
        for size, (bits, have) in tables.items():
            gram = eight if size == 8 else eight & np.uint64((1 << 8 * size) - 1)
            at = np.flatnonzero(have[_slots(gram, bits)])
            row = np.searchsorted(offsets, at + start, "right") - 1
            inside = at + start + size <= offsets[row + 1]
            at, row = at[inside], row[inside]
            if len(at):
                yield size, at + start, gram[at].view(np.int64), row


def _unpacked(tables: dict) -> dict[int, tuple[int, np.ndarray]]:
    return {size: (bits, np.unpackbits(np.frombuffer(have, np.uint8)).view(bool)) for size, (bits, have, _) in tables.items()}


def _gram_counts(texts: DataFrame, tables: dict) -> DataFrame:
    """(size, gram, n) of the grams of texts (_t) that the tables let through, added up for each task."""
    asked = {size: (bits, have, None) for size, (bits, have, _) in tables.items()}

    def added(held: dict[int, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for size, grams in held.items():
            gram, n = np.unique(np.concatenate(grams), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), size, np.int32)), pa.array(gram), pa.array(n)], names=["size", "gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, held, n = _unpacked(asked), {}, 0
        for _, data, offsets in _pieces(batches):
            for size, _, grams, _ in _met(data, offsets, have):
                held.setdefault(size, []).append(grams)
                n += len(grams)
            if n > _HELD:
                yield from added(held)
                held, n = {}, 0
        yield from added(held)

    counted = texts.select(F.col("_t").cast("binary").alias("_t")).mapInArrow(run, "size int, gram long, n long")
    return counted.groupBy("size", "gram").agg(F.sum("n").alias("n"))


def _gram_places(texts: DataFrame, tables: dict) -> DataFrame:
    """(_k, size, gram, place, piece, before) of the grams that the tables let through; ``piece``: the bytes about it, of which ``before`` come first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = _unpacked(tables)
        for part, data, offsets in _pieces(batches):
            raw, met = data.tobytes(), []
            for size, places, grams, row in _met(data, offsets, have):
                bits, _, reach = tables[size]
                slot = _slots(grams.view(np.uint64), bits) >> (bits - _PART)
                first = np.maximum(places - reach[0][slot], offsets[row])
                met.append((np.full(len(row), size, np.int32), places, grams, row, first, np.minimum(places + reach[1][slot], offsets[row + 1])))
            if met:
                size, places, grams, row, first, stop = map(np.concatenate, zip(*met))
                for at in range(0, len(row), _ROWS):
                    k = slice(at, at + _ROWS)
                    piece = pa.array([raw[a:b] for a, b in zip(first[k].tolist(), stop[k].tolist())], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [part.column("_k").take(pa.array(row[k])), pa.array(size[k]), pa.array(grams[k]), pa.array(places[k] - offsets[row[k]]), piece, pa.array((places[k] - first[k]).astype(np.int32))],
                        names=["_k", "size", "gram", "place", "piece", "before"],
                    )

    kind = texts.schema["_k"].dataType.simpleString()
    return texts.select("_k", F.col("_t").cast("binary").alias("_t")).mapInArrow(run, f"_k {kind}, size int, gram long, place long, piece binary, before int")


def occurrences(texts: DataFrame, aliases: DataFrame) -> DataFrame:
    """(_k, alias, start, stop) of every occurrence of aliases (alias) in texts (_k, _t), in bytes; ``_k`` tells texts apart."""
    catalog = aliases.where("alias <> ''").select("alias").distinct()
    looked = cut_lineage(_alias_grams(catalog))
    nowhere = F.lit(0).alias("before"), F.lit(0).alias("after")
    frequency = _gram_counts(texts, _tables(looked.select("size", "gram").distinct().select("size", "gram", *nowhere)))
    # an alias of which some gram is in no text is in none
    ranked = looked.join(frequency, ["size", "gram"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rare = ranked.groupBy("alias", "size").agg(F.min_by(F.struct("n", "gram", "place"), F.struct("n", "place")).alias("g"))
    rare = cut_lineage(rare.where("g.n > 0").select("alias", "size", "g.gram", F.col("g.place").alias("within"), F.octet_length("alias").alias("bytes")))
    reach = F.least("within", F.lit(PIECE)).cast("int"), F.least(F.col("bytes") - F.col("within"), F.lit(PIECE)).cast("int")
    asked = rare.groupBy("size", "gram").agg(F.max(reach[0]).alias("before"), F.max(reach[1]).alias("after"))
    places = _gram_places(texts, _tables(asked)).join(rare, ["size", "gram"]).where("place >= within")
    start = F.col("place") - F.col("within")
    own = F.col("alias").cast("binary")
    near = (F.col("within") <= PIECE) & (F.col("bytes") - F.col("within") <= PIECE)
    same = F.substring("piece", (F.col("before") - F.col("within") + 1).cast("int"), F.col("bytes")) == own
    found = places.where(near & (F.col("before") >= F.col("within")) & same).select("_k", "alias", start.alias("start"), "bytes").distinct()
    if rare.where(~near).limit(1).count():
        far = places.where(~near).select("_k", "alias", start.alias("start"), "bytes").distinct()
        met = texts.dropDuplicates(["_k"]).join(far, "_k")
        found = found.union(met.where(F.substring(F.col("_t").cast("binary"), (F.col("start") + 1).cast("int"), F.col("bytes")) == own).select(found.columns))
    return found.select("_k", "alias", "start", (F.col("start") + F.col("bytes")).alias("stop"))


def _accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences in order of preference, those that lie over an accepted one of their text left out."""
    now, starts, stops, rank = None, [], [], 0
    for batch in batches:
        keep, ranks = [], []
        for at, (key, start, stop) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("_k", "start", "stop")))):
            if key != now:
                now, starts, stops, rank = key, [], [], 0
            place = bisect.bisect_left(starts, start)  # accepted stretches never overlap, so their stops are in order too
            if (place and stops[place - 1] > start) or (place < len(starts) and starts[place] < stop):
                continue
            starts.insert(place, start)
            stops.insert(place, stop)
            keep.append(at)
            ranks.append(rank)
            rank += 1
        kept = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([*(kept.column(c) for c in ("_k", "alias", "start", "stop")), pa.array(ranks, pa.int64())], names=["_k", "alias", "start", "stop", "rank"])


def longest_first(found: DataFrame) -> DataFrame:
    """(_k, alias, start, stop, rank): the occurrences that count; longer aliases first, then by alias and place."""
    ordered = found.withColumn("_n", -F.length("alias")).repartition("_k").sortWithinPartitions("_k", "_n", "alias", "start")
    return ordered.select("_k", "alias", "start", "stop").mapInArrow(_accepted, "_k binary, alias string, start long, stop long, rank long")


def scan_aliases(texts: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """The texts with ``found``: distinct ids of the aliases (alias, id) contained in them, longest alias first.

    Defined cases: null and empty texts contain nothing; empty and null aliases are contained in nothing; of several ids of one alias all count,
    least first; rows are joined by the hash of their text, so repeated rows each get the ids.
    """
    keyed = texts.withColumn("_k", F.unhex(F.sha2(F.col(column), 256)))
    searched = keyed.where(F.col(column) != "").select("_k", F.col(column).alias("_t"))
    kept = longest_first(occurrences(searched, aliases))
    ids = kept.groupBy("_k", "alias").agg(F.min("rank").alias("rank")).join(aliases.select("alias", "id").distinct(), "alias")
    first = ids.groupBy("_k", "id").agg(F.min("rank").alias("rank"))
    listed = first.groupBy("_k").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "id"))), lambda x: x["id"]).alias("found"))
    nothing = F.array().cast(f"array<{aliases.schema['id'].dataType.simpleString()}>")
    return keyed.join(listed, "_k", "left").withColumn("found", F.coalesce("found", nothing)).drop("_k")

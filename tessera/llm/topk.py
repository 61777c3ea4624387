"""Exact search for the largest inner products.

Vectors stand in files of descending length, one for each range of lengths, beside the first coordinates of their
rotation to the principal axes of all vectors and the length of the rest. A block of queries goes through the
files in order: partial sums over the first coordinates plus the product of the lengths of the rests
(Cauchy-Schwarz) bound each score; a pair whose bound is below the query's k-th best score so far is left out,
and the scores of the others are computed from the integers. A block of queries ends at the first vector whose
length, times each query's, cannot reach that query's k-th best score.

The files are in the shared folder, memory-mapped where that is a local path and read one at a time otherwise; no
vector is shuffled but to put them in order of length, and the driver gets a line for each file.

Defined cases: every row takes part for itself, repeated ids and equal rows too, and meets all rows but itself;
vectors that are null or hold a null or a non-finite component, and rows with a null id, take no part; shorter
vectors count as padded with zeros; an empty vector scores 0 with all; an empty table gives an empty result;
components that leave 64 bits are held at their ends, and scores that leave them wrap; other columns are not
looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import load_shared, make_shared, materialise, open_shared, scratch_path, sum_rows

K = 20
SCALE = 64
QUERY_EVERY = 20
QUERY_BLOCK = 512
STEP = 512
HEAD = 16
_FOUND = "query_id long, rank int, vec_id long, score long"
_LOWEST, _HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _integers(vectors: DataFrame, scale: int) -> DataFrame:
    """(row, vec_id, v, norm): components as whole doubles, rows numbered."""
    number = F.col("embedding").cast("array<double>")
    sound = F.col("vec_id").isNotNull() & number.isNotNull() & F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(number, lambda x: F.floor(x * scale).cast("double"))
    rows = vectors.where(sound).select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))
    return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows of one width, padded with zeros."""
    sizes = np.asarray(column.value_lengths())
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.asarray(column.flatten())
    return out


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers: in doubles where they are exact, else in 64-bit integers."""
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(q.shape[1], 1)
    if largest < 2**53:
        return (q @ c.T).astype(np.int64)
    return q.astype(np.int64) @ c.astype(np.int64).T


class Searcher:
    """Blocks of queries against files of vectors in order of length."""

    def __init__(self, rotation: np.ndarray, head: int, k: int):
        self.rotation, self.head, self.k = rotation, min(head, rotation.shape[1]), k

    def parts(self, x: np.ndarray) -> np.ndarray:
        """The first coordinates of each row's rotation, the length of the rest and that of the whole."""
        y = x @ self.rotation
        return np.column_stack([y[:, : self.head], np.sqrt((y[:, self.head :] ** 2).sum(axis=1)), np.sqrt((y * y).sum(axis=1))])

    def search(self, row: np.ndarray, q: np.ndarray, steps) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, vector id, score) of the k best, by query and rank.

        ``steps(reaches)`` gives vectors as (rows, ids, values, parts), the longest first, as long as ``reaches(length)``.
        """
        mine = self.parts(q)
        q_head, q_rest, q_norm = mine[:, : self.head], mine[:, -2], mine[:, -1]
        floor, last = np.full(len(q), _LOWEST), np.full(len(q), _HIGHEST)
        best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        slack = 1e-6 * (1 + q_norm)

        def reaches(length: float) -> bool:
            return bool(np.any(q_norm * length + slack * (1 + length) >= floor))

        for c_row, ids, values, parts in steps(reaches):
            c_head, c_rest, c_norm = parts[:, : self.head], parts[:, -2], parts[:, -1]
            slop = (slack * (1 + c_norm.max()))[:, None]
            may = q_head @ c_head.T + q_rest[:, None] * c_rest[None, :] + slop >= floor[:, None]
            may &= row[:, None] != c_row[None, :]
            rows, columns = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
            if not len(rows):
                continue
            exact, lowest = _products(q[rows], values[columns]), floor[rows][:, None]
            better = (exact > lowest) | ((exact == lowest) & (ids[columns][None, :] < last[rows][:, None]))
            i, j = np.nonzero(may[np.ix_(rows, columns)] & better)
            merged = [np.concatenate(x) for x in zip(best, (rows[i], ids[columns[j]], exact[i, j]))]
            # ~x puts the largest first and, unlike -x, is defined for all numbers
            order = np.lexsort((merged[1], ~merged[2], merged[0]))
            merged = [x[order] for x in merged]
            rank = np.arange(len(order)) - np.searchsorted(merged[0], merged[0], "left")
            best = tuple(x[rank < self.k] for x in merged)
            full = rank == self.k - 1
            floor[merged[0][full]], last[merged[0][full]] = merged[2][full], merged[1][full]
        return best


def search(vectors: DataFrame, *, k: int = K, is_query: Column | None = None, scale: int = SCALE, query_block: int = QUERY_BLOCK, head: int = HEAD) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query with the other rows."""
    spark = vectors.sparkSession
    query = (F.col("vec_id") % QUERY_EVERY == 0) if is_query is None else is_query
    rows = materialise(_integers(vectors, scale), "topk-vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return spark.createDataFrame([], _FOUND)
    width = max(int(width), 1)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch.column("v"), width)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["i", "v"])

    # the right singular vectors of all vectors, largest first
    rotation = np.linalg.eigh(sum_rows(rows.select("v"), moments, width))[1][:, ::-1]
    searcher = Searcher(np.ascontiguousarray(rotation), head, k)
    wide = searcher.head + 2
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = make_shared(spark, scratch_path(spark, "topk-files"))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The partition's rows, in order, as three files; the line of the manifest."""
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        name, count, longest = f"{folder}/{part:06d}-{uuid.uuid4().hex}", 0, 0.0
        with open_shared(name + ".ids", "wb") as ids, open_shared(name + ".vectors", "wb") as vectors, open_shared(name + ".parts", "wb") as parts:
            for batch in batches:
                values = _matrix(batch.column("v"), width)
                own = searcher.parts(values)
                longest = max(longest, float(own[:, -1].max(initial=0)))
                ids.write(np.column_stack([np.asarray(batch.column("row")), np.asarray(batch.column("vec_id"))]).astype("<i8").tobytes())
                vectors.write(values.astype("<f8").tobytes())
                parts.write(own.astype("<f8").tobytes())
                count += batch.num_rows
        yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "n": [count], "longest": [longest]})

    order = [F.col("order"), F.col("vec_id"), F.col("row")]
    ordered = rows.withColumn("order", -F.col("norm")).repartitionByRange(n, *order).sortWithinPartitions(*order)
    manifest = sorted(r for r in ordered.select("row", "vec_id", "v").mapInArrow(store, "part long, file string, n long, longest double").collect() if r["n"])

    def steps(reaches):
        for _, name, _, longest in manifest:
            if not reaches(longest):
                return
            ids = load_shared(name + ".ids", "<i8").reshape(-1, 2)
            values, parts = load_shared(name + ".vectors", "<f8").reshape(-1, width), load_shared(name + ".parts", "<f8").reshape(-1, wide)
            for at in range(0, len(ids), STEP):
                some = slice(at, at + STEP)
                own = np.asarray(parts[some])
                if not reaches(float(own[:, -1].max())):
                    return
                yield np.asarray(ids[some, 0]), np.asarray(ids[some, 1]), np.asarray(values[some]), own

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, query_block):
                some = batch.slice(at, query_block)
                i, other, score = searcher.search(np.asarray(some.column("row")), _matrix(some.column("v"), width), steps)
                rank = np.arange(len(i)) - np.searchsorted(i, i, "left") + 1
                yield pa.RecordBatch.from_arrays([pa.array(np.asarray(some.column("vec_id"))[i]), pa.array(rank, pa.int32()), pa.array(other), pa.array(score)], names=["query_id", "rank", "vec_id", "score"])

    return rows.where(query).select("row", "vec_id", "v").repartition(n, "row").mapInArrow(answer, _FOUND)

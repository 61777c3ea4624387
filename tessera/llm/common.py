"""Helpers shared by the training-data operators: the shared folder, scratch tables, Arrow slices, split rules."""

from __future__ import annotations

import atexit
import ctypes
import os
import re
import shutil
import tempfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step handles; it bounds a worker's memory whatever the batch holds.
SLICE_BYTES = 1_000_000
FAN = 1024
#: Rows of a batch between the JVM and Python: with the default, batches of long texts fill the memory of both.
BATCH_ROWS = 1000
_BATCH, _DEFAULT_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; where it is unset and all run here, one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tessera-")
        atexit.register(shutil.rmtree, found[7:], ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def small_batches(spark: SparkSession) -> None:
    """Rows of texts go to Python and back in batches of ``BATCH_ROWS``, unless the session has a size of its own."""
    if spark.conf.get(_BATCH, _DEFAULT_BATCH) == _DEFAULT_BATCH:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends (``clear_scratch`` removes it earlier)."""
    small_batches(spark)
    path = f"{shared_dir(spark).rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"
    _paths.append((spark, path))
    return path


_paths: list[tuple[SparkSession, str]] = []


def clear_scratch() -> None:
    """Remove every scratch table made so far; results that still read them must have been written before."""
    while _paths:
        spark, path = _paths.pop()
        try:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # the session may have ended
            if path.startswith("file:"):
                shutil.rmtree(path[5:].replace("//", "/", 1), ignore_errors=True)


atexit.register(clear_scratch)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove one scratch table that nothing reads any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_path(uri: str) -> str | None:
    """The local path of a ``file:`` URI or plain path; None for other stores."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if uri.startswith("/") else None


def make_shared(spark: SparkSession, path: str) -> str:
    """The folder, made where it isn't there."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)
    return path


def open_shared(uri: str, mode: str):
    """A binary file of the shared folder, on driver or executors."""
    path = local_path(uri)
    if path is not None:
        return open(path, mode)
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(uri)
    return store.open_output_stream(inner) if "w" in mode else store.open_input_file(inner)


def load_shared(uri: str, dtype) -> np.ndarray:
    """A file's numbers, memory-mapped where it is local."""
    path = local_path(uri)
    if path is not None:
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    with open_shared(uri, "rb") as file:
        return np.frombuffer(file.read(), dtype)


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the text ``""``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def crc_mod_py(doc_id: int | None, modulus: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, end to end, and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def return_memory() -> None:
    """Make freed arrays go back to the system, so that idle workers don't hold what their last step needed."""
    if not _tuned:
        _tuned.append(True)
        try:  # glibc: arrays from 256 KB on are mapped for themselves; a fixed threshold, which else grows
            ctypes.CDLL(None).mallopt(-3, 1 << 18)
        except (AttributeError, OSError):
            pass
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


_tuned: list[bool] = []


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches again, cut between rows so that the texts of a piece have at most ``limit`` bytes, one row at least."""
    return_memory()
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(batch.schema.get_field_index(column))
        kind = np.int64 if pa.types.is_large_string(text.type) else np.int32
        offsets = np.frombuffer(text.buffers()[1], kind)[text.offset : text.offset + len(text) + 1].astype(np.int64)
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
        del batch, text, offsets
        return_memory()


def ids_of(batch: pa.RecordBatch, name: str = "doc_id") -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def set_threads() -> None:
    """One thread for each worker: Spark already runs one task for each core."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    pa.set_cpu_count(1)


def sum_rows(df: DataFrame, run, width: int) -> np.ndarray:
    """Sum over partitions of a matrix that each gives as (row, values); ``width`` rows are collected.

    They meet in two steps, in ``FAN`` groups of partitions first, so that a task gets a small share of them.
    """
    parts = df.mapInArrow(run, "i int, v binary").withColumn("p", F.spark_partition_id() % FAN)
    sums = parts.groupBy("i", "p").applyInArrow(_add_rows, "i int, v binary").groupBy("i").applyInArrow(_add_rows, "i int, v binary")
    out = np.zeros((width, 0))
    for r in sums.collect():
        values = np.frombuffer(bytes(r["v"]))
        out = np.zeros((width, len(values))) if not out.size else out
        out[r["i"]] = values
    return out


def _add_rows(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v.as_buffer()) for v in group.column("v"))
    return pa.table({"i": group.column("i").slice(0, 1), "v": pa.array([total.tobytes()], pa.binary())})


def keep_rows(docs: DataFrame, judge) -> DataFrame:
    """The rows, with all their columns, for whose slices ``judge(batch)`` is true: a narrow stage."""

    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield batch.filter(pa.array(judge(batch), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def numbered(rows: DataFrame, key: list[str], order: list[str], name: str, *, few: bool = True) -> DataFrame:
    """The rows with their number within their key, from 0, by prefix sums over range partitions.

    Rows of one key may be many; ``few``: of the keys there is a proven number.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, *key, *order).sortWithinPartitions(*key, *order)
    ranged = materialise(ranged.withColumn("_at", F.monotonically_increasing_id()).withColumn("_p", F.spark_partition_id()), "numbers")
    # a row for each partition and for each key that begins inside one
    pieces = ranged.groupBy("_p", *key).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*key).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    pieces = pieces.select("_p", *key, "_first", F.coalesce(before, F.lit(0)).alias("_base"))
    joined = ranged.join(F.broadcast(pieces) if few else pieces, ["_p", *key])
    return joined.withColumn(name, F.col("_at") - F.col("_first") + F.col("_base")).drop("_at", "_p", "_first", "_base")

"""Connected components of an edge table, by alternating large and small stars.

Each partition first replaces its edges by a spanning star of what they connect. Then every node sends its larger
neighbours, and in turn its smaller ones, to its smallest; rounds end when the edges no longer change. Edges
are longs; the work is joins and minima over tables in the shared folder, nothing is gathered on the driver
but two sums a round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import drop_scratch, scratch_path


def spanning(a: list[int], b: list[int]) -> dict[int, int]:
    """For each node the smallest that the edges connect it with."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent[x]
        return root

    for x, y in zip(a, b):
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(parent)}


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, int] = {}
    for batch in batches:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        known = spanning([*known, *a], [*known.values(), *b])
    nodes = [(x, r) for x, r in known.items() if x != r]
    if nodes:
        pairs = np.array(nodes, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def contract(edges: DataFrame) -> DataFrame:
    """Each partition's edges (a, b) as spanning stars, b the smallest."""
    return edges.select("a", "b").mapInArrow(_contract, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that an edge (a, b) has, root the smallest node of its component."""
    spark = edges.sparkSession
    paths: list[str] = []

    def keep(df: DataFrame) -> DataFrame:
        """Write a round's edges and remove those that they were made of."""
        paths.append(scratch_path(spark, "components"))
        df.write.option("compression", "zstd").parquet(paths[-1])
        for path in paths[:-1]:
            drop_scratch(spark, path)
        del paths[:-1]
        return spark.read.schema(df.schema).parquet(paths[-1])

    state = keep(contract(edges).distinct())
    before = None
    while True:
        # small star: a node's smaller neighbours and itself go to the smallest of them
        low = state.groupBy("a").agg(F.min("b").alias("m"))
        joined = state.join(low, "a")
        small = joined.where(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).distinct()
        state = keep(small)
        # large star: a node's larger neighbours go to the smallest of all its neighbours and itself
        both = state.union(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        state = keep(large)
        mark = F.xxhash64("a", "b")
        now = tuple(state.agg(F.count("*"), F.sum(mark.cast("decimal(20,0)")), F.bit_xor(mark)).first())
        if now == before or not now[0]:
            break
        before = now
    roots = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

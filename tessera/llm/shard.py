"""Sharding by a k-d tree over document metadata, under the law ``bytes``: shards of nearly equal size.

Points are groups of equal texts with their bytes as weight, at the metadata of the group's first document. A
group of over a sixteenth of a shard is cut into several points of as many rows, by its rows' numbers from prefix sums, so no copies are
too many, of one id neither; smaller groups stay in one shard. A node with k shards is cut along its widest dimension (relative to the
whole range) at the weighted quantile that leaves k // 2 shards' bytes on its left; points of one value are
ordered by a hash. The quantiles of all nodes of a level are found together by histogram refinement, a few
distributed passes over the points; only histograms of fixed size reach the driver. Slots are positions in
(shard, doc_id) order, from prefix sums over range partitions.

Defined cases: a null text has no bytes (size 16) and forms one group with other null texts, apart from empty
ones; null metadata are a value of their own; repeated rows count each; an empty table gives an empty
result; where there are fewer points than shards some shards stay empty; dimensions that the table lacks
are left out; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialise, numbered

SHARDS = 40
OVERHEAD = 16
LAW = "bytes"
DIMENSIONS = ("lang", "source")
_VALUE_BITS, _HASH_BITS, _STEP = 14, 34, 12


def _position(field: T.StructField) -> Column:
    """A metadata value as a place on a line: numbers as they are, others by hash; null apart from all."""
    column = F.col(field.name)
    if isinstance(field.dataType, T.NumericType):
        return F.coalesce(F.nanvl(column.cast("double"), F.lit(-1.0)), F.lit(-1.0))
    return F.pmod(F.xxhash64(F.coalesce(column.cast("string"), F.lit("\0"))), F.lit(1 << 20)).cast("double")


def _grow(points: DataFrame, shards: int, dims: list[str]) -> DataFrame:
    """The points with their leaf ``n`` (0 to shards - 1): the tree, grown level by level.

    A node is named after its first shard; ``nodes`` holds how many shards each has.
    """
    spark = points.sparkSession
    nodes = {0: shards}
    state = points.withColumn("n", F.lit(0))
    extent = None
    top = float((1 << _VALUE_BITS) - 1)
    while any(k > 1 for k in nodes.values()):
        sides = [f(d).alias(f"{k}_{d}") for d in dims for k, f in (("lo", F.min), ("hi", F.max))]
        ranges = {r["n"]: r for r in state.groupBy("n").agg(F.sum("w").alias("w"), *sides).collect()}
        extent = extent or {d: ranges[0][f"hi_{d}"] - ranges[0][f"lo_{d}"] or 1.0 for d in dims}
        goal, axes = {}, []
        for n, k in nodes.items():
            if k > 1 and n in ranges:
                width = {d: ranges[n][f"hi_{d}"] - ranges[n][f"lo_{d}"] for d in dims}
                widest = max(dims, key=lambda d: width[d] / extent[d])  # noqa: B023
                goal[n] = ranges[n]["w"] * (k // 2) / k
                axes.append((n, dims.index(widest), float(ranges[n][f"lo_{widest}"]), top / (width[widest] or 1.0)))
        axis = F.broadcast(spark.createDataFrame(axes, "n int, axis int, low double, scale double"))
        value = F.floor((F.get(F.array(*dims), F.col("axis")) - F.col("low")) * F.col("scale")).cast("long")
        keyed = state.join(axis, "n", "left").select("n", *points.columns, (F.shiftleft(value, _HASH_BITS) + F.col("h")).alias("k"))
        keyed = materialise(keyed, "shard-level")
        cut = F.broadcast(spark.createDataFrame(list(_quantiles(keyed, goal).items()), "n int, cut long"))
        left = F.broadcast(spark.createDataFrame([(n, k // 2) for n, k in nodes.items()], "n int, step int"))
        stays = F.col("cut").isNull() | (F.col("k") <= F.col("cut"))
        state = keyed.join(cut, "n", "left").join(left, "n").select(F.when(stays, F.col("n")).otherwise(F.col("n") + F.col("step")).alias("n"), *points.columns)
        nodes = {m: c for n, k in nodes.items() for m, c in (((n, k // 2), (n + k // 2, k - k // 2)) if k > 1 else ((n, k),))}
    return state


def _quantiles(keyed: DataFrame, goal: dict[int, float]) -> dict[int, int]:
    """For each node the key up to which the weight is nearest its goal, by histograms of ever finer keys."""
    spark = keyed.sparkSession
    prefix, before, cut = dict.fromkeys(goal, 0), dict.fromkeys(goal, 0), {}
    bits = _VALUE_BITS + _HASH_BITS
    while bits:
        step = min(_STEP, bits)
        inside = F.broadcast(spark.createDataFrame(list(prefix.items()), "n int, prefix long"))
        part = keyed.join(inside, "n").where(F.shiftright("k", bits) == F.col("prefix"))
        bits -= step
        found: dict[int, list[tuple[int, int]]] = {n: [] for n in goal}
        for r in part.groupBy("n", F.shiftright("k", bits).alias("b")).agg(F.sum("w").alias("w")).collect():
            found[r["n"]].append((r["b"], r["w"]))
        for n, bins in found.items():
            for b, w in sorted(bins):
                prefix[n] = b
                if before[n] + w >= goal[n]:
                    break
                before[n] += w
            if not bits:  # the last bin has one key: take it or leave it, whichever is nearer
                w = dict(bins).get(prefix[n], 0)
                cut[n] = prefix[n] if before[n] + w - goal[n] <= goal[n] - before[n] else prefix[n] - 1
    return cut


def assign(docs: DataFrame, *, shards: int = SHARDS, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    fields = [f for f in docs.schema if f.name in dimensions]
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    meta = docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64("text").alias("g1"),
        F.xxhash64(F.lit(2), "text").alias("g2"),
        *(_position(f).alias(f"d_{f.name}") for f in fields),
        F.log2(F.octet_length(text) + 1.0).alias("d_bytes"),
        F.spark_partition_id().alias("lane"),  # tells equal rows apart
    )
    dims = [c for c in meta.columns if c.startswith("d_")]
    meta = materialise(meta, "shard-metadata")
    total = meta.agg(F.sum("size")).first()[0] or 0
    limit = max(1, total // (16 * shards))
    # at most 16 groups a shard are larger than the limit, so this table has a fixed bound
    large = meta.groupBy("g1", "g2").agg(F.sum("size").alias("_b"), F.count("*").alias("_rows")).where(F.col("_b") > limit)
    large = F.broadcast(large.select("g1", "g2", "_rows", F.ceil(F.col("_b") / F.lit(limit)).alias("_parts")))
    columns = ["doc_id", "size", "text_crc32", "g1", "g2", "lane", *dims]
    cut = numbered(meta.join(large, ["g1", "g2"]), ["g1", "g2"], ["lane"], "_k")
    part = F.floor(F.col("_k") * F.col("_parts") / F.col("_rows")).cast("long").alias("part")
    whole = meta.join(large, ["g1", "g2"], "left_anti")
    meta = materialise(whole.select(*columns, F.lit(0).cast("long").alias("part")).unionAll(cut.select(*columns, part)), "shard-groups")
    first = F.min(F.struct("doc_id", *dims)).alias("_f")
    points = meta.groupBy("g1", "g2", "part").agg(F.sum("size").alias("w"), first)
    points = materialise(points.select("g1", "g2", "part", "w", F.pmod(F.xxhash64("g1", "g2", "part"), F.lit(1 << _HASH_BITS)).alias("h"), *(F.col(f"_f.{d}").alias(d) for d in dims)), "shard-points")
    placed = (_grow(points, shards, dims) if total else points.withColumn("n", F.lit(0))).select("g1", "g2", "part", F.col("n").alias("shard"))
    located = meta.join(placed, ["g1", "g2", "part"]).select("doc_id", "size", "text_crc32", "lane", "shard")
    return number_slots(located).select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def number_slots(located: DataFrame) -> DataFrame:
    """The rows with ``slot``: their places in their shard by (doc_id, text_crc32), from 0 without gaps; equal rows in any order."""
    return numbered(located, ["shard"], ["doc_id", "text_crc32", "lane"], "slot").drop("lane")

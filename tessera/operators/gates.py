"""Quality gates: rules, references, metrics against floors, digests, manifests."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class GateError(Exception):
    """A stop with a reason, what to do, and the rows that caused it."""

    reason: str
    action: str = ""
    details: list[dict] = field(default_factory=list)

    def __str__(self) -> str:
        return json.dumps({"reason": self.reason, "action": self.action, "details": self.details}, ensure_ascii=False, sort_keys=True)


def violations(rows: DataFrame, key: Column, rules: dict[str, Column]) -> DataFrame:
    """(rule, key) of every rule whose predicate a row does not satisfy; null does not satisfy."""
    broken = F.array_compact(F.array(*(F.when(~F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in rules.items())))
    return rows.select(key.cast("string").alias("key"), F.explode(broken).alias("rule")).select("rule", "key")


def require_empty(found: DataFrame, reason: str, action: str = "", *, shown: int = 50) -> None:
    """Stop if there is any row; some of them are shown."""
    rows = found.limit(shown).collect()
    if rows:
        raise GateError(reason, action, [r.asDict(recursive=True) for r in rows])


def missing_references(rows: DataFrame, column: str, known: DataFrame, key: str) -> DataFrame:
    """Rows whose reference no known row has."""
    return rows.where(F.col(column).isNotNull()).join(known.select(F.col(key).alias("_known")).distinct(), F.col(column) == F.col("_known"), "left_anti")


def same_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that one of two tables lacks, with the side that has them."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).union(b.join(a, key, "left_anti").withColumn("side", F.lit("right")))


def unequal_rows(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of one table that the other lacks, copies counted."""
    columns = expected.columns
    lost = expected.exceptAll(found.select(columns)).withColumn("side", F.lit("expected"))
    return lost.union(found.select(columns).exceptAll(expected).withColumn("side", F.lit("found")))


def metrics(tables: dict[str, DataFrame], measures: dict[str, tuple[str, Column]]) -> DataFrame:
    """(metric, value): each measure an aggregate over a table; the measures of one table are one scan."""
    out = None
    for table, df in tables.items():
        own = {name: c for name, (t, c) in measures.items() if t == table}
        if not own:
            continue
        row = df.agg(*(c.cast("double").alias(name) for name, c in own.items()))
        stacked = row.select(F.explode(F.create_map(*(x for name in own for x in (F.lit(name), F.col(f"`{name}`"))))).alias("metric", "value"))
        out = stacked if out is None else out.union(stacked)
    return out


def gate(current: DataFrame, baseline: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Metrics (metric, value) against thresholds (metric, minimum, ratio) and a baseline: (metric, value, floor, passed).

    The floor is the larger of the absolute minimum and the whole part of baseline times ratio; a baseline of
    nothing sets no floor, a missing metric fails.
    """
    joined = thresholds.join(current, "metric", "left").join(baseline.select("metric", F.col("value").alias("_old")), "metric", "left")
    relative = F.when(F.col("_old") > 0, F.floor(F.col("_old") * F.col("ratio")).cast("double"))
    floor = F.greatest(F.coalesce("minimum", F.lit(float("-inf"))), F.coalesce(relative, F.lit(float("-inf"))))
    out = joined.select("metric", "value", floor.alias("floor"))
    return out.withColumn("passed", F.coalesce(F.col("value") >= F.col("floor"), F.lit(False)))


def fold_digest(rows: DataFrame, path: str, digest: str, *, header: str = "") -> DataFrame:
    """One digest of (path, digest) rows in order of path: sha256 of the header and a ``path NUL digest`` line for each.

    Lines are sorted in ranges side by side and packed; one task then goes through the packs in order with a running hash, so no row, task or
    driver holds them all.
    """
    lines = rows.select(F.col(path).cast("string").alias("p"), F.col(digest).cast("string").alias("d")).where("p is not null and d is not null")
    packs = lines.repartitionByRange("p", "d").sortWithinPartitions("p", "d").select(F.concat("p", F.lit("\0"), "d", F.lit("\n")).cast("binary").alias("line")).mapInArrow(_packed, "part long, k long, pack binary")
    first = rows.sparkSession.range(1).select(F.lit(-1).cast("long").alias("part"), F.lit(0).cast("long").alias("k"), F.lit(header).cast("binary").alias("pack"))
    return first.union(packs).repartition(1).sortWithinPartitions("part", "k").select("pack").mapInArrow(_running_hash, "digest string")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    for k, batch in enumerate(batches):
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "k": pa.array([k], pa.int64()), "pack": pa.array([b"".join(batch.column(0).to_pylist())], pa.binary())})


def _running_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    running = hashlib.sha256()
    for batch in batches:
        for pack in batch.column(0):
            running.update(pack.as_buffer())
    yield pa.RecordBatch.from_pydict({"digest": [running.hexdigest()]})


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of the files below a folder that are not empty; path is relative to it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    root = F.lit(path.rstrip("/").removeprefix("file://").removeprefix("file:"))
    plain = F.regexp_replace("path", "^file:/+", "/")
    return files.select(F.substring(plain, F.length(root) + 2, F.length(plain)).alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def verify_manifest(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Files that are missing, unexpected or changed against a manifest."""
    from tessera.operators.history import tree_diff

    state = F.expr("case change when 'added' then 'unexpected' when 'deleted' then 'missing' else change end")
    return tree_diff(manifest, found).where("change <> 'unchanged'").select("path", state.alias("state"))


def freshness(fetches: DataFrame, run_start: Column) -> DataFrame:
    """Whether every fetch of a source is fresh, validated in this run and no fallback. (source, status, validated_at, fallback)"""
    ok = (F.col("status") == "fresh") & (F.col("validated_at") >= run_start) & ~F.col("fallback")
    return fetches.groupBy("source").agg(F.bool_and(F.coalesce(ok, F.lit(False))).alias("fresh"), F.count("*").alias("fetches"))


def snapshot_problems(rows: DataFrame, key: str, declared: dict[str, int], measures: dict[str, Column], pending: DataFrame) -> DataFrame:
    """(problem, key) of a snapshot: keys that are missing or repeated, counts other than declared, and stops (reason) still pending."""
    none = rows.where(F.col(key).isNull()).select(F.lit("missing-key").alias("problem"), F.lit("").alias("key"))
    again = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("key")).count().where("count > 1").select(F.lit("repeated-key").alias("problem"), "key")
    counted = rows.agg(*(F.coalesce(c.cast("long"), F.lit(-1)).alias(name) for name, c in measures.items()))
    each = F.array(*(F.struct(F.lit(name).alias("name"), F.col(f"`{name}`").alias("found"), F.lit(declared.get(name, -1)).alias("declared")) for name in measures))
    wrong = counted.select(F.explode(each).alias("m")).where("m.found <> m.declared").select(F.lit("other-count").alias("problem"), F.col("m.name").alias("key"))
    return none.union(again).union(wrong).union(pending.select(F.lit("pending-stop").alias("problem"), F.col("reason").alias("key")))


def source_choice(*, fresh: Column, cached: Column, placeholder: Column, legacy: Column) -> Column:
    """Which content a step takes: what is fresh, else what an earlier run left, else a legacy copy; a placeholder is none of these."""
    return F.when(fresh & ~placeholder, "fresh").when(cached, "reuse").when(legacy, "restore").otherwise("stop")


def integrity(content: Column) -> Column:
    """The sha512 of a file as registries write it."""
    return F.concat(F.lit("sha512-"), F.base64(F.unhex(F.sha2(content, 512))))


def image_kind(content: Column) -> Column:
    """png, webp or jpeg by magic bytes; null otherwise."""
    head = F.hex(F.substring(content, 1, 12))
    return F.when(head.startswith("89504E470D0A1A0A"), "png").when(head.startswith("52494646") & head.endswith("57454250"), "webp").when(head.startswith("FFD8FF"), "jpeg")


def require_counts(rows: DataFrame, declared: dict[str, int], measures: dict[str, Column]) -> None:
    """Stop if a declared count differs from the measured one."""
    found = rows.agg(*(c.alias(name) for name, c in measures.items())).first().asDict()
    wrong = [{"metric": k, "declared": v, "found": found.get(k)} for k, v in declared.items() if found.get(k) != v]
    if wrong:
        raise GateError("snapshot counts differ from its metadata", "rebuild the snapshot", wrong)

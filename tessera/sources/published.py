"""Tables that are published whole: segments written aside, and one small manifest that names those that count.

Tasks write the segment's files through Spark's own commit protocol; nothing of a write is seen before the manifest is replaced, in one
step, as its last act. A write that is cut off, however far it came, leaves the old content and a folder that ``tidy`` removes. Any store that
Spark writes to will do. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.gates import require_empty
from tessera.sources.io import exists, replace_file

MANIFEST = "MANIFEST.json"
#: With more segments than this an append writes all of them as one.
MOST_SEGMENTS = 32
CAPTURES = "cache_key string, url string, etag string, fetched_at long, validated_at long, content_sha256 string, content binary"


def manifest(spark: SparkSession, root: str) -> dict:
    """What counts: ``segments`` in order, and what the writers keep beside them."""
    path = f"{root.rstrip('/')}/{MANIFEST}"
    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if exists(spark, path) else {"segments": []}


def write_segment(df: DataFrame, root: str) -> str:
    """A table beside the others, not yet seen; its name."""
    name = f"segment-{uuid.uuid4().hex}"
    df.write.parquet(f"{root.rstrip('/')}/{name}")
    return name


def publish(spark: SparkSession, root: str, state: dict) -> dict:
    """Make a manifest the one that counts."""
    replace_file(spark, f"{root.rstrip('/')}/{MANIFEST}", (json.dumps(state, sort_keys=True, indent=1) + "\n").encode())
    return state


def overwrite(df: DataFrame, root: str) -> dict:
    """The table's content is ``df`` from now on; ``df`` may be made of what it was."""
    return publish(df.sparkSession, root, manifest(df.sparkSession, root) | {"segments": [write_segment(df, root)]})


def append(df: DataFrame, root: str) -> dict:
    state = manifest(df.sparkSession, root)
    return publish(df.sparkSession, root, state | {"segments": [*state["segments"], write_segment(df, root)]})


def read_segments(spark: SparkSession, root: str, schema: str, segments: list[str]) -> DataFrame:
    """The rows with ``segment``, their segment's place."""
    parts = [spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{s}").withColumn("segment", F.lit(k)) for k, s in enumerate(segments)]
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], schema).withColumn("segment", F.lit(0))


def read(spark: SparkSession, root: str, schema: str) -> DataFrame:
    return read_segments(spark, root, schema, manifest(spark, root)["segments"]).drop("segment")


def tidy(spark: SparkSession, root: str, keep: tuple[str, ...] = ()) -> list[str]:
    """Remove segments that do not count, left by writes that were cut off or replaced; no reader may still use them."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    named = json.dumps(manifest(spark, root))
    gone = sorted(f.getPath().getName() for f in store.listStatus(hadoop) if f.getPath().getName().startswith("segment-") and f.getPath().getName() not in named and f.getPath().getName() not in keep)
    for name in gone:
        store.delete(spark._jvm.org.apache.hadoop.fs.Path(hadoop, name), True)
    return gone


# --- captures ------------------------------------------------------------------------------------


def install_captures(spark: SparkSession, root: str, captures: DataFrame) -> dict:
    """A batch of captures (of ``CAPTURES``) as one write; keys have to stay inside the cache and declared hashes have to be the content's.

    Of several captures of a key the latest counts, by validation or fetch, then hash; it replaces what earlier batches had.
    """
    own = captures.select(*(F.col(c) if c in captures.columns else F.lit(None).alias(c) for c in (f.split()[0] for f in CAPTURES.split(", "))))
    own = own.select(*(F.col(f.split()[0]).cast(f.split()[1]) for f in CAPTURES.split(", "))).withColumn("_sha", F.sha2("content", 256))
    outside = F.col("cache_key").isNull() | (F.col("cache_key") == "") | F.col("cache_key").startswith("/") | F.array_contains(F.split("cache_key", "/"), "..")
    require_empty(own.where(outside).select("cache_key"), "a key leads out of the cache", "check the address")
    require_empty(own.where("content is null or content_sha256 <> _sha").select("cache_key"), "a capture is not what it was declared to be", "capture it again")
    own = own.withColumn("content_sha256", F.col("_sha")).drop("_sha")
    told = F.struct(*(c for c in own.columns if c != "cache_key"))
    newest = own.groupBy("cache_key").agg(F.max_by(told, F.struct(F.coalesce("validated_at", "fetched_at", F.lit(0)), "content_sha256")).alias("_c"))
    state = append(newest.select("cache_key", "_c.*"), root)
    if len(state["segments"]) > MOST_SEGMENTS:
        state = overwrite(_newest(spark, root), root)
    return state


def _newest(spark: SparkSession, root: str) -> DataFrame:
    from pyspark.sql import Window

    rows = read_segments(spark, root, CAPTURES, manifest(spark, root)["segments"])
    # a filter on the key goes through the window to the files
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy("cache_key").orderBy(F.desc("segment")))).where("_rank = 1").drop("_rank", "segment")


def read_captures(spark: SparkSession, root: str) -> DataFrame:
    """(cache_key, url, content, content_sha256, state): the newest capture of each key; changed content is null."""
    rows = _newest(spark, root)
    state = F.when(F.sha2("content", 256) == F.col("content_sha256"), "ok").otherwise("changed")
    return rows.select("cache_key", "url", F.when(state == "ok", F.decode("content", "UTF-8")).alias("content"), "content_sha256", state.alias("state"))


# --- reuse by record -----------------------------------------------------------------------------


def refresh(spark: SparkSession, root: str, inputs: DataFrame, key: str, compute: Callable[[DataFrame], DataFrame], schema: str) -> dict[str, int]:
    """Bring the outputs of records up to date: ``compute`` is given the inputs that are new or changed, and no others.

    ``inputs`` has a row for each record: its key, ``input_hash`` and what ``compute`` needs; that gives rows of ``schema``, which has the
    key, any number for each record. A record whose hash is null, as its source can't be had, keeps the outputs that it had last (``stale``), or has
    none (``placeholder``). Outputs stay beside the hash that they were made of, so a record that changes back is not computed again. Counts
    of the records by state. Everything counts with the manifest, so a run that is cut off has changed nothing.
    """
    state = manifest(spark, root)
    keys = spark.createDataFrame([], f"{_key_of(schema, key)}, input_hash string, state string")
    last = spark.read.schema(keys.schema).parquet(f"{root.rstrip('/')}/{state['inputs']}") if "inputs" in state else keys
    known = read_segments(spark, root, f"{_key_of(schema, key)}, input_hash string", state.get("done", [])).drop("segment")
    told = inputs.join(last.select(key, F.col("input_hash").alias("_last")), key, "left")
    now = F.coalesce("input_hash", "_last")
    kind = F.when(now.isNull(), "placeholder").when(F.col("input_hash").isNull(), "stale")
    done = known.select(key, "input_hash", F.lit(True).alias("_done")).distinct()
    told = told.withColumns({"state": kind, "input_hash": now}).drop("_last").join(done, [key, "input_hash"], "left")
    told = told.withColumn("state", F.coalesce("state", F.when(F.col("_done"), "reused").otherwise("computed"))).drop("_done")
    listed = write_segment(told.select(key, "input_hash", "state"), root)
    fresh = spark.read.schema(keys.schema).parquet(f"{root.rstrip('/')}/{listed}").where("state = 'computed'").select(key, "input_hash")
    counts = {r["state"]: r["count"] for r in spark.read.schema(keys.schema).parquet(f"{root.rstrip('/')}/{listed}").groupBy("state").count().collect()}
    new = dict(state) | {"inputs": listed}
    if counts.get("computed"):
        made = compute(inputs.join(fresh, [key, "input_hash"], "left_semi"))
        made = made.select(*(f.split()[0] for f in schema.split(", "))).join(fresh, key)
        new |= {"segments": [*state["segments"], write_segment(made, root)], "done": [*state.get("done", []), write_segment(fresh, root)]}
    publish(spark, root, new)
    return counts


def _key_of(schema: str, key: str) -> str:
    return next(f for f in schema.split(", ") if f.split()[0] == key)


def outputs(spark: SparkSession, root: str, key: str, schema: str) -> DataFrame:
    """The outputs of all records of the last refresh, of ``schema`` and with their ``state``."""
    state = manifest(spark, root)
    rows = read_segments(spark, root, f"{schema}, input_hash string", state["segments"]).drop("segment")
    listed = spark.read.schema(f"{_key_of(schema, key)}, input_hash string, state string").parquet(f"{root.rstrip('/')}/{state['inputs']}")
    return rows.join(listed, [key, "input_hash"]).drop("input_hash")

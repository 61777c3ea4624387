"""Typed readers and sinks for frozen inputs: JSON lines, JSON documents, captures of pages, and their metadata."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.gates import GateError, require_empty

CAPTURE = "cache_key string, url string, etag string, last_modified string, fetched_at long, validated_at long, status_code int, fetch_status string, used_cache_fallback boolean, content_sha256 string, acquisition_source string, item_id long, item_name string"


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str, *, strict: bool = False) -> DataFrame:
    """JSON lines. Lenient: a missing file is empty, bad lines are left out; strict: both are errors, which name file and line."""
    if not strict:
        return spark.read.schema(schema).json(path, mode="DROPMALFORMED") if exists(spark, path) else spark.createDataFrame([], schema)
    if not exists(spark, path):
        raise GateError("a file is missing", "restore it", [{"file": path}])
    require_empty(bad_json_lines(spark, path), "lines are no JSON objects", "mend these lines")
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text) of all lines, from 1 in each file. Files are split by byte ranges as always, and none is read whole.

    Lines are numbered within their split, as they come; where a split begins in its file is the sum of the counts of those before it.
    """
    from pyspark.sql import Window

    scan, splits = _split_lines(spark, path)
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = splits.select("file", "split", (before - F.col("_first") + 1).alias("_base"))
    return scan.join(bases, ["file", "split"]).select("file", (F.col("_at") + F.col("_base")).alias("line"), "text")


def _split_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(lines with the file, the split and a number that grows within it, the first number and the count of each split)."""
    scan = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("_at"), F.col("value").alias("text"))
    return scan, scan.groupBy("file", "split").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))


def bad_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, text) of lines that are no JSON object; lines are numbered only where there are any."""
    parsed = F.try_parse_json("text")
    bad = (F.trim("text") != "") & (parsed.isNull() | ~F.schema_of_variant(parsed).startswith("OBJECT"))
    if not _split_lines(spark, path)[0].where(bad).limit(1).count():
        return spark.createDataFrame([], "file string, line long, text string")
    return numbered_lines(spark, path).where(bad)


def read_catalog(spark: SparkSession, path: str, schema: T.StructType | str, *, optional: bool = False) -> DataFrame:
    """Rows of a JSON array file with their place; a missing file is an error unless it may be missing. Read anew at each call."""
    if not exists(spark, path):
        if not optional:
            raise GateError("a catalog is missing", "restore it", [{"file": path}])
        return spark.createDataFrame([], schema).withColumn("pos", F.lit(0).cast("long"))
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST").withColumn("pos", F.monotonically_increasing_id())


def read_json_document(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A JSON document of any layout: rows of a schema (an array gives a row for each element), or one variant ``document``."""
    if schema is not None:
        return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")
    return spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("document"))


def split_master(spark: SparkSession, path: str, out: str) -> list[str]:
    """One folder of JSON lines for each key of a document of arrays."""
    master = spark.read.text(path, wholetext=True).select(F.parse_json("value").alias("v"))
    rows = spark.sql("select k.key as key, to_json(e.value) as value from {master}, lateral variant_explode(v) k, lateral variant_explode(k.value) e", master=master)
    rows.write.mode("overwrite").partitionBy("key").text(out)
    return sorted(r["key"] for r in rows.select("key").distinct().collect())


def newest_captures(metadata: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(newest capture of each item, duplicates) of one acquisition source; of equal times the later row counts."""
    from pyspark.sql import Window

    at = F.coalesce("validated_at", "fetched_at", F.lit(0))
    own = metadata.where((F.col("acquisition_source") == source) & F.col("item_id").isNotNull())
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(at.desc(), F.col("pos").desc()))
    ranked = own.withColumn("_rank", rank)
    return ranked.where("_rank = 1").drop("_rank"), ranked.where("_rank > 1").drop("_rank")


def read_captures(spark: SparkSession, root: str, metadata: DataFrame) -> DataFrame:
    """Pages of a cache whose content has the hash that the metadata say: (cache_key, content, state)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    prefix = root.rstrip("/").removeprefix("file://").removeprefix("file:") + "/"
    key = F.replace(F.regexp_replace("path", "^file:/+", "/"), F.lit(prefix), F.lit(""))
    found = files.select(key.alias("_key"), F.sha2("content", 256).alias("_sha"), F.decode("content", "UTF-8").alias("content"))
    joined = metadata.join(found, F.col("cache_key") == F.col("_key"), "left")
    inside = ~F.col("cache_key").contains("..") & ~F.col("cache_key").startswith("/")
    state = F.when(~inside, "outside").when(F.col("_key").isNull(), "missing").when(F.col("_sha") != F.col("content_sha256"), "changed").otherwise("ok")
    return joined.withColumn("state", state).withColumn("content", F.when(F.col("state") == "ok", F.col("content"))).drop("_key", "_sha")


def resumable(records: DataFrame, now: int, max_age: int) -> DataFrame:
    """Records of a crawl that need no new fetch: done, with content, and not too old."""
    return records.where((F.col("fetch_status") == "ok") & F.col("content_sha256").isNotNull() & (F.lit(now) - F.coalesce("validated_at", "fetched_at") <= max_age))


def cache_decision(*, cached: Column, validated: Column, validated_at: Column, now: Column, ttl: int, cache_only: bool = False, force: bool = False) -> Column:
    """What to do for an address: ``cache``, ``missing`` (only the cache may be used and lacks it), ``ask`` (a conditional request) or ``fetch``.

    In this order: only the cache; validated in this run; not older than ``ttl``; else the network.
    """
    fresh = validated | (F.coalesce(now - validated_at, F.lit(ttl + 1)) <= ttl)
    if cache_only:
        return F.when(cached, "cache").otherwise("missing")
    network = F.when(cached, "ask").otherwise("fetch")
    return network if force else F.when(cached & fresh, "cache").otherwise(network)


def cache_outcome(*, decision: Column, status: Column, cached: Column, strict: bool = False) -> Column:
    """What became of it, by the status of the answer (null: none): ``cached``, ``revalidated``, ``updated``, ``fallback`` or ``failed``."""
    answered = F.when((status == 304) & cached, "revalidated").when((status >= 200) & (status < 300), "updated")
    lost = F.lit("failed") if strict else F.when(cached, "fallback").otherwise("failed")
    return F.when(decision == "cache", "cached").when(decision == "missing", "failed").otherwise(F.coalesce(answered, lost))


def retry_delay(attempt: Column, retry_after: Column, *, base: float = 1.0, cap: float = 8.0, jitter: Column | float = 0.0) -> Column:
    """Seconds before the next attempt: what the answer asks for, else twice as long each time; at most ``cap``, plus the jitter."""
    asked = retry_after.try_cast("double")
    doubled = F.least(F.lit(base) * F.pow(F.lit(2.0), F.greatest(attempt - 1, F.lit(0))), F.lit(cap))
    return F.when(asked.isNotNull(), F.least(asked, F.lit(cap))).otherwise(doubled + (F.lit(jitter) if isinstance(jitter, float) else jitter))


def retries(status: Column, attempt: Column, *, most: int = 4) -> Column:
    """Whether an answer is worth another attempt."""
    return ((status == 429) | (status >= 500)) & (attempt < most)


def master_state(*, age_hours: Column, local_version: Column, remote_version: Column, valid: Column, most_hours: float, force: bool = False) -> Column:
    """What to do with the master data at hand: ``keep``, ``refresh``, ``keep-stale`` (the remote can't be asked) or ``stop``."""
    current = valid & ~F.lit(force) & (age_hours <= most_hours)
    same = valid & (local_version == remote_version)
    return F.when(current, "keep").when(remote_version.isNull(), F.when(valid, "keep-stale").otherwise("stop")).when(F.coalesce(same, F.lit(False)) & ~F.lit(force), "keep").otherwise("refresh")


def read_cache_index(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(newest metadata of each key, broken lines) of a metadata table kept as JSON lines, of which the later count; ``pos`` orders them."""
    parsed = lines.withColumn("_m", F.from_json(column, CAPTURE))
    sound = F.col("_m.cache_key").isNotNull()
    newest = parsed.where(sound).groupBy(F.col("_m.cache_key").alias("_key")).agg(F.max_by("_m", "pos").alias("_m")).select("_m.*")
    return newest, parsed.where(~sound | F.col("_m").isNull()).drop("_m")


def write_json_lines(df: DataFrame, path: str, *, append: bool = False) -> None:
    """Rows as JSON lines, nulls written as null, in as many files as the table has partitions."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def append_json_list(spark: SparkSession, path: str, rows: list[dict]) -> int:
    """Append a few objects to a document that is a list, made where it is missing, and replace it as a whole; its new length."""
    found = []
    if exists(spark, path):
        found = json.loads(spark.read.text(path, wholetext=True).first()[0])
        if not isinstance(found, list):
            raise GateError("a document is no list", "write it anew", [{"file": path}])
    replace_file(spark, path, (json.dumps([*found, *rows], ensure_ascii=False, indent=2) + "\n").encode())
    return len(found) + len(rows)


def replace_file(spark: SparkSession, path: str, data: bytes) -> None:
    """A file's new content, written beside it and put in its place in one step: readers see the old or the new."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    out = target.getFileSystem(conf).create(part, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.getFileSystem(conf).getUri(), conf)
    files.rename(files.makeQualified(part), files.makeQualified(target), options)


def replace_folder(spark: SparkSession, fresh: str, path: str) -> None:
    """Put a folder in the place of another, which is kept beside it until then; ``recover_folder`` ends what was cut off."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, new, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, fresh, f"{path.rstrip('/')}.old"))
    store = target.getFileSystem(conf)
    store.delete(old, True)
    if store.exists(target):
        store.rename(target, old)
    store.rename(new, target)
    store.delete(old, True)


def recover_folder(spark: SparkSession, path: str) -> bool:
    """Bring back a folder that a replacement had moved aside when it was cut off."""
    old = f"{path.rstrip('/')}.old"
    if exists(spark, path) or not exists(spark, old):
        return False
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, kept = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(old)
    return bool(target.getFileSystem(conf).rename(kept, target))


def write_if_changed(df: DataFrame, path: str, key: str) -> dict[str, int]:
    """Rewrite a table only if its records differ from what is there; counts of the changes."""
    from tessera.operators.history import record_diff

    spark = df.sparkSession
    recover_folder(spark, path)
    old = spark.read.schema(df.schema).json(path) if exists(spark, path) else spark.createDataFrame([], df.schema)
    counts = {r["change"]: r["count"] for r in record_diff(old, df, key).groupBy("change").count().collect()}
    if set(counts) - {"unchanged"} or not exists(spark, path):
        new = f"{path.rstrip('/')}.new"
        df.write.mode("overwrite").json(new)
        replace_folder(spark, new, path)
    return counts


def copy_files(spark: SparkSession, source: str, target: str, pattern: str = "*") -> list[str]:
    """Copy a folder's files of a pattern, in order of name; nothing where the folder is missing. Their names."""
    if not exists(spark, source):
        return []
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = jvm.org.apache.hadoop.fs.Path(f"{source.rstrip('/')}/{pattern}")
    store, folder = found.getFileSystem(conf), jvm.org.apache.hadoop.fs.Path(target)
    into = folder.getFileSystem(conf)
    into.mkdirs(folder)
    paths = sorted((f.getPath() for f in store.globStatus(found) or [] if f.isFile()), key=lambda p: p.getName())
    for p in paths:
        jvm.org.apache.hadoop.fs.FileUtil.copy(store, p, into, jvm.org.apache.hadoop.fs.Path(folder, p.getName()), False, True, conf)
    return [p.getName() for p in paths]


def clear_folder(spark: SparkSession, path: str, keep: tuple[str, ...] = ()) -> list[str]:
    """Remove what is in a folder but for some names; the names removed."""
    if not exists(spark, path):
        return []
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(conf)
    gone = sorted((f.getPath() for f in store.listStatus(folder) if f.getPath().getName() not in keep), key=lambda p: p.getName())
    for p in gone:
        store.delete(p, True)
    return [p.getName() for p in gone]

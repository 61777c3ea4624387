"""What a user calls: read captured pages, validate a package against a baseline, build its manifest. All switches are arguments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.evidence import Vocabulary
from tessera.functions.pages import coverage_metrics, page_records
from tessera.operators import rules
from tessera.operators.gates import GateError, gate, require_empty
from tessera.plans.package import write_document, write_manifest
from tessera.sources.io import newest_captures, read_captures, write_json_lines


def offline_parse(spark: SparkSession, root: str, metadata: DataFrame, out: str | None = None, *, source: str, items: list[int] | None = None, limit: int | None = None, words: Vocabulary | None = None, allow_incomplete: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, issues) of the newest captures of items: pages whose hash holds, read as records.

    ``items`` and ``limit`` (in order of the item) restrict it; pages that are missing, changed or outside stop, unless it
    may be incomplete. With ``out`` records, issues and counts are written there.
    """
    newest, repeated = newest_captures(metadata, source)
    if items is not None:
        newest = newest.where(F.col("item_id").isin(items))
    if limit is not None:
        newest = newest.orderBy("item_id").limit(limit)
    pages = read_captures(spark, root, newest)
    lost = pages.where("state <> 'ok'").select("item_id", "cache_key", F.col("state").alias("issue"))
    if not allow_incomplete:
        require_empty(lost, "pages are not what their metadata say", "capture them again or allow an incomplete result")
    read = pages.where("state = 'ok'").select("item_id", "item_name", "url", page_records(F.col("content"), F.col("item_id"), F.col("item_name"), words=words).alias("record"))
    issues = read.select("item_id", F.col("url").alias("cache_key"), F.explode("record.issues").alias("issue")).union(lost)
    issues = issues.union(repeated.select("item_id", "cache_key", F.lit("duplicate-capture")))
    if out:
        write_json_lines(read.select("item_id", "item_name", "url", "record.*"), f"{out}/records")
        write_json_lines(issues, f"{out}/issues")
        counts = {r["metric"]: r["value"] for r in coverage_metrics(read).collect()}
        write_document(spark, f"{out}/metadata.json", {"counts": counts, "issues": issues.count(), "source": source})
    return read, issues


def validate(datasets: dict[str, DataFrame], counts: DataFrame, baseline: DataFrame, thresholds: DataFrame, *, strict: bool = True) -> DataFrame:
    """(rule, key) of what a package breaks: the rules of its datasets, and metrics below their floors.

    ``datasets``: any of ``list``, ``detail``, ``drop``, ``source``, ``bonus`` as JSON records (pos, json). Strict stops.
    """
    checks = {"list": rules.list_violations, "detail": rules.detail_violations, "drop": rules.drop_violations, "source": rules.source_violations, "bonus": rules.bonus_violations}
    found = gate(counts, baseline, thresholds).where("not passed").select(F.lit("metric").alias("rule"), F.col("metric").alias("key"))
    for name, records in datasets.items():
        if name not in checks:
            raise GateError("there is no such dataset", "use one of " + ", ".join(checks), [{"dataset": name}])
        found = found.union(checks[name](records))
    if strict:
        rules.require_sound(found)
    return found


def build(spark: SparkSession, tables: dict[str, DataFrame], folder: str, *, strict: bool, status: dict[str, str], **facts) -> dict:
    """Write datasets as JSON lines below a folder, with a manifest; strict stops unless every source is fresh."""
    stale = sorted(k for k, v in status.items() if v != "fresh")
    if strict and stale:
        raise GateError("sources are not fresh", "refresh them", [{"source": k, "status": status[k]} for k in stale])
    for name, df in tables.items():
        write_json_lines(df, f"{folder.rstrip('/')}/{name}")
    return write_manifest(spark, folder, sources=status, **facts)

"""Observing sources: snapshots kept beside an append-only log of what changed."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import history
from tessera.sources import published


def snapshot(facts: DataFrame) -> DataFrame:
    """(source, fact_key, signature) of aggregated facts; routes and evidence are no content."""
    return facts.select("source", "fact_key", F.to_json(F.struct("item_id", "assistant_id", "capability", "target_id", "mask")).alias("signature"))


def facts_hash(facts: DataFrame) -> DataFrame:
    """A hash of each source's snapshot: the sum of its rows' hashes, so that nothing is gathered, with its count."""
    rows = F.conv(F.substring(F.sha2(F.concat_ws("|", "fact_key", "signature"), 256), 1, 15), 16, 10).cast("decimal(20,0)")
    return snapshot(facts).groupBy("source").agg(F.sha2(F.concat_ws(":", F.count("*"), F.sum(rows)), 256).alias("facts_hash"), F.count("*").alias("facts"))


EVENTS = "source string, fact_key string, change string, origin string, before string, after string, observed_at string, pos long, assessment string"
SNAPSHOT = "source string, fact_key string, signature string"
#: Runs whose reports a manifest keeps; a batch that comes again later than that counts as new.
KEPT_RUNS = 1000


def events(spark: SparkSession, root: str, source: str) -> DataFrame:
    """The log of a source: the events of all runs that count."""
    return published.read_segments(spark, f"{root}/{source}", EVENTS, published.manifest(spark, f"{root}/{source}")["segments"]).drop("segment")


def observe(
    spark: SparkSession, root: str, facts: DataFrame, statuses: dict[str, str], *, observed_at: str | None = None, parser_versions: dict[str, tuple[str, str]] | None = None, run_id: str | None = None
) -> dict[str, dict]:
    """One run over all sources' aggregated facts: what each source's log and snapshot became.

    Sources whose status is not ``ok`` are skipped, so that what they lack is no removal. The first run writes a
    baseline and no events. Events carry how the other sources of the same run bear on them. Everything that a run writes for a source counts
    with its manifest, which is replaced last: a run cut off before has changed nothing, and one of a ``run_id`` that the source
    knows is not done again. What has been removed is a table of its own, brought up to date from the run's events, so the log is not read.
    """
    at = observed_at or datetime.now(UTC).replace(microsecond=0).isoformat()
    run_id = run_id or uuid.uuid4().hex
    states = {source: published.manifest(spark, f"{root}/{source}") for source in statuses}
    done = {source: s["runs"][run_id] for source, s in states.items() if run_id in s.get("runs", {})}
    current = snapshot(facts.where(F.col("source").isin([s for s, v in statuses.items() if v == "ok"]))).cache()
    report: dict[str, dict] = {}
    for source, status in sorted(statuses.items()):
        if source in done:
            report[source] = done[source]
            continue
        folder, state = f"{root}/{source}", states[source]
        row = {"state": "skipped", "status": status, "events": 0}
        if status == "ok":
            own = current.where(F.col("source") == source)
            if "snapshot" not in state:
                row["state"] = "baseline"
                state |= {"snapshot": published.write_segment(own, folder), "gone": None}
            else:
                old = spark.read.schema(SNAPSHOT).parquet(f"{folder}/{state['snapshot']}")
                gone = spark.read.schema("fact_key string").parquet(f"{folder}/{state['gone']}") if state["gone"] else spark.createDataFrame([], "fact_key string")
                found = history.snapshot_events(old, own, gone, versions=(parser_versions or {}).get(source)).withColumn("source", F.lit(source))
                found = history.assess(found, current).withColumn("observed_at", F.lit(at)).withColumn("pos", F.lit(state.get("observed", 0)).cast("long"))
                name = published.write_segment(found.select(*(f.split()[0] for f in EVENTS.split(", "))), folder)
                told = spark.read.schema(EVENTS).parquet(f"{folder}/{name}")
                counts = {r["change"]: r["count"] for r in told.groupBy("change").count().collect()}
                row |= {"state": "changed" if counts else "unchanged", "events": sum(counts.values())}
                if counts:
                    state |= {"segments": [*state["segments"], name], "snapshot": published.write_segment(own, folder)}
                if counts.keys() & {"removed", "added", "reappeared"}:
                    back = told.where(F.col("change").isin("added", "reappeared")).select("fact_key")
                    now = gone.join(back, "fact_key", "left_anti").union(told.where("change = 'removed'").select("fact_key")).distinct()
                    state["gone"] = published.write_segment(now, folder)
        runs = {**state.get("runs", {}), run_id: row | {"observed_at": at}}
        published.publish(spark, folder, state | {"observed": state.get("observed", 0) + 1, "runs": dict(list(runs.items())[-KEPT_RUNS:])})
        report[source] = row | {"observed_at": at}
    current.unpersist()
    return report

"""Observation as a stream (a Spark extra): every micro-batch of fact files is one run of ``plans.observe``."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.facts import aggregate_facts
from tessera.plans.observe import observe

FACTS = "source string, item_id long, assistant_id long, capability string, target_id long, route string, pos long, mask int, evidence_status string, batch string"


def observe_stream(spark: SparkSession, folder: str, root: str, checkpoint: str) -> StreamingQuery:
    """Watch a folder of fact files (Parquet); each batch holds whole sources, which are taken as their new state."""
    stream = spark.readStream.schema(FACTS).option("maxFilesPerTrigger", 1).parquet(folder)

    def run(batch, number: int) -> None:
        facts = aggregate_facts(batch)
        names = [r["source"] for r in facts.select("source").distinct().collect()]  # a row for each source
        observe(batch.sparkSession, root, facts, dict.fromkeys(names, "ok"), observed_at=f"batch-{number}", run_id=f"batch-{number}")

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Configuration documents as tables and settings: floors of metrics and of files, weights of the reliability score.

A document that lacks a key, has a value of another type or a weight out of its range stops before anything is computed with it.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.facts import Reliability
from tessera.operators.gates import GateError
from tessera.sources.io import read_json_document

_QUALITY = "minimums map<string,double>, relativeMinimumRatios map<string,double>, fileSizeMinimumRatio double, fileSizePaths array<string>"
_RELIABILITY = """currentSignals struct<pairwiseAgreement:double,peerConsensusAgreement:double>, historyContribution double, minimumHistoricalEvaluableChanges int, relativeWeightRange array<double>,
  minimumPairwiseEvidenceForFullConfidence int, minimumPeerConsensusEvidenceForFullConfidence int, minimumHistoricalEvidenceForFullConfidence int"""


def quality_floors(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(thresholds (metric, minimum, ratio) for ``gates.gate``, files (path, ratio) whose sizes are watched) of a document."""
    document = read_json_document(spark, path, _QUALITY)
    least = document.select(F.explode("minimums").alias("metric", "minimum"))
    ratios = document.select(F.explode("relativeMinimumRatios").alias("metric", "ratio"))
    thresholds = least.join(ratios, "metric", "full").select("metric", "minimum", "ratio")
    if thresholds.where("minimum < 0 or ratio < 0 or ratio > 1 or (minimum is null and ratio is null)").limit(1).count():
        raise GateError("a floor is out of its range", "mend the configuration", [{"file": path}])
    return thresholds, document.select(F.explode("fileSizePaths").alias("path"), F.col("fileSizeMinimumRatio").alias("ratio"))


def reliability_settings(spark: SparkSession, path: str) -> Reliability:
    """The settings of ``facts.reliability`` of a document."""
    row = read_json_document(spark, path, _RELIABILITY).first()
    missing = [f for f in row.asDict() if row[f] is None]
    signals, bounds = row["currentSignals"], row["relativeWeightRange"] or []
    numbers = [*(signals or [None]), row["historyContribution"], *bounds]
    if missing or len(bounds) != 2 or any(x is None or x < 0 for x in numbers) or bounds[0] > bounds[1] or row["historyContribution"] > 1 or not sum(signals):
        raise GateError("settings of the reliability score are missing or out of their range", "mend the configuration", [{"file": path, "missing": missing}])
    default = Reliability()
    full = [row[f"minimum{k}EvidenceForFullConfidence"] for k in ("Pairwise", "PeerConsensus", "Historical")]
    return replace(
        default, pairwise=signals["pairwiseAgreement"], consensus=signals["peerConsensusAgreement"], history=row["historyContribution"], history_least=row["minimumHistoricalEvaluableChanges"],
        lowest=bounds[0], highest=bounds[1], confidence=tuple((c, w, n) for (c, w, _), n in zip(default.confidence, full)),
    )

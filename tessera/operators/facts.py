"""Fact algebra: merging, comparing and scoring what several sources say about the same keys.

A fact says on which days of a week (a mask of seven bits, Sunday first) an item can be handled by an assistant
(null: any) for a capability and a target (null: none), along a route. Its comparison identity is (item,
assistant, capability, target); keys are compared null-safe.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IDENTITY = ("item_id", "assistant_id", "capability", "target_id")
DAYS = ("sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday")


def week_mask(week: Column) -> Column:
    """Seven booleans as a mask; another length is an error."""
    checked = F.when(F.size(week) == 7, week).otherwise(F.raise_error(F.lit("a week has seven days")).cast("array<boolean>"))
    bits = F.transform(checked, lambda on, day: F.when(on, F.pow(F.lit(2), day)).otherwise(0).cast("int"))
    return F.aggregate(bits, F.lit(0), lambda a, b: a + b)


def week_days(mask: Column) -> Column:
    """Names of the enabled days, in order."""
    return F.filter(F.array(*(F.when(mask.bitwiseAND(1 << i) > 0, F.lit(d)) for i, d in enumerate(DAYS))), lambda d: d.isNotNull())


def fact_key(*, route: Column | None = None) -> Column:
    """A fact's identity as text."""
    part = lambda name, c: F.concat(F.lit(f"{name}:"), F.coalesce(c.cast("string"), F.lit("none")))
    parts = [part("item", F.col("item_id")), part("assistant", F.col("assistant_id")), part("capability", F.col("capability")), part("target", F.col("target_id"))]
    return F.concat_ws("|", *parts, *([] if route is None else [part("route", route)]))


def merge_facts(facts: DataFrame, *keys: str) -> DataFrame:
    """One row for each identity (and further keys): days of any of its facts, routes in order of ``pos``, each once.

    A route's first place is taken before routes meet, so a key holds each of its routes once, however many facts it has.
    """
    by = [*keys, *IDENTITY]
    each = facts.groupBy(*by, "route").agg(F.bit_or("mask").alias("mask"), F.min("pos").alias("pos"))
    places = F.array_sort(F.collect_list(F.when(F.col("route").isNotNull(), F.struct("pos", "route"))))
    return each.groupBy(*by).agg(F.bit_or("mask").cast("int").alias("mask"), F.transform(places, lambda x: x["route"]).alias("routes"))


def aggregate_facts(facts: DataFrame) -> DataFrame:
    """Merged facts of each source with their key and the sorted sets of evidence; empty sets are null."""
    evidence = [c for c in ("parser_version", "source_ref", "evidence_status") if c in facts.columns]
    sets = [F.nullif(F.sort_array(F.collect_set(c)), F.array().cast("array<string>")).alias(f"{c}s") for c in evidence]
    merged = facts.groupBy("source", *IDENTITY).agg(F.bit_or("mask").cast("int").alias("mask"), F.sort_array(F.collect_set("route")).alias("routes"), *sets)
    return merged.withColumn("fact_key", fact_key())


def supported(candidate: DataFrame, declared: list[str] | None = None) -> DataFrame:
    """Capabilities that a source can speak of: declared ones, or those of its facts."""
    names = sorted({x.strip() for x in declared or [] if x.strip()})
    if names:
        return candidate.sparkSession.createDataFrame([(n,) for n in names], "capability string")
    return candidate.select("capability").distinct()


def compare(baseline: DataFrame, candidate: DataFrame, *, declared: list[str] | None = None) -> DataFrame:
    """Null-safe full outer comparison of merged facts: every identity with its status.

    Baseline facts of capabilities that the candidate can't speak of are left out before.
    """
    able = supported(candidate, declared)
    left = merge_facts(baseline.join(able, "capability", "left_semi")).select(*IDENTITY, F.col("mask").alias("baseline_mask"), F.col("routes").alias("baseline_routes"))
    right = merge_facts(candidate).select(*IDENTITY, F.col("mask").alias("candidate_mask"), F.col("routes").alias("candidate_routes"))
    l, r = left.alias("l"), right.alias("r")
    match = F.col(f"l.{IDENTITY[0]}").eqNullSafe(F.col(f"r.{IDENTITY[0]}"))
    for c in IDENTITY[1:]:
        match = match & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    status = (
        F.when(F.col("baseline_mask").isNull(), "extra-in-candidate")
        .when(F.col("candidate_mask").isNull(), "missing-in-candidate")
        .when(F.col("baseline_mask") != F.col("candidate_mask"), "weekday-mismatch")
        .otherwise("match")
    )
    # a null key is a value here, so which side has the row is told by its mask
    mine = [F.when(F.col("baseline_mask").isNotNull(), F.col(f"l.{c}")).otherwise(F.col(f"r.{c}")).alias(c) for c in IDENTITY]
    return l.join(r, match, "full").select(*mine, status.alias("status"), "baseline_mask", "candidate_mask", "baseline_routes", "candidate_routes")


def rate(part: Column, whole: Column) -> Column:
    """part / whole to six places, halves to even; null where there is nothing."""
    return F.bround(F.try_divide(part.cast("double"), whole), 6)


def summarise(compared: DataFrame) -> DataFrame:
    """Counts by status and the agreement rate, in one row."""
    n = lambda s: F.count_if(F.col("status") == s)
    counts = compared.agg(n("match").alias("matches"), n("weekday-mismatch").alias("mismatches"), n("missing-in-candidate").alias("missing"), n("extra-in-candidate").alias("extra"))
    comparable = F.col("matches") + F.col("mismatches")
    return counts.select("*", comparable.alias("comparable"), rate(F.col("matches"), comparable).alias("agreement_rate"))


def pairwise(facts: DataFrame) -> DataFrame:
    """How often each source agrees with each other on common keys. ``facts``: (source, fact_key, mask)."""
    own = facts.select("source", "fact_key", "mask")
    peer = facts.select(F.col("source").alias("peer"), "fact_key", F.col("mask").alias("peer_mask"))
    pairs = own.join(peer, "fact_key").where(F.col("source") != F.col("peer"))
    counted = pairs.groupBy("source", "peer").agg(F.count("*").alias("comparable"), F.count_if(F.col("mask") == F.col("peer_mask")).alias("agreements"))
    return counted.withColumn("agreement_rate", rate(F.col("agreements"), F.col("comparable")))


def consensus(facts: DataFrame, *, votes: int = 2) -> DataFrame:
    """Of the keys on which ``votes`` or more peers of a source say the same, how many the source agrees on.

    A key's votes are counted once; a source's own vote is taken off before its peers' most common one is
    found, ties going to the peer first in order. No two sources' rows are paired.
    """
    said = facts.groupBy("fact_key", "mask").agg(F.count("*").alias("votes"), F.sort_array(F.collect_set("source")).alias("by"))
    options = said.groupBy("fact_key").agg(F.collect_list(F.struct("mask", "votes", "by")).alias("options"))
    mine = facts.select("source", "fact_key", "mask").join(options, "fact_key")
    others = F.transform(
        "options",
        lambda o: F.struct(
            (-(o["votes"] - F.array_contains(o["by"], F.col("source")).cast("long"))).alias("order"),
            F.array_min(F.filter(o["by"], lambda s: s != F.col("source"))).alias("first"),
            o["mask"].alias("mask"),
        ),
    )
    best = F.array_min(others)
    agreed = mine.select("source", "mask", best.alias("best")).where(-F.col("best.order") >= votes)
    counted = agreed.groupBy("source").agg(F.count("*").alias("comparable"), F.count_if(F.col("mask") == F.col("best.mask")).alias("agreements"))
    return counted.withColumn("agreement_rate", rate(F.col("agreements"), F.col("comparable")))


def weighted_average(*pairs: tuple[Column, float]) -> Column:
    """Mean of the values that are not null, by weight; null if all are. Values of six places, weights of two: in decimals, so exact but for the division."""
    part = lambda v, w: F.when(v.isNotNull(), v.cast("decimal(12,6)") * F.lit(w).cast("decimal(4,2)")).otherwise(F.lit(0).cast("decimal(4,2)"))
    total = sum((part(v, w) for v, w in pairs[1:]), part(*pairs[0]))
    present = lambda v, w: F.when(v.isNotNull(), F.lit(w)).otherwise(0.0).cast("decimal(4,2)")
    weight = sum((present(v, w) for v, w in pairs[1:]), present(*pairs[0]))
    return F.try_divide(total, weight)


@dataclass(frozen=True)
class Reliability:
    """Settings of the reliability score; the defaults are fixed values: weights, thresholds and sufficient evidence."""

    pairwise: float = 0.65
    consensus: float = 0.35
    history: float = 0.2
    history_least: int = 5
    confidence: tuple = (("pair_comparable", 0.45, 500), ("vote_comparable", 0.30, 200), ("evaluable", 0.25, 20))
    lowest: float = 0.75
    highest: float = 1.25


def confidence_label(confidence: Column) -> Column:
    return F.when(confidence >= 0.8, "high").when(confidence >= 0.5, "medium").otherwise("low")


def reliability(evidence: DataFrame, settings: Reliability = Reliability()) -> DataFrame:
    """Scores of sources from (source, pair_rate, pair_comparable, vote_rate, vote_comparable, history_rate, evaluable).

    The mean of the scores is a window over all sources, of which there are few.
    """
    current = weighted_average((F.col("pair_rate"), settings.pairwise), (F.col("vote_rate"), settings.consensus))
    old = F.col("history_rate").isNotNull() & F.col("current").isNotNull() & (F.col("evaluable") >= settings.history_least)
    combined = F.when(old, round(1 - settings.history, 6) * F.col("current") + settings.history * F.col("history_rate")).otherwise(F.col("current"))
    parts = [F.least(F.lit(1.0), F.coalesce(F.col(c), F.lit(0)) / F.lit(float(full))) * w for c, w, full in settings.confidence]
    scored = evidence.withColumn("current", current).withColumn("score", F.bround(combined, 6)).withColumn("confidence", F.bround(parts[0] + parts[1] + parts[2], 6))
    mean = F.avg("score").over(Window.partitionBy())
    weight = F.when(F.col("score").isNull() | (F.col("mean") <= 0), 1.0).otherwise(F.bround(F.greatest(F.lit(settings.lowest), F.least(F.lit(settings.highest), F.col("score") / F.col("mean"))), 4))
    state = F.when(F.col("score").isNull() | (F.col("mean") <= 0), "insufficient-evidence").otherwise("scored")
    return scored.withColumn("mean", mean).select("source", "score", "confidence", confidence_label(F.col("confidence")).alias("confidence_label"), weight.alias("relative_weight"), state.alias("state"))


def preliminary_decision(facts: DataFrame) -> DataFrame:
    """Confidence in each key by how many sources say it explicitly: two high, one medium, none low."""
    explicit = F.count_distinct(F.when(F.col("evidence_status") == "explicit", F.col("source")))
    counted = facts.groupBy("fact_key").agg(explicit.alias("explicit_sources"), F.count_distinct("source").alias("sources"))
    return counted.withColumn("decision", F.when(F.col("explicit_sources") >= 2, "high").when(F.col("explicit_sources") >= 1, "medium").otherwise("low"))


def route_variants(facts: DataFrame) -> DataFrame:
    """Items with several routes, with what each is used for, in the order of ``pos``, each value once."""
    kinds = ("route", "assistant_id", "capability", "target_id")
    values = F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value")) for c in kinds))
    each = facts.select("item_id", "pos", F.explode(values).alias("v")).where("v.value is not null")
    # a value's first place, before an item's values meet
    first = each.groupBy("item_id", "v.kind", "v.value").agg(F.min("pos").alias("pos"))

    def ordered(kind: str) -> Column:
        places = F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("pos", "value"))))
        return F.transform(places, lambda x: x["value"]).cast(f"array<{facts.schema[kind].dataType.simpleString()}>").alias(f"{kind}s")

    return first.groupBy("item_id").agg(*map(ordered, kinds)).where(F.size("routes") > 1)

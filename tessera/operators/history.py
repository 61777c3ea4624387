"""Snapshots, their differences, and the events that these make.

A snapshot is a table of facts by ``fact_key`` with a ``signature``, what counts as its content. Events are
appended; a key that comes back after its last event was a removal has reappeared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def record_diff(before: DataFrame, after: DataFrame, key: str, content: list[str] | None = None) -> DataFrame:
    """Every key of either side with its change: added, removed, changed or unchanged.

    Of rows of one key on one side the last by ``pos`` counts, or the greatest where there is no such column.
    """
    columns = content or [c for c in after.columns if c not in (key, "pos")]

    def side(rows: DataFrame, name: str, value: str) -> DataFrame:
        what = F.struct(*columns)
        last = F.max_by(what, "pos") if "pos" in rows.columns and "pos" not in columns else F.max(what)
        return rows.groupBy(F.col(key).alias(name)).agg(last.alias(value))

    joined = side(before, "_k1", "_before").join(side(after, "_k2", "_after"), F.col("_k1").eqNullSafe(F.col("_k2")), "full")
    change = F.when(F.col("_before").isNull(), "added").when(F.col("_after").isNull(), "removed").when(F.col("_before").eqNullSafe(F.col("_after")), "unchanged").otherwise("changed")
    return joined.select(F.when(F.col("_after").isNull(), F.col("_k1")).otherwise(F.col("_k2")).alias(key), change.alias("change"))


def text_diff(before: DataFrame, after: DataFrame, key: str, column: str) -> DataFrame:
    """Difference of records kept as JSON text, whatever the layout and the order of their keys."""
    from tessera.functions.text import to_canonical_json

    form = lambda rows: rows.withColumn(column, F.coalesce(to_canonical_json(F.col(column)), F.col(column)))
    return record_diff(form(before), form(after), key, [column])


def tree_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Difference of two lists of files (path, bytes, sha256)."""
    return record_diff(source, target, "path", ["bytes", "sha256"]).withColumn("change", F.expr("case change when 'removed' then 'deleted' when 'changed' then 'modified' else change end"))


def removed_keys(events: DataFrame) -> DataFrame:
    """Keys whose last added, removed or reappeared event, by ``pos``, is a removal."""
    told = events.where(F.col("change").isin("added", "removed", "reappeared"))
    return told.groupBy("fact_key").agg(F.max_by("change", "pos").alias("last")).where("last = 'removed'").select("fact_key")


def snapshot_events(previous: DataFrame, current: DataFrame, removed: DataFrame, *, versions: tuple[str, str] | None = None) -> DataFrame:
    """Events between two snapshots (fact_key, signature[, parser_version]); unchanged keys make none.

    A change is of the parser where the sets of versions of the snapshots differ, of the source otherwise.
    """
    old = previous.select(F.col("fact_key").alias("_o"), F.col("signature").alias("before"))
    new = current.select(F.col("fact_key").alias("_n"), F.col("signature").alias("after"))
    gone = removed.select(F.col("fact_key").alias("_r")).distinct()
    joined = old.join(new, F.col("_o") == F.col("_n"), "full").join(gone, F.col("_n") == F.col("_r"), "left")
    change = (
        F.when(F.col("_o").isNull() & F.col("_r").isNotNull(), "reappeared")
        .when(F.col("_o").isNull(), "added")
        .when(F.col("_n").isNull(), "removed")
        .when(~F.col("before").eqNullSafe(F.col("after")), "modified")
    )
    origin = "parser-version-changed" if versions and versions[0] != versions[1] else "source-observed"
    return joined.select(F.coalesce("_o", "_n").alias("fact_key"), change.alias("change"), F.lit(origin).alias("origin"), "before", "after").where("change is not null")


def assess(events: DataFrame, peers: DataFrame) -> DataFrame:
    """How the other sources' current facts (source, fact_key, signature) bear on the events (source, fact_key, ...).

    For a removal: no peer has the key or peers don't agree, unconfirmed; two or more agree on one content,
    outlier. Else: a peer has the new content, corroborated; two or more agree on another, outlier; else
    unconfirmed. The peers' votes on a key are counted before they meet its events.
    """
    votes = peers.groupBy("fact_key", "signature").agg(F.collect_set("source").alias("by"))
    votes = votes.groupBy("fact_key").agg(F.collect_list(F.struct("signature", "by")).alias("votes"))
    joined = events.join(votes, "fact_key", "left")
    others = F.transform(F.coalesce("votes", F.array()), lambda v: F.struct(v["signature"].alias("signature"), F.size(F.array_except(v["by"], F.array("source"))).alias("n")))
    others = F.filter(others, lambda v: v["n"] > 0)
    agreeing = F.coalesce(F.array_max(F.transform(F.filter("_others", lambda v: v["signature"].eqNullSafe(F.col("after"))), lambda v: v["n"])), F.lit(0))
    against = F.coalesce(F.array_max(F.transform(F.filter("_others", lambda v: ~v["signature"].eqNullSafe(F.col("after"))), lambda v: v["n"])), F.lit(0))
    label = F.when((F.col("change") != "removed") & (agreeing > 0), "corroborated").when(against >= 2, "outlier").otherwise("unconfirmed")
    return joined.withColumn("_others", others).withColumn("assessment", label).drop("votes", "_others")


def history_metrics(events: DataFrame) -> DataFrame:
    """Counts of events by source, change and assessment, and the rate of corroborated among evaluable ones."""
    from tessera.operators.facts import rate

    n = lambda c, v: F.count_if(F.col(c) == v)
    counts = events.groupBy("source").agg(
        F.count("*").alias("events"),
        *(n("change", v).alias(v) for v in ("added", "removed", "modified", "reappeared")),
        *(n("assessment", v).alias(v) for v in ("corroborated", "outlier", "unconfirmed")),
    )
    evaluable = F.col("corroborated") + F.col("outlier")
    return counts.withColumn("evaluable", evaluable).withColumn("history_rate", rate(F.col("corroborated"), evaluable))


def latest(rows: DataFrame, key: list[str], *order: Column) -> DataFrame:
    """The last row of each key in the given order, which has to be total."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")

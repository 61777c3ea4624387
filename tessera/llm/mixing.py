"""Mixing sources to target weights by iterative proportional fitting.

Token counts of the cells (source, language, topic) are raked until their marginals are the targets; the ratio
of raked to counted tokens is a cell's weight. Sampling probabilities are the weights times one factor,
calibrated so that the expected tokens are the budget with no probability over 1; a document is taken when a
hash of its id, as a number in [0, 1), is below its probability.

By default a marginal's target is its observed share to the power ``temper``, renormalised. The topic is a column
``topic`` of the documents, or where they have none one learned from all texts (``topics``). Up to ``driver_cells`` cells are raked on the driver and broadcast; more are
raked as a distributed table.

Defined cases: null and empty texts have no tokens, learned topic ``empty``, and get the largest weight of
all cells, 1 at least where there is nothing to rake; null source, language or topic is a value of its
own; repeated rows of one id and cell are taken or left together; targets for values that don't occur are ignored
and the rest renormalised, values without a target get none of the weight; where no target of a dimension occurs it
keeps its observed shares; an empty table gives an empty
result; a table lacking the columns lang or source is raked to what it has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import topics
from tessera.llm.common import materialise, slices, text_buffer
from tessera.llm.words import NOT_SPACE, split

DRIVER_CELLS = 100_000
BUDGET = 0.6
TEMPER = 0.7
ROUNDS = 50
TOLERANCE = 1e-6
_DIMS = ("source", "lang", "topic")


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, source, lang, topic, text): strings, null where the table lacks the column."""
    part = lambda c: (F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")).alias(c)
    return docs.select("doc_id", *map(part, _DIMS), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _teller(docs: DataFrame) -> Callable[[pa.RecordBatch], tuple[pa.Array, np.ndarray]]:
    """What gives the topics and words of a slice (lang, topic, text): topics learned from all texts, if the table has none."""
    given = "topic" in docs.columns
    known = None if given else topics.learn(_texts(docs))

    def tell(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
        words = split(*text_buffer(batch.column("text")), NOT_SPACE)
        count = np.diff(words.offsets)
        if given:
            return batch.column("topic"), count
        found = known(topics.features(words), batch.column("lang").to_pylist())
        return pa.array(["empty" if k < 0 else f"topic-{k}" for k in found.tolist()], pa.string()), count

    return tell


def measure(docs: DataFrame, tell: Callable | None = None) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens) of every row; a missing source or language is null."""
    id_type, tell = docs.schema["doc_id"].dataType.simpleString(), tell or _teller(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            topic, words = tell(batch)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "source", "lang")), topic, pa.array(words, pa.int64())], names=["doc_id", "source", "lang", "topic", "n_tokens"])

    return _texts(docs).mapInArrow(run, f"doc_id {id_type}, source string, lang string, topic string, n_tokens long")


def tempered(shares: dict, temper: float) -> dict:
    raised = {k: v**temper for k, v in shares.items() if v > 0}
    return {k: v / sum(raised.values()) for k, v in raised.items()}


def fit(mass: np.ndarray, members: list[np.ndarray], targets: list[np.ndarray], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> np.ndarray:
    """Rake cell masses: members give each cell's value along each dimension, targets the values' totals."""
    mass = mass.astype(float).copy()
    for _ in range(rounds):
        worst = 0.0
        for member, target in zip(members, targets):
            now = np.bincount(member, mass, len(target))
            worst = max(worst, float(np.abs(now - target).max(initial=0)))
            mass *= np.divide(target, now, out=np.zeros_like(target), where=now > 0)[member]
        if worst <= tolerance * max(mass.sum(), 1):
            break
    return mass


def calibrate(tokens: np.ndarray, weight: np.ndarray, budget: float) -> float:
    """The factor at which tokens times min(1, factor * weight) add up to the budget, or to all if that is less."""
    some = (tokens > 0) & (weight > 0)
    tokens, weight = tokens[some], weight[some]
    order = np.argsort(-weight)
    tokens, weight = tokens[order], weight[order]
    left = budget - np.concatenate([[0], np.cumsum(tokens)])
    rest = np.concatenate([np.cumsum((tokens * weight)[::-1])[::-1], [0]])
    for k in range(len(tokens)):  # the k largest weights are taken whole
        factor = left[k] / rest[k]
        if factor * weight[k] <= 1:
            return max(factor, 0.0)
    return 1 / weight[-1] if len(weight) else 1.0


def _targets(marginals: dict[str, dict], given: dict[str, dict] | None, temper: float) -> dict[str, dict]:
    out = {}
    for d, tokens in marginals.items():
        total = sum(tokens.values())
        if not total:
            out[d] = tokens
            continue
        wanted = (given or {}).get(d) or tempered({k: v / total for k, v in tokens.items()}, temper)
        wanted = {k: wanted.get(k, 0.0) for k, v in tokens.items() if v > 0}
        scale = sum(wanted.values())
        out[d] = {k: total * v / scale for k, v in wanted.items()} if scale else tokens
    return out


def rake(measured: DataFrame, *, targets: dict[str, dict] | None = None, temper: float = TEMPER, budget: float = BUDGET, rounds: int = ROUNDS, driver_cells: int = DRIVER_CELLS) -> tuple[DataFrame, bool]:
    """(source, lang, topic, weight, probability) of each cell, and whether the table is small enough to broadcast."""
    spark = measured.sparkSession
    cells = materialise(measured.groupBy(*_DIMS).agg(F.sum("n_tokens").cast("double").alias("tokens")), "mixing-cells")
    schema = "source string, lang string, topic string, weight double, probability double"
    if cells.limit(driver_cells + 1).count() <= driver_cells:
        rows = sorted(cells.collect(), key=lambda r: tuple((r[d] is not None, r[d] or "") for d in _DIMS))
        if not rows:
            return spark.createDataFrame([], schema), True
        tokens = np.array([r["tokens"] for r in rows])
        marginals: dict[str, dict] = {d: {} for d in _DIMS}
        for r in rows:
            for d in _DIMS:
                marginals[d][r[d]] = marginals[d].get(r[d], 0.0) + r["tokens"]
        members, totals = [], []
        for d, wanted in _targets(marginals, targets, temper).items():
            number = {v: i for i, v in enumerate(marginals[d])}
            members.append(np.array([number[r[d]] for r in rows]))
            totals.append(np.array([wanted.get(v, 0.0) for v in number]))
        raked = fit(tokens, members, totals, rounds)
        weight = np.divide(raked, tokens, out=np.zeros(len(tokens)), where=tokens > 0)
        weight[tokens == 0] = weight.max(initial=0) or 1.0
        factor = calibrate(tokens, weight, budget * tokens.sum())
        # without any token there is nothing to weigh: all such documents are taken
        probability = np.minimum(1, factor * weight) if tokens.sum() else np.ones(len(rows))
        return spark.createDataFrame([(*(r[d] for d in _DIMS), float(w), float(p)) for r, w, p in zip(rows, weight, probability)], schema), True
    return _rake_table(cells, targets, temper, budget, rounds), False


def _rake_table(cells: DataFrame, targets: dict[str, dict] | None, temper: float, budget: float, rounds: int) -> DataFrame:
    """As above, for more cells than the driver takes: each step joins the cells with the totals along a dimension."""
    spark = cells.sparkSession
    total = cells.agg(F.sum("tokens")).first()[0] or 0.0
    if not total:
        return cells.select(*_DIMS, F.lit(1.0).alias("weight"), F.lit(1.0).alias("probability"))
    state = cells.withColumn("mass", F.col("tokens"))
    wanted = {}
    for d in _DIMS:
        sums = cells.groupBy(F.col(d).alias("_v")).agg(F.sum("tokens").alias("_t"))
        even = sums.select("_v", F.pow(F.col("_t"), F.lit(temper)).alias("_w"))
        if targets and targets.get(d):
            given = spark.createDataFrame([(k, float(v)) for k, v in targets[d].items()], "_k string, _w double")
            chosen = sums.join(given, F.col("_v").eqNullSafe(F.col("_k")), "left").select("_v", F.when(F.col("_t") > 0, F.coalesce("_w", F.lit(0.0))).otherwise(0.0).alias("_w"))
            # targets of which none occurs: the dimension keeps what it has
            even = chosen if chosen.agg(F.sum("_w")).first()[0] else sums.select("_v", F.col("_t").alias("_w"))
        sums = even
        scale = sums.agg(F.sum("_w")).first()[0]
        wanted[d] = materialise(sums.select("_v", (F.col("_w") / scale * total).alias("_goal")), "mixing-target")
    for _ in range(rounds):
        worst = 0.0
        for d in _DIMS:
            now = state.groupBy(F.col(d).alias("_v2")).agg(F.sum("mass").alias("_now"))
            step = now.join(wanted[d], F.col("_v2").eqNullSafe(F.col("_v"))).select("_v", "_now", "_goal")
            step = materialise(step, "mixing-step")
            worst = max(worst, step.agg(F.max(F.abs(F.col("_now") - F.col("_goal")))).first()[0] or 0.0)
            ratio = F.when(F.col("_now") > 0, F.col("_goal") / F.col("_now")).otherwise(0.0)
            state = state.join(step, F.col(d).eqNullSafe(F.col("_v"))).select(*_DIMS, "tokens", (F.col("mass") * ratio).alias("mass"))
        state = materialise(state, "mixing-state")
        if worst <= TOLERANCE * total:
            break
    weighed = materialise(state.withColumn("weight", F.when(F.col("tokens") > 0, F.col("mass") / F.col("tokens"))), "mixing-weights")
    some = weighed.where("weight > 0")
    low, high = 0.0, 1 / (some.agg(F.min("weight")).first()[0] or 1.0)
    # the factor is that of the cells that are taken whole: those found at one factor give the next, which only grows
    while True:
        whole = F.lit(low) * F.col("weight") >= 1
        taken, rest = some.agg(F.sum(F.when(whole, F.col("tokens")).otherwise(0.0)), F.sum(F.when(whole, 0.0).otherwise(F.col("mass")))).first()
        factor = min(high, (budget * total - (taken or 0.0)) / rest) if rest else high
        if factor <= low * (1 + 1e-12):
            break
        low = factor
    factor = low
    largest = weighed.agg(F.max("weight")).first()[0] or 1.0
    weight = F.coalesce("weight", F.lit(largest))
    return weighed.select(*_DIMS, weight.alias("weight"), F.least(F.lit(1.0), F.lit(factor) * weight).alias("probability"))


def place(column: Column, seed: int = 23) -> Column:
    """A hash as a number in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(column, F.lit(seed)), 11) / F.lit(float(1 << 53))


def mix(docs: DataFrame, **options) -> DataFrame:
    """Every row with its cell, weight and probability, and whether it is in the sample."""
    measured = materialise(measure(docs), "mixing-measured")
    cells, small = rake(measured, **options)
    cells = cells.select(*(F.col(d).alias(f"_{d}") for d in _DIMS), "weight", "probability")
    match = [measured[d].eqNullSafe(cells[f"_{d}"]) for d in _DIMS]
    joined = measured.join(F.broadcast(cells) if small else cells, match[0] & match[1] & match[2])
    return joined.select("doc_id", *_DIMS, "n_tokens", "weight", "probability", (place(F.col("doc_id")) < F.col("probability")).alias("sampled"))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The sampled documents with all their columns; texts are not moved where the cells can be broadcast."""
    tell = _teller(docs)
    cells, small = rake(materialise(measure(docs, tell), "mixing-measured"), **options)
    cells = cells.select(*(F.col(d).alias(f"_tessera_{d}") for d in _DIMS), F.col("probability").alias("_tessera_p"))
    value = {c: F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string") for c in ("source", "lang")}
    if "topic" in docs.columns:
        marked, value["topic"] = docs, F.col("topic").cast("string")
    else:
        marked, value["topic"] = docs.withColumn("_tessera_own", value["lang"]), F.col("_tessera_form")

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                told = tell(pa.RecordBatch.from_arrays([batch.column("_tessera_own"), batch.column("text").cast(pa.string())], names=["lang", "text"]))[0]
                yield batch.append_column("_tessera_form", told)

        marked = marked.mapInArrow(mark, T.StructType([*marked.schema.fields, T.StructField("_tessera_form", T.StringType())]))
    match = [value[d].eqNullSafe(F.col(f"_tessera_{d}")) for d in _DIMS]
    joined = marked.join(F.broadcast(cells) if small else cells, match[0] & match[1] & match[2])
    return joined.where(place(F.col("doc_id")) < F.col("_tessera_p")).select(*docs.columns)

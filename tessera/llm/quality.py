"""Quality classifier: random Fourier features over document statistics, ridge regression, isotonic calibration.

Each whole text becomes a vector of statistics (``STATISTICS``). Standardised and clipped, it is mapped to
random cosine features, which approximate a Gaussian kernel, next to the statistics themselves and a constant.
Every partition sums its own part of the normal equations; the sums of ``n_features`` rows, each of that
width, are all that is gathered, whatever the number of documents. Raw scores of a calibration part of the
training rows are counted in ``BINS`` bins, from which pool-adjacent-violators gives the calibrated score.

Training uses all labelled rows that are not held out: remainders 2 and over for the ridge, the rest for the
calibration. Labels, language, source and id are never inputs.

Defined cases: null and empty texts have statistics of zero and get a score like any other; without training
labels (or with none for calibration) the score is 0.5 (the clipped raw score); repeated rows are scored row
by row; a repeated id in the labels counts once for each label row; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod, materialise, slices, sum_rows, text_buffer
from tessera.llm.words import NOT_SPACE, mix, split

STATISTICS = (
    "log_bytes", "log_words", "word_length", "word_length_sd", "distinct_words", "top_word", "repeated_pairs",
    "upper", "digits", "non_ascii", "newlines", "spaces", "stops", "commas", "marks", "bars", "symbols",
    "brackets", "quotes", "slashes", "other_punctuation", "log_lines", "line_length", "repeated_lines",
    "sentence_length", "short_words", "punctuated_words",
)
BINS = 2048
THRESHOLD = 0.3
#: Byte classes counted for the statistics, each with its bytes.
_CLASSES = {
    "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digits": b"0123456789", "non_ascii": bytes(range(128, 256)), "newlines": b"\n",
    "spaces": b" \t\r\x0b\x0c", "stops": b".", "commas": b",;:", "marks": b"!?", "bars": b"|", "symbols": b"#$%&*@^~+=", "brackets": b"()[]{}<>",
    "quotes": b"\"'`", "slashes": b"/\\_",
}
_CLASS_OF = np.full(256, len(_CLASSES), np.int64)
for _k, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes)] = _k


def _mean(total: np.ndarray, count: np.ndarray) -> np.ndarray:
    return total / np.maximum(count, 1)


def _repeats(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row how many distinct values it has and how often its most frequent one occurs."""
    if not len(row):
        return np.zeros(n), np.zeros(n)
    key = mix(value ^ mix(row.astype(np.uint64) + np.uint64(1)))
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    most = np.zeros(n)
    np.maximum.at(most, row[first], counts)
    return np.bincount(row[first], minlength=n).astype(float), most


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``STATISTICS`` for each text of a slice."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    width = len(_CLASSES) + 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    share = np.bincount(owner * width + _CLASS_OF[raw], minlength=n * width).reshape(n, width).astype(float)
    by = {k: share[:, i] for i, k in enumerate([*_CLASSES, "other_punctuation"])}
    words = split(raw, offsets, NOT_SPACE)
    row, length = words.rows, (words.ends - words.starts).astype(float)
    count = np.diff(words.offsets).astype(float)
    mean = _mean(np.bincount(row, length, n), count)
    spread = np.sqrt(np.maximum(_mean(np.bincount(row, length * length, n), count) - mean * mean, 0))
    prints = words.fingerprints() if len(words) else np.zeros(0, np.uint64)
    distinct, top = _repeats(row, prints, n)
    inner = np.flatnonzero(row[1:] == row[:-1]) if len(row) else np.zeros(0, np.int64)
    pairs = np.bincount(row[inner], minlength=n)
    distinct_pairs, _ = _repeats(row[inner], mix(prints[inner] + np.uint64(1)) + prints[inner + 1], n) if len(inner) else (np.zeros(n), None)
    not_newline = np.ones(256, bool)
    not_newline[10] = False
    lines = split(raw, offsets, not_newline)
    line_count = np.diff(lines.offsets).astype(float)
    distinct_lines, _ = _repeats(lines.rows, lines.fingerprints() if len(lines) else np.zeros(0, np.uint64), n)
    last = words.text[words.ends - 1] if len(words) else np.zeros(0, np.uint8)
    punctuated = ~(((last >= 97) & (last <= 122)) | ((last >= 48) & (last <= 57)) | (last >= 128))
    letters = by["upper"] + by["lower"]
    columns = {
        "log_bytes": np.log1p(size),
        "log_words": np.log1p(count),
        "word_length": np.log1p(mean),
        "word_length_sd": np.log1p(spread),
        "distinct_words": _mean(distinct, count),
        "top_word": _mean(top, count),
        "repeated_pairs": 1 - _mean(distinct_pairs, np.maximum(pairs, 1)) * (pairs > 0) - (pairs == 0),
        "upper": _mean(by["upper"], letters),
        "log_lines": np.log1p(line_count),
        "line_length": np.log1p(_mean(size, line_count)),
        "repeated_lines": (1 - _mean(distinct_lines, line_count)) * (line_count > 0),
        "sentence_length": np.log1p(_mean(count, by["stops"] + by["marks"])),
        "short_words": _mean(np.bincount(row, length <= 3, n), count),
        "punctuated_words": _mean(np.bincount(row, punctuated, n), count),
    }
    # shares of rare bytes on a root scale, which tells none from few
    return np.column_stack([columns[k] if k in columns else np.sqrt(_mean(by[k], size)) for k in STATISTICS])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found = statistics(*text_buffer(batch.column("text"))).astype(np.float32)
        flat = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(STATISTICS)).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), flat], names=["doc_id", "stats"])


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, stats) of every whole text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(_measure, f"doc_id {id_type}, stats array<float>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).astype(float).reshape(len(column), len(STATISTICS))


class Map:
    """Standardised statistics, their random cosine features, a constant."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, features: int, gamma: float, seed: int):
        self.mean, self.deviation = mean, np.where(deviation > 1e-9, deviation, 1.0)
        random = np.random.default_rng(seed)
        self.directions = random.normal(0, np.sqrt(2 * gamma), (len(STATISTICS), features))
        self.phases = random.uniform(0, 2 * np.pi, features)
        self.width = features + len(STATISTICS) + 1

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.deviation, -5, 5)
        cosines = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([cosines, 0.1 * z, np.ones((len(z), 1))])


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((1, 2 * len(STATISTICS) + 1))
    for batch in batches:
        x = _matrix(batch.column("stats"))
        total += np.concatenate([x.sum(axis=0), (x * x).sum(axis=0), [len(x)]])
    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["i", "v"])


class Model:
    def __init__(self, features: Map | None, weights: np.ndarray | None, knots: np.ndarray, levels: np.ndarray):
        self.features, self.weights, self.knots, self.levels = features, weights, knots, levels

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.full(len(stats), 0.5) if self.features is None else np.clip(self.features(stats) @ self.weights, -0.5, 1.5)

    def score(self, stats: np.ndarray) -> np.ndarray:
        value = self.raw(stats)
        return np.interp(value, self.knots, self.levels) if len(self.knots) else np.clip(value, 0, 1)


def isotonic(total: np.ndarray, ones: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (mean place, level) of each block of the rising fit to ones/total."""
    blocks: list[list[float]] = []  # weight, ones, weighted place
    for n, y, x in zip(total, ones, at):
        blocks.append([n, y, n * x])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n2, y2, x2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n2, blocks[-1][1] + y2, blocks[-1][2] + x2]
    knots = np.array([x / n for n, _, x in blocks])
    levels = np.array([(y + 0.5) / (n + 1) for n, y, _ in blocks])
    return knots, np.maximum.accumulate(levels) if len(levels) else levels


def train(labelled: DataFrame, *, features: int = 256, gamma: float | None = None, ridge: float = 1e-3, seed: int = 17) -> Model:
    """Fit on rows (doc_id, stats, quality), a part for the ridge and a part for the calibration."""
    part = crc_mod(F.col("doc_id"), 5)
    fit, rest = labelled.where(part >= 2), labelled.where(part < 2)
    moments = sum_rows(fit.select("stats"), _moments, 1)
    k = len(STATISTICS)
    if not moments.size or moments[0, -1] == 0:
        return Model(None, None, np.zeros(0), np.zeros(0))
    n = moments[0, -1]
    mean = moments[0, :k] / n
    space = Map(mean, np.sqrt(np.maximum(moments[0, k : 2 * k] / n - mean * mean, 0)), features, gamma or 0.5 / k, seed)

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((space.width, space.width + 1))
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                some = batch.slice(at, 2000)
                z = space(_matrix(some.column("stats")))
                sums += z.T @ np.column_stack([z, np.asarray(some.column("quality")).astype(float)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(space.width), pa.int32()), pa.array([row.tobytes() for row in sums], pa.binary())], names=["i", "v"])

    sums = sum_rows(fit.select("stats", "quality"), normal, space.width)
    weights = np.linalg.solve(sums[:, :-1] + ridge * n * np.eye(space.width), sums[:, -1])
    raw = Model(space, weights, np.zeros(0), np.zeros(0))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.minimum(((raw.raw(_matrix(batch.column("stats"))) + 0.5) / 2 * BINS).astype(np.int32), BINS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(place), batch.column("quality")], names=["bin", "quality"])

    rows = rest.select("stats", F.col("quality").cast("int").alias("quality")).mapInArrow(values, "bin int, quality int").groupBy("bin").agg(F.count("*").alias("n"), F.sum("quality").alias("ones")).collect()
    rows.sort()
    if not rows:
        return raw
    bins, total, ones = (np.array(x, float) for x in zip(*rows))
    return Model(space, weights, *isotonic(total, ones, (bins + 0.5) / BINS * 2 - 0.5))


def held_out() -> Column:
    return crc_mod(F.col("doc_id"), 5) == 0


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Train on the labelled rows that are not held out and score all rows: (doc_id, held_out, score, predicted)."""
    stats = materialise(measure(docs), "quality-statistics")
    marks = labels.where(F.col("quality").isNotNull()).select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("quality"))
    labelled = materialise(stats.join(marks, stats["doc_id"] == marks["_id"]).where(~held_out()).select("doc_id", "stats", "quality"), "quality-labelled")
    model = train(labelled, **options)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                some = batch.slice(at, 2000)
                value = model.score(_matrix(some.column("stats")))
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(value)], names=["doc_id", "score"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    scored = stats.mapInArrow(score, f"doc_id {id_type}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

"""Topics of texts: spherical k-means over hashed words, with what is common to a language taken out.

A text's words are counted in ``WIDTH`` buckets of their hash; square roots of the counts, scaled to length one and kept
in a byte each, are its features. Less the mean of its language's texts they are compared with the centroids of
``TOPICS`` topics; the nearest by angle is its topic. Means and centroids are learned from all texts: every pass adds
up sums of fixed size over the partitions, and the features, not the texts, are read again.

Defined cases: texts without words have no topic (-1) and teach nothing; a language beyond the ``LANGUAGES`` most
frequent, and none, takes the mean of all texts; ties go to the lower topic; without any words nothing is learned and
all texts with words, seen later, have topic 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import FAN, materialise, slices, sum_rows, text_buffer
from tessera.llm.words import NOT_SPACE, Words, split

WIDTH = 128
TOPICS = 8
ROUNDS = 4
LANGUAGES = 256


def features(words: Words) -> np.ndarray:
    """A row of bytes for each text; zeros for texts without words."""
    n = len(words.offsets) - 1
    bucket = (words.fingerprints() >> np.uint64(57)).astype(np.int64) if len(words) else np.zeros(0, np.int64)
    root = np.sqrt(np.bincount(words.rows * WIDTH + bucket, minlength=n * WIDTH).reshape(n, WIDTH))
    length = np.sqrt((root * root).sum(axis=1, keepdims=True))
    return np.round(255 * root / np.maximum(length, 1e-9)).astype(np.uint8)


class Topics:
    """Means by language and centroids."""

    def __init__(self, means: dict[str, np.ndarray], mean: np.ndarray, centroids: np.ndarray):
        self.means, self.mean, self.centroids = means, mean, centroids

    def centred(self, rows: np.ndarray, langs: list[str | None]) -> np.ndarray:
        """The rows less their languages' means, of length one."""
        names = sorted({x for x in langs if x in self.means})
        table = np.vstack([self.mean, *(self.means[x] for x in names)])
        place = {x: i + 1 for i, x in enumerate(names)}
        x = rows.astype(float) - table[[place.get(v, 0) for v in langs]]
        return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)

    def __call__(self, rows: np.ndarray, langs: list[str | None]) -> np.ndarray:
        if not len(rows):
            return np.zeros(0, np.int64)
        nearest = (self.centred(rows, langs) @ self.centroids.T).argmax(axis=1)
        return np.where(rows.any(axis=1), nearest, -1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, WIDTH)


def _add_language(group: pa.Table) -> pa.Table:
    """The sum of a language's vectors, whose last number counts its texts."""
    total = sum(np.frombuffer(v.as_buffer()) for v in group.column("v"))
    return pa.table({"lang": group.column("lang").slice(0, 1), "v": pa.array([total.tobytes()], pa.binary()), "n": pa.array([total[-1]])})


def learn(docs: DataFrame, *, topics: int = TOPICS, rounds: int = ROUNDS, languages: int = LANGUAGES, seed: int = 31) -> Topics:
    """Means and centroids of the texts of rows (lang, text)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = features(split(*text_buffer(batch.column("text")), NOT_SPACE))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([r.tobytes() for r in rows], pa.binary())], names=["lang", "f"])

    def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str | None, np.ndarray] = {}
        for batch in batches:
            rows, code = _matrix(batch.column("f")), batch.column("lang").dictionary_encode()
            taught = rows.any(axis=1)
            index = np.asarray(code.indices.fill_null(len(code.dictionary)))
            for k, name in enumerate([*code.dictionary.to_pylist(), None]):
                mine = rows[(index == k) & taught].astype(float)
                if len(mine):
                    found[name] = found.get(name, 0) + np.append(mine.sum(axis=0), len(mine))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([*found], pa.string()), pa.array([v.tobytes() for v in found.values()], pa.binary())], names=["lang", "v"])

    stored = materialise(docs.select("lang", "text").mapInArrow(measure, "lang string, f binary"), "topics-features")
    parts = stored.mapInArrow(by_language, "lang string, v binary").withColumn("p", F.spark_partition_id() % FAN)
    kind = "lang string, v binary, n double"
    sums = materialise(parts.groupBy("lang", "p").applyInArrow(_add_language, kind).groupBy("lang").applyInArrow(_add_language, kind), "topics-languages")
    total = sum_rows(sums.select("v"), _total, 1)
    total = total[0] if total.size else np.zeros(WIDTH + 1)
    top = sums.where("lang is not null").orderBy(F.desc("n"), "lang").limit(languages).collect()
    means = {r["lang"]: (v := np.frombuffer(bytes(r["v"])))[:-1] / v[-1] for r in top}
    found = Topics(means, total[:-1] / max(total[-1], 1), np.random.default_rng(seed).normal(size=(topics, WIDTH)))
    for _ in range(rounds if total[-1] else 0):
        state = Topics(found.means, found.mean, found.centroids)

        def gather(batches: Iterator[pa.RecordBatch], state: Topics = state) -> Iterator[pa.RecordBatch]:
            out = np.zeros((topics, WIDTH))
            for batch in batches:
                rows, langs = _matrix(batch.column("f")), batch.column("lang").to_pylist()
                place = state(rows, langs)
                for k in np.unique(place[place >= 0]).tolist():
                    out[k] += state.centred(rows[place == k], [x for x, p in zip(langs, place) if p == k]).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(topics), pa.int32()), pa.array([r.tobytes() for r in out], pa.binary())], names=["i", "v"])

        moved = sum_rows(stored, gather, topics)
        length = np.sqrt((moved * moved).sum(axis=1, keepdims=True))
        # a topic that no text is nearest to keeps its direction
        found.centroids = np.where(length > 1e-9, moved / np.maximum(length, 1e-9), state.centroids)
    return found


def _total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(WIDTH + 1)
    for batch in batches:
        for v in batch.column("v"):
            total = total + np.frombuffer(v.as_buffer())
    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["i", "v"])

"""Language identification by nearest centroid.

Texts become TF-IDF vectors of hashed letter n-grams (one to three letters), of
length one. Each language has several centroids, found by spherical k-means over a
sample of its labelled rows, and a text gets the language of the centroid with the
largest cosine. A text far from all centroids is rejected: its cosine is below
``REJECT`` times the smallest cosine that the language's own sample has.

The sample is bounded: ``SAMPLE`` rows of each language, those with the least hash
of doc_id. Only frequencies, centroids and the rejection distance come from it, and
every text is read whole.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and
rejected; without any labelled rows all texts are; rows without a language or a
doc_id teach nothing; ties go to the language first in alphabetical order; repeated
rows teach once (of one doc_id and language the least text) and return as often as they
come; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import extended, stage, training_row
from .ngrams import (
    DIMENSIONS,
    gram_counts,
    inverse_frequency,
    letter_runs,
    normalised,
    packed,
    unpacked,
    weighted,
)

SIZES = (1, 2, 3)
SAMPLE = 400
PARTS = 16
CLUSTERS = 4
ROUNDS = 12
REJECT = 0.5
ROWS = 256
UNKNOWN = "und"


def counts_of(text: str | None, dimensions: int = DIMENSIONS) -> np.ndarray:
    runs = letter_runs(text or "")
    if len(runs) < 2:
        return np.zeros(dimensions, dtype=np.int64)
    return gram_counts(runs, SIZES, dimensions)


def centroids(vectors: np.ndarray, clusters: int, seed: int = 0) -> np.ndarray:
    """Spherical k-means; the first centres are spread out by distance."""
    random = np.random.default_rng(seed)
    centres = vectors[[random.integers(len(vectors))]]
    while len(centres) < min(clusters, len(vectors)):
        nearest = (vectors @ centres.T).max(axis=1)
        centres = np.vstack([centres, vectors[nearest.argmin()]])
    for _ in range(ROUNDS):
        owner = (vectors @ centres.T).argmax(axis=1)
        sums = np.stack([vectors[owner == k].sum(axis=0) for k in range(len(centres))])
        alive = np.einsum("ij,ij->i", sums, sums) > 0
        centres = np.where(alive[:, None], normalised(sums), centres)
    return centres


class Model:
    """Weights, centroids, the language of each and its rejection cosine."""

    def __init__(self, samples: dict[str, list[bytes]], clusters: int, dimensions: int):
        self.dimensions = dimensions
        self.languages: list[str] = []
        self.centres = np.zeros((0, dimensions), dtype=np.float32)
        self.weights = np.ones(dimensions, dtype=np.float32)
        self.least = np.zeros(0)
        if not samples:
            return
        counts = {name: unpacked(samples[name], dimensions) for name in sorted(samples)}
        self.weights = inverse_frequency(np.concatenate(list(counts.values())))
        centres, least = [], []
        for name, rows in counts.items():
            vectors = weighted(rows, self.weights)
            own = centroids(vectors, clusters)
            centres.append(own)
            self.languages += [name] * len(own)
            least += [float((vectors @ own.T).max(axis=1).min())] * len(own)
        self.centres, self.least = np.concatenate(centres), np.array(least) * REJECT

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        counts = np.stack([counts_of(text, self.dimensions) for text in texts])
        known = counts.any(axis=1)
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        cosine = weighted(counts.astype(np.float32), self.weights) @ self.centres.T
        best = cosine.argmax(axis=1)
        score = np.where(known, cosine[np.arange(len(texts)), best].clip(0, 1), 0.0)
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, known)]
        return names, score.tolist(), (~known | (score < self.least[best])).tolist()


def least(rows: DataFrame, keys: list[str], many: int) -> DataFrame:
    """The rows of least hash of each group."""
    order = Window.partitionBy(*keys).orderBy("_hash", "doc_id")
    return rows.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= many).drop("_place")


def train(
    docs: DataFrame,
    teaches: Column | None = None,
    sample: int = SAMPLE,
    clusters: int = CLUSTERS,
    dimensions: int = DIMENSIONS,
) -> Model:
    """Learn from at most ``sample`` rows of each language."""
    rows = docs.where("lang is not null and text is not null and doc_id is not null")
    rows = rows.where(training_row() if teaches is None else teaches).select("doc_id", "lang")
    hashed = rows.distinct().withColumn("_hash", F.xxhash64("doc_id"))
    # by parts first, so that a frequent language is no single task
    parts = least(hashed.withColumn("_part", F.pmod("_hash", F.lit(PARTS))), ["lang", "_part"], sample)
    chosen = least(parts, ["lang"], sample).select("doc_id", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [packed(counts_of(text, dimensions)) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(data, pa.binary())], names=["lang", "counts"]
            )

    samples: dict[str, list[bytes]] = {}
    # written first: Spark then knows its size, and broadcasts it only if it is small
    chosen = stage(chosen, "sample")
    own = (
        docs.select("doc_id", "lang", "text")
        .join(chosen, ["doc_id", "lang"])
        .groupBy("doc_id", "lang")
        .agg(F.min("text").alias("text"))
    )
    found = own.select("lang", "text").mapInArrow(count, "lang string, counts binary").collect()
    for lang, data in sorted((row.lang, bytes(row.counts)) for row in found):
        if data:
            samples.setdefault(lang, []).append(data)
    return Model(samples, clusters, dimensions)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` with lang_pred, score and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = ("lang_pred", "score", "rejected")
    kept = [name for name in docs.columns if name not in added]
    place = kept.index("text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                names, scores, rejected = shared.value.predict(part.column(place).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array(names, pa.string()),
                        pa.array(scores, pa.float64()),
                        pa.array(rejected, pa.bool_()),
                    ],
                    names=[*part.schema.names, *added],
                )

    frame = docs.select(*kept)
    return frame.mapInArrow(
        predict, extended(frame, "lang_pred string, score double, rejected boolean")
    )

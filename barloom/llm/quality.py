"""Quality score by the votes of nearest labelled neighbours.

Texts become TF-IDF vectors of hashed character trigrams, case and symbols
included; the leading singular vectors of a labelled sample turn them into
latent-semantic vectors. The sample's vectors and labels are broadcast, exact
cosine products with all of them are computed for blocks of documents, and the
nearest neighbours vote with a weight that rises with their similarity.

The sample is bounded: the ``SAMPLE`` labelled rows with the least hash of doc_id,
with ``RANK`` dimensions each, so the broadcast has a fixed size (1.2 MB). Every
document is scored on its whole text.

Defined cases: a null or empty text, and a text like no labelled one, gets the mean
label; without labelled rows the score is 0.5; null labels teach nothing, and a
document with several labels counts with their mean; of repeated labelled rows the
least text teaches; all neighbours as near as the last one vote; repeated rows return
as often as they come; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import extended, training_row
from .ngrams import (
    DIMENSIONS,
    code_points,
    gram_counts,
    inverse_frequency,
    normalised,
    packed,
    unpacked,
    weighted,
)

SIZES = (3,)
SAMPLE = 4096
RANK = 64
NEIGHBOURS = 25
POWER = 4
ROWS = 256


def counts_of(text: str | None, dimensions: int = DIMENSIONS) -> np.ndarray:
    return gram_counts(code_points(f"\n{text}\n" if text else ""), SIZES, dimensions)


def leading_vectors(matrix: np.ndarray, rank: int, seed: int = 0) -> np.ndarray:
    """Right singular vectors by randomised subspace iteration."""
    random = np.random.default_rng(seed)
    width = min(rank + 16, *matrix.shape)
    basis = random.standard_normal((matrix.shape[1], width)).astype(np.float32)
    for _ in range(4):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    return (basis @ right.T)[:, : min(rank, width)]


class Model:
    """Weights, the projection, and the labelled latent vectors."""

    def __init__(self, rows: list[bytes], labels: list[float], dimensions: int, rank: int):
        self.dimensions = dimensions
        self.labels = np.array(labels, dtype=np.float32)
        self.prior = float(self.labels.mean()) if rows else 0.5
        if not rows:
            return
        counts = unpacked(rows, dimensions)
        self.weights = inverse_frequency(counts)
        vectors = weighted(counts, self.weights)
        self.projection = leading_vectors(vectors, rank)
        self.points = normalised(vectors @ self.projection)

    def score(self, texts: list[str | None], neighbours: int = NEIGHBOURS) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), self.prior)
        counts = np.stack([counts_of(text, self.dimensions) for text in texts])
        latent = weighted(counts.astype(np.float32), self.weights) @ self.projection
        cosine = normalised(latent) @ self.points.T
        many = min(neighbours, cosine.shape[1])
        last = np.partition(cosine, -many, axis=1)[:, -many, None]
        weight = np.where(cosine >= last, cosine, 0).clip(0) ** POWER
        total = weight.sum(axis=1)
        votes = weight @ self.labels
        score = np.full(len(texts), self.prior)
        np.divide(votes, total, out=score, where=total > 1e-9)
        return score.clip(0, 1)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    teaches: Column | None = None,
    sample: int = SAMPLE,
    dimensions: int = DIMENSIONS,
    rank: int = RANK,
) -> Model:
    """Learn from at most ``sample`` labelled rows."""
    known = labels.select("doc_id", F.col(label).cast("double").alias("_label"))
    known = known.where("doc_id is not null and _label is not null")
    known = known.where(training_row() if teaches is None else teaches)
    present = docs.where("doc_id is not null").select("doc_id")
    chosen = (
        known.groupBy("doc_id")
        .agg(F.avg("_label").alias("_label"))
        .join(present, "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [packed(counts_of(text, dimensions)) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(data, pa.binary())],
                names=["doc_id", "_label", "counts"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    own = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # ``sample`` rows at most
        .groupBy("doc_id")
        .agg(F.min("_label").alias("_label"), F.min("text").alias("text"))
    )
    found = (
        own.select("doc_id", "_label", "text")
        .mapInArrow(count, f"doc_id {kind}, _label double, counts binary")
        .collect()
    )
    rows = {row.doc_id: (row["_label"], bytes(row.counts)) for row in sorted(found)}
    return Model(
        [data for _, data in rows.values()], [x for x, _ in rows.values()], dimensions, rank
    )


def score(docs: DataFrame, model: Model, cut: float = 0.7) -> DataFrame:
    """The columns of ``docs`` with score and predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = ("score", "predicted")
    kept = [name for name in docs.columns if name not in added]
    place = kept.index("text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                scores = shared.value.score(part.column(place).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array(scores, pa.float64()),
                        pa.array((scores >= cut).astype(np.int32), pa.int32()),
                    ],
                    names=[*part.schema.names, *added],
                )

    frame = docs.select(*kept)
    return frame.mapInArrow(predict, extended(frame, "score double, predicted int"))

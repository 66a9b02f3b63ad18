"""Quality by nearest neighbours: labelled latent-semantic vectors, exact cosine products, weighted votes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import id_remainder, slices, stable_sample, texts

#: Labelled documents (at most) that become vectors: the bound of what is broadcast, 1 MB at 64 dimensions.
LABELLED_ROWS = 4000
WORD_DIMENSIONS = 768
SHAPE_DIMENSIONS = 192
MEASURES = 32
LATENT = 64
NEIGHBOURS = 25
#: Weight of a neighbour: its cosine to this power.
SHARPNESS = 8
CACHE_WORDS = 400_000
FOLD = 3
_WIDTH = WORD_DIMENSIONS + SHAPE_DIMENSIONS + MEASURES


def shape(word: bytes) -> bytes:
    """Letters as a, capitals as A, digits as 9, bytes beyond ASCII as a; runs joined; punctuation stays."""
    coarse = re.sub(rb"[a-z\x80-\xff]+", b"a", word[:64])
    coarse = re.sub(rb"[A-Z]+", b"A", coarse)
    coarse = re.sub(rb"[0-9]+", b"9", coarse)
    return re.sub(rb"([^aA9])\1+", rb"\1\1", coarse)


class Featurizer:
    """Counts of hashed words and word shapes, and binned measures of the whole text."""

    def __init__(self):
        self.cells: dict[bytes, tuple[int, int]] = {}

    def cell(self, word: bytes) -> tuple[int, int]:
        if len(self.cells) >= CACHE_WORDS:
            self.cells.clear()
        place = xxhash.xxh64_intdigest(word.lower()) % WORD_DIMENSIONS
        self.cells[word] = found = place, WORD_DIMENSIONS + xxhash.xxh64_intdigest(shape(word)) % SHAPE_DIMENSIONS
        return found

    def vector(self, text: bytes) -> np.ndarray:
        words = text.split()
        out = np.zeros(_WIDTH, np.float32)
        n = len(words)
        if n:
            get, cell = self.cells.get, self.cell
            pairs = np.array([get(w) or cell(w) for w in words], np.int64)
            counts = np.bincount(pairs.ravel(), minlength=_WIDTH)
            out[:] = np.log1p(counts)
            out[:WORD_DIMENSIONS] /= max(float(np.linalg.norm(out[:WORD_DIMENSIONS])), 1e-9)
            # The share of each shape, not its number, so that long and short texts are alike.
            out[WORD_DIMENSIONS:] = np.sqrt(counts[WORD_DIMENSIONS:] / n)
        m = out[WORD_DIMENSIONS + SHAPE_DIMENSIONS :]
        repeats = 1 - len(set(words)) / n if n else 0.0
        chars = sum(map(len, words)) / n if n else 0.0
        marks = (len(text) - len(text.translate(None, b"#*$%&|<>!"))) / max(n, 1)
        for at, value, step, bins in ((0, n, None, 10), (10, repeats, 0.125, 8), (18, chars, 2.0, 6), (24, marks, 0.25, 8)):
            place = min(bins - 1, int(np.log2(n + 1)) // 1 if step is None else int(value / step))
            m[at + place] = 0.5
        return out


@dataclass
class Model:
    axes: np.ndarray  # feature to latent dimension
    vectors: np.ndarray  # labelled documents, of length 1
    labels: np.ndarray
    prior: float


def featurized(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Featurizer()
        for batch in slices(batches):
            vectors = [made.vector(x).tolist() for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "label": batch.column("label"), "vector": pa.array(vectors, pa.list_(pa.float32()))}
            )

    return texts(docs, "label").mapInArrow(run, "doc_id long, label double, vector array<float>")


def train(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Model:
    """Latent axes and labelled vectors from at most ``rows`` labelled documents outside the held-out fold.

    A document with several labels counts with their mean; null labels and labels without document are left out.
    """
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.avg("quality").alias("label"))
    in_training = docs.where(F.coalesce(id_remainder(FOLD) != 1, F.lit(False))).select("doc_id", "text")
    chosen = stable_sample(known.join(in_training.select("doc_id").distinct(), "doc_id"), rows, "neighbours")
    found = featurized(in_training.join(chosen, "doc_id")).dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    if not found:
        return Model(np.zeros((_WIDTH, LATENT), np.float32), np.zeros((0, LATENT), np.float32), np.zeros(0, np.float32), 0.5)
    matrix = np.array([r["vector"] for r in found], np.float32)
    labels_of = np.array([r["label"] for r in found], np.float32)
    # Latent semantic analysis: the leading right singular vectors, from the small square of the matrix.
    _, axes = np.linalg.eigh((matrix.T @ matrix).astype(np.float64))
    axes = np.ascontiguousarray(axes[:, ::-1][:, :LATENT], np.float32)
    return Model(axes, unit(matrix @ axes), labels_of, float(labels_of.mean()))


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


def vote(vectors: np.ndarray, model: Model) -> np.ndarray:
    """Votes for label 1 among the nearest labelled vectors of each row: one exact block of cosine products."""
    if not len(model.labels):
        return np.full(len(vectors), model.prior)
    cosine = vectors @ model.vectors.T
    k = min(NEIGHBOURS, cosine.shape[1])
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** SHARPNESS
    total = weight.sum(axis=1)
    return np.where(total > 1e-12, (weight * model.labels[near]).sum(axis=1) / np.maximum(total, 1e-12), model.prior)


def score(docs: DataFrame, model: Model, block: int = 512) -> DataFrame:
    """One row per document: its fold, the weighted vote for label 1, and the label at 0.5.

    A null or empty text has only the measures of an empty text as its vector and is voted on like any other. Without
    any labelled rows each score is 0.5. Rows are scored alone; repeated rows get equal scores; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Featurizer()
        for batch in slices(batches):
            data = batch.column("text").to_pylist()
            scores = [np.zeros(0)]
            for i in range(0, len(data), block):
                rows = np.array([made.vector(x) for x in data[i : i + block]], np.float32)
                scores.append(vote(unit(rows @ model.axes), model))
            values = np.clip(np.round(np.concatenate(scores), 6), 0, 1)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "held_out": batch.column("held_out"),
                    "score": pa.array(values, pa.float64()),
                    "predicted": pa.array((values >= 0.5).astype(np.int32), pa.int32()),
                }
            )

    held_out = F.coalesce(id_remainder(FOLD) == 1, F.lit(False)).alias("held_out")
    return texts(docs.select("doc_id", "text", held_out), "held_out").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")

"""Quality of documents: random-indexing word vectors, pooled, under a small network.

* Tokens are runs of letters and digits, or of symbols, case kept.  Each hashes to one of
  ``BUCKETS`` vectors and to a sparse random index vector of +1 and -1.
* The vector of a bucket is the sum of the index vectors of all its neighbours, up to ``REACH``
  tokens away, over *all* documents.  The table has a fixed size, so it goes to every task.
* A document is the mean and the spread of its tokens' unit vectors, and how often index vectors
  repeat 1 to REACH tokens later.
* A network with one hidden layer learns from a bounded sample of labelled rows
  (``MAX_TRAINING_ROWS``); a fifth of the sample sets the temperature that makes its outputs
  probabilities.

Defined results: a null or empty text has a pooled vector of zeros and gets the score of that
vector; labels that are null teach nothing; without labels of both kinds every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tailfold.llm.fixed_tables import parts_of, table_sum
from tailfold.llm.sizes import checked
from tailfold.llm.words import Slice, byte_classes, slices
from tailfold.session import stage

BUCKETS = 1 << 14
WIDTH = 48
NONZERO = 2
REACH = 2
HIDDEN = 32
MAX_TRAINING_ROWS = 20_000
EPOCHS = 60
THRESHOLD = 0.3
# Text held as vectors at a time: a token has WIDTH numbers, in double precision while they are summed,
# which is some hundred times its bytes.
SLICE_BYTES = 1 << 17
FEATURES = 2 * WIDTH + REACH
_TOKENS = byte_classes(symbols_apart=True)


def _codes(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every token, and the places and signs of its index vector."""
    h = part.hashes()
    bucket = (h % np.uint64(BUCKETS)).astype(np.int64)
    places, signs = [], []
    for k in range(NONZERO):
        piece = h >> np.uint64(20 + 12 * k)
        places.append(((piece >> np.uint64(1)) % np.uint64(WIDTH)).astype(np.int64))
        signs.append(1 - 2 * (piece & np.uint64(1)).astype(np.int64))
    return bucket, np.array(places), np.array(signs)


def _contexts(texts: DataFrame) -> DataFrame:
    """Per task, the sums of its tokens' contexts as parts of the table."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(BUCKETS * WIDTH, np.int32)
        for batch in source:
            for part in slices(batch.column(0), _TOKENS, SLICE_BYTES):
                bucket, places, signs = _codes(part)
                row = np.repeat(np.arange(part.rows), np.diff(part.bounds))
                for step in range(1, REACH + 1):
                    same = row[step:] == row[:-step]
                    left, right = np.flatnonzero(same), np.flatnonzero(same) + step
                    for a, b in ((left, right), (right, left)):
                        for k in range(NONZERO):
                            np.add.at(table, bucket[a] * WIDTH + places[k][b],
                                      signs[k][b].astype(np.int32))
        numbers, data = parts_of(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(data, pa.binary())], ["part", "data"])

    return texts.mapInArrow(batches, "part int, data binary")


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """BUCKETS x WIDTH unit vectors gathered from all documents."""
    contexts = _contexts(docs.select(F.col(f"`{text_col}`")))
    table = table_sum(contexts, BUCKETS * WIDTH).reshape(BUCKETS, WIDTH).astype(np.float64)
    lengths = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.where(lengths > 0, lengths, 1)).astype(np.float32)


def pooled(docs: DataFrame, vectors: np.ndarray, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``id, features``: mean and spread of the vectors of all tokens of every document."""
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in slices(batch.column(1), _TOKENS, SLICE_BYTES):
                h = part.hashes()
                bucket = (h % np.uint64(BUCKETS)).astype(np.int64)
                counts = np.diff(part.bounds)
                full = np.flatnonzero(counts)
                out = np.zeros((part.rows, FEATURES), np.float32)
                if len(full):
                    own, n = vectors[bucket], counts[full, None]
                    mean = np.add.reduceat(own, part.bounds[full], axis=0, dtype=np.float64) / n
                    own *= own
                    square = np.add.reduceat(own, part.bounds[full], axis=0, dtype=np.float64) / n
                    out[full, :WIDTH] = mean
                    out[full, WIDTH:2 * WIDTH] = np.sqrt(np.maximum(square - mean * mean, 0))
                    row = np.repeat(np.arange(part.rows), counts)
                    for step in range(1, REACH + 1):
                        again = (h[step:] == h[:-step]) & (row[step:] == row[:-step])
                        out[:, 2 * WIDTH + step - 1] = np.bincount(
                            row[step:][again], minlength=part.rows) / np.maximum(counts, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, part.rows),
                     pa.array([row.tobytes() for row in out], pa.binary())], ["id", "features"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`")).mapInArrow(
        batches, f"id {kind}, features binary")


@dataclass
class Network:
    """Scores features; ``weights`` is None if there was nothing to learn from."""

    centre: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, ...] | None
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(x))
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.centre) / self.scale @ w1 + b1) @ w2 + b2[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 0) -> Network:
    """Mini-batch Adam on four fifths of the rows; the temperature from the last fifth."""
    none = Network(np.zeros(FEATURES), np.ones(FEATURES), None)
    if len(set(y.tolist())) < 2:
        return none
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    apart = order[:len(x) // 5]
    order = order[len(x) // 5:]
    centre, scale = x[order].mean(axis=0), x[order].std(axis=0) + 1e-3
    z = (x - centre) / scale
    weights = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
               rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        rng.shuffle(order)
        for start in range(0, len(order), 128):
            own = order[start:start + 128]
            hidden = np.tanh(z[own] @ weights[0] + weights[1])
            p = 1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3], -60, 60)))
            error = (p - y[own]) / len(own)
            back = np.outer(error, weights[2]) * (1 - hidden * hidden)
            slopes = [z[own].T @ back + 1e-4 * weights[0], back.sum(axis=0),
                      hidden.T @ error + 1e-4 * weights[2], np.array([error.sum()])]
            step += 1
            for k, slope in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope * slope
                weights[k] -= 3e-3 * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    network = Network(centre, scale, tuple(weights))
    if len(apart):
        logits, target = network.logits(x[apart]), y[apart]

        def loss(t: float) -> float:
            p = np.clip(1 / (1 + np.exp(-np.clip(logits / t, -60, 60))), 1e-9, 1 - 1e-9)
            return -np.mean(target * np.log(p) + (1 - target) * np.log(1 - p))

        network.temperature = float(min(np.geomspace(0.25, 20, 80), key=loss))
    return network


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality") -> DataFrame:
    """One row per document: id, ``held_out``, ``score``, ``predicted``."""
    vectors = word_vectors(docs, text_col)
    features = stage(pooled(docs, vectors, id_col, text_col), "pooled")
    sample = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)
                     & ~held_out(F.col(id_col)))
        .select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
        .orderBy(F.md5(F.col("id").cast("string")), "id", "label").limit(MAX_TRAINING_ROWS))
    rows = (features.join(F.broadcast(sample), "id")
            .orderBy("id", "label", "features").limit(MAX_TRAINING_ROWS).collect())
    x = np.array([np.frombuffer(r["features"], np.float32) for r in rows],
                 np.float64).reshape(len(rows), FEATURES)
    network = fit(x, np.array([r["label"] for r in rows], np.float64))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            own = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float32)
            score = network.scores(own.reshape(-1, FEATURES).astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64()),
                 pa.array((score >= THRESHOLD).astype(np.int32))], ["id", "score", "predicted"])

    kind = features.schema["id"].dataType.simpleString()
    return features.mapInArrow(batches, f"id {kind}, score double, predicted int").select(
        F.col("id").alias(id_col),
        F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected; rows without an id are kept."""
    rejected = stage(scored(docs, labels, id_col, text_col).where("predicted = 0")
                     .select(id_col).distinct(), "rejected")
    return docs.join(checked(rejected), id_col, "left_anti").select(
        [F.col(f"`{c}`") for c in docs.columns])

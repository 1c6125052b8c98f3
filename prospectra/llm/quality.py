"""Quality scores: random-indexing word vectors, pooled per document, and a small calibrated network.

Every word belongs to one of a fixed number of rows by its hash, and every row has a sparse index vector of
-1, 0 and 1. The word vector of a row is the sum of the index vectors of all neighbours that its words have in
the whole table: whole numbers, so that the sum does not depend on the order of tasks. Tasks send one matrix
each, and matrices are added in a tree. A document is described by the mean and the spread of its words'
vectors and the step from word to word. A two-layer network learns the labels from a bounded sample of labelled
rows; a temperature fitted on rows set aside makes its outputs probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prospectra.llm.batches import slices, text_bytes
from prospectra.sources.scratch import materialize

#: Rows and length of the word vectors: 2 MB of 32-bit numbers, the size of the model whatever the corpus.
ROWS, DIMENSIONS = 1 << 14, 32
#: Neighbours on either side that make up a word's context.
REACH = 2
#: Labelled rows the network is fitted on, at most: those with the smallest hash of the id.
MAX_LABELLED = 20_000
#: Matrices added in one task of the tree.
FAN_IN = 16
#: Words of a text taken at a time.
PORTION = 1 << 17

_WORD = re.compile(rb"[a-z\x80-\xff]+|[A-Z][a-z\x80-\xff]*|[0-9]+|\n+|[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+")


class _Rows(dict):
    """Word -> row; forgets all beyond a number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 20:
            self.clear()
        row = self[word] = zlib.crc32(word) % ROWS
        return row


def _portions(text: bytes, rows: _Rows) -> Iterator[np.ndarray]:
    """Rows of the words of a text, in order; portions of very long texts end at a line or word."""
    start, step = 0, PORTION * 8
    while start < len(text):
        end = len(text)
        if end - start > step:
            cut = max(text.rfind(b" ", start, start + step), text.rfind(b"\n", start, start + step))
            end = cut if cut > start else start + step
        words = _WORD.findall(text[start:end])
        yield np.fromiter(map(rows.__getitem__, words), np.int32, len(words))
        start = end


def index_vectors(seed: int = 7) -> np.ndarray:
    """One sparse vector per row: four entries of 1 or -1, the rest 0."""
    rng = np.random.default_rng(seed)
    vectors = np.zeros((ROWS, DIMENSIONS), np.int32)
    places = np.argsort(rng.random((ROWS, DIMENSIONS)), axis=1)[:, :4]
    np.put_along_axis(vectors, places, rng.choice(np.array([-1, 1], np.int32), (ROWS, 4)), axis=1)
    return vectors


def _add_contexts(total: np.ndarray, index: np.ndarray, rows: np.ndarray) -> None:
    """Adds to each word's row the index vectors of its neighbours."""
    own = index[rows]
    context = np.zeros_like(own)
    for k in range(1, REACH + 1):
        context[k:] += own[:-k]
        context[:-k] += own[k:]
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    firsts = np.flatnonzero(np.diff(rows[order], prepend=-1))
    total[rows[order][firsts]] += np.add.reduceat(context[order], firsts, axis=0)


def context_sums(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The summed context vectors of all rows of the model, over all documents.

    Repeated rows count each time; null and empty texts add nothing, and an empty table gives zeros. A context does not
    reach over the end of a portion, which only texts of more than `PORTION` * 8 bytes have.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, index, rows = np.zeros((ROWS, DIMENSIONS), np.int64), index_vectors(), _Rows()
        for piece in slices(batches):
            gathered, size = [], 0
            for text in text_bytes(piece.column(0)):
                for portion in _portions(text, rows):
                    gathered.append(portion)
                    size += len(portion)
                    if size > PORTION:
                        _add_separately(total, index, gathered)
                        gathered, size = [], 0
            _add_separately(total, index, gathered)
        yield pa.record_batch([pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], ["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((ROWS, DIMENSIONS), np.int64), False
        for piece in slices(batches, 1):
            total += np.frombuffer(zlib.decompress(piece.column(0)[0].as_py()), np.int64).reshape(total.shape)
            some = True
        if some:
            yield pa.record_batch([pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())], ["sums"])

    sums = docs.select(text_col).mapInArrow(count, "sums binary")
    left = docs.rdd.getNumPartitions()
    while left > 1:
        left = -(-left // FAN_IN)
        sums = sums.repartition(left).mapInArrow(add, "sums binary")
    total = np.zeros((ROWS, DIMENSIONS), np.int64)
    for (packed,) in sums.collect():  # one row, or none for a table without partitions
        total += np.frombuffer(zlib.decompress(bytes(packed)), np.int64).reshape(total.shape)
    return total


def _add_separately(total: np.ndarray, index: np.ndarray, texts: list[np.ndarray]) -> None:
    """Contexts within each text: texts are set `REACH` empty places apart."""
    gap = np.full(REACH, ROWS, np.int32)
    parts = [part for text in texts if len(text) for part in (text, gap)]
    if not parts:
        return
    rows = np.concatenate(parts)
    padded = np.vstack([index, np.zeros((1, DIMENSIONS), np.int32)])
    sums = np.zeros((ROWS + 1, DIMENSIONS), np.int64)
    _add_contexts(sums, padded, rows)
    total += sums[:ROWS]


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Context sums damped by logarithm and scaled to length one; rows without words stay zero."""
    damped = np.sign(sums) * np.log1p(np.abs(sums))
    length = np.linalg.norm(damped, axis=1, keepdims=True)
    return np.divide(damped, length, out=np.zeros(damped.shape), where=length > 0).astype(np.float32)


def describe(text: bytes, vectors: np.ndarray, rows: _Rows) -> np.ndarray:
    """Mean, spread and mean step of a text's word vectors, and how much of it repeats; zeros without words."""
    n, first, second, step, last = 0, np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), None
    seen = np.zeros(ROWS, bool)
    for portion in _portions(text, rows):
        if not len(portion):
            continue
        own = vectors[portion]
        n += len(own)
        first += own.sum(axis=0)
        second += np.einsum("ij,ij->j", own, own)
        step += np.abs(np.diff(own, axis=0)).sum(axis=0)
        if last is not None:
            step += np.abs(own[0] - last)
        last = own[-1]
        seen[portion] = True
    if not n:
        return np.zeros(FEATURES)
    mean = first / n
    spread = np.sqrt(np.maximum(second / n - mean**2, 0))
    return np.concatenate([mean, spread, step / n, [np.log1p(n), np.log(seen.sum() / n)]])


#: Numbers that describe a document.
FEATURES = 3 * DIMENSIONS + 2


@dataclass
class QualityModel:
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.maximum((features - self.centre) / self.scale @ w1 + b1, 0) @ w2 + b2

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -30, 30)))


def _train(x: np.ndarray, y: np.ndarray, hidden: int, epochs: int, seed: int) -> list[np.ndarray]:
    """Adam on the cross-entropy with weight decay."""
    rng = np.random.default_rng(seed)
    width = x.shape[1]
    weights = [
        rng.normal(0, np.sqrt(2 / width), (width, hidden)),
        np.zeros(hidden),
        rng.normal(0, np.sqrt(1 / hidden), hidden),
        np.zeros(1),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    count = 0
    for epoch in range(epochs):
        order, rate = rng.permutation(len(x)), 3e-3 * (1 - epoch / epochs) + 1e-4
        for start in range(0, len(x), 128):
            rows = order[start : start + 128]
            hot = np.maximum(x[rows] @ weights[0] + weights[1], 0)
            error = (1 / (1 + np.exp(-np.clip(hot @ weights[2] + weights[3], -30, 30))) - y[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (hot > 0)
            slopes = [x[rows].T @ back, back.sum(axis=0), hot.T @ error, error.sum(keepdims=True)]
            count += 1
            for i, slope in enumerate(slopes):
                slope = slope + 1e-4 * weights[i]
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                weights[i] -= rate * first[i] / (1 - 0.9**count) / (np.sqrt(second[i] / (1 - 0.999**count)) + 1e-8)
    return weights


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least cross-entropy, from a grid of factors."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 141))
    losses = [np.mean(np.logaddexp(0, np.where(y > 0.5, -1, 1) * logits / t)) for t in grid]
    return float(grid[int(np.argmin(losses))])


def held_out(doc_id: Column) -> Column:
    """Rows the classifier must not learn from: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_labelled: int = MAX_LABELLED,
    hidden: int = 32,
    epochs: int = 25,
    seed: int = 11,
) -> QualityModel:
    """Word vectors from all documents, the network from at most `max_labelled` labelled ones.

    Rows with `held_out` ids are never learned from. Ids that are labelled several times take the smallest
    label; null labels and null ids are left out. Of the texts of a repeated id the one whose description is the smallest,
    byte by byte, is learned. Null and empty texts are described by zeros. Without both classes, also for
    empty tables, the score is the share of label 1 (0.5 without any label).
    """
    vectors = word_vectors(context_sums(docs, text_col))
    known = (
        labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("double").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.min("label").alias("label"))
    )
    sample = known.orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    chosen = texts.join(F.broadcast(materialize(sample, "labelled")), "id").select("id", "label", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows()
        for piece in slices(batches):
            found = [describe(text, shared.value, rows).tobytes() for text in text_bytes(piece.column(2))]
            yield pa.record_batch(
                [piece.column(0), piece.column(1), pa.array(found, pa.binary())], ["id", "label", "features"]
            )

    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    described = chosen.mapInArrow(features, "id bigint, label double, features binary")
    single = described.groupBy("id").agg(F.min(F.struct("label", "features")).alias("one"))
    rows = sorted((r.id, r.one.label, bytes(r.one.features)) for r in single.collect())
    x = np.array([np.frombuffer(r[2]) for r in rows]).reshape(-1, FEATURES)
    y = np.array([r[1] for r in rows])
    flat = [np.zeros((FEATURES, 1)), np.zeros(1), np.zeros(1), np.zeros(1)]
    if len(set(y)) < 2:
        share = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
        flat[3] = np.array([np.log(share / (1 - share))])
        return QualityModel(vectors, np.zeros(FEATURES), np.ones(FEATURES), flat, 1.0)
    aside = np.array([zlib.crc32(b"aside %d" % r[0]) % 5 == 0 for r in rows])
    if aside.all() or len(set(y[~aside])) < 2:
        aside[:] = False
    centre, scale = x[~aside].mean(axis=0), x[~aside].std(axis=0) + 1e-3
    scaled = (x - centre) / scale
    weights = _train(scaled[~aside], y[~aside], hidden, epochs, seed)
    model = QualityModel(vectors, centre, scale, weights, 1.0)
    if aside.any():
        model.temperature = _temperature(model.logits(x[aside]), y[aside])
    return model


def score(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """All columns of `docs` as the struct `row`, and `score`, the probability of label 1.

    A null text is scored like an empty one. No row moves.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    packed = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows()
        for piece in slices(batches):
            texts = text_bytes(piece.column(1))
            found = np.array([describe(t, shared.value.vectors, rows) for t in texts]).reshape(-1, FEATURES)
            yield pa.record_batch(
                [piece.column(0), pa.array(shared.value.probabilities(found), pa.float64())], ["row", "score"]
            )

    # a schema in words could not hold columns whose names need quoting
    return packed.mapInArrow(run, T.StructType([packed.schema["row"], T.StructField("score", T.DoubleType())]))

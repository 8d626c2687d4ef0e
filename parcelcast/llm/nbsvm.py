"""Quality classifier: naive Bayes support vectors over n-gram indicators.

Every n-gram indicator of a text is scaled by the log-count ratio of its class frequencies; a linear hinge-loss model is
fitted to the scaled, length-normalised rows by dual coordinate descent, and a logistic curve turns margins into scores.

The n-grams are hashed: byte 1- to 3-grams of the text, words, and 1- to 3-grams of word shapes, where a shape tells the
kind of a word's first and last byte, its length and whether it repeats the word before.

Null and empty texts get the score of a text without n-grams; repeated rows get equal scores. Without labelled
rows of both classes the score is the share of the known class (0.5 if nothing is labelled).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelcast.llm.common import Words, bound_batches, distinct, mix, scan, text_slices
from parcelcast.llm.labelled import held_out, platt, training_sample

BITS = 18
ACCEPT_BYTES = 1 << 18  # text whose n-grams ``accept`` holds at once; a longer document is taken by itself


def _kinds() -> np.ndarray:
    """Byte classes: 0 other ASCII sign, 1 lower case, 2 upper case, 3 digit, 4 beyond ASCII, 5 stop, 6 comma."""
    kinds = np.zeros(256, dtype=np.uint64)
    kinds[97:123], kinds[65:91], kinds[48:58], kinds[128:] = 1, 2, 3, 4
    kinds[[33, 46, 63]], kinds[44] = 5, 6
    return kinds


_KINDS = _kinds()


def feature_ids(words: Words) -> list[np.ndarray]:
    """Sorted distinct hashed n-gram ids of each text of a slice."""
    texts, offsets = len(words.bounds) - 1, words.offsets
    raw = words.raw.astype(np.uint64)
    keep = np.uint64(64 - BITS)
    parts = []
    for size in (1, 2, 3):
        code = raw[: max(0, len(raw) - size + 1)]
        for k in range(1, size):
            code = code * np.uint64(256) + raw[k: len(raw) - size + 1 + k]
        parts.append((mix(code + np.uint64(size << 40)) >> keep).astype(np.int32))
    h, start, end = words.hash, words.start, words.end
    word_ids = (mix(h + np.uint64(5)) >> keep).astype(np.int32)
    same = np.zeros(len(h), dtype=np.uint64)
    same[1:] = h[1:] == h[:-1]
    shape = np.zeros(0, dtype=np.uint64)
    if len(h):
        first, last = _KINDS[words.raw[start]], _KINDS[words.raw[end - 1]]
        middle = _KINDS[words.raw[(start + end) // 2]]
        shape = (((first * np.uint64(8) + middle) * np.uint64(8) + last) * np.uint64(2) + same) * np.uint64(8) + np.minimum(
            (end - start + 3) // 4, 7).astype(np.uint64)
    shapes = []
    for size in (1, 2, 3):
        code = shape[: max(0, len(shape) - size + 1)]
        for k in range(1, size):
            code = code * np.uint64(16384) + shape[k: len(shape) - size + 1 + k]
        shapes.append((mix(code + np.uint64((size + 8) << 56)) >> keep).astype(np.int32))
    out = []
    for i in range(texts):
        lo, hi = int(offsets[i]), int(offsets[i + 1])
        a, b = int(words.bounds[i]), int(words.bounds[i + 1])
        out.append(distinct(np.concatenate(
            [ids[lo: max(lo, hi - size)] for size, ids in enumerate(parts)] + [word_ids[a:b]]
            + [ids[a: max(a, b - size)] for size, ids in enumerate(shapes)])))
    return out


@dataclass
class QualityModel:
    weights: np.ndarray  # ratio times fitted weight, by n-gram id
    bias: float
    slope: float
    offset: float

    def margin(self, ids: np.ndarray) -> float:
        return float(self.weights[ids].sum() / np.sqrt(max(1, len(ids)))) + self.bias

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30)))


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, width: int, cost: float, epochs: int,
                 seed: int) -> tuple[np.ndarray, float]:
    """Linear hinge-loss model (values at ids for each row, y of -1 and 1) by dual coordinate descent."""
    w, bias, alpha = np.zeros(width), 0.0, np.zeros(len(y))
    norm = np.array([float(v @ v) + 1.0 for _, v in rows])
    order, rng = np.arange(len(y)), np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        largest = 0.0
        for i in order.tolist():
            ids, values = rows[i]
            slope = y[i] * (float(values @ w[ids]) + bias) - 1
            fresh = min(max(alpha[i] - slope / norm[i], 0.0), cost)
            if (step := (fresh - alpha[i]) * y[i]) != 0.0:
                w[ids] += step * values
                bias += step
                alpha[i] = fresh
                largest = max(largest, abs(step))
        if largest < 1e-4:
            break
    return w, bias


def fit_features(features: list[np.ndarray], y: np.ndarray, cost: float = 1.0, smoothing: float = 1.0,
                 epochs: int = 20, seed: int = 7) -> QualityModel:
    width = 1 << BITS
    if len(y) == 0 or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        return QualityModel(np.zeros(width, dtype=np.float32), 0.0, 0.0, float(np.log(share / (1 - share))))
    fold = np.arange(len(y)) % 5 == 4  # margins of rows left out give the curve
    if len(set(y[fold])) < 2 or len(set(y[~fold])) < 2:
        fold = np.zeros(len(y), dtype=bool)

    def train(index: np.ndarray) -> tuple[np.ndarray, float]:
        counts = {c: np.full(width, smoothing) for c in (0, 1)}
        for i in index:
            counts[int(y[i])][features[i]] += 1
        ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
        rows = [(features[i], ratio[features[i]] / np.sqrt(max(1, len(features[i])))) for i in index]
        w, bias = dual_descent(rows, np.where(y[index] > 0, 1.0, -1.0), width, cost, epochs, seed)
        return (ratio * w).astype(np.float32), bias

    weights, bias = train(np.flatnonzero(~fold))
    probe = QualityModel(weights, bias, 1.0, 0.0)
    rest = np.flatnonzero(fold) if fold.any() else np.arange(len(y))
    slope, offset = platt(np.array([probe.margin(features[i]) for i in rest]), y[rest].astype(float))
    return QualityModel(weights, bias, slope, offset)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 5000) -> QualityModel:
    """Fit on at most ``max_rows`` labelled documents (the documented bound of the training sample)."""
    sample = training_sample(docs, labels, label, max_rows)
    features: list[np.ndarray] = []
    if sample.num_rows:
        texts = sample["text"].combine_chunks()
        for lo, hi in text_slices(texts):
            features += feature_ids(Words(texts.slice(lo, hi - lo)))
    return fit_features(features, np.array(sample["y"].to_pylist(), dtype=np.int64))


def score(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; the model is of a fixed size (1 MB)."""
    rows = bound_batches(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")

    def run(batches):
        for batch, words in scan(batches):
            margins = np.array([model.margin(ids) for ids in feature_ids(words)])
            scores = model.score(margins)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def accept(docs: DataFrame, model: QualityModel, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score reaches the threshold."""

    @F.arrow_udf("boolean")
    def good(texts: pa.Array) -> pa.Array:
        margins = []
        for lo, hi in text_slices(texts, ACCEPT_BYTES):
            margins += [model.margin(ids) for ids in feature_ids(Words(texts.slice(lo, hi - lo)))]
        return pa.array(model.score(np.array(margins, dtype=np.float64)) >= threshold)

    # only the texts go to Python and only the verdicts come back
    return bound_batches(docs).filter(good(F.coalesce("text", F.lit(""))))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = 5000) -> DataFrame:
    return score(docs, fit(docs, labels, max_rows=max_rows), threshold)


def op10_quality(spark, sf_dir):
    from parcelcast.llm.common import table

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

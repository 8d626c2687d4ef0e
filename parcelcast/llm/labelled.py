"""Labelled rows for the classifiers: a bounded training sample, and the held-out fifth."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

HELD_OUT_FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """True for the documents whose labels are never learnt from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_FOLDS == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> pa.Table:
    """(text, y) of at most ``max_rows`` labelled documents outside the held-out fifth, the same on every run.

    The rows are the smallest by a hash of the id, so the bound is on the labelled rows of the fit alone. An id
    labelled twice counts with its larger label; an id that occurs twice in ``docs`` gives one row.
    """
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    # at most max_rows narrow rows, hence the broadcast
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    got = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y")).toArrow()
    return got.sort_by("doc_id").combine_chunks()


def platt(margin: np.ndarray, y: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margins to probabilities.

    Newton steps with halving, on targets drawn in by a row of each class, so that separable margins have an optimum.
    """
    positive = float(y.sum())
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (len(y) - positive + 2))
    centre, spread = float(margin.mean()), float(margin.std()) or 1.0
    x = np.column_stack([(margin - centre) / spread, np.ones(len(margin))])

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - target * z).sum())

    w, ridge = np.zeros(2), 1e-9 * np.eye(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - target))
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return float(w[0] / spread), float(w[1] - w[0] * centre / spread)

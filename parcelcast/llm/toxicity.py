"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as two vectors: a hashed embedding of the lower-cased word and the mean embedding of its hashed character
n-grams (4-grams anywhere, and its first 4 and 5 bytes). Windows of ``length`` words, ``stride`` apart, run through both
directions; attention pools the states of a window into one logit. All overlapping windows of a whole text are scored;
the text gets the largest logit, which a logistic curve turns into a score.

Training knows labels of texts, not of windows: each round scores all windows of the sample and takes a gradient pass over
the largest window of every text. Null and empty texts have one window of padding; repeated rows get equal scores.
Without labelled rows of both classes the score is the share of the known class (0.5 if nothing is labelled).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelcast.llm.common import Words, bound_batches, mix, scan, table, text_slices
from parcelcast.llm.labelled import held_out, platt, training_sample

WORD_BITS, GRAM_BITS = 14, 15
CHUNK = 1024  # windows that go through the network together


@dataclass
class WordInputs:
    """Distinct words of some texts: word ids, character n-gram ids in rows, and the words of each text in order."""

    word_ids: np.ndarray
    gram_ids: np.ndarray
    gram_starts: np.ndarray
    tokens: np.ndarray
    bounds: np.ndarray


def word_inputs(words: Words) -> WordInputs:
    _, at, tokens = np.unique(words.hash, return_index=True, return_inverse=True)
    start, size = words.start[at], words.end[at] - words.start[at]
    raw = np.concatenate([words.raw, np.zeros(8, dtype=np.uint8)]).astype(np.uint64)
    four = raw[:-4] | raw[1:-3] << np.uint64(8) | raw[2:-2] << np.uint64(16) | raw[3:-1] << np.uint64(24)
    count = np.maximum(size - 3, 1)  # a word below four bytes has one n-gram: what follows it is masked out
    rows = count + 2
    first = np.concatenate([[0], np.cumsum(rows)[:-1]]).astype(np.int64) if len(rows) else np.zeros(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(rows)), rows)
    place = np.arange(len(owner)) - first[owner]
    inner = place < count[owner]
    code = four[start[owner] + np.where(inner, place, 0)]
    short = np.minimum(size, 4)[owner].astype(np.uint64)
    code = code & ((np.uint64(1) << (np.uint64(8) * short)) - np.uint64(1))
    fifth = place == count[owner] + 1
    code = code | np.where(fifth & (size[owner] > 4), raw[start[owner] + 4] << np.uint64(32), np.uint64(0))
    code = code + (np.where(inner, 0, np.where(fifth, 2, 1)).astype(np.uint64) << np.uint64(56))
    return WordInputs((mix(words.hash[at]) >> np.uint64(64 - WORD_BITS)).astype(np.int32),
                      (mix(code + np.uint64(11)) >> np.uint64(64 - GRAM_BITS)).astype(np.int32),
                      first, tokens.astype(np.int64), words.bounds)


def window_rows(inputs: WordInputs, length: int, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows x length) distinct-word numbers, with the number of distinct words as padding; first window per text."""
    pad, sizes = len(inputs.word_ids), np.diff(inputs.bounds)
    count = np.maximum(1, -(-(sizes - length) // stride) + 1)
    first = np.concatenate([[0], np.cumsum(count)])
    owner = np.repeat(np.arange(len(sizes)), count)
    begin = (np.arange(first[-1]) - first[owner]) * stride
    place = begin[:, None] + np.arange(length)[None, :]
    valid = place < sizes[owner][:, None]
    tokens = np.append(inputs.tokens, pad)
    index = np.where(valid, inputs.bounds[:-1][owner][:, None] + place, len(inputs.tokens))
    return tokens[index], first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class GatedNetwork:
    """Weights and passes of the network; ``p`` holds float32 arrays by name."""

    def __init__(self, width: int = 8, hidden: int = 8, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.width, self.hidden = width, hidden
        small = lambda *shape: (rng.standard_normal(shape) * 0.15).astype(np.float32)
        self.p = {"word": small(1 << WORD_BITS, width), "gram": small(1 << GRAM_BITS, width), "bias": np.zeros(1, np.float32),
                  "out": small(2 * hidden), "look": small(2 * hidden)}
        for d in "fb":
            self.p[f"W{d}"], self.p[f"U{d}"] = small(2 * width, 3 * hidden) * 3, small(hidden, 3 * hidden)
            self.p[f"c{d}"] = np.zeros(3 * hidden, np.float32)

    def inputs(self, x: WordInputs) -> np.ndarray:
        """One row per distinct word, and a row of zeros for padding."""
        rows = np.zeros((len(x.word_ids) + 1, 2 * self.width), dtype=np.float32)
        if len(x.word_ids):
            counts = np.diff(np.append(x.gram_starts, len(x.gram_ids)))
            rows[:-1, : self.width] = self.p["word"][x.word_ids]
            rows[:-1, self.width:] = np.add.reduceat(self.p["gram"][x.gram_ids], x.gram_starts, axis=0) / counts[:, None]
        return rows

    def _run(self, gates: np.ndarray, d: str, windows: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        n, length = windows.shape
        k, U = self.hidden, self.p[f"U{d}"]
        h, states, trace = np.zeros((n, k), np.float32), np.empty((length, n, k), np.float32), []
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            g, hu = gates[windows[:, t]], h @ U
            zr = _sigmoid(g[:, : 2 * k] + hu[:, : 2 * k])
            z, r = zr[:, :k], zr[:, k:]
            m = np.tanh(g[:, 2 * k:] + r * hu[:, 2 * k:])
            new = m + z * (h - m)
            if keep:
                trace.append((t, h, z, r, m, hu[:, 2 * k:]))
            h = states[t] = new
        return states, trace

    def forward(self, rows: np.ndarray, windows: np.ndarray, keep: bool = False, gates: dict | None = None):
        gates = gates or self.gates(rows)
        runs = {d: self._run(gates[d], d, windows, keep) for d in "fb"}
        states = np.concatenate([runs["f"][0], runs["b"][0]], axis=2)  # length x windows x 2 hidden
        look = states @ self.p["look"]
        look = np.where(windows.T == len(rows) - 1, np.float32(-30), look)
        look = np.exp(look - look.max(axis=0))
        share = look / look.sum(axis=0)
        pooled = (states * share[:, :, None]).sum(axis=0)
        return pooled @ self.p["out"] + self.p["bias"][0], (states, share, pooled, runs)

    def gates(self, rows: np.ndarray) -> dict[str, np.ndarray]:
        return {d: rows @ self.p[f"W{d}"] + self.p[f"c{d}"] for d in "fb"}

    def logits(self, x: WordInputs, windows: np.ndarray) -> np.ndarray:
        rows = self.inputs(x)
        gates = self.gates(rows)
        parts = [self.forward(rows, windows[i: i + CHUNK], gates=gates)[0] for i in range(0, len(windows), CHUNK)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def gradients(self, x: WordInputs, windows: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean cross entropy; those of the embeddings are dense."""
        rows, k = self.inputs(x), self.hidden
        logits, (states, share, pooled, runs) = self.forward(rows, windows, keep=True)
        d_logit = ((_sigmoid(logits) - y) / len(y)).astype(np.float32)
        g = {"bias": np.array([d_logit.sum()], np.float32), "out": pooled.T @ d_logit}
        d_pooled = d_logit[:, None] * self.p["out"]
        d_share = (states * d_pooled).sum(axis=2)
        d_look = share * (d_share - (share * d_share).sum(axis=0))
        g["look"] = np.einsum("tnk,tn->k", states, d_look)
        d_states = share[:, :, None] * d_pooled + d_look[:, :, None] * self.p["look"]
        d_rows = np.zeros_like(rows)
        for d, part in (("f", slice(0, k)), ("b", slice(k, 2 * k))):
            U, d_gates = self.p[f"U{d}"], np.zeros((len(rows), 3 * k), np.float32)
            g[f"U{d}"], dh = np.zeros_like(U), np.zeros((len(windows), k), np.float32)
            for t, h, z, r, m, hum in reversed(runs[d][1]):
                dh = dh + d_states[t][:, part]
                dm = dh * (1 - z) * (1 - m * m)
                dz = dh * (h - m) * z * (1 - z)
                dr = dm * hum * r * (1 - r)
                d_in = np.concatenate([dz, dr, dm], axis=1)
                d_hu = np.concatenate([dz, dr, dm * r], axis=1)
                np.add.at(d_gates, windows[:, t], d_in)
                g[f"U{d}"] += h.T @ d_hu
                dh = dh * z + d_hu @ U.T
            g[f"W{d}"], g[f"c{d}"] = rows.T @ d_gates, d_gates.sum(axis=0)
            d_rows += d_gates @ self.p[f"W{d}"].T
        g["word"], g["gram"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["gram"])
        if len(x.word_ids):
            counts = np.diff(np.append(x.gram_starts, len(x.gram_ids)))
            np.add.at(g["word"], x.word_ids, d_rows[:-1, : self.width])
            np.add.at(g["gram"], x.gram_ids, np.repeat(d_rows[:-1, self.width:] / counts[:, None], counts, axis=0))
        return g


def _subset(x: WordInputs, windows: np.ndarray) -> tuple[WordInputs, np.ndarray]:
    """The distinct words of some windows, renumbered."""
    pad = len(x.word_ids)
    used = np.unique(windows)
    used = used[used < pad]
    place = np.full(pad + 1, len(used))
    place[used] = np.arange(len(used))
    counts = np.diff(np.append(x.gram_starts, len(x.gram_ids)))[used]
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64) if len(used) else np.zeros(0, np.int64)
    flat = np.repeat(x.gram_starts[used] - first, counts) + np.arange(counts.sum())
    return WordInputs(x.word_ids[used], x.gram_ids[flat], first, x.tokens, x.bounds), place[windows]


@dataclass
class ToxicityModel:
    network: GatedNetwork
    slope: float
    offset: float
    length: int = 16
    stride: int = 8

    def margins(self, words: Words) -> np.ndarray:
        x = word_inputs(words)
        windows, first = window_rows(x, self.length, self.stride)
        return np.maximum.reduceat(self.network.logits(x, windows), first[:-1]) if len(first) > 1 else np.zeros(0)

    def score(self, margins: np.ndarray) -> np.ndarray:
        return _sigmoid(np.clip(self.slope * margins.astype(np.float64) + self.offset, -30, 30))


def fit_texts(texts: pa.Array, y: np.ndarray, length: int = 16, stride: int = 8, rounds: int = 6, batch: int = 64,
              rate: float = 0.01, seed: int = 3) -> ToxicityModel:
    network = GatedNetwork()
    if len(y) == 0 or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        return ToxicityModel(network, 0.0, float(np.log(share / (1 - share))), length, stride)
    left_out = np.arange(len(y)) % 5 == 4  # margins of rows left out give the curve
    if len(set(y[left_out])) < 2 or len(set(y[~left_out])) < 2:
        left_out = np.zeros(len(y), dtype=bool)  # too few rows: all of them give both
    parts = []
    for lo, hi in text_slices(texts):
        x = word_inputs(Words(texts.slice(lo, hi - lo), lower=True))
        parts.append((x, *window_rows(x, length, stride), y[lo:hi], left_out[lo:hi]))
    _seed_embeddings(network, parts)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    rng, step = np.random.default_rng(seed), 0
    for _ in range(rounds):
        picked = []
        for x, windows, first, labels, out in parts:
            logits = network.logits(x, windows)
            for i in np.flatnonzero(~out):
                picked.append((x, windows[first[i] + int(np.argmax(logits[first[i]: first[i + 1]]))], labels[i]))
        by_part: dict[int, list] = {}
        for x, w, label in picked:
            by_part.setdefault(id(x), [x, [], []])
            by_part[id(x)][1].append(w)
            by_part[id(x)][2].append(label)
        batches = []
        for x, ws, labels in by_part.values():
            order = rng.permutation(len(ws))
            batches += [(x, np.array(ws)[order[i: i + batch]], np.array(labels)[order[i: i + batch]])
                        for i in range(0, len(ws), batch)]
        for b in rng.permutation(len(batches)):
            x, windows, labels = batches[b]
            step += 1
            for k, grad in network.gradients(*_subset(x, windows), labels.astype(np.float32)).items():
                first_moment, second = moments[k]
                first_moment += 0.1 * (grad - first_moment)
                second += 0.01 * (grad * grad - second)
                network.p[k] -= (rate * (first_moment / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
                                 ).astype(np.float32)
    margins, labels = [], []
    for x, windows, first, known, out in parts:
        top = np.maximum.reduceat(network.logits(x, windows), first[:-1])
        used = out if left_out.any() else ~out
        margins.append(top[used])
        labels.append(known[used])
    slope, offset = platt(np.concatenate(margins).astype(np.float64), np.concatenate(labels).astype(float))
    return ToxicityModel(network, slope, offset, length, stride)


def _seed_embeddings(network: GatedNetwork, parts: list) -> None:
    """Start the first coordinate of each embedding at the log odds of its word or n-gram in labelled texts."""
    seen = {"word": np.ones((2, 1 << WORD_BITS)), "gram": np.ones((2, 1 << GRAM_BITS))}
    for x, _, _, labels, out in parts:
        ends = np.append(x.gram_starts, len(x.gram_ids))
        for i in np.flatnonzero(~out):
            used = np.unique(x.tokens[x.bounds[i]: x.bounds[i + 1]])
            seen["word"][int(labels[i]), np.unique(x.word_ids[used])] += 1
            if len(used):
                seen["gram"][int(labels[i]), np.unique(np.concatenate([x.gram_ids[ends[u]: ends[u + 1]] for u in used]))] += 1
    texts = np.array([1 + sum(int(((p[3] == c) & ~p[4]).sum()) for p in parts) for c in (0, 1)])
    for name, counts in seen.items():
        share = counts / (texts[:, None] + 1)
        network.p[name][:, 0] = np.clip(np.log(share[1] / share[0]), -4, 4).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = 4000) -> ToxicityModel:
    """Fit on at most ``max_rows`` labelled documents (the documented bound of the training sample)."""
    sample = training_sample(docs, labels, label, max_rows)
    texts = sample["text"].combine_chunks() if sample.num_rows else pa.array([], pa.string())
    return fit_texts(texts, np.array(sample["y"].to_pylist(), dtype=np.int64))


def score(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; the model is of a fixed size (about 2 MB)."""
    rows = bound_batches(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")

    def run(batches):
        for batch, words in scan(batches, lower=True):
            scores = model.score(model.margins(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_rows: int = 4000) -> DataFrame:
    return score(docs, fit(docs, labels, max_rows=max_rows), threshold)


def op5_toxicity(spark, sf_dir):
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

"""Histogram trees: forests, single trees and second-order boosting, many models grown together.

Rows are binned once per fold, by quantiles, medians and categories of that fold's training rows, and written as blocks. Then
all trees that are being grown, of all configurations and folds, advance together: a job adds up gradient or class
histograms by (tree, node, feature, bin) and picks the best split of every open node; the driver sees the splits only. A node
with at most ``local_rows`` rows is not opened level by level any more: its rows, a bounded number, go to one task, which
grows the rest of that branch; if that is a boosted model's root, up to ``rounds_at_once`` trees. The rows of larger boosted models
stay in their tasks, with their margins; a job counts the smaller children of a level. So the jobs of a search go
with rounds times the levels above that size, whatever the number of models. Histogram sums are whole numbers, gradients
being rounded to multiples of _UNIT: they do not depend on the order of the rows, and both ways give the very same trees.

What a row adds to a histogram follows from the written block and the trees broadcast with the job, so that nothing is held
between jobs that a lost executor could take along. Margins are written out every CHECKPOINT_TREES trees.

Boosting minimises the log loss by Newton steps: gain and leaf values carry an L2 penalty, children need a least hessian weight
or number of rows, trees may take a share of the rows and of the columns, and grow either to a depth or, best split first, to a
number of leaves. With patience, the last tenth of the training rows in time is held back, and a model ends after so many
rounds without a lower loss there. Forests draw Poisson(1) copies of the rows and a new set of columns for every node,
and weigh the classes of each tree's own sample evenly.

Numbers are filled with the fold's median and flagged, text with its most frequent value; each category counts as a column
(equal or not), as after one-hot encoding. Draws are hashes of row position, column, node and seed: refits agree on any layout.
"""

from __future__ import annotations

import copy
import heapq
import json
import math
import operator
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from parcelcast.contracts import CATEGORICAL_FEATURES, ContractError, NUMERIC_FEATURES, TARGET, require_columns
from parcelcast.functions.expressions import present
from parcelcast.session import for_sketches, scratch_path, shared_dir

MAX_BINS = 64
MAX_CATEGORIES = 1000
SKETCH_ACCURACY = 5000
BLOCK_ROWS = 4096
LEAST_BLOCK_ROWS = 256
LOCAL_ROWS = 1 << 20
TAIL_ROWS = 1 << 18  # rows of a spread model's open nodes that are sent on to finish its tree
SPREAD_ROWS = 1 << 20  # rows of a model that a task holds at most when they lie in many
WAVE_ROWS = 1 << 24  # rows of the trees that grow at once and do not depend on each other; of those that go in bundles, four times as many
ROUNDS_AT_ONCE = 25
GROUP_ROWS = 1 << 17  # rows of the branches that are grown on together
LARGE_NODE = 1 << 11  # rows of a node with drawn columns from which on it is counted by itself
MOST_COPIES, COPY_ROWS, COPY_BITS = 15, 1 << 13, 17  # so many copies of so many rows fit these bits, and three such sums one number
JOINT_CELLS = 1 << 12  # combinations of bins that features counted together have at most
JOINT_ROWS = 1 << 13  # rows of a node from which on they are
PART_ROWS = 1 << 16  # rows whose sums are kept in whole numbers together
TABLE_CELLS = 1 << 22  # histogram cells of a level that a task holds at most
CHECKPOINT_TREES = 24
HELD_BACK = 0.1
LEAST_GAIN = 1e-7
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_UNIT = 2.0**-20  # gradients and hessians are whole multiples of it, so that sums do not depend on their order
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


# --- binning -------------------------------------------------------------------------------------------------


@dataclass
class BinSpec:
    """What turns raw rows into bin numbers, fitted on one fold's training rows."""

    edges: dict[str, np.ndarray]
    medians: dict[str, float]
    gaps: list[str]
    categories: dict[str, list[str]]
    modes: dict[str, str]
    rows: int
    positives: int
    last: int  # position of the last training row

    def __post_init__(self) -> None:
        self.numeric = [*self.edges, *self.gaps]
        self.texts = list(self.categories)
        self.sizes = [len(e) + 1 for e in self.edges.values()] + [2] * len(self.gaps) + [len(c) + 1 for c in self.categories.values()]
        # (feature, category or -1) of every column that a split can use
        self.columns = [(f, -1) for f in range(len(self.numeric))]
        for f, values in enumerate(self.categories.values(), len(self.numeric)):
            self.columns += [(f, c) for c in range(len(values))]
        self.width = max(self.sizes, default=1)
        self.dtype = np.uint8 if self.width <= 256 else np.uint16

    @property
    def inputs(self) -> list[str]:
        return [*self.edges, *self.texts]

    def names(self) -> list[str]:
        flagged = [f"numeric__{c}" for c in self.edges] + [f"numeric__missingindicator_{c}" for c in self.gaps]
        return flagged + [f"categorical__{c}_{v}" for c, values in self.categories.items() for v in values]

    def bins(self, arrays: Sequence[pa.Array]) -> np.ndarray:
        """(rows x features) bin numbers of the ``inputs`` columns."""
        out = np.zeros((len(arrays[0]), len(self.sizes)), dtype=self.dtype)
        for i, (name, edges) in enumerate(self.edges.items()):
            x = arrays[i].cast(pa.float64()).to_numpy(zero_copy_only=False)
            absent = np.isnan(x)
            out[:, i] = np.searchsorted(edges, np.where(absent, self.medians[name], x))
            if name in self.gaps:
                out[:, len(self.edges) + self.gaps.index(name)] = absent
        for i, (name, values) in enumerate(self.categories.items()):
            found = pc.index_in(arrays[len(self.edges) + i].fill_null(self.modes[name]), pa.array(values, pa.string()))
            out[:, len(self.numeric) + i] = found.fill_null(len(values)).to_numpy(zero_copy_only=False)
        return out


def fit_bins(ranked: DataFrame, folds: Sequence, max_bins: int = MAX_BINS) -> dict[int, BinSpec]:
    """Specifications by fold; sketches and category counts of all folds come from two grouped jobs."""
    require_columns(ranked, [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES, TARGET, "row_num"], "training rows")
    position = F.col("row_num")
    inside = F.array_compact(F.array(*[F.when(f.in_train(position), F.lit(f.number)) for f in folds]))
    members = ranked.select(
        F.explode(inside).alias("fold"), F.col(TARGET), *CATEGORICAL_FEATURES,
        *[F.when(present(c), F.col(c).cast("double")).alias(c) for c in NUMERIC_FEATURES])
    probs = [i / max_bins for i in range(1, max_bins)]
    half = max_bins // 2 - 1
    # cells are aggregated as they are read, the label as one more column: a task sends on one row a fold and column
    cells_ = members.select("fold", F.posexplode(F.array(*NUMERIC_FEATURES, F.col(TARGET).cast("double"))).alias("i", "x"))
    found = for_sketches(cells_).filter("x IS NOT NULL").groupBy("fold", "i").agg(
        F.percentile_approx("x", probs, SKETCH_ACCURACY).alias("q"), F.count("x").alias("n"), F.max("x").alias("most"), F.sum("x").alias("total"))
    stats: dict[int, dict[int, tuple]] = {}
    for r in found.collect():
        stats.setdefault(r["fold"], {})[r["i"]] = (r["q"], r["n"], r["most"], r["total"])
    texts = members.select("fold", *CATEGORICAL_FEATURES).unpivot(["fold"], CATEGORICAL_FEATURES, "feature", "value")
    limit = MAX_CATEGORIES * len(folds) * len(CATEGORICAL_FEATURES)
    counted = texts.filter("value IS NOT NULL").groupBy("fold", "feature", "value").agg(F.count(F.lit(1)).alias("n")).limit(limit + 1).collect()
    held: dict[tuple, list] = {}
    for r in counted:
        held.setdefault((r["fold"], r["feature"]), []).append((-r["n"], r["value"]))
    ends = {f.number: int(f.train_end) for f in folds}
    out = {}
    for fold, of_column in stats.items():
        _, rows, _, positives = of_column[len(NUMERIC_FEATURES)]
        edges, medians, gaps = {}, {}, []
        for i, c in enumerate(NUMERIC_FEATURES):
            if i in of_column:
                q, n, most, _ = of_column[i]
                values = np.unique(np.array(q, dtype=np.float64))
                edges[c], medians[c] = values[values < most], float(q[half])
                if n < rows:
                    gaps.append(c)
        categories, modes = {}, {}
        for c in CATEGORICAL_FEATURES:
            known = sorted(held.get((fold, c), []))
            if len(known) > MAX_CATEGORIES:
                raise ContractError(f"{c} has more than {MAX_CATEGORIES} values")
            if known:
                categories[c], modes[c] = sorted(v for _, v in known), known[0][1]
        out[fold] = BinSpec(edges, medians, gaps, categories, modes, rows, int(positives), ends[fold])
    return out


_BLOCK = "fold int, ids binary, y binary, bins binary, margins binary"


def binned_blocks(ranked: DataFrame, folds: Sequence, specs: dict[int, BinSpec]) -> DataFrame:
    """Training rows of every fold as blocks of at most BLOCK_ROWS rows, fewer while there are less blocks than cores."""
    names = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
    ends = {f.number: f.train_end for f in folds if f.number in specs}
    last = max(ends.values(), default=0)
    rows = ranked.filter(F.col("row_num") <= last)
    size = min(BLOCK_ROWS, max(LEAST_BLOCK_ROWS, -(-last // ranked.sparkSession.sparkContext.defaultParallelism)))

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, size):
                batch = whole.slice(lo, size)
                position = batch.column(0).to_numpy()
                label = batch.column(1).cast(pa.int64()).to_numpy(zero_copy_only=False).astype(np.uint8)
                for fold, end in ends.items():
                    inside = position <= end
                    if inside.any():
                        spec, kept = specs[fold], batch.filter(pa.array(inside))
                        bins = spec.bins([kept.column(2 + names.index(c)) for c in spec.inputs])
                        yield pa.RecordBatch.from_pylist([{
                            "fold": fold, "ids": position[inside].astype(np.int64).tobytes(), "y": label[inside].tobytes(),
                            "bins": bins.tobytes(), "margins": None}], schema=_arrow_schema(_BLOCK))

    parts = max(1, -(-last // size))
    return rows.select("row_num", TARGET, *names).repartition(parts).mapInArrow(run, _BLOCK)


def _arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


# --- settings ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class TreeSettings:
    """How trees grow. ``boosting`` chooses Newton steps, else class shares."""

    boosting: bool
    trees: int
    learning_rate: float = 1.0
    max_depth: int | None = None
    max_leaves: int | None = None
    min_rows: int = 1
    min_weight: float = 0.0
    l2: float = 0.0
    row_share: float = 1.0
    column_share: float = 1.0
    node_columns: str | None = None
    bootstrap: bool = False
    patience: int | None = None
    late_weight: str | float = "balanced"
    seed: int = 42


def settings_of(family: str, p: dict, seed: int) -> TreeSettings:
    """Settings of a registry configuration of a tree family."""
    if family == "tree":
        return TreeSettings(False, 1, max_depth=p["max_depth"], min_rows=p["min_samples_leaf"], seed=seed)
    if family in ("random_forest", "ensemble"):
        return TreeSettings(False, p["n_estimators"], max_depth=p.get("max_depth"), min_rows=p["min_samples_leaf"],
                            node_columns=p.get("max_features", "sqrt"), bootstrap=True, seed=seed)
    if family in ("hist_gradient_boosting", "boosting"):
        return TreeSettings(True, p.get("max_iter", 220), p["learning_rate"], max_leaves=p["max_leaf_nodes"],
                            min_rows=p["min_samples_leaf"], min_weight=1e-3, l2=p.get("l2_regularization", 1.0),
                            patience=p.get("n_iter_no_change", 15), seed=seed)
    if family == "xgboost":
        return TreeSettings(True, p["n_estimators"], p["learning_rate"], max_depth=p["max_depth"],
                            min_weight=p["min_child_weight"], l2=p["reg_lambda"], row_share=p["subsample"],
                            column_share=p["colsample_bytree"],
                            late_weight="scale" if p.get("scale_pos_weight", 1.0) == "auto" else float(p.get("scale_pos_weight", 1.0)), seed=seed)
    raise ContractError(f"unknown tree family: {family}")


# --- random draws by hash ------------------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(values: np.ndarray, *seeds: int) -> np.ndarray:
    """64 random bits drawn from each value and the seeds."""
    base = np.uint64(0)
    with np.errstate(over="ignore"):
        for s in seeds:
            base = _mixed(np.array([base + np.uint64(s) * _GOLDEN + _GOLDEN], dtype=np.uint64))[0]
        return _mixed(_mixed(values.astype(np.uint64) * _GOLDEN + base) + _GOLDEN)


def uniform(values: np.ndarray, *seeds: int) -> np.ndarray:
    """Numbers in [0, 1) drawn from ``values`` and the seeds."""
    return (hashed(values, *seeds) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


# --- best splits ---------------------------------------------------------------------------------------------


@dataclass
class Rule:
    """What a task needs to open nodes of one tree."""

    settings: TreeSettings
    tree: int = 0  # number of the tree in its model
    classes: tuple[float, float] | None = None  # weights of late and on-time rows of a class tree, once known

    def score(self, s: np.ndarray) -> np.ndarray:
        if self.settings.boosting:
            return (s[..., 0] * _UNIT) ** 2 / (s[..., 1] * _UNIT + self.settings.l2 + 1e-16)
        late, on_time = s[..., 0] * self.classes[0], s[..., 1] * self.classes[1]
        return -2 * late * on_time / np.maximum(late + on_time, 1e-300)

    def allowed(self, s: np.ndarray) -> np.ndarray:
        enough = s[..., 2] >= max(1, self.settings.min_rows)
        return enough & (s[..., 1] * _UNIT >= self.settings.min_weight) if self.settings.boosting else enough

    def value(self, s: np.ndarray) -> np.ndarray:
        if self.settings.boosting:
            return -self.settings.learning_rate * s[..., 0] * _UNIT / (s[..., 1] * _UNIT + self.settings.l2 + 1e-16)
        late, on_time = s[..., 0] * self.classes[0], s[..., 1] * self.classes[1]
        return late / np.maximum(late + on_time, 1e-300)

    def balance(self, totals: np.ndarray) -> None:
        """Class weights that make both classes of the tree's own sample count alike."""
        if not self.settings.boosting and self.classes is None:
            n = totals[0] + totals[1]
            self.classes = (n / (2 * totals[0]) if totals[0] else 1.0, n / (2 * totals[1]) if totals[1] else 1.0)

    def candidates(self, spec: BinSpec, paths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(feature, category) of the candidates of each node: (nodes x candidates) arrays.

        All features, a text one standing for all its categories (category -1), or a draw of columns for each node.
        """
        if self.settings.node_columns is None:
            f = np.tile(np.arange(len(spec.sizes)), (len(paths), 1))
            return f, np.full_like(f, -1)
        columns = np.array(spec.columns)
        count = max(1, int(math.sqrt(len(columns)))) if self.settings.node_columns == "sqrt" else len(columns)
        draw = uniform(paths[:, None].astype(np.uint64) * np.uint64(len(columns)) + np.arange(len(columns), dtype=np.uint64)[None],
                       self.settings.seed, self.tree, 7)
        chosen = np.sort(np.argpartition(draw, count - 1, axis=1)[:, :count], axis=1)
        return columns[chosen, 0], columns[chosen, 1]

    def closed(self, spec: BinSpec) -> np.ndarray | None:
        """(features x bins) places that this tree may not use, from its share of the columns."""
        if self.settings.column_share >= 1:
            return None
        columns = np.array(spec.columns)
        draw = uniform(np.arange(len(columns)), self.settings.seed, self.tree, 11)
        out = np.argsort(draw, kind="stable")[max(1, round(self.settings.column_share * len(columns))):]
        closed = np.zeros((len(spec.sizes), spec.width), dtype=bool)
        for f, c in columns[out]:
            closed[f, slice(None) if c < 0 else c] = True
        return closed


def cells(bins: np.ndarray, stats: np.ndarray, node: np.ndarray, features: np.ndarray, categories: np.ndarray, width: int):
    """Occupied histogram cells of rows: (key, sums), where key is (node * candidates + candidate) * width + bin."""
    count = features.shape[1]
    f, c = features[node], categories[node]
    value = np.take_along_axis(bins, f, axis=1).astype(np.int64)
    if (categories >= 0).any():
        value = np.where(c >= 0, (value != c).astype(np.int64), value)
    key = ((node[:, None] * count + np.arange(count)) * width + value).ravel()
    size = len(features) * count * width
    if size <= 4 * len(key) + 4096:
        return _dense([np.bincount(key, weights=np.repeat(stats[:, s], count), minlength=size) for s in range(stats.shape[1])])
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    rows = order // count
    return key[first], np.add.reduceat(stats[rows], first, axis=0) if len(first) else np.zeros((0, stats.shape[1]))


def _dense(sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key = np.flatnonzero(sums[-1])
    return key, np.stack([s[key] for s in sums], axis=1)


@dataclass
class Split:
    """Best splits of some nodes; feature -1 where there is none. ``left`` holds the sums of the left side."""

    feature: np.ndarray
    equal: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    left: np.ndarray


def best_splits(rule: Rule, spec: BinSpec, key: np.ndarray, sums: np.ndarray, totals: np.ndarray, features: np.ndarray,
                categories: np.ndarray) -> Split:
    """The split of largest gain of each node; the first candidate and the lowest bin win ties."""
    nodes, count = features.shape
    out = Split(np.full(nodes, -1), np.zeros(nodes, dtype=bool), np.zeros(nodes, dtype=np.int64), np.zeros(nodes), np.zeros((nodes, 3)))
    if not len(key):
        return out
    place, value = key // spec.width, key % spec.width
    node, candidate = place // count, place % count
    f, c = features[node, candidate], categories[node, candidate]
    text = f >= len(spec.numeric)
    one_against_rest = text & (c < 0)
    running = np.cumsum(sums, axis=0)
    first = np.concatenate([[True], place[1:] != place[:-1]])
    start = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
    before = np.where((start > 0)[:, None], running[np.maximum(start - 1, 0)], 0.0)
    left = np.where(one_against_rest[:, None], sums, running - before)
    parent = totals[node]
    right = parent - left
    gain = rule.score(left) + rule.score(right) - rule.score(parent)
    valid = rule.allowed(left) & rule.allowed(right) & (gain > LEAST_GAIN)
    # the last category stands for values not seen in training, and of a pair "equal or not" only "equal" is a cut
    valid &= ~(one_against_rest & (value >= np.array(spec.sizes)[f] - 1)) & ~((c >= 0) & (value > 0))
    closed = rule.closed(spec)
    if closed is not None:
        valid &= ~closed[f, value]
    gain = np.where(valid, gain, -np.inf)
    edge = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    top = np.maximum.reduceat(gain, edge)
    best_of = np.full(nodes, -np.inf)
    best_of[node[edge]] = top
    hit = np.flatnonzero((gain == best_of[node]) & np.isfinite(gain))
    found, at = np.unique(node[hit], return_index=True)
    at = hit[at]
    out.feature[found], out.gain[found], out.left[found] = f[at], gain[at], left[at]
    out.equal[found] = text[at]
    out.cut[found] = np.where(c[at] >= 0, c[at], value[at])
    return out


# --- trees ---------------------------------------------------------------------------------------------------


@dataclass
class Nodes:
    """Nodes of a tree by path: the root is 1, children of p are 2p (left) and 2p + 1."""

    splits: dict[int, tuple] = field(default_factory=dict)  # feature, equal, cut, gain
    totals: dict[int, np.ndarray] = field(default_factory=dict)

    def selected(self, root: int, max_leaves: int | None) -> set[int]:
        """Splits kept when the split of largest gain among the leaves comes first, up to that many leaves."""
        if max_leaves is None:
            return set(self.splits)
        kept, heap = set(), [(-self.splits[root][3], root)] if root in self.splits else []
        while heap and len(kept) < max_leaves - 1:
            _, p = heapq.heappop(heap)
            kept.add(p)
            for child in (2 * p, 2 * p + 1):
                if child in self.splits:
                    heapq.heappush(heap, (-self.splits[child][3], child))
        return kept

    def add(self, paths: np.ndarray, split: Split) -> list[int]:
        """Enter the splits found; returns the children."""
        out = []
        for i in np.flatnonzero(split.feature >= 0).tolist():
            p = int(paths[i])
            self.splits[p] = (int(split.feature[i]), bool(split.equal[i]), int(split.cut[i]), float(split.gain[i]))
            self.totals[2 * p], self.totals[2 * p + 1] = split.left[i], self.totals[p] - split.left[i]
            out += [2 * p, 2 * p + 1]
        return out

    def worth_opening(self, children: list[int], settings: TreeSettings, root: int) -> list[int]:
        """Children that may be split: deep, large and, where leaves are limited, well placed enough."""
        kept = self.selected(root, settings.max_leaves)
        most = settings.max_depth if settings.max_depth is not None else 60
        return [c for c in children if c // 2 in kept and c.bit_length() - 1 < most
                and self.totals[c][2] >= 2 * max(1, settings.min_rows)
                and (settings.boosting or min(self.totals[c][:2]) > 0)]


def place_rows(nodes: Nodes, bins: np.ndarray, path: np.ndarray) -> np.ndarray:
    """Rows moved down to the deepest node known, by paths."""
    path = path.copy()
    moving = np.arange(len(path))
    while len(moving):
        here = path[moving]
        known, at = np.unique(here, return_inverse=True)
        table = np.array([nodes.splits.get(int(p), (-1, False, 0, 0.0))[:3] for p in known], dtype=np.int64)
        f, equal, cut = table[at].T
        moving, here, f, equal, cut = (x[f >= 0] for x in (moving, here, f, equal, cut))
        b = bins[moving, f]
        path[moving] = 2 * here + ~np.where(equal > 0, b == cut, b <= cut)
    return path


class Tables:
    """Histograms over all features of the open nodes of a level.

    Only the smaller child of a split is counted, the other is what remains of the parent: whole numbers, so nothing is lost.
    """

    def __init__(self, spec: BinSpec):
        self.cells, self.width = spec.width, spec.width * len(spec.sizes)
        self.of: dict[int, np.ndarray] = {}

    def wanted(self, paths: Sequence[int], totals: dict[int, np.ndarray]) -> list[int]:
        """The nodes to count, so that those of all ``paths`` are known."""
        return sorted({min((p, p ^ 1), key=lambda c: (totals[c][2], c)) if p // 2 in self.of else p for p in paths})

    def entered(self, paths: Sequence[int], tables: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Occupied cells of all ``paths``, keyed by the node's place among them, from the tables counted."""
        self.of = {p: tables[p] if p in tables else self.of[p // 2] - tables[p ^ 1] for p in paths}
        key, sums = [], []
        for i, p in enumerate(paths):
            at = np.flatnonzero(self.of[p][:, 2])
            key.append(at + i * self.width)
            sums.append(self.of[p][at])
        return np.concatenate(key), np.concatenate(sums)


class Lines:
    """Bins with a line a feature and, where ``joint``, lines of several features: a key for each combination of their bins."""

    def __init__(self, bins: np.ndarray, spec: BinSpec, joint: bool = True):
        self.bins = np.ascontiguousarray(bins)
        self.groups: list[list[int]] = []
        self.shapes, self.keys = [], []
        if not joint:
            return
        rooms: list[int] = []
        for f in np.argsort(-np.array(spec.sizes), kind="stable").tolist():  # the largest first, each where it fits first
            at = next((i for i, cells_ in enumerate(rooms) if cells_ * spec.sizes[f] <= JOINT_CELLS), len(rooms))
            if at == len(rooms):
                self.groups.append([])
                rooms.append(1)
            self.groups[at].append(f)
            rooms[at] *= spec.sizes[f]
        self.shapes = [tuple(spec.sizes[f] for f in group) for group in self.groups]
        for group, shape in zip(self.groups, self.shapes):
            key = self.bins[group[0]].astype(np.uint16 if math.prod(shape) <= 1 << 16 else np.uint32)
            for f, size in zip(group[1:], shape[1:]):
                key *= size
                key += self.bins[f]
            self.keys.append(key)


class LevelTables(Tables):
    """Tables of rows that are all here: those of ``stats``, which lie at ``place`` in the lines, or are all of them."""

    def __init__(self, bins: np.ndarray | None, stats: np.ndarray, spec: BinSpec, lines: Lines | None = None, place: np.ndarray | None = None):
        super().__init__(spec)
        self.stats = np.ascontiguousarray(stats.T)
        self.lines, self.place = lines or Lines(bins.T, spec), place
        self.bins, self.positive = self.lines.bins, not (stats[:, 1] < 0).any()

    def count(self, path: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """(nodes x cells x sums) of the rows whose path is among ``wanted``."""
        return np.stack([self.table(np.flatnonzero(path == p)) for p in wanted.tolist()])

    def table(self, rows: np.ndarray) -> np.ndarray:
        """(cells x sums) of a node's rows. Many rows are counted by the lines of several features, whose tables are added up for each."""
        out = np.zeros((len(self.bins), self.cells, 3))
        every = len(rows) == self.stats.shape[1]
        at = self.place if every else rows if self.place is None else self.place[rows]
        spans = [slice(lo, min(lo + PART_ROWS, len(rows))) for lo in range(0, len(rows), PART_ROWS)]
        parts = [self._weights(rows[span], span, every) for span in spans]
        if len(rows) < JOINT_ROWS or not self.lines.keys:
            for f, bins in enumerate(self.bins):
                out[f] = self._sums(bins, at, parts, self.cells).T
            return out.reshape(self.width, 3)
        for group, shape, key in zip(self.lines.groups, self.lines.shapes, self.lines.keys):
            joint = self._sums(key, at, parts, math.prod(shape)).reshape(3, *shape)
            for f, size in zip(group[:0:-1], shape[:0:-1]):  # the last one's table, then the others' without it
                out[f, :size] = joint.reshape(3, -1, size).sum(axis=1).T
                joint = joint.sum(axis=-1)
            out[group[0], : shape[0]] = joint.T
        return out.reshape(self.width, 3)

    def _weights(self, rows: np.ndarray, span: slice, every: bool) -> tuple[slice, np.ndarray, np.ndarray, int | None]:
        """First and second sums of a part's rows; the second and the count share the bits of one number where they fit and none is negative."""
        first, second = self.stats[:2, span] if every else self.stats[:2, rows]
        bits = int(second.sum()).bit_length()
        if self.positive and bits + len(rows).bit_length() <= 53:
            return span, first, second + 2.0**bits, bits
        return span, first, second, None

    def _sums(self, line: np.ndarray, at: np.ndarray | None, parts: list[tuple], cells_: int) -> np.ndarray:
        """(sums x cells) of one line: a histogram that stays in the cache, no row repeated."""
        out = np.zeros((3, cells_))
        for span, first, second, bits in parts:
            key = (line[span] if at is None else line[at[span]]).astype(np.intp)
            out[0] += np.bincount(key, weights=first, minlength=cells_)
            both = np.bincount(key, weights=second, minlength=cells_)
            n = np.bincount(key, minlength=cells_) if bits is None else np.floor(both * 2.0**-bits)
            out[1] += both if bits is None else both - n * 2.0**bits
            out[2] += n
        return out

    def level(self, rows: dict[int, np.ndarray], paths: np.ndarray, totals: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Occupied cells of all open nodes, keyed by the node's place in ``paths``; ``rows`` holds those of their siblings too."""
        return self.entered(paths.tolist(), {p: self.table(rows[p]) for p in self.wanted(paths.tolist(), totals)})


def grow(bins: np.ndarray, stats: np.ndarray, root: int, rule: Rule, spec: BinSpec, lines: Lines | None = None,
         place: np.ndarray | None = None) -> Nodes:
    """The branch below ``root``, grown from all its rows. They lie together by node; those of finished nodes are dropped.

    With ``place``, the rows of ``stats`` are those places of ``bins`` and its ``lines``, which many trees share.
    """
    out = Nodes(totals={root: stats.sum(axis=0)})
    rule.balance(out.totals[root])
    tables = LevelTables(bins, stats, spec, lines, place) if rule.settings.node_columns is None else None
    drawn = not tables and not rule.settings.boosting
    paths = np.array([root] if out.totals[root][2] >= 2 * max(1, rule.settings.min_rows) else [], dtype=np.int64)
    parts = {root: np.arange(len(stats))}  # rows of the open nodes and, for tables, of their siblings

    def opened(paths: np.ndarray, key: np.ndarray, sums: np.ndarray, *of_nodes: np.ndarray) -> tuple[Split, list[int]]:
        split = best_splits(rule, spec, key, sums, *of_nodes)
        return split, sorted(out.worth_opening(out.add(paths, split), rule.settings, root))

    while len(paths) and tables and len(paths) * tables.width <= TABLE_CELLS:
        totals = np.stack([out.totals[int(p)] for p in paths])
        split, below = opened(paths, *tables.level(parts, paths, out.totals), totals, *rule.candidates(spec, paths))
        held, parts, wanted = parts, {}, {p // 2 for p in below}
        for i, p in enumerate(paths.tolist()):
            if p in wanted:
                rows = held[p]
                b, cut = tables.bins[split.feature[i], rows if place is None else place[rows]], split.cut[i]
                left = b == cut if split.equal[i] else b <= cut
                parts[2 * p], parts[2 * p + 1] = rows[left], rows[~left]
        paths = np.array(below, dtype=np.int64)
    if not len(paths):
        return out
    if drawn and len(stats) >= LARGE_NODE and stats.max() <= MOST_COPIES:
        lines = lines or Lines(bins.T, spec, joint=False)
        paths = np.array([], dtype=np.int64)  # nodes that have become small
        large, weight = [root], stats @ np.array([1.0, 2.0**COPY_BITS, 2.0**(2 * COPY_BITS)])
        while large:
            here = np.array(large, dtype=np.int64)
            totals = np.stack([out.totals[p] for p in large])
            features, categories = rule.candidates(spec, here)
            found = [large_cells(lines, parts[p] if place is None else place[parts[p]], weight[parts[p]], *x, spec, i)
                     for i, (p, *x) in enumerate(zip(large, features, categories))]
            split, below = opened(here, *(np.concatenate(x) for x in zip(*found)), totals, features, categories)
            for i, p in enumerate(large):
                rows, f = parts.pop(p), split.feature[i]
                b = lines.bins[f, rows if place is None else place[rows]]
                left = b == split.cut[i] if split.equal[i] else b <= split.cut[i]
                parts |= {c: rows[side] for c, side in ((2 * p, left), (2 * p + 1, ~left)) if c in below}
            large = [p for p in below if len(parts[p]) >= LARGE_NODE]
            paths = np.concatenate([paths, np.array([p for p in below if len(parts[p]) < LARGE_NODE], dtype=np.int64)])
        paths.sort()
        if not len(paths):
            return out
    sizes = np.cumsum([len(parts[p]) for p in paths.tolist()])
    for some in np.split(paths, np.flatnonzero(np.diff(sizes // GROUP_ROWS)) + 1):  # branches whose rows stay in the cache
        rows = np.concatenate([parts[p] for p in some.tolist()])
        node = np.repeat(np.arange(len(some)), [len(parts[p]) for p in some.tolist()])
        near = np.ascontiguousarray(bins[rows if place is None else place[rows]])
        flat, width, sums_of, rows = near.ravel(), near.shape[1], stats[rows], np.arange(len(rows))
        while len(some):
            totals = np.stack([out.totals[int(p)] for p in some])
            features, categories = rule.candidates(spec, some)
            if drawn:
                key, sums = drawn_cells(flat, rows * width, sums_of[rows], node, totals, features, categories, spec)
            else:
                key, sums = cells(near[rows], sums_of[rows], node, features, categories, spec.width)
            split, below = opened(some, key, sums, totals, features, categories)
            child = np.full((len(some), 2), -1)  # place of the left and the right child among the nodes opened next
            if below:
                for side in (0, 1):
                    at = np.minimum(np.searchsorted(below, 2 * some + side), len(below) - 1)
                    child[:, side] = np.where(np.array(below)[at] == 2 * some + side, at, -1)
            b, cut = flat[rows * width + split.feature[node]], split.cut[node]
            node = child.ravel()[2 * node + ~np.where(split.equal[node], b == cut, b <= cut)]
            kept = np.flatnonzero(node >= 0)
            # few nodes sort by radix
            order = kept[np.argsort(node[kept].astype(np.uint16) if len(below) <= 1 << 16 else node[kept], kind="stable")]
            rows, node, some = rows[order], node[order], np.array(below, dtype=np.int64)
    return out


def large_cells(lines: Lines, at: np.ndarray, weight: np.ndarray, columns: np.ndarray, categories: np.ndarray, spec: BinSpec,
                number: int) -> tuple[np.ndarray, np.ndarray]:
    """``drawn_cells`` of one node of many rows: ``weight`` holds a row's three sums in the bits of one number, added up COPY_ROWS at a time."""
    keys, found, mask = [], [], (1 << COPY_BITS) - 1
    tables: dict[int, np.ndarray] = {}
    for j, (f, c) in enumerate(zip(columns.tolist(), categories.tolist())):
        if f not in tables:
            bins = lines.bins[f][at].astype(np.intp)
            sums = np.zeros((3, spec.sizes[f]), dtype=np.int64)
            for lo in range(0, len(at), COPY_ROWS):
                whole = np.bincount(bins[lo: lo + COPY_ROWS], weights=weight[lo: lo + COPY_ROWS], minlength=spec.sizes[f]).astype(np.int64)
                sums += np.stack([whole & mask, whole >> COPY_BITS & mask, whole >> 2 * COPY_BITS])
            tables[f] = sums.T.astype(np.float64)
        bin_ = np.flatnonzero(tables[f][:, 2]) if c < 0 else np.flatnonzero(tables[f][c: c + 1, 2]) + c
        keys.append((number * len(columns) + j) * spec.width + (bin_ if c < 0 else bin_ - c))
        found.append(tables[f][bin_])
    return np.concatenate(keys), np.concatenate(found)


def drawn_cells(flat: np.ndarray, start: np.ndarray, stats: np.ndarray, node: np.ndarray, totals: np.ndarray, columns: np.ndarray,
                categories: np.ndarray, spec: BinSpec) -> tuple[np.ndarray, np.ndarray]:
    """``cells`` that can be cuts, of rows that lie together by node; sums are copies of rows, whole and not negative.

    A feature is counted once a node, however many of its categories are drawn, and the sums share the bits of one number
    where they fit.
    """
    count, sizes = columns.shape[1], np.array(spec.sizes)
    fresh = np.concatenate([np.ones((len(columns), 1), dtype=bool), columns[:, 1:] != columns[:, :-1]], axis=1)  # candidates lie by feature
    each = fresh.sum(axis=1)  # features a node
    slot = np.cumsum(fresh.ravel()).reshape(fresh.shape) - 1  # of each candidate
    feature = columns[fresh]
    first, offset = np.concatenate([[0], np.cumsum(each)]), np.concatenate([[0], np.cumsum(sizes[feature])])
    ends = np.searchsorted(node, np.arange(len(columns) + 1))
    bits = int(totals.max()).bit_length()
    keys, found, lo = [], [], 0
    while lo < len(columns):  # nodes of about TABLE_CELLS cells at once
        hi = max(lo + 1, int(np.searchsorted(offset[first], offset[first[lo]] + TABLE_CELLS, side="right")) - 1)
        rows = slice(ends[lo], ends[hi])
        at, begin, stat = node[rows], start[rows], stats[rows]
        a, z = offset[first[lo]], offset[first[hi]]
        packed = stat[:, 0] + stat[:, 1] * 2.0**bits + (stat[:, 2] * 2.0**(2 * bits) if 3 * bits <= 53 else 0.0)
        cell, weight = [], []
        for j in range(each[lo:hi].max()):
            inside = slice(None) if j < each[lo:hi].min() else np.flatnonzero(each[at] > j)
            place = first[at[inside]] + j
            cell.append(offset[place] - a + flat[begin[inside] + feature[place]])
            weight.append(packed[inside])
        cell = np.concatenate(cell)
        whole = np.bincount(cell, weights=np.concatenate(weight), minlength=z - a).astype(np.int64)
        rest = whole >> bits
        n = rest >> bits if 3 * bits <= 53 else np.bincount(cell, minlength=z - a)
        mask = (1 << bits) - 1
        # numbers: all occupied bins; texts: the drawn categories
        number = np.flatnonzero(fresh[lo:hi].ravel() & (categories[lo:hi].ravel() < 0))
        of = slot[lo:hi].ravel()[number]
        width = sizes[feature[of]]
        bin_ = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        spot, key = np.repeat(offset[of], width) + bin_ - a, np.repeat(number, width) * spec.width + bin_
        text = np.flatnonzero(categories[lo:hi].ravel() >= 0)
        spot = np.concatenate([spot, offset[slot[lo:hi].ravel()[text]] + categories[lo:hi].ravel()[text] - a])
        key = np.concatenate([key, text * spec.width]) + lo * count * spec.width
        occupied = np.flatnonzero(n[spot])
        occupied = occupied[np.argsort(key[occupied], kind="stable")]  # two runs in order, merged
        spot = spot[occupied]
        keys.append(key[occupied])
        found.append(np.stack([whole[spot] & mask, rest[spot] & mask if 3 * bits <= 53 else rest[spot], n[spot]], axis=1).astype(np.float64))
        lo = hi
    return np.concatenate(keys), np.concatenate(found)


class Ensemble:
    """Finished trees as flat arrays: the right child comes after the left one; leaves lead to themselves, whatever the bin."""

    def __init__(self, trees: Sequence[tuple[np.ndarray, ...]]):
        starts = np.cumsum([0, *(len(t[0]) for t in trees)])
        def joined(i: int, kind: type) -> np.ndarray:
            return np.concatenate([np.asarray(t[i], dtype=kind) for t in trees]) if trees else np.zeros(0, dtype=kind)

        self.feature, self.equal, self.cut = joined(0, np.int16), joined(1, bool), joined(2, np.int16)
        self.left, self.value, self.roots = joined(3, np.int32), joined(5, np.float64), starts[:-1].astype(np.int32)
        for lo, hi in zip(starts, starts[1:]):
            self.left[lo:hi] += lo
        self.cut[self.left == np.arange(len(self.left))] = np.iinfo(np.int16).max
        self.depth = max((t[6] for t in trees), default=0)

    def sums(self, bins: np.ndarray) -> np.ndarray:
        """Sum of the leaf values of each row over all trees."""
        out = np.zeros(len(bins))
        if not len(self.roots):
            return out
        step = max(1, (1 << 18) // len(self.roots))
        for lo in range(0, len(bins), step):
            part = bins[lo: lo + step]
            rows = np.arange(len(part))[:, None]
            at = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            for _ in range(self.depth):
                b = part[rows, self.feature[at]]
                cut = self.cut[at]
                at = self.left[at] + ~np.where(self.equal[at], b == cut, b <= cut)
            out[lo: lo + step] = self.value[at].sum(axis=1)
        return out


def path_contributions(model: "TreeModel", bins: np.ndarray) -> tuple[np.ndarray, float]:
    """((rows x columns) contributions, base): what each split on a row's paths adds to the value of the node above it.

    Base and contributions of a row add up to its raw score: the margin of a boosted model, the probability of the others.
    """
    ensemble, spec = model.ensemble, model.spec
    number = {c: i for i, c in enumerate(spec.columns)}
    column = np.array([number.get((int(f), int(cut) if equal else -1), 0) for f, equal, cut in zip(ensemble.feature, ensemble.equal, ensemble.cut)])
    scale = 1.0 if model.settings.boosting else 1.0 / max(1, model.n_trees)
    out = np.zeros((len(bins), len(spec.columns)))
    step = max(1, (1 << 18) // max(1, len(ensemble.roots)))
    for lo in range(0, len(bins), step):
        part = bins[lo: lo + step]
        rows = np.arange(len(part))[:, None]
        at = np.broadcast_to(ensemble.roots, (len(part), len(ensemble.roots)))
        for _ in range(ensemble.depth):
            b, cut = part[rows, ensemble.feature[at]], ensemble.cut[at]
            below = ensemble.left[at] + ~np.where(ensemble.equal[at], b == cut, b <= cut)
            moved = (ensemble.value[below] - ensemble.value[at]).ravel()
            key = (rows * len(spec.columns) + column[at]).ravel()
            out[lo: lo + step] += np.bincount(key, weights=moved, minlength=out[lo: lo + step].size).reshape(len(part), -1)
            at = below
    base = float(ensemble.value[ensemble.roots].sum()) * scale + (model.base if model.settings.boosting else 0.0)
    return out * scale, base


def flat_tree(nodes: Nodes, rule: Rule) -> tuple:
    """(feature, equal, cut, left, right, value, depth, gain) of the nodes that are kept, by place in the tree."""
    kept = nodes.selected(1, rule.settings.max_leaves)
    paths = sorted({1, *(c for p in kept for c in (2 * p, 2 * p + 1))})
    at = {p: i for i, p in enumerate(paths)}
    table = np.array([nodes.splits[p] if p in kept else (0, False, 0, 0.0) for p in paths], dtype=np.float64)
    left = np.array([at[2 * p] if p in kept else at[p] for p in paths])
    right = np.array([at[2 * p + 1] if p in kept else at[p] for p in paths])
    value = rule.value(np.stack([nodes.totals[p] for p in paths]))
    return (table[:, 0].astype(np.int16), table[:, 1].astype(bool), table[:, 2].astype(np.int32), left.astype(np.int32),
            right.astype(np.int32), value, max(p.bit_length() - 1 for p in paths), table[:, 3])


# --- growing many trees with Spark ---------------------------------------------------------------------------


@dataclass
class Unit:
    """A tree being grown."""

    model: int
    fold: int
    rule: Rule
    nodes: Nodes = field(default_factory=Nodes)
    open: dict[int, bool] = field(default_factory=dict)  # path: is the rest of the branch grown by one task?

    def decide(self, paths: list[int], local_rows: int) -> None:
        self.open = {p: self.nodes.totals[p][2] <= local_rows for p in paths}


@dataclass
class Member:
    """A model being fitted."""

    number: int
    fold: int
    place: int  # among the boosted models of its fold, in the order of their margins
    settings: TreeSettings
    base: float
    weights: tuple[float, float]  # of late and on-time rows
    held_from: int  # first position held back
    trees: list[tuple] = field(default_factory=list)
    since: int = 0  # trees that the written margins hold
    losses: list[float] = field(default_factory=list)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


_EMITTED = "task int, unit int, path long, kind int, left binary, right binary"
_RESULT = "unit int, path long, kind int, result binary"
_HISTOGRAM, _ROWS, _MODEL, _BUNDLE = 0, 1, 2, 3


def row_stats(member: Member, rule: Rule, ids: np.ndarray, y: np.ndarray, margin: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their sums): gradient, hessian and 1, or copies of late and on-time rows and 1."""
    s = member.settings
    if s.boosting:
        part = ids < member.held_from
        if s.row_share < 1:
            part &= uniform(ids, s.seed, rule.tree, 3) < s.row_share
        weight, p = np.where(y > 0, *member.weights), logistic(margin)
        stats = np.stack([np.rint(weight * (p - y) / _UNIT), np.rint(weight * p * (1 - p) / _UNIT), np.ones(len(p))], axis=1)
    else:
        copies = np.searchsorted(_POISSON, uniform(ids, s.seed, rule.tree, 5), side="right") if s.bootstrap else np.ones(len(y))
        part = copies > 0
        stats = np.stack([copies * y, copies * (1 - y), np.ones(len(y))], axis=1)
    rows = np.flatnonzero(part)
    return rows, stats[rows]


def held_back_loss(member: Member, ids: np.ndarray, y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Weighted log loss and weight of the rows held back."""
    kept = ids >= member.held_from
    weight = np.where(y[kept] > 0, *member.weights)
    return np.array([(weight * np.logaddexp(0, np.where(y[kept] > 0, -margin[kept], margin[kept]))).sum(), weight.sum()])


class Block:
    """One block of binned rows, decoded."""

    def __init__(self, row: dict, spec: BinSpec):
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.y = np.frombuffer(row["y"], dtype=np.uint8).astype(np.float64)
        self.bins = np.frombuffer(row["bins"], dtype=spec.dtype).reshape(len(self.ids), len(spec.sizes))
        self.margins = None if row["margins"] is None else np.frombuffer(row["margins"], dtype=np.float64).reshape(-1, len(self.ids))

    def margin(self, member: Member, recent: Ensemble) -> np.ndarray:
        start = np.full(len(self.ids), member.base) if self.margins is None else self.margins[member.place]
        return start + recent.sums(self.bins)


class Plan:
    """What a job needs: the trees being grown, their models, and the trees that the written margins lack.

    Whole trees that draw from the rows of one fold go in ``bundles``, so many a fold: the rows are sent once for all trees of one.
    """

    def __init__(self, units: list[Unit], members: list[Member], specs: dict[int, BinSpec], rounds_at_once: int = ROUNDS_AT_ONCE, bundles: int = 0):
        self.units, self.specs, self.rounds_at_once = units, specs, rounds_at_once
        whole: dict[int, list[int]] = {}
        for number, unit in enumerate(units):
            if bundles and not unit.rule.settings.boosting and unit.open.get(1):
                whole.setdefault(unit.fold, []).append(number)
        self.bundles = {numbers[i]: numbers[i::bundles] for numbers in whole.values() for i in range(min(bundles, len(numbers)))}
        self.bundled = {number for numbers in self.bundles.values() for number in numbers[1:]}
        self.members = {m.number: m for m in members if any(u.model == m.number for u in units)}
        self.recent = {k: Ensemble(m.trees[m.since:]) if m.settings.boosting else None for k, m in self.members.items()}
        for k, m in list(self.members.items()):  # tasks need no older trees
            self.members[k] = Member(m.number, m.fold, m.place, m.settings, m.base, m.weights, m.held_from, losses=m.losses)

    def places(self, tasks: int) -> dict[tuple[int, int], int]:
        """Task of each open node: dealt out from the largest on, so that none gets several while another has none."""
        nodes = [(unit.nodes.totals[p][2], number, p) for number, unit in enumerate(self.units) if number not in self.bundled for p in unit.open]
        return {(number, p): i % tasks for i, (_, number, p) in enumerate(sorted(nodes, key=lambda x: (-x[0], x[1:])))}

    def emitted(self, blocks) -> Iterator[dict]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for row in blocks:
            spec = self.specs[row["fold"]]
            block = Block(row, spec)
            margins: dict[int, np.ndarray] = {}
            for number, unit in enumerate(self.units):
                if unit.fold != row["fold"] or number in self.bundled:
                    continue
                member = self.members[unit.model]
                if number in self.bundles:
                    yield {"unit": number, "path": 1, "kind": _BUNDLE, "left": row["bins"],
                           "right": np.column_stack([block.ids, block.y.astype(np.int64)]).tobytes()}
                    continue
                if member.settings.boosting and unit.model not in margins:
                    margins[unit.model] = block.margin(member, self.recent[unit.model])
                margin = margins.get(unit.model)
                if member.settings.boosting and unit.open.get(1):
                    yield {"unit": number, "path": 1, "kind": _MODEL, "left": block.bins.tobytes(),
                           "right": np.column_stack([block.ids, block.y, margin]).tobytes()}
                    continue
                rows, stats = row_stats(member, unit.rule, block.ids, block.y, margin)
                bins = block.bins[rows]
                path = place_rows(unit.nodes, bins, np.ones(len(rows), dtype=np.int64))
                for p, local in unit.open.items():
                    inside = np.flatnonzero(path == p) if p > 1 else np.arange(len(rows))
                    if not len(inside):
                        continue
                    if local:
                        yield {"unit": number, "path": p, "kind": _ROWS, "left": bins[inside].tobytes(),
                               "right": stats[inside, :2].astype(np.int64).tobytes()}
                        continue
                    features, categories = unit.rule.candidates(spec, np.array([p]))
                    key, sums = cells(bins[inside], stats[inside], np.zeros(len(inside), dtype=np.int64), features, categories, spec.width)
                    table = held.setdefault((number, p), np.zeros((features.shape[1] * spec.width, 3)))
                    table[key] += sums
        for (number, p), table in held.items():
            yield {"unit": number, "path": p, "kind": _HISTOGRAM, "left": b"", "right": table.tobytes()}

    def reduced(self, number: int, path: int, kind: int, batches: Iterator[pa.RecordBatch]) -> bytes:
        unit = self.units[number]
        spec = self.specs[unit.fold]
        if kind in (_ROWS, _MODEL, _BUNDLE):
            lefts, rights = [], []
            for batch in batches:
                lefts += [np.frombuffer(x, dtype=spec.dtype) for x in batch.column("left").to_pylist()]
                rights += [np.frombuffer(x, dtype=np.float64 if kind == _MODEL else np.int64) for x in batch.column("right").to_pylist()]
            bins = np.concatenate(lefts).reshape(-1, len(spec.sizes))
            if kind == _MODEL:
                order = np.argsort(np.concatenate(rights).reshape(-1, 3)[:, 0])
                ids, y, margin = np.concatenate(rights).reshape(-1, 3)[order].T
                return pickle.dumps(self.rounds(unit, bins[order], ids.astype(np.int64), y, margin.copy()))
            if kind == _BUNDLE:
                return pickle.dumps(self.bundle(self.bundles[number], bins, *np.concatenate(rights).reshape(-1, 2).T))
            stats = np.concatenate(rights).reshape(-1, 2).astype(np.float64)
            branch = grow(bins, np.column_stack([stats, np.ones(len(stats))]), path, unit.rule, spec)
            return pickle.dumps((flat_tree(branch, unit.rule) if path == 1 else branch, unit.rule.classes))
        total = None
        for batch in batches:
            for x in batch.column("right").to_pylist():
                part = np.frombuffer(x, dtype=np.float64)
                total = part.copy() if total is None else total + part
        table = total.reshape(-1, 3)
        features, categories = unit.rule.candidates(spec, np.array([path]))
        totals = unit.nodes.totals.get(path)
        if totals is None or totals[2] < 0 or path == 1:  # the root's sums are not known before
            totals = table.reshape(features.shape[1], spec.width, 3)[0].sum(axis=0)
        unit.rule.balance(totals)
        key = np.flatnonzero(table[:, 2])
        split = best_splits(unit.rule, spec, key, table[key], totals[None], features, categories)
        return pickle.dumps((totals, split, unit.rule.classes))


    def bundle(self, numbers: list[int], bins: np.ndarray, ids: np.ndarray, y: np.ndarray) -> list[tuple[int, bytes]]:
        """(unit, its tree) of whole trees that draw from the same rows."""
        units, spec = [self.units[number] for number in numbers], self.specs[self.units[numbers[0]].fold]
        lines = Lines(bins.T, spec, joint=any(u.rule.settings.node_columns is None for u in units))
        out = []
        for number, unit in zip(numbers, units):
            rows, stats = row_stats(self.members[unit.model], unit.rule, ids, y.astype(np.float64), None)
            branch = grow(bins, stats, 1, unit.rule, spec, lines, rows)
            out.append((number, pickle.dumps((flat_tree(branch, unit.rule), unit.rule.classes))))
        return out

    def rounds(self, unit: Unit, bins: np.ndarray, ids: np.ndarray, y: np.ndarray, margin: np.ndarray) -> tuple[list, list, bool]:
        """(trees, losses before each, has the model ended?): the next trees of a model whose rows are all here."""
        member, spec = self.members[unit.model], self.specs[unit.fold]
        trees, losses, lines = [], [], Lines(bins.T, spec)
        for tree in range(unit.rule.tree, min(unit.rule.tree + self.rounds_at_once, member.settings.trees)):
            if member.settings.patience:
                total, weight = held_back_loss(member, ids, y, margin)
                losses.append(float(total / weight) if weight else math.nan)
                if no_longer_better([*member.losses, *losses], member.settings.patience):
                    return trees, losses, True
            rule = Rule(member.settings, tree)
            rows, stats = row_stats(member, rule, ids, y, margin)
            trees.append(flat_tree(grow(bins, stats, 1, rule, spec, lines, None if len(rows) == len(bins) else rows), rule))
            margin += leaf_values(trees[-1], lines.bins)
        return trees, losses, unit.rule.tree + len(trees) >= member.settings.trees


def run_step(blocks: DataFrame, plan: Plan, tasks: int) -> list:
    """One job: histograms or rows of all open nodes, grouped by node, to splits or branches: (unit, path, kind, result) of each."""
    shared = blocks.sparkSession.sparkContext.broadcast(plan)
    places = plan.places(tasks)

    def emit(batches):
        for row in shared.value.emitted(r for batch in batches for r in batch.to_pylist()):
            row["task"] = places.get((row["unit"], row["path"]), row["unit"] % tasks)
            yield pa.RecordBatch.from_pylist([row], schema=_arrow_schema(_EMITTED))

    def reduce(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, unit, path, kind = (k.as_py() for k in key)
        result = shared.value.reduced(unit, path, kind, batches)
        yield pa.RecordBatch.from_pylist([{"unit": unit, "path": path, "kind": kind, "result": result}], schema=_arrow_schema(_RESULT))

    emitted = blocks.mapInArrow(emit, _EMITTED).repartitionById(tasks, F.col("task"))
    out = emitted.groupBy("task", "unit", "path", "kind").applyInArrow(reduce, _RESULT).collect()
    shared.destroy()
    alone = [r.asDict() for r in out if r["kind"] != _BUNDLE]
    return alone + [{"unit": number, "path": 1, "kind": _ROWS, "result": tree}
                    for r in out if r["kind"] == _BUNDLE for number, tree in pickle.loads(r["result"])]


def advance(unit: Unit, results: list, local_rows: int) -> tuple[list[tuple], list[float], bool]:
    """Enter a job's results into the tree; returns finished trees, losses, and whether the model has ended."""
    trees, losses, ended, children = [], [], False, []
    for r in results:
        result = pickle.loads(r["result"])
        if r["kind"] == _MODEL:
            trees, losses, ended = result
        elif r["kind"] == _ROWS:
            branch, classes = result
            unit.rule.classes = unit.rule.classes or classes
            if r["path"] == 1:
                trees.append(branch)
            else:
                unit.nodes.splits.update(branch.splits)
                unit.nodes.totals.update(branch.totals)
        else:
            totals, split, classes = result
            unit.rule.classes = unit.rule.classes or classes
            unit.nodes.totals[r["path"]] = totals
            children += unit.nodes.add(np.array([r["path"]]), split)
    unit.decide(unit.nodes.worth_opening(children, unit.rule.settings, 1), local_rows)
    if not unit.open and not trees and not ended:
        unit.rule.balance(unit.nodes.totals[1])
        trees.append(flat_tree(unit.nodes, unit.rule))
    return trees, losses, ended


def no_longer_better(losses: Sequence[float], patience: int, tolerance: float = 1e-7) -> bool:
    """True once none of the last ``patience`` losses is below the one before them."""
    return len(losses) > patience and min(losses[-patience:]) > losses[-patience - 1] - tolerance


def _weights_of(settings: TreeSettings, spec: BinSpec) -> tuple[float, float]:
    n, pos = float(spec.rows), float(spec.positives)
    neg = n - pos
    if settings.late_weight == "balanced":
        return (n / (2 * pos) if pos else 1.0), (n / (2 * neg) if neg else 1.0)
    if settings.late_weight == "scale":
        return (neg / pos if pos else 1.0), 1.0
    return float(settings.late_weight), 1.0


def _members(tasks: Sequence[tuple[TreeSettings, int]], specs: dict[int, BinSpec]) -> list[Member]:
    places: dict[int, int] = {}
    out = []
    for number, (settings, fold) in enumerate(tasks):
        spec = specs[fold]
        late, on_time = _weights_of(settings, spec)
        positive, negative = late * spec.positives, on_time * (spec.rows - spec.positives)
        base = math.log(max(positive, 1e-9) / max(negative, 1e-9)) if settings.boosting else 0.0
        held = int(spec.last * (1 - HELD_BACK)) + 1 if settings.patience else np.iinfo(np.int64).max
        place = places.get(fold, 0)
        if settings.boosting:
            places[fold] = place + 1
        out.append(Member(number, fold, place, settings, base, (late, on_time), held))
    return out


def _kept(spark: SparkSession, path: str, tasks: int) -> DataFrame:
    return spark.read.schema(_BLOCK).parquet(path).repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)


def _written(spark: SparkSession, frame: DataFrame) -> str:
    path = scratch_path(spark, "tree-blocks")
    frame.write.parquet(path)
    return path


def _with_margins(blocks: DataFrame, members: list[Member], specs: dict[int, BinSpec]) -> DataFrame:
    """Blocks whose margins hold all finished trees."""
    by_fold: dict[int, list[tuple[Member, Ensemble]]] = {}
    for m in members:
        if m.settings.boosting:
            by_fold.setdefault(m.fold, []).append((Member(m.number, m.fold, m.place, m.settings, m.base, m.weights, m.held_from),
                                                   Ensemble(m.trees[m.since:])))
    shared = blocks.sparkSession.sparkContext.broadcast(by_fold)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, specs[row["fold"]])
                margins = [block.margin(m, e) for m, e in shared.value.get(row["fold"], [])]
                yield pa.RecordBatch.from_pylist([{**row, "margins": np.stack(margins).tobytes() if margins else None}], schema=_arrow_schema(_BLOCK))

    return blocks.mapInArrow(run, _BLOCK)


# --- boosted models whose rows lie in many tasks -------------------------------------------------------------


class Growth:
    """The next tree of a spread model: the driver holds a histogram for each open node, however many rows there are.

    Once the open nodes hold ``tail`` rows or fewer, these are sent on, and a task grows the rest of each branch.
    """

    def __init__(self, member: Member, spec: BinSpec, tail: int):
        self.member, self.spec, self.tail, self.last = member, spec, tail, False
        self.rule, self.nodes, self.tables = Rule(member.settings, len(member.trees)), Nodes(), Tables(spec)
        self.paths = self.wanted = [1]

    def enter(self, counted: dict) -> tuple | None:
        """Split the open nodes by their tables; the tree once it is finished, else ``wanted`` has the nodes to count next."""
        if self.last:
            for branch in counted.values():
                self.nodes.splits.update(branch.splits)
                self.nodes.totals.update(branch.totals)
            return flat_tree(self.nodes, self.rule)
        if self.paths == [1]:
            self.nodes.totals[1] = counted[1][: self.tables.cells].sum(axis=0)
        opened = []
        if self.paths != [1] or self.nodes.totals[1][2] >= 2 * max(1, self.rule.settings.min_rows):
            paths = np.array(self.paths, dtype=np.int64)
            totals = np.stack([self.nodes.totals[p] for p in self.paths])
            key, sums = self.tables.entered(self.paths, counted)
            split = best_splits(self.rule, self.spec, key, sums, totals, *self.rule.candidates(self.spec, paths))
            opened = self.nodes.worth_opening(self.nodes.add(paths, split), self.rule.settings, 1)
        if not opened:
            return flat_tree(self.nodes, self.rule)
        self.paths = sorted(opened)
        self.last = sum(self.nodes.totals[p][2] for p in opened) <= self.tail
        self.wanted = self.paths if self.last else self.tables.wanted(self.paths, self.nodes.totals)
        return None


def rows_of(nodes: dict[int, tuple], wanted: Sequence[int], bins: np.ndarray, rows: np.ndarray) -> dict[int, np.ndarray]:
    """The ``rows`` that lie in each of the ``wanted`` nodes, going down their branches only; ``bins`` has a line a feature."""
    above = {p >> k for p in wanted for k in range(p.bit_length())}
    held, out = {1: rows}, {}
    for p in sorted(above):
        if p in wanted:
            out[p] = held.pop(p)
            continue
        f, equal, cut = nodes[p][:3]
        here = held.pop(p)
        b = bins[f, here]
        left = b == cut if equal else b <= cut
        for child, side in ((2 * p, left), (2 * p + 1, ~left)):
            if child in above:
                held[child] = here[side]
    return out


def leaf_values(tree: tuple, bins: np.ndarray) -> np.ndarray:
    """Each row's value in a finished tree; ``bins`` has a line a feature."""
    feature, equal, cut, left, right, value = tree[:6]
    out, open_ = np.zeros(bins.shape[1]), [(0, np.arange(bins.shape[1]))]
    while open_:
        i, rows = open_.pop()
        if left[i] == i:
            out[rows] = value[i]
            continue
        b = bins[feature[i], rows]
        side = b == cut[i] if equal[i] else b <= cut[i]
        open_ += [(left[i], rows[side]), (right[i], rows[~side])]
    return out


class SpreadRows:
    """The rows of one fold in one partition: bins with a line a feature, and a margin for each model."""

    def __init__(self, fold: int, ids: np.ndarray, y: np.ndarray, lines: Lines, margins: dict[int, np.ndarray]):
        self.fold, self.ids, self.y, self.lines, self.margins = fold, ids, y, lines, margins

    def counted(self, growths: dict[int, tuple], specs: dict[int, BinSpec]) -> Iterator[tuple[tuple[int, int], np.ndarray | list]]:
        """((model, node), table) of the nodes wanted, or their rows; with a root also (model, 0): the loss of the rows held back."""
        y = self.y.astype(np.float64)
        for number, (member, tree, nodes, wanted, last) in growths.items():
            if member.fold != self.fold:
                continue
            margin = self.margins[number]
            if 1 in wanted and member.settings.patience:
                yield (number, 0), held_back_loss(member, self.ids, y, margin)
            rows, stats = row_stats(member, Rule(member.settings, tree), self.ids, y, margin)
            place = None if len(rows) == 0 or rows[-1] < len(rows) else rows  # rows held back lie last
            tables = LevelTables(None, stats, specs[self.fold], self.lines, place)
            bins = tables.bins[:, : len(rows)] if place is None else np.take(tables.bins, rows, axis=1)
            for p, inside in rows_of(nodes, wanted, bins, np.arange(len(rows))).items():
                yield (number, p), [(bins[:, inside], stats[inside])] if last else tables.table(inside)

    def grown(self, finished: dict[int, tuple]) -> "SpreadRows":
        """The same rows with the trees just finished in their margins; models that have ended are dropped."""
        margins = {k: m + leaf_values(finished[k], self.lines.bins) for k, m in self.margins.items() if k in finished}
        return SpreadRows(self.fold, self.ids, self.y, self.lines, margins)


def spread_rows(blocks: DataFrame, members: list[Member], specs: dict[int, BinSpec], parts: int) -> RDD:
    """The blocks of the members' folds, put together by partition and fold."""
    bases = {f: {m.number: m.base for m in members if m.fold == f} for f in {m.fold for m in members}}

    def put_together(rows):
        held: dict[int, list[Block]] = {}
        for row in rows:
            held.setdefault(row["fold"], []).append(Block(row, specs[row["fold"]]))
        for fold, some in held.items():
            ids = np.concatenate([b.ids for b in some])
            order = np.argsort(ids)  # rows held back lie last
            ids = ids[order]
            yield SpreadRows(fold, ids, np.concatenate([b.y for b in some])[order].astype(np.uint8),
                             Lines(np.concatenate([b.bins for b in some])[order].T, specs[fold], joint=False), {k: np.full(len(ids), x) for k, x in bases[fold].items()})

    return blocks.filter(F.col("fold").isin(list(bases))).repartition(parts).rdd.mapPartitions(put_together)


def grow_spread(spark: SparkSession, blocks: DataFrame, members: list[Member], specs: dict[int, BinSpec], tail: int) -> None:
    """Fit boosted models whose rows are too many for a task: a round grows a tree of each, a job adds up the histograms of a level.

    The rows stay where they are, with their margins, which a round brings up to date as it counts the roots; lost ones are reckoned
    again from the margins last written.
    """
    shared_dir(spark)
    cores = max(1, spark.sparkContext.defaultParallelism)
    rows = spread_rows(blocks, members, specs, max(cores, -(-sum(specs[f].rows for f in {m.fold for m in members}) // SPREAD_ROWS)))
    rows.persist(StorageLevel.MEMORY_AND_DISK_DESER)
    growing = {m.number: m for m in members}
    finished: dict[int, tuple] = {}
    round_ = 0
    try:
        while growing:
            before = None
            if finished:
                fresh = {k: t for k, t in finished.items() if k in growing}
                before, rows = rows, rows.map(lambda r, fresh=fresh: r.grown(fresh)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
                if round_ % CHECKPOINT_TREES == 0:
                    rows.checkpoint()
            growths = {k: Growth(m, specs[m.fold], tail) for k, m in growing.items()}
            finished = {}
            while growths:
                asked = {k: (bare(g.member), g.rule.tree, g.nodes.splits, g.wanted, g.last) for k, g in growths.items()}
                found: dict[int, dict] = {}
                for (k, p), table in _added_up(rows, asked, specs, cores):
                    found.setdefault(k, {})[p] = table
                if before is not None:
                    before.unpersist()
                    before = None
                for k, g in list(growths.items()):
                    m, loss = g.member, found[k].pop(0, None)
                    if loss is not None:
                        m.losses.append(float(loss[0] / loss[1]) if loss[1] else math.nan)
                        if no_longer_better(m.losses, m.settings.patience):
                            del growths[k], growing[k]
                            continue
                    tree = g.enter(found[k])
                    if tree is not None:
                        finished[k] = tree
                        m.trees.append(tree)
                        del growths[k]
                        if len(m.trees) >= m.settings.trees:
                            del growing[k]
            round_ += 1
    finally:
        rows.unpersist()


def _added_up(rows: RDD, asked: dict[int, tuple], specs: dict[int, BinSpec], cores: int) -> list[tuple[tuple[int, int], np.ndarray | Nodes]]:
    """Tables by (model, node), summed over the partitions by the tasks, or the branches grown from the rows of all partitions."""
    def branch(item):
        (number, p), found = item
        if isinstance(found, list):
            member, tree, *_ = asked[number]
            bins, stats = (np.concatenate(parts, axis=axis) for parts, axis in zip(zip(*found), (1, 0)))
            found = grow(bins.T, stats, p, Rule(member.settings, tree), specs[member.fold])
        return (number, p), found

    nodes = sum(len(wanted) for _, _, _, wanted, _ in asked.values())
    return rows.flatMap(lambda r: r.counted(asked, specs)).reduceByKey(operator.add, min(cores, nodes)).map(branch).collect()


def bare(m: Member) -> Member:
    """A member without its trees: what tasks are sent."""
    return Member(m.number, m.fold, m.place, m.settings, m.base, m.weights, m.held_from)


def grow_all(spark: SparkSession, blocks: str, tasks: Sequence[tuple[TreeSettings, int]], specs: dict[int, BinSpec],
             local_rows: int = LOCAL_ROWS, rounds_at_once: int = ROUNDS_AT_ONCE, units_at_once: int = 512) -> list[Member]:
    """Fit a model for each (settings, fold) on the written blocks. Boosted models take one tree at a time each, the others all trees at once,
    in waves of ``units_at_once`` trees and about WAVE_ROWS rows, so that what a job sends and the driver holds unfinished stays bounded."""
    members = _members(tasks, specs)
    quiet = spark.newSession()  # settings of these small jobs leave the caller's alone
    quiet.conf.set("spark.sql.adaptive.enabled", "false")
    quiet.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    cores = max(1, spark.sparkContext.defaultParallelism)
    kept = _kept(quiet, blocks, cores)

    def unit(m: Member, tree: int) -> Unit:
        u = Unit(m.number, m.fold, Rule(m.settings, tree))
        spec = specs[m.fold]
        u.nodes.totals[1] = np.array([0.0, 0.0, min(spec.rows, m.held_from - 1)])
        u.decide([1], local_rows)
        return u

    boosted = [m for m in members if m.settings.boosting and m.settings.trees > 0]
    growing = {m.number: u for m in boosted if (u := unit(m, 0)).open[1]}
    spread = [m for m in boosted if m.number not in growing]
    if spread:
        grow_spread(spark, quiet.read.schema(_BLOCK).parquet(blocks), spread, specs, min(local_rows, TAIL_ROWS))
    waiting = [(m, t) for m in members if not m.settings.boosting for t in range(m.settings.trees)][::-1]
    wave: list[Unit] = []
    done: dict[int, dict[int, tuple]] = {}  # trees of the models that take all at once, which end in any order
    try:
        while growing or waiting or wave:
            rounds = all(u.open.get(1) for u in growing.values())  # tasks of many rounds each: other trees grow beside them
            while waiting and rounds and len(wave) < units_at_once and (
                    len(wave) < cores or sum(specs[u.fold].rows / (4 if u.open.get(1) else 1) for u in wave) < WAVE_ROWS):
                wave.append(unit(*waiting.pop()))
            units = [*growing.values(), *wave]
            bundles = max(1, 2 * cores // max(1, len({u.fold for u in wave})))
            results: dict[int, list] = {}
            for r in run_step(kept, Plan(units, members, specs, rounds_at_once, bundles), min(4 * cores, max(cores, len(units)))):
                results.setdefault(r["unit"], []).append(r)
            still = []
            for number, u in enumerate(units):
                m = members[u.model]
                trees, losses, ended = advance(u, results.get(number, []), local_rows)
                m.losses += losses
                if not m.settings.boosting:
                    done.setdefault(u.model, {}).update({u.rule.tree: t for t in trees})
                    still += [u] if u.open else []
                    continue
                m.trees += trees
                if ended or len(m.trees) >= m.settings.trees:
                    del growing[m.number]
                elif trees:
                    growing[m.number] = unit(m, len(m.trees))
            wave = still
            if growing and max(len(m.trees) - m.since for m in members if m.number in growing) >= CHECKPOINT_TREES:
                fresh = _kept(quiet, _written(spark, _with_margins(kept, members, specs)), cores)
                kept.unpersist()
                kept = fresh
                for m in members:
                    m.since = len(m.trees)
    finally:
        kept.unpersist()
    for m in members:
        m.trees = m.trees if m.settings.boosting else [done[m.number][t] for t in range(m.settings.trees)]
    return members


# --- fitted models -------------------------------------------------------------------------------------------


class TreeModel:
    """A fitted ensemble with its binning; scores rows, keeps its importances, is saved as a Parquet table."""

    def __init__(self, spec: BinSpec, settings: TreeSettings, base: float, trees: Sequence[tuple], losses: Sequence[float] = ()):
        self.spec, self.settings, self.base, self.losses, self.ensemble = spec, settings, base, list(losses), Ensemble(trees)
        e, starts = self.ensemble, np.cumsum([0, *(len(t[0]) for t in trees)])
        # features, kinds and values are held once, by the ensemble
        self.trees = [(e.feature[lo:hi], e.equal[lo:hi], *t[2:5], e.value[lo:hi], *t[6:]) for t, lo, hi in zip(trees, starts, starts[1:])]

    @property
    def n_trees(self) -> int:
        return len(self.ensemble.roots)

    def for_scoring(self) -> "TreeModel":
        """The model without its trees as single arrays: what tasks are sent."""
        out = copy.copy(self)
        out.trees = []
        return out

    def probabilities(self, bins: np.ndarray) -> np.ndarray:
        total = self.ensemble.sums(bins)
        return logistic(self.base + total) if self.settings.boosting else total / max(1, self.n_trees)

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a ``probability`` vector of both classes; the other columns do not leave the JVM."""
        model = self.for_scoring()

        @F.arrow_udf("double")
        def score(*columns: pa.Array) -> pa.Array:
            return pa.array(model.probabilities(model.spec.bins(columns)))

        p = score(*[F.col(c).cast("double") if c in self.spec.edges else F.col(c) for c in self.spec.inputs])
        return rows.withColumn("_p", p).withColumn("probability", array_to_vector(F.array(1 - F.col("_p"), F.col("_p")))).drop("_p")

    def importances(self) -> list[tuple[str, float]]:
        """Share of the gain of all splits by column."""
        at = {c: i for i, c in enumerate(self.spec.columns)}
        total = np.zeros(len(at))
        for feature, equal, cut, left, _, _, _, gain in self.trees:
            inner = np.flatnonzero(left != np.arange(len(left)))
            for i in inner.tolist():
                total[at[(int(feature[i]), int(cut[i]) if equal[i] else -1)]] += gain[i]
        return list(zip(self.spec.names(), (total / (total.sum() or 1.0)).tolist()))

    def save(self, spark: SparkSession, path: str) -> str:
        spec = self.spec
        head = json.dumps({
            "edges": {c: e.tolist() for c, e in spec.edges.items()}, "medians": spec.medians, "gaps": spec.gaps,
            "categories": spec.categories, "modes": spec.modes, "rows": spec.rows, "positives": spec.positives, "last": spec.last,
            "settings": asdict(self.settings), "base": self.base, "losses": self.losses})
        rows = [(-1, head, None, None, None, None, None, None, None, 0, None)]
        rows += [(i, None, *[x.tolist() for x in t[:6]], t[7].tolist(), int(t[6]), None) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, _SAVED).repartition(1).sortWithinPartitions("tree").write.mode("overwrite").parquet(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TreeModel":
        rows = spark.read.parquet(path).orderBy("tree").collect()
        if not rows or rows[0]["tree"] != -1:
            raise ContractError(f"no tree model in {path}")
        head = json.loads(rows[0]["head"])
        spec = BinSpec({c: np.array(e) for c, e in head["edges"].items()}, head["medians"], head["gaps"], head["categories"],
                       head["modes"], head["rows"], head["positives"], head["last"])
        kinds = [np.int16, bool, np.int32, np.int32, np.int32, np.float64]
        trees = [(*[np.array(r[c], dtype=k) for c, k in zip(_TREE_COLUMNS, kinds)], r["depth"], np.array(r["gain"])) for r in rows[1:]]
        return TreeModel(spec, TreeSettings(**head["settings"]), head["base"], trees, head["losses"])


_TREE_COLUMNS = ["feature", "equal", "cut", "left", "right", "value"]
_SAVED = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("head", T.StringType()),
    T.StructField("feature", T.ArrayType(T.IntegerType())), T.StructField("equal", T.ArrayType(T.BooleanType())),
    T.StructField("cut", T.ArrayType(T.IntegerType())), T.StructField("left", T.ArrayType(T.IntegerType())),
    T.StructField("right", T.ArrayType(T.IntegerType())), T.StructField("value", T.ArrayType(T.DoubleType())),
    T.StructField("gain", T.ArrayType(T.DoubleType())), T.StructField("depth", T.IntegerType()), T.StructField("note", T.StringType()),
])


def fit_trees(ranked: DataFrame, folds: Sequence, settings: Sequence[TreeSettings], local_rows: int = LOCAL_ROWS,
              rounds_at_once: int = ROUNDS_AT_ONCE) -> list[list[TreeModel]]:
    """For each fold, the models of all ``settings``, fitted together on the fold's training rows.

    ``ranked`` holds the features, the label and ``row_num``, the position from 1 on.
    """
    spark = ranked.sparkSession
    specs = fit_bins(ranked, folds)
    missing = [f.number for f in folds if f.number not in specs]
    if missing:
        raise ContractError(f"no training rows in folds {missing}")
    blocks = _written(spark, binned_blocks(ranked, folds, specs))
    tasks = [(s, f.number) for f in folds for s in settings]
    members = grow_all(spark, blocks, tasks, specs, local_rows, rounds_at_once)
    models = [TreeModel(specs[m.fold], m.settings, m.base, m.trees, m.losses) for m in members]
    return [models[i * len(settings): (i + 1) * len(settings)] for i in range(len(folds))]


def score_many(rows: DataFrame, models: dict[str, TreeModel], keep: Sequence[str], name: str = "config_id") -> DataFrame:
    """``keep`` columns, the model's name and ``probability``: all models of one binning score a row in one pass."""
    spec = next(iter(models.values())).spec
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField(name, T.StringType()), T.StructField("probability", T.DoubleType())])
    shared = rows.sparkSession.sparkContext.broadcast({label: m.for_scoring() for label, m in models.items()})

    def run(batches):
        for batch in batches:
            bins = spec.bins([batch.column(len(keep) + i) for i in range(len(spec.inputs))])
            for label, model in shared.value.items():
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i) for i in range(len(keep))], pa.array([label] * batch.num_rows, pa.string()),
                     pa.array(model.probabilities(bins))], names=[*keep, name, "probability"])

    return rows.select(*keep, *[F.col(c).alias(f"_{c}") for c in spec.inputs]).mapInArrow(run, schema)

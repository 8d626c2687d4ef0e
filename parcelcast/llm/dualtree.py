"""Ranked lexical search: a dual tree over items and documents, exact.

A document is a vector over the terms of the items; a coordinate is the term's weight times its saturated frequency, so
that a score is the dot product with the item's term counts. Both sides are arranged in trees whose nodes hold the
maximum of every coordinate below them. The dot product of two nodes bounds the score of every item below the one with every
document below the other. If it stays under the weakest k-th score of the node's items, the whole batch is left out; pairs of
leaves are scored exactly. No document is skipped that could still be listed, so results equal those of scoring all pairs.

Spark's part: one pass turns whole texts into stored vectors and counts document frequencies, a second lets every task build
trees over its own documents, a batch at a time, and walk them against the items' tree. A first search over a share of the
documents (by a hash) gives each item a score that its k-th best document reaches at least; with it, tasks send on little. The
bound only saves work. Items are taken in blocks of a bounded number of terms; each block is one pass over the vectors.

Scores are whole numbers below 2**53, computed in doubles without rounding (checked, else in 64-bit integers).

Rows of ``docs`` are documents: rows that share an id are ranked one by one, equal rows too. A null id stays null and comes
after all others on ties. Null and empty texts have no terms and are listed nowhere; an item without terms has no rows. Items
of equal id and text count once; an id with several texts is ranked for each of them. Very long texts are read whole.
Without documents or items there are no rows. Other columns are ignored, whatever their names. Terms are known by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from parcelcast.llm.common import Words, _offsets, bound_batches, slices, store, table

K = 20
BLOCK_TERMS = 1 << 16  # terms (with repeats) of the items searched in one pass
FIRST_SHARE = 32  # one document in so many is searched first
DOCS_PER_TREE, DOCS_PER_LEAF, ITEMS_PER_LEAF, FANOUT = 2048, 16, 4, 4
DENSE_CELLS = 1 << 22  # documents x terms of one tree
LAST = np.iinfo(np.int64).max
SALTS = 64

_TERM_BYTE = np.zeros(256, dtype=bool)
_TERM_BYTE[0x30:0x3A] = _TERM_BYTE[0x41:0x5B] = _TERM_BYTE[0x61:0x7B] = _TERM_BYTE[0x80:] = True


class Terms(Words):
    """Terms in place of words: runs of ASCII letters, digits and all characters beyond ASCII, A to Z lower-cased."""

    def __init__(self, texts: pa.Array):
        offsets = _offsets(texts)
        raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0]: offsets[-1]]
        offsets = offsets - offsets[0]
        inside = _TERM_BYTE[raw]
        raw = raw + ((raw - np.uint8(65)) < 26).astype(np.uint8) * np.uint8(32)
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = offsets[:-1][offsets[:-1] < len(raw)]
        before[edges] = False
        after[edges[edges > 0] - 1] = False
        self.raw, self.offsets = raw, offsets
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.bounds = np.searchsorted(self.start, offsets)
        self.hash = self._hashes()


def term_weight(documents: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


# --- documents as stored vectors


def vectors(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, n and, as packed 32-bit numbers, the vocabulary's terms in the document and how often each occurs.

    ``vocabulary``: sorted hashes. Documents without any term are left out.
    """
    def run(batches):
        for batch, texts in slices(batches):
            terms = Terms(texts)
            owner = np.repeat(np.arange(len(texts)), np.diff(terms.bounds))
            at = np.minimum(np.searchsorted(vocabulary, terms.hash), max(0, len(vocabulary) - 1))
            known = vocabulary[at] == terms.hash if len(vocabulary) else np.zeros(len(at), dtype=bool)
            pairs, tf = np.unique(owner[known] * max(1, len(vocabulary)) + at[known], return_counts=True)
            held, ids = np.divmod(pairs, max(1, len(vocabulary)))
            edges = np.searchsorted(held, np.arange(len(texts) + 1))
            ids, tf = ids.astype(np.int32), tf.astype(np.int32)
            n, rows = np.diff(terms.bounds), [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]
            full = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n.astype(np.int64)), pa.array([ids[r].tobytes() for r in rows], pa.binary()),
                 pa.array([tf[r].tobytes() for r in rows], pa.binary())], names=["doc_id", "n", "terms", "tf"])
            yield full.filter(pa.array(n > 0))

    return bound_batches(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, n long, terms binary, tf binary")


def corpus_counts(stored: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """(documents, terms with repeats, documents holding each vocabulary term)."""
    documents, total = stored.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()

    def run(batches):
        held = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                held[np.frombuffer(ids, dtype=np.int32)] += 1
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], names=["term", "held"])

    out = np.zeros(size, dtype=np.int64)
    counted = stored.select("terms").mapInArrow(run, "term long, held long").groupBy("term").agg(F.sum("held").alias("held"))
    for row in counted.toLocalIterator():  # one row per vocabulary term
        out[row["term"]] = row["held"]
    return documents, total, out


# --- trees


def kd_order(points: np.ndarray, leaf: int) -> np.ndarray:
    """Order in which neighbours stand together: halved at the median of the widest coordinate until ``leaf`` are left."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        own = todo.pop()
        if len(own) <= leaf:
            out.append(own)
            continue
        axis = int(np.argmax(points[own].var(axis=0)))
        own = own[np.argsort(points[own, axis], kind="stable")]
        half = -(-len(own) // (2 * leaf)) * leaf
        todo += [own[half:], own[:half]]
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


class Tree:
    """Rows in an order of their own, and levels of nodes with the maxima of their coordinates, leaves first."""

    def __init__(self, rows: np.ndarray, leaf: int):
        sketch = np.random.default_rng(5).standard_normal((rows.shape[1], 24))
        scale = np.maximum(1.0, rows.max(axis=0, initial=0))
        self.order = kd_order((rows / scale) @ sketch, leaf)
        self.rows, self.leaf = rows[self.order], leaf
        level = np.maximum.reduceat(self.rows, np.arange(0, len(rows), leaf), axis=0)
        self.levels = [level]
        while len(level) > 1:
            level = np.maximum.reduceat(level, np.arange(0, len(level), FANOUT), axis=0)
            self.levels.append(level)

    def below(self, level: int, node: int) -> slice:
        """The nodes of the level under ``level`` (rows under the leaves) that a node holds."""
        step, size = (FANOUT, len(self.levels[level - 1])) if level else (self.leaf, len(self.rows))
        return slice(node * step, min(size, (node + 1) * step))


class Items:
    """A block of items as a tree over its own terms; small enough to be sent to every task."""

    def __init__(self, names: list, counts: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray):
        self.terms = np.unique(np.concatenate([ids for ids, _ in counts]))  # ids in the whole vocabulary
        rows = np.zeros((len(names), len(self.terms)))
        for i, (ids, c) in enumerate(counts):
            rows[i, np.searchsorted(self.terms, ids)] = c
        self.weight = weight[self.terms]
        self.tree = Tree(rows, ITEMS_PER_LEAF)
        self.names = [names[i] for i in self.tree.order]
        # a coordinate stays below 1,000,000 times the weight
        self.exact = float((rows * self.weight).sum(axis=1).max(initial=0)) * 1e6 < 2**53
        self.support = [[np.flatnonzero(node) for node in level] for level in self.tree.levels]
        self.maxima = [[node[s] for node, s in zip(level, sup)] for level, sup in zip(self.tree.levels, self.support)]


class Best:
    """The k best documents of each item so far, and the score below which none can enter."""

    def __init__(self, items: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, np.maximum(floor, 1).astype(np.float64)
        self.found = [np.zeros(0, np.int64) for _ in range(3)]  # item, score, id
        self.waiting, self.size = [], 0

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        self.waiting.append((item, score, doc))
        self.size += len(item)
        if self.size >= 8 * self.k * len(self.floor):
            self.settle()

    def settle(self) -> None:
        item, score, doc = (np.concatenate([f, *(w[i] for w in self.waiting)]) for i, f in enumerate(self.found))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        full = place == self.k - 1
        self.floor[item[full]] = np.maximum(self.floor[item[full]], score[full])
        keep = place < self.k
        self.found, self.waiting, self.size = [item[keep], score[keep], doc[keep]], [], 0


def walk(items: Items, docs: Tree, ids: np.ndarray, best: Best) -> int:
    """Score all pairs of leaves whose nodes' bounds reach the weakest floor; returns the pairs scored."""
    tree, scored = items.tree, 0
    todo = [(len(tree.levels) - 1, 0, len(docs.levels) - 1, np.zeros(1, dtype=np.int64))]
    while todo:
        q_level, q, r_level, nodes = todo.pop()
        span = ITEMS_PER_LEAF * FANOUT**q_level
        lo, hi = q * span, min(len(tree.rows), (q + 1) * span)
        support, maxima = items.support[q_level][q], items.maxima[q_level][q]
        bound = docs.levels[r_level][np.ix_(nodes, support)] @ maxima
        weakest = best.floor[lo:hi].min()
        open_ = bound >= (weakest if items.exact else weakest * (1 - 1e-9))
        nodes = nodes[open_]
        if not len(nodes):
            continue
        if q_level:  # split the items first: bounds of fewer items are tighter
            below = tree.below(q_level, q)
            todo += [(q_level - 1, c, r_level, nodes) for c in range(below.start, below.stop)]
        elif r_level:
            nodes = nodes[np.argsort(bound[open_])]  # the most promising last, so first off the stack
            for part in np.array_split(nodes, min(len(nodes), 4)):
                inner = np.concatenate([np.arange(s.start, s.stop) for s in (docs.below(r_level, int(r)) for r in part)])
                todo.append((0, q, r_level - 1, inner))
        else:
            rows = np.concatenate([np.arange(s.start, s.stop) for s in (docs.below(0, int(r)) for r in nodes)])
            left, right = tree.rows[lo:hi][:, support], docs.rows[np.ix_(rows, support)]
            if not items.exact:
                left, right = left.astype(np.int64), right.astype(np.int64)
            scores = left @ right.T
            scored += scores.size
            a, b = np.nonzero(scores >= best.floor[lo:hi, None])
            best.add(a + lo, scores[a, b].astype(np.int64), ids[docs.order[rows[b]]])
            if best.size >= 4 * best.k:
                best.settle()
    return scored


# --- search


def _tree_batches(batches, width: int):
    """(ids, n, [(terms, tf)]) of as many documents as make one tree."""
    most = max(DOCS_PER_LEAF, min(DOCS_PER_TREE, DENSE_CELLS // max(1, width)))
    held: list[tuple] = []
    for batch in batches:
        ids = batch.column(0).fill_null(LAST).to_numpy()
        n = batch.column(1).to_numpy()
        held += zip(ids.tolist(), n.tolist(), batch.column(2).to_pylist(), batch.column(3).to_pylist())
        while len(held) >= most:
            yield held[:most]
            held = held[most:]
    if held:
        yield held


def _search(stored: DataFrame, items: Items, documents: int, total: int, floor: np.ndarray, k: int) -> DataFrame:
    """number of the item, score and doc_id: at most ``k`` rows of each task and item, none below the item's floor."""
    def run(batches):
        best = Best(len(items.names), k, floor)
        place = {int(t): i for i, t in enumerate(items.terms)}
        lookup = np.full(max(place, default=0) + 1, -1)
        lookup[list(place)] = list(place.values())
        for held in _tree_batches(batches, len(items.terms)):
            rows = np.zeros((len(held), len(items.terms)))
            for i, (_, n, terms, tf) in enumerate(held):
                ids, tf = np.frombuffer(terms, dtype=np.int32), np.frombuffer(tf, dtype=np.int32).astype(np.int64)
                inside = ids < len(lookup)
                at = lookup[ids[inside]]
                tf, at = tf[inside][at >= 0], at[at >= 0]
                m = 100 - 25 + (25 * n * documents) // total
                rows[i, at] = items.weight[at] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))
            walk(items, Tree(rows, DOCS_PER_LEAF), np.array([h[0] for h in held], dtype=np.int64), best)
            best.settle()
        best.settle()
        item, score, doc = best.found
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(doc, mask=doc == LAST), pa.array(score)], names=["item", "doc_id", "score"])

    return stored.mapInArrow(run, "item long, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each item; a first cut within salted groups keeps an item's rows off a single task."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    cut = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).filter(F.col("rank") <= k)
    return cut.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)


def item_terms(items: DataFrame) -> list[tuple]:
    """(item_id, hashes, counts) of the distinct items with at least one term, block by block on the driver."""
    out = []
    rows = items.select("item_id", "text").filter("text is not null").distinct().orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        hashes, counts = np.unique(Terms(pa.array([row["text"]])).hash, return_counts=True)
        if len(hashes):
            out.append((row["item_id"], hashes, counts))
    return out


def search(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents with a score above 0 of every item.

    The items are the query set: their terms are read by the driver, ``block_terms`` of them are searched in a pass.
    """
    spark = docs.sparkSession
    queries = item_terms(items)
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    if not queries:
        return empty
    vocabulary = np.unique(np.concatenate([h for _, h, _ in queries]))
    stored = store(vectors(docs, vocabulary), "term-vectors")
    documents, total, held = corpus_counts(stored, len(vocabulary))
    if not documents:
        return empty
    weight = np.array([term_weight(documents, int(h)) for h in held], dtype=np.int64)
    blocks, room = [], 0
    for query in queries:
        if not blocks or room < len(query[1]):
            blocks.append([])
            room = block_terms
        blocks[-1].append(query)
        room -= len(query[1])
    sample = stored.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(FIRST_SHARE)) == 0)
    parts = []
    for block in blocks:
        tree = Items([q[0] for q in block], [(np.searchsorted(vocabulary, h), c) for _, h, c in block], weight)
        floor = np.zeros(len(block))
        first = _ranked(_search(sample, tree, documents, total, floor, k), k).filter(F.col("rank") == k)
        for row in first.toLocalIterator():  # one row per item at most
            floor[row["item"]] = row["score"]
        found = _ranked(_search(stored, tree, documents, total, floor, k), k)
        names = spark.createDataFrame([(i, n) for i, n in enumerate(tree.names)], "item long, item_id long")
        # a row per item of the block
        parts.append(found.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int"), "doc_id", "score"))
    parts = [store(p, "ranked") for p in parts] if len(parts) > 1 else parts
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def op12_lexical_search(spark, sf_dir):
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL)
, sized AS (SELECT r, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0)
, total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sized)
, items AS (SELECT item_id, text, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL))
, asked AS (SELECT item_id, text, term, count(*) AS c FROM items GROUP BY ALL)
, occurring AS (SELECT r, doc_id, n, unnest(terms) AS term FROM sized)
, held AS (SELECT r, doc_id, n, term, count(*) AS tf FROM occurring GROUP BY ALL)
, weighed AS (SELECT term, CAST(floor(1000*ln(CAST(2*docs + 2 AS DOUBLE)/CAST(2*count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held, total GROUP BY term, docs)
, valued AS (SELECT r, doc_id, h.term, w*((1000000000*tf)//(1000*tf + 12*(100 - 25 + (25*n*docs)//words))) AS v
  FROM held h JOIN weighed USING (term), total)
, scored AS (SELECT item_id, text, r, doc_id, CAST(sum(c*v) AS BIGINT) AS score FROM asked JOIN valued USING (term) GROUP BY ALL)
, ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {K}
"""

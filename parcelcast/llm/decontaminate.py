"""Benchmark decontamination by greedy string tiling.

Words are lower-cased (A-Z) runs without white space. A document and a benchmark item are compared when they share a seed, a
run of ``min_match`` consecutive words. Running Karp-Rabin then marks matches between the words of both that are not yet
marked, the longest first, until none of ``min_match`` words is left; every word is marked once. The share of the
item's words in tiles is its coverage; at ``threshold`` or more the document holds the item, in whatever order
its passages stand. Items of fewer words match as a whole.

The seeds of a benchmark up to ``broadcast_bytes`` of text (measured first) go to all tasks; a larger one is joined to the
documents on seeds. Null or empty texts hold nothing and are never held. Rows with equal ids are judged each for itself; the
result has a row per id, item and distinct outcome. A null id is an id like any other, of documents and items: such rows are
judged and reported with the null. Rows are told apart by a 64-bit hash of id and text; ``clean`` drops rows, not ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelcast.llm.common import Words, bound_batches, distinct, lists, scan, split_rows, store, table, text_slices

MIN_MATCH, THRESHOLD, BROADCAST_BYTES = 4, 0.5, 16 << 20
RESULT = "doc_id long, item_id long, item_words int, covered int, tiles int, longest int, coverage double"


def tile(doc: list[list[int]], item: list[int], min_match: int) -> list[int]:
    """Lengths of the tiles between an item and the parts of a document that may match (greedy string tiling)."""
    text: list[int | None] = []
    for part in doc:  # a part ends with a word that matches nothing
        text += [*part, None]
    base, modulus = 1_000_003, (1 << 61) - 1
    free_text, free_item = [w is not None for w in text], [True] * len(item)

    def windows(words: list, free: list[bool], size: int) -> Iterator[tuple[int, int]]:
        """Start and rolling hash of the unmarked runs of ``size`` words."""
        top, value, run = pow(base, size, modulus), 0, 0
        for i, word in enumerate(words):
            if not free[i]:
                value = run = 0
                continue
            value = (value * base + word) % modulus
            if run >= size:
                value = (value - words[i - size] * top) % modulus
            run += 1
            if run >= size:
                yield i - size + 1, value

    tiles, size = [], max(min_match, min(len(item), max((len(p) for p in doc), default=0)) // 2)
    while True:
        places: dict[int, list[int]] = {}
        for q, value in windows(item, free_item, size):
            places.setdefault(value, []).append(q)
        found, longest = [], 0
        for p, value in windows(text, free_text, size):
            for q in places.get(value, ()):
                n = 0
                while (p + n < len(text) and q + n < len(item) and free_text[p + n] and free_item[q + n]
                       and text[p + n] == item[q + n]):
                    n += 1
                if n >= size:
                    found.append((-n, q, p))
                    longest = max(longest, n)
            if longest > 2 * size:
                break
        if longest > 2 * size:
            size = longest
            continue
        for n, q, p in sorted(found):
            n = -n
            if all(free_text[p: p + n]) and all(free_item[q: q + n]):
                tiles.append(n)
                free_text[p: p + n] = [False] * n
                free_item[q: q + n] = [False] * n
        if size > 2 * min_match:
            size //= 2
        elif size > min_match:
            size = min_match
        elif not found:
            return tiles
        # at the smallest size a match that was cut by a longer tile gets another pass


class Benchmark:
    """The items' words and the seeds that lead to them."""

    def __init__(self, keys: list[int | None], texts: list[str | None], min_match: int):
        self.keys, self.min_match, self.items = [], min_match, []
        seeds: dict[int, list[tuple[np.ndarray, int]]] = {}
        column = pa.array([t or "" for t in texts], pa.string())
        for lo, hi in text_slices(column):
            words = Words(column.slice(lo, hi - lo), lower=True)
            for key, (a, b) in zip(keys[lo:hi], words.spans()):
                if b == a:
                    continue
                size = min(min_match, b - a)
                part = _grams(words.hash[a:b], size)
                seeds.setdefault(size, []).append((part, len(self.items)))
                self.items.append(words.hash[a:b].tolist())
                self.keys.append(key)
        self.seeds = {}
        for size, parts in seeds.items():
            codes = np.concatenate([p for p, _ in parts])
            owner = np.repeat([i for _, i in parts], [len(p) for p, _ in parts])
            order = np.lexsort((owner, codes))
            seen = np.zeros(1 << 20, dtype=bool)
            seen[(codes >> np.uint64(44)).astype(np.int64)] = True
            self.seeds[size] = codes[order], owner[order], seen

    def hits(self, words: Words) -> dict[int, tuple[np.ndarray, int]]:
        """Positions in a slice whose seed occurs in some item, by seed size."""
        out = {}
        for size, (codes, _, seen) in self.seeds.items():
            grams = words.grams(size)
            spots = np.flatnonzero(seen[(grams >> np.uint64(44)).astype(np.int64)])
            place = np.minimum(np.searchsorted(codes, grams[spots]), len(codes) - 1)
            out[size] = spots[codes[place] == grams[spots]], grams
        return out

    def judge(self, hashes: np.ndarray, spots: dict[int, np.ndarray], grams: dict[int, np.ndarray]) -> list[tuple]:
        """(item, words, covered, tiles, longest) of the items that share a seed with a document."""
        by_item: dict[int, list[tuple[int, int]]] = {}
        for size, at in spots.items():
            codes, owner, _ = self.seeds[size]
            left = np.searchsorted(codes, grams[size], side="left").tolist()
            right = np.searchsorted(codes, grams[size], side="right").tolist()
            for p, a, b in zip(at.tolist(), left, right):
                for i in set(owner[a:b].tolist()):
                    by_item.setdefault(i, []).append((p, size))
        out = []
        for i, places in by_item.items():
            item, parts, end = self.items[i], [], -1
            for p, size in places:
                if p > end:
                    parts.append([p, p + size])
                else:
                    parts[-1][1] = p + size
                end = p + size
            # repeated parts are needed no oftener than the item could take them
            tiles = tile([hashes[a:b].tolist() for a, b in parts], item, min(self.min_match, len(item)))
            out.append((i, len(item), sum(tiles), len(tiles), max(tiles, default=0)))
        return out


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    holder = object.__new__(Words)
    holder.hash = hashes
    return Words.grams(holder, size)


def _result(rows: list[tuple], threshold: float) -> pa.RecordBatch:
    kept = [(*r, r[3] / r[2]) for r in rows if r[3] >= threshold * r[2]]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
    names = [part.split()[0] for part in RESULT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in kept], t) for k, t in enumerate(types)], names=names)


def _with_broadcast(docs: DataFrame, bench: Benchmark, threshold: float) -> DataFrame:
    def run(batches):
        for batch, words in scan(batches, lower=True):
            found, rows = bench.hits(words), []
            keys = batch.column(0).to_pylist()
            for d, (a, b) in enumerate(words.spans()):
                spots, grams = {}, {}
                for size, (at, codes) in found.items():
                    lo, hi = np.searchsorted(at, [a, b - size + 1])
                    if hi > lo:
                        spots[size], grams[size] = at[lo:hi] - a, codes[at[lo:hi]]
                if spots:
                    rows += [(keys[d], bench.keys[r[0]], *r[1:]) for r in bench.judge(words.hash[a:b], spots, grams)]
            if rows:
                yield _result(rows, threshold)

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def _keyed(rows: DataFrame, key: str, name: str) -> DataFrame:
    """With a key of the row that is never null: equal for equal rows only."""
    return rows.withColumn(name, F.xxhash64(key, "text"))


def _with_join(docs: DataFrame, items: DataFrame, min_match: int, threshold: float) -> DataFrame:
    docs, items = _keyed(docs.select("doc_id", "text"), "doc_id", "row"), _keyed(items, "item_id", "item_row")

    def seeds_of(key: str):
        def run(batches):
            for batch, words in scan(batches, lower=True):
                sizes = range(1, min_match + 1) if key == "doc_id" else [min_match]
                grams, rows = {m: words.grams(m) for m in sizes}, []
                for a, b in words.spans():
                    if key == "doc_id":
                        own = [grams[m][a: b - m + 1] for m in sizes if b - a >= m]
                        rows.append(distinct(np.concatenate(own)) if own else np.zeros(0, np.uint64))
                    else:
                        rows.append(distinct(_grams(words.hash[a:b], min(min_match, b - a))) if b > a else np.zeros(0, np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), lists(np.concatenate(rows).view(np.int64), [len(r) for r in rows])], names=["key", "seeds"])
        return run

    schema = "key long, seeds array<long>"
    left = docs.select("row", "text").mapInArrow(seeds_of("doc_id"), schema).select(F.col("key").alias("row"), F.explode("seeds").alias("seed"))
    right = items.select("item_row", "text").mapInArrow(seeds_of("item_id"), schema).select(
        F.col("key").alias("item_row"), F.explode("seeds").alias("seed"))
    pairs = store(left.join(right, "seed").select("row", "item_row").distinct(), "seed-pairs")
    rows = pairs.join(docs, "row").join(
        items.withColumnRenamed("text", "item"), "item_row").select("doc_id", "text", "item_id", "item")

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text, item_id, item in zip(*(c.to_pylist() for c in batch.columns)):
                bench, words = Benchmark([item_id], [item], min_match), Words(pa.array([text or ""]), lower=True)
                spots = {m: at for m, (at, _) in bench.hits(words).items() if len(at)}
                grams = {m: words.grams(m)[at] for m, at in spots.items()}
                rows += [(doc_id, item_id, *r[1:]) for r in bench.judge(words.hash, spots, grams)]
            if rows:
                yield _result(rows, threshold)

    return rows.mapInArrow(run, RESULT)


def contaminated(docs: DataFrame, items: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD,
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row for each document and benchmark item that it covers to ``threshold``."""
    items = bound_batches(items).select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > broadcast_bytes:
        return _with_join(docs, items, min_match, threshold).distinct()
    got = items.toArrow()
    bench = Benchmark(got["item_id"].to_pylist(), got["text"].to_pylist(), min_match)
    return _with_broadcast(docs, bench, threshold).distinct()


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item."""
    rows = _keyed(docs, "doc_id", "_row")
    found = contaminated(rows.select(F.col("_row").alias("doc_id"), "text"), items, **options)
    hits = store(found.select(F.col("doc_id").alias("_row")).distinct(), "contaminated")
    some, rest = split_rows(rows, hits, "_row")
    return rest.unionByName(some.join(hits, "_row", "left_anti")).select(*docs.columns)


def op6_decontamination(spark, sf_dir):
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

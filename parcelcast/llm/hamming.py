"""Exact top-k search over binary codes by incremental multi-index hashing.

A code holds the signs of an embedding (1 where a component is above 0), cut into segments. Every segment of every code is
hashed. A query probes all buckets within radius 0 of its segments, then 1, 2, ...; the codes found are verified. After
radius r over m segments every code within Hamming distance m * (r + 1) - 1 has been seen, so a query ends as soon as its k-th
verified distance is no larger. Where looking up a radius costs more than comparing all codes does (PROBE_COST compared ones for each bucket
or candidate), they are compared, in tiles against the k-th distance so far. Queries go QUERIES_AT_ONCE at a time, so that a task
holds a bounded number of candidates whatever its blocks hold.

The rows are dealt into blocks by a hash of the id, and each block of the query set meets each block of rows in one task,
which holds both; block sizes are bounded by parameters. Equal codes are one entry with its smallest ids, which is
all that a top-k with ties broken by id can use, so a vector of a third of all rows costs no more than others.

Null embeddings have no code: they answer nothing and are no neighbour. Null components and those that a shorter embedding
lacks give 0. A row is no neighbour of rows with its own id. Repeated rows count once; an id with several vectors is
queried with each of them. A null id is never a query, nor a neighbour.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from parcelcast.llm.common import store, table

ROWS_PER_BLOCK, QUERIES_PER_BLOCK, LEAST_BLOCKS = 100_000, 20_000, 16
QUERIES_AT_ONCE, PROBE_COST, QUERY_TILE, CODE_TILE = 1024, 512, 64, 8192


def sign_codes(rows: pa.Array, bits: int) -> np.ndarray:
    """(rows x words) unsigned 64-bit codes of a list column without nulls; bit i is component i."""
    words = max(1, -(-bits // 64))
    out = np.zeros((len(rows), words * 64), dtype=np.uint8)
    sizes = np.diff(rows.offsets.to_numpy()) if len(rows) else np.zeros(0, np.int64)
    values = rows.flatten().fill_null(0).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(rows)), sizes)
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[owner, place] = values > 0
    return np.packbits(out, axis=1, bitorder="little").view("<u8").reshape(len(rows), words)


def coded(vectors: DataFrame) -> DataFrame:
    """id and code (little-endian bytes) of every row with an id and an embedding."""
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select("vec_id", "embedding")
    bits = rows.agg(F.max(F.size("embedding"))).first()[0] or 1

    def run(batches):
        for batch in batches:
            codes = sign_codes(batch.column(1), bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary())], names=["vec_id", "code"])

    return rows.mapInArrow(run, "vec_id long, code binary").distinct()


def _as_codes(column: pa.ChunkedArray) -> np.ndarray:
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), dtype="<u8").reshape(len(parts), -1)


class MultiIndex:
    """Distinct codes hashed by each of their segments."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, keep: int):
        order = np.lexsort((ids, *codes.T[::-1]))
        ids, codes = ids[order], codes[order]
        first = np.ones(len(codes), dtype=bool)
        first[1:] = (codes[1:] != codes[:-1]).any(axis=1)
        self.codes, begin = codes[first], np.flatnonzero(first)
        self.count = np.minimum(np.diff(np.append(begin, len(codes))), keep)
        self.begin, self.ids = begin, ids
        n, total = len(self.codes), codes.shape[1] * 64
        parts = max(1, min(total, round(total / max(1.0, math.log2(max(n, 2))))))
        parts = max(parts, -(-total // 20))  # bucket tables of at most 2**20 entries
        edges = [total * i // parts for i in range(parts + 1)]
        self.segments = list(zip(edges[:-1], edges[1:]))
        self.tables = []
        for lo, hi in self.segments:
            value = segment(self.codes, lo, hi)
            by_value = np.argsort(value, kind="stable")
            self.tables.append((np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << (hi - lo)))]), by_value))

    def nearest(self, own: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(query number, id, distance) in parts: the k nearest of each query by distance, then id."""
        out = []
        for lo in range(0, len(queries) if len(self.codes) else 0, QUERIES_AT_ONCE):
            q, ids, d = self._nearest(own[lo: lo + QUERIES_AT_ONCE], queries[lo: lo + QUERIES_AT_ONCE], k)
            out.append((q + lo, ids, d))
        return out

    def _nearest(self, own: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found, active = [], np.arange(len(queries))
        seen = tuple(np.zeros(0, np.int64) for _ in range(3))
        for radius in range(max(hi - lo for lo, hi in self.segments) + 1):
            if not len(active):
                break
            probes = sum(math.comb(hi - lo, radius) for lo, hi in self.segments)
            limit = len(active) * len(self.codes) // PROBE_COST
            pieces = self._probed(queries, active, radius, limit - len(seen[0])) if probes * len(active) <= limit else None
            if pieces is None:
                found += self._compared(own, queries, active, k)
                seen, active = tuple(x[:0] for x in seen), active[:0]
                break
            q = np.concatenate([seen[0], *(p[0] for p in pieces)])
            c = np.concatenate([seen[1], *(p[1] for p in pieces)])
            both = np.unique(q * len(self.codes) + c)  # verify each pair once
            q, c = both // len(self.codes), both % len(self.codes)
            q, c, d, sure = self._best(q, c, np.bitwise_count(queries[q] ^ self.codes[c]).sum(axis=1).astype(np.int64), own, k)
            done = np.zeros(len(queries), dtype=bool)
            done[active] = sure[active] <= len(self.segments) * (radius + 1) - 1
            found.append((q[done[q]], c[done[q]], d[done[q]]))
            seen, active = (q[~done[q]], c[~done[q]], d[~done[q]]), active[~done[active]]
        found.append(seen)  # every bucket has been probed
        return self._members(*(np.concatenate(x) for x in zip(*found)), own, k)

    def _compared(self, own: np.ndarray, queries: np.ndarray, active: np.ndarray, k: int) -> list[tuple]:
        """The codes that can hold the k nearest, from comparing all; a tile of queries and codes at a time, growing as bounds tighten."""
        out, kind = [], np.uint8 if self.codes.shape[1] < 4 else np.uint16
        for lo in range(0, len(active), QUERY_TILE):
            of = active[lo: lo + QUERY_TILE]
            asked, bound = queries[of], np.full(len(of), np.iinfo(kind).max, dtype=kind)
            best, at, size = tuple(np.zeros(0, np.int64) for _ in range(3)), 0, 256
            while at < len(self.codes):
                tile = self.codes[at: at + size]
                d = sum((np.bitwise_count(asked[:, w, None] ^ tile[None, :, w]).astype(kind, copy=False) for w in range(1, tile.shape[1])),
                        start=np.bitwise_count(asked[:, 0, None] ^ tile[None, :, 0]).astype(kind, copy=False))
                near = np.flatnonzero(d <= bound[:, None])
                new = (of[near // len(tile)], near % len(tile) + at, d.ravel()[near].astype(np.int64))
                *best, sure = self._best(*(np.concatenate(x) for x in zip(best, new)), own, k)
                bound = np.minimum(sure[of], np.iinfo(kind).max).astype(kind)
                at, size = at + size, min(2 * size, CODE_TILE)
            out.append(tuple(best))
        return out

    def _best(self, q: np.ndarray, c: np.ndarray, d: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
        """(query, code, distance) of the codes that can hold the k nearest ids, and the distance within which a query has k for sure.

        A code that only the query's own id has is none of them; any other holds one id at least.
        """
        mine = self.ids[self.begin[c]] == own[q]
        of_others = ~mine | (self.count[c] > 1)
        q, c, d, mine = q[of_others], c[of_others], d[of_others], mine[of_others]
        order = np.lexsort((self.ids[self.begin[c] + mine], d, q))
        q, c, d = q[order], c[order], d[order]
        held = np.maximum(1, self.count[c] - 1)
        place = np.arange(len(q))
        fresh = np.concatenate([[True], q[1:] != q[:-1]])[: len(q)]
        nearer = fresh | np.concatenate([[True], d[1:] != d[:-1]])[: len(q)]
        begin = np.maximum.accumulate(np.where(fresh, place, 0))
        total = np.cumsum(held)
        ahead = total - held
        within = ahead - ahead[begin]  # ids that the codes before hold for sure
        closer = within[np.maximum.accumulate(np.where(nearer, place, 0))]  # those at a smaller distance
        kept = (place - begin < k) & (closer < k)
        sure = np.full(len(own), np.iinfo(np.int64).max)
        enough = kept & (within + held >= k)
        np.minimum.at(sure, q[enough], d[enough])
        return q[kept], c[kept], d[kept], sure

    def _members(self, q: np.ndarray, c: np.ndarray, d: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        count = self.count[c]
        at = np.repeat(self.begin[c] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        q, ids, d = np.repeat(q, count), self.ids[at], np.repeat(d, count)
        others = np.flatnonzero(ids != own[q])
        order = others[np.lexsort((ids[others], d[others], q[others]))]
        q, ids, d = q[order], ids[order], d[order]
        kept = np.arange(len(q)) - np.searchsorted(q, q) < k
        return q[kept], ids[kept], d[kept]

    def _probed(self, queries: np.ndarray, active: np.ndarray, radius: int, limit: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """(query number, code) of all buckets within the radius; nothing if they hold more than ``limit``."""
        out, total = [], 0
        for (lo, hi), (edges, by_value) in zip(self.segments, self.tables):
            value = segment(queries[active], lo, hi)
            for flips in itertools.combinations(range(hi - lo), radius):
                bucket = value ^ sum(1 << f for f in flips)
                size = edges[bucket + 1] - edges[bucket]
                if held := int(size.sum()):
                    total += held
                    if total > limit:
                        return None
                    at = np.repeat(edges[bucket] - (np.cumsum(size) - size), size) + np.arange(held)
                    out.append((np.repeat(active, size), by_value[at]))
        return out


def segment(codes: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Bits lo to hi of the codes as integers."""
    word, shift = divmod(lo, 64)
    value = codes[:, word] >> np.uint64(shift)
    if shift and hi > (word + 1) * 64:
        value = value | codes[:, word + 1] << np.uint64(64 - shift)
    return (value & np.uint64((1 << (hi - lo)) - 1)).astype(np.int64)


def top_k(vectors: DataFrame, k: int = 10, every: int = 50, rows_per_block: int = ROWS_PER_BLOCK,
          queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """query_id, rank, vec_id and distance: the k nearest rows of every row whose id is divisible by ``every``."""
    rows = store(coded(vectors), "codes")
    is_query = F.col("vec_id") % every == 0
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    blocks, turns = max(LEAST_BLOCKS, -(-n // rows_per_block)), max(1, -(-n_queries // queries_per_block))
    deal = F.xxhash64("vec_id", "code")
    left = rows.select("vec_id", "code", F.pmod(deal, F.lit(blocks)).alias("block"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.lit(turns - 1).cast("long"))).alias("turn"))
    right = rows.filter(is_query).select("vec_id", "code", F.pmod(deal, F.lit(turns)).alias("turn"),
                                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))

    def run(data: pa.Table, asked: pa.Table) -> pa.Table:
        parts = []
        if data.num_rows and asked.num_rows:
            index = MultiIndex(data["vec_id"].to_numpy(), _as_codes(data["code"]), k + 1)
            own = asked["vec_id"].to_numpy()
            parts = index.nearest(own, _as_codes(asked["code"]), k)
        if not parts:
            return pa.table({"query_id": pa.array([], pa.int64()), "code": pa.array([], pa.binary()),
                             "vec_id": pa.array([], pa.int64()), "distance": pa.array([], pa.int32())})
        q, ids, d = (np.concatenate([p[i] for p in parts]) for i in range(3))
        return pa.table({"query_id": own[q], "code": asked["code"].combine_chunks().take(pa.array(q)), "vec_id": ids,
                         "distance": d.astype(np.int32)})

    found = left.groupBy("block", "turn").cogroup(right.groupBy("block", "turn")).applyInArrow(
        run, "query_id long, code binary, vec_id long, distance int")
    best = Window.partitionBy("query_id", "code").orderBy("distance", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "distance")


def op1_top_k(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (SELECT DISTINCT vec_id, [coalesce(x, 0) > 0 for x in embedding] AS signs FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL)
, pairs AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_sum([CASE WHEN coalesce(p[1], false) <> coalesce(p[2], false) THEN 1 ELSE 0 END
    for p in list_zip(q.signs, v.signs)]) AS INTEGER) AS distance
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id)
, ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank, vec_id, distance FROM pairs)
SELECT * FROM ranked WHERE rank <= 10
"""

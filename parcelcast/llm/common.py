"""What several operators share: tables, stored intermediates, and numpy word scanning of Arrow text columns.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return. Null text
counts as empty. Word and shingle identities are 64-bit hashes computed for a whole batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelcast.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 20  # text handled at once inside a task; a longer document is a slice of its own
BATCH_ROWS = 512
PIECE = 1 << 20  # bytes whose prefix hashes are held at once

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BYTE_CODES = np.random.default_rng(20240101).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bound_batches(df: DataFrame) -> DataFrame:
    """``df``, after limiting the rows that a Python task is handed at once: whole texts are large rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit generator: spreads every input bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n + 1`` of each."""
    if "up" not in _POWERS or len(_POWERS["up"]) <= n:
        size = max(n + 1, PIECE + 4096)
        for name, base in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            _POWERS[name] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text."""
    sizes = np.diff(_offsets(texts))
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def _offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    column = batch.column(batch.schema.get_field_index(name))
    return column.fill_null("") if column.null_count else column


class Words:
    """The words of some texts: byte ranges, 64-bit hashes, and the first word of each text."""

    def __init__(self, texts: pa.Array, lower: bool = False, end_marks: bool = False):
        offsets = _offsets(texts)
        raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0]: offsets[-1]]
        offsets = offsets - offsets[0]
        if lower:
            raw = raw + ((raw - np.uint8(65)) < 26).astype(np.uint8) * np.uint8(32)
        inside = (raw != 32) & ((raw - np.uint8(9)) > 4)
        before = np.empty_like(inside)
        before[1:] = inside[:-1]
        if len(before):
            before[0] = False
        edges = offsets[:-1][offsets[:-1] < len(raw)]
        before[edges] = False
        first = inside & ~before
        if end_marks:  # a full stop or comma between an ASCII letter and the end of a word begins a word
            last = np.empty_like(inside)
            last[:-1] = ~inside[1:] | first[1:]
            if len(last):
                last[-1] = True
            letter = ((raw | np.uint8(32)) - np.uint8(97)) < 26
            first[1:] |= ((raw[1:] == 46) | (raw[1:] == 44)) & last[1:] & letter[:-1] & ~first[1:] & inside[:-1]
        after = np.empty_like(inside)
        after[:-1] = inside[1:] & ~first[1:]
        if len(after):
            after[-1] = False
        self.raw, self.offsets = raw, offsets  # bytes, and where each text begins
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.bounds = np.searchsorted(self.start, offsets)  # words of text i: bounds[i] to bounds[i + 1]
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        out, i, n = np.empty(len(self.start), dtype=np.uint64), 0, len(self.start)
        while i < n:
            base = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, base + PIECE, side="right")))
            up, down = _powers(int(self.end[j - 1] - base))
            coded = _BYTE_CODES[self.raw[base: self.end[j - 1]]]
            total = np.zeros(len(coded) + 1, dtype=np.uint64)
            np.cumsum(coded * up[: len(coded)], out=total[1:])
            s, e = self.start[i:j] - base, self.end[i:j] - base
            out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * _GOLDEN)
            i = j
        return out

    def grams(self, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each word on; only positions that ``within`` admits mean anything."""
        n = max(0, len(self.hash) - size + 1)
        total = np.zeros(n, dtype=np.uint64)
        for k in range(size):
            total = total * _BASE + self.hash[k: k + n]
        return mix(total + np.uint64(size * int(_GOLDEN) % (1 << 64)))

    def spans(self) -> Iterator[tuple[int, int]]:
        return zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist())


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of the batches of about ``limit`` bytes of text, and their text."""
    for batch in batches:
        texts = text_column(batch, column)
        for lo, hi in text_slices(texts, limit):
            yield batch.slice(lo, hi - lo), texts.slice(lo, hi - lo)


def scan(batches: Iterator[pa.RecordBatch], lower: bool = False, column: str = "text",
         limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Slices of the batches with their words."""
    for batch, texts in slices(batches, column, limit):
        yield batch, Words(texts, lower)


DOC_BITS = 23  # a bitmap of 1 MB


def bitmap(df: DataFrame, place: Column, bits: int) -> np.ndarray:
    """Bitmap of the places (0 to 2**bits - 1) that occur: of a fixed size whatever the input."""
    parts = df.select(place.cast("long").alias("at")).groupBy(F.shiftright("at", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit(32767))).alias("bits"))
    out = np.zeros((max(1, (1 << bits) >> 15), 4096), dtype=np.uint8)
    for row in parts.toLocalIterator():
        out[row["part"]] |= np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return out.ravel()


def held(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 > 0


def split_rows(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` whose ``key`` may be in ``ids``, and those for which it is not.

    Told apart by a bitmap of a fixed size, so that rows that meet nothing need not be shuffled to a join; a null is in
    none. The second part is exact, the first may hold more and is to be joined.
    """
    flagged = bitmap(ids.filter(F.col(key).isNotNull()), F.pmod(key, F.lit(1 << DOC_BITS)), DOC_BITS)
    at = docs.columns.index(key)

    def part(want: bool):
        def run(batches):
            for batch in batches:
                keys = batch.column(at)
                known = held(flagged, keys.fill_null(0).to_numpy() % (1 << DOC_BITS)) & keys.is_valid().to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(known == want))
        return run

    return docs.mapInArrow(part(True), docs.schema), docs.mapInArrow(part(False), docs.schema)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values (by sorting: faster here than a hash table)."""
    values = np.sort(values)
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = values[1:] != values[:-1]
    return values[keep]


def lists(values: np.ndarray, sizes: list[int]) -> pa.ListArray:
    """Rows of ``values`` as an Arrow list column."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))

"""Token-ID output: texts as token ids in shards that are compressed by Re-Pair grammars.

Documents are range-partitioned by id; each task writes its documents in ascending order as shards of about
``shard_tokens`` ids. In a shard frequent id pairs are repeatedly replaced by nonterminals: a round counts all adjacent
pairs and replaces, from left to right, those at least a sixteenth as frequent as the most frequent one, until no pair is left eight
times. The shard keeps its rules, the expansion length of each rule and the reduced sequence. Running sums of expansion lengths find the symbols
that cover any token range, so a document is decoded without the rest of its shard.

A file row is one shard: ``part``, ``shard``, ``offset`` (ids before it in its part), ``doc_ids``, ``doc_tokens`` and ``payload``.
The payload is little-endian unsigned 32-bit: mark, number of rules, number of symbols, number of ids; the rules' left and
right symbols; the rules' expansion lengths; the symbols. Symbols from ``BASE`` on are rules.

Null text is empty and has the end id alone. A null id sorts first. Rows with equal ids are all written, in the order of
their text.
"""

from __future__ import annotations

import functools
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from parcelcast.llm.common import Words, bound_batches, slices, table
from parcelcast.session import scratch_path

MARK, BASE = 0x52505431, 1 << 20
END_ID = 2
CACHE_PIECES = 600_000  # pieces whose ids a worker process remembers, about 90 MB
FILE_SCHEMA = ("part int, shard int, offset long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, payload binary")


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_signs() -> dict[int, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable bytes for themselves, the others from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: 256 + i for i, b in enumerate(rest)}


_BYTE_SIGNS = _byte_signs()


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Ids of whole texts by the ids of their distinct pieces.

    The tokenizer lower-cases, and never joins text across white space, nor a full stop or comma at the end of a word to
    the ASCII letter before it; so the ids of a text are those of such pieces one after another. Pieces of Latin letters
    below U+0100 go straight to the merges, which is all that the other steps leave of them.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}  # number of a piece by its 64-bit hash
        self.flat, self.size = array("I"), array("q")

    def _learn(self, keys: list[int], pieces: list[bytes]) -> None:
        merge, known, flat, size, others = self.tokenizer.model.tokenize, self.known, self.flat, self.size, []
        for key, piece in zip(keys, pieces):
            text = piece.decode("utf-8", "replace")
            if text.isalpha() and (text.isascii() or max(text) < "\u0100"):
                # letters that lower-case alike everywhere and are in normal form: what is left are bytes and merges
                text = text.lower()
                ids = [t.id for t in merge(text if text.isascii() else text.encode().decode("latin-1").translate(_BYTE_SIGNS))]
                known[key] = len(size)
                size.append(len(ids))
                flat.extend(ids)
            else:
                others.append((key, text))
        if others:
            coded = self.tokenizer.encode_batch_fast([text for _, text in others], add_special_tokens=False)
            for (key, _), e in zip(others, coded):
                known[key] = len(size)
                size.append(len(e.ids))
                flat.extend(e.ids)

    def encode(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice, and the number of ids of each text, without end ids."""
        if len(self.known) > CACHE_PIECES:
            self._forget()
        distinct, at, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        keys, known = distinct.tolist(), self.known
        numbers = [known.get(k, -1) for k in keys]
        index = np.array(numbers, dtype=np.int64)
        if len(new := np.flatnonzero(index < 0)):
            data, fresh = words.raw.tobytes(), distinct[new].tolist()
            spots = zip(words.start[at[new]].tolist(), words.end[at[new]].tolist())
            self._learn(fresh, [data[a:b] for a, b in spots])
            index[new] = [known[k] for k in fresh]
        sizes, flat = np.array(self.size), np.array(self.flat)
        first = np.cumsum(sizes) - sizes
        token_of = index[inverse]
        count = sizes[token_of]
        ends = np.concatenate([[0], np.cumsum(count)])
        picked = np.repeat(first[token_of] - ends[:-1], count) + np.arange(ends[-1])
        return flat[picked], np.diff(ends[words.bounds])


@functools.lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


class Pieces(Words):
    """Words in lower case, with a full stop or comma after an ASCII letter at their end as a word of its own.

    A slice with the opening of a special token keeps its case, since those are recognised before lower-casing.
    """

    def __init__(self, texts: pa.Array):
        super().__init__(texts, lower=not pc.any(pc.match_substring(texts, "<|")).as_py(), end_marks=True)


def compress(ids: np.ndarray, min_count: int = 8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rules n x 2, expansion lengths, symbols) of the ids; no pair of adjacent symbols is left ``min_count`` times."""
    symbols, min_count = ids.astype(np.int64), max(min_count, 2)
    rules, lengths, n_rules = [np.zeros((0, 2), np.int64)], np.zeros(0, np.int64), 0
    slot = lambda p: ((p * 0x5851F42D4C957F2D) >> 40) & 0xFFFF
    while len(symbols) > min_count:
        pairs = symbols[:-1] << 32 | symbols[1:]
        slots = slot(pairs)
        often = np.flatnonzero((np.bincount(slots, minlength=1 << 16) >= min_count)[slots])  # no other pair can be frequent
        if not len(often):
            break
        ordered = np.sort(pairs[often])
        edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        counts = np.diff(np.append(edge, len(ordered)))
        most = int(counts.max())
        if most < min_count:
            break
        least = max(min_count, most // 16)
        chosen = ordered[edge[counts >= least]]
        likely = np.zeros(1 << 16, dtype=bool)
        likely[slot(chosen)] = True
        spots = often[likely[slots[often]]]
        place = np.searchsorted(chosen, pairs[spots])
        hit = chosen[np.minimum(place, len(chosen) - 1)] == pairs[spots]
        spots, place = spots[hit], place[hit]
        # of hits that overlap the more frequent pair is replaced (so copies of a passage are cut alike), of equal ones (aaa)
        # every second from the left
        rank = np.empty(len(chosen), dtype=np.int64)
        rank[np.argsort(counts[counts >= least], kind="stable")] = np.arange(len(chosen))
        ranks, meet = rank[place], np.diff(spots) == 1
        ousted = np.zeros(len(spots), dtype=bool)
        ousted[:-1] |= meet & (ranks[:-1] < ranks[1:])
        ousted[1:] |= meet & (ranks[1:] < ranks[:-1])
        spots, place = spots[~ousted], place[~ousted]
        fresh = np.concatenate([[True], np.diff(spots) > 1])
        run = np.maximum.accumulate(np.where(fresh, spots, 0))
        odd = (spots - run) % 2 == 0
        spots, place = spots[odd], place[odd]
        # the first in rank keeps half of its count at least, so each round shortens; pairs left with less wait for the next
        useful = np.bincount(place, minlength=len(chosen)) >= min_count // 2
        kept = useful[place]
        spots, place = spots[kept], (np.cumsum(useful) - 1)[place[kept]]
        new = np.stack([chosen[useful] >> 32, chosen[useful] & 0xFFFFFFFF], axis=1)
        sizes = np.ones(new.shape, dtype=np.int64)
        sizes[new >= BASE] = lengths[new[new >= BASE] - BASE]
        rules.append(new)
        lengths = np.concatenate([lengths, sizes.sum(axis=1)])
        symbols[spots] = BASE + n_rules + place
        keep = np.ones(len(symbols), dtype=bool)
        keep[spots + 1] = False
        symbols, n_rules = symbols[keep], n_rules + len(new)
    return np.concatenate(rules), lengths, symbols


def pack(ids: np.ndarray, **options) -> bytes:
    rules, lengths, symbols = compress(ids, **options)
    head = np.array([MARK, len(rules), len(symbols), len(ids)])
    return np.concatenate([head, rules.T.ravel(), lengths, symbols]).astype("<u4").tobytes()


def _unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    words = np.frombuffer(payload, dtype="<u4")
    if len(words) < 4 or words[0] != MARK:
        raise ValueError("not a token shard")
    n, m = int(words[1]), int(words[2])
    body = words[4:].astype(np.int64)
    return body[: 2 * n].reshape(2, n).T, body[2 * n: 3 * n], body[3 * n: 3 * n + m]


def _expand(symbols: np.ndarray, rules: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(symbols >= BASE)
    while len(at):
        # the rules found last are replaced by their two symbols, everything else moves up
        size = np.ones(len(symbols), dtype=np.int64)
        size[at] = 2
        out = np.repeat(symbols, size)
        pairs = rules[symbols[at] - BASE]
        left = at + np.arange(len(at))
        out[left], out[left + 1] = pairs[:, 0], pairs[:, 1]
        places = np.stack([left, left + 1], axis=1).ravel()
        at, symbols = places[out[places] >= BASE], out
    return symbols


def unpack(payload: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The ids from ``start`` to ``stop`` of a shard; only the symbols that cover them are expanded."""
    rules, lengths, symbols = _unpack(payload)
    size = np.where(symbols < BASE, 1, lengths[np.maximum(symbols - BASE, 0)] if len(lengths) else 1)
    ends = np.cumsum(size)
    stop = (int(ends[-1]) if len(ends) else 0) if stop is None else stop
    if stop <= start:
        return np.zeros(0, dtype="<u4")
    a, b = int(np.searchsorted(ends, start, side="right")), int(np.searchsorted(ends, stop, side="left")) + 1
    skipped = int(ends[a] - size[a])
    return _expand(symbols[a:b], rules)[start - skipped: stop - skipped].astype("<u4")


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, shard_tokens: int = 1 << 17) -> None:
    """Encode every text and write the shards (Parquet rows) in ascending order of ids."""
    ordered = bound_batches(docs).select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer), TaskContext.get().partitionId()
        shard, offset, held, keys, sizes, total = 0, 0, [], [], [], 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([offset], pa.int64()),
                 pa.array([total], pa.int64()), pa.array([keys], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([pack(np.concatenate(held))], pa.binary())],
                names=["part", "shard", "offset", "n_tokens", "doc_ids", "doc_tokens", "payload"])

        for batch, texts in slices(batches):
            ids, counts = encoder.encode(Pieces(texts))
            ends = np.cumsum(counts)
            for key, a, b in zip(batch.column(0).to_pylist(), (ends - counts).tolist(), ends.tolist()):
                held += [ids[a:b], np.array([end_id], dtype=np.uint32)]
                keys.append(key)
                sizes.append(b - a + 1)
                total += b - a + 1
                if total >= shard_tokens:
                    yield row()
                    shard, offset = shard + 1, offset + total
                    held, keys, sizes, total = [], [], [], 0
        if keys:
            yield row()

    ordered.mapInArrow(run, FILE_SCHEMA).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the files: doc_id, start (ids before it), n_tokens and ids_crc32."""
    shards = bound_batches(spark.read.schema(FILE_SCHEMA).parquet(path))
    # one row a part: the ids of all parts before it
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    rows = shards.join(parts, "part").select(
        (F.col("base") + F.col("offset")).alias("base"), "doc_ids", "doc_tokens", "payload")

    def run(batches):
        for batch in batches:
            for base, keys, sizes, payload in zip(*(c.to_pylist() for c in batch.columns)):
                ids, ends = unpack(payload), np.cumsum(sizes)
                starts = ends - np.array(sizes)
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(base + starts), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_token_ids(spark, sf_dir):
    path = scratch_path(spark, "token-ids")
    write(table(spark, sf_dir, "documents"), path, public_tokenizer())
    return read(spark, path)

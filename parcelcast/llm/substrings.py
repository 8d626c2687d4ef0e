"""Substring dedup with suffix automata of reference shards.

Words are taken unchanged. A window is ``length`` consecutive words; a word goes if a window over it also starts in a document
with a smaller id. Windows are judged on the input.

1. The key of a window is the smallest hash of its runs of ``gram`` words. Equal windows have equal keys, and neighbours
   mostly share theirs, so a document has about a fifth as many keys as words. One aggregate finds the keys of two or
   more documents, and the first document of each.
2. A reference shard is what one document is the first to hold: its windows under such keys. The suffix automaton of a shard
   is streamed with the windows of later documents that share its keys. All shards together grow with the data, so
   shards meet their documents by a join: adaptive execution broadcasts a side that it measures to be small, and
   splits the documents of a shard that many share.
3. Matching statistics (the longest match that ends at each word) of ``length`` or more mark spans to remove.
4. Windows that the first holder of their key lacks are compared with each other by hash.

Key and document filters are bitmaps of a fixed size: they save shuffled rows where they can, and joins decide.

Null and empty texts keep nothing and lose nothing. A row with a null id loses nothing and is no reference. Rows with equal
ids are judged one by one, and are no reference for each other.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from parcelcast.llm.common import Words, bitmap, bound_batches, distinct, held, lists, scan, split_rows, store, table

LENGTH, GRAM = 13, 4
KEY_BITS = 25  # a bitmap of 4 MB


def window_keys(words: Words, length: int, gram: int) -> np.ndarray:
    """Key of the window from each word on; only windows inside a text mean anything."""
    grams, span = words.grams(gram), length - gram + 1
    low, have = grams, 1
    while have < span:
        step = min(have, span - have)
        low = np.minimum(low[: max(0, len(low) - step)], low[step:])
        have += step
    return low


class SuffixAutomaton:
    """Of a sequence of words (as integers); a state knows its longest length, suffix link and moves."""

    def __init__(self, sequences: list[list[int]]):
        self.moves, self.link, self.longest = [{}], [-1], [0]
        for number, sequence in enumerate(sequences):
            last = 0 if not number else self._extend(last, -number)  # a separator that occurs once
            for word in sequence:
                last = self._extend(last, word)

    def _extend(self, last: int, word: int) -> int:
        moves, link, longest = self.moves, self.link, self.longest
        state = len(moves)
        moves.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        p = last
        while p != -1 and word not in moves[p]:
            moves[p][word] = state
            p = link[p]
        if p != -1:
            q = moves[p][word]
            if longest[p] + 1 == longest[q]:
                link[state] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                longest.append(longest[p] + 1)
                link.append(link[q])
                while p != -1 and moves[p].get(word) == q:
                    moves[p][word] = clone
                    p = link[p]
                link[q] = link[state] = clone
        return state

    def statistics(self, words: list[int]) -> list[int]:
        """For each word the length of the longest match that ends there."""
        moves, link, longest, out, state, size = self.moves, self.link, self.longest, [], 0, 0
        for word in words:
            while state and word not in moves[state]:
                state = link[state]
                size = longest[state]
            if word in moves[state]:
                state = moves[state][word]
                size += 1
            out.append(size)
        return out


def _covers(at: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Word ranges covered by windows that start at the sorted places."""
    edge = np.flatnonzero(np.concatenate([[True], np.diff(at) > length]))
    return list(zip(at[edge].tolist(), (at[np.append(edge[1:], len(at)) - 1] + length).tolist()))


def _keyed(docs: DataFrame, length: int, gram: int, known: np.ndarray | None = None) -> DataFrame:
    """doc_id and each distinct key of its windows (if ``known`` is given, those that it may hold)."""

    def run(batches):
        for batch, words in scan(batches):
            keys, rows = window_keys(words, length, gram), []
            for a, b in words.spans():
                own = distinct(keys[a: b - length + 1]) if b - a >= length else keys[:0]
                if known is not None and len(own):
                    own = own[held(known, (own >> np.uint64(64 - KEY_BITS)).astype(np.int64))]
                rows.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists(np.concatenate(rows).view(np.int64), [len(r) for r in rows])], names=["doc_id", "keys"])

    return docs.filter("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(run, "doc_id long, keys array<long>").select(
        "doc_id", F.explode("keys").alias("key"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, print (hash of the text), and the first word and number of words of ranges to remove; ranges may overlap."""
    docs = bound_batches(docs).select("doc_id", "text")
    firsts = _keyed(docs, length, gram).groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    firsts = store(firsts.filter("first < last").select("key", "first"), "first-holders")
    known = bitmap(firsts, F.shiftrightunsigned("key", 64 - KEY_BITS), KEY_BITS)
    shared = _keyed(docs, length, gram, known).join(firsts, "key")
    by_doc = store(shared.groupBy("doc_id").agg(F.collect_list(F.struct("key", "first")).alias("shared")), "shared-keys")
    texts, _ = split_rows(docs.filter("doc_id IS NOT NULL"), by_doc)
    joined = texts.join(by_doc, "doc_id").select(
        "doc_id", F.xxhash64("text").alias("print"), "text", F.col("shared.key").alias("keys"), F.col("shared.first").alias("firsts"))

    def parts_of(batches):
        """Windows by the first holder of their key: the words that they cover, and where the windows start."""
        for batch, words in scan(batches):
            window, rows = window_keys(words, length, gram), []
            keys_column, firsts_column = batch.column(3), batch.column(4)
            for i, (a, b) in enumerate(words.spans()):
                if b - a < length:
                    continue
                keys = np.asarray(keys_column[i].values).view(np.uint64)
                order = np.argsort(keys)
                keys, first = keys[order], np.asarray(firsts_column[i].values)[order]
                own = window[a: b - length + 1]
                place = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                at = np.flatnonzero(keys[place] == own)
                holder = first[place[at]]
                by_holder = np.argsort(holder, kind="stable")
                at, holder = at[by_holder], holder[by_holder]
                edges = np.flatnonzero(np.concatenate([[True], np.diff(holder) != 0])) if len(holder) else []
                me, mark = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                for lo, hi in zip(edges, [*edges[1:], len(holder)]):
                    covers = _covers(at[lo:hi], length)
                    rows.append((int(holder[lo]), me, mark, at[lo:hi].astype("<i4").tobytes(),
                                 np.array(covers, dtype="<i4").tobytes(),
                                 b"".join(words.hash[a + x: a + y].tobytes() for x, y in covers)))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                                                 names=["shard", "doc_id", "print", "at", "covers", "words"])

    parts = store(joined.mapInArrow(
        parts_of, "shard long, doc_id long, print long, at binary, covers binary, words binary"), "shard-parts")
    # rows of one id hold one shard each
    references = parts.filter("shard = doc_id").select("shard", F.col("covers").alias("ref_covers"), F.col("words").alias("ref_words"))
    queries = parts.filter("shard <> doc_id")
    met = queries.join(references, "shard").select("doc_id", "print", "at", "covers", "words", "shard", "ref_covers", "ref_words")

    def match(batches):
        built: OrderedDict[tuple, SuffixAutomaton] = OrderedDict()
        for batch in batches:
            out = []
            for doc_id, mark, at, covers, words, shard, ref_covers, ref_words in zip(*(c.to_pylist() for c in batch.columns)):
                name = (shard, ref_words) if len(ref_words) < 65536 else (shard, hashlib.sha256(ref_words).digest())
                if name not in built:
                    built[name] = SuffixAutomaton(_sequences(ref_covers, ref_words))
                    if len(built) > 2:  # rows of one shard mostly follow each other
                        built.popitem(last=False)
                built.move_to_end(name)
                at, found = np.frombuffer(at, dtype="<i4").astype(np.int64), []
                hashes = np.frombuffer(words, dtype=np.uint64)
                for (x, _), sequence in zip(_pairs(covers), _sequences(covers, words)):
                    sizes = np.array(built[name].statistics(sequence))
                    found.append(x + np.flatnonzero(sizes >= length) - length + 1)
                hit = np.concatenate(found)
                for x, y in _covers(hit, length) if len(hit) else ():
                    out.append((doc_id, mark, x, y - x, None))
                rest = np.setdiff1d(at, hit, assume_unique=True)
                if len(rest):
                    whole = object.__new__(Words)
                    whole.hash = hashes
                    code, offset = whole.grams(length).view(np.int64), _offsets_of(covers, rest)
                    out += [(doc_id, mark, p, length, c) for p, c in zip(rest.tolist(), code[offset].tolist())]
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                                 names=["doc_id", "print", "start", "size", "open"])

    matched = store(met.mapInArrow(match, "doc_id long, print long, start int, size int, open long"), "matches")
    left = matched.filter("open IS NOT NULL")
    earlier = left.groupBy("open").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    earlier = store(earlier.select("open", "first"), "open-windows")
    late = left.join(earlier, "open").filter("first < doc_id")
    columns = ["doc_id", "print", "start", "size"]
    return matched.filter("open IS NULL").select(*columns).union(late.select(*columns))


def _pairs(covers: bytes) -> list[list[int]]:
    return np.frombuffer(covers, dtype="<i4").reshape(-1, 2).tolist()


def _sequences(covers: bytes, words: bytes) -> list[list[int]]:
    sizes = [y - x for x, y in _pairs(covers)]
    ends = np.cumsum(sizes).tolist()
    words = np.frombuffer(words, dtype=np.uint64)
    return [words[e - n: e].tolist() for n, e in zip(sizes, ends)]


def _offsets_of(covers: bytes, at: np.ndarray) -> np.ndarray:
    """Where in the joined words of the covers the word ``at`` of the text is."""
    ranges = np.frombuffer(covers, dtype="<i4").reshape(-1, 2).astype(np.int64)
    number = np.searchsorted(ranges[:, 0], at, side="right") - 1
    before = np.cumsum(ranges[:, 1] - ranges[:, 0]) - (ranges[:, 1] - ranges[:, 0])
    return before[number] + at - ranges[number, 0]


RESULT = "doc_id long, n_words long, n_removed long, kept string"


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by a space) of every document."""
    spans = repeated_spans(docs, length, gram)
    by_doc = store(spans.groupBy("doc_id", "print").agg(
        F.collect_list("start").alias("starts"), F.collect_list("size").alias("sizes")), "spans")
    def keep(batches):
        for batch, words in scan(batches):
            starts, sizes = (batch.column(k) if batch.num_columns > 2 else None for k in (2, 3))
            total, removed, kept = [], [], []
            for i, (a, b) in enumerate(words.spans()):
                gone = np.zeros(b - a + 1, dtype=np.int64)
                if starts is not None and starts[i].is_valid:
                    x = np.asarray(starts[i].values, dtype=np.int64)
                    np.add.at(gone, x, 1)
                    np.add.at(gone, x + np.asarray(sizes[i].values, dtype=np.int64), -1)
                stays = np.cumsum(gone[:-1]) == 0
                total.append(b - a)
                removed.append(int((~stays).sum()))
                begin, end = words.start[a:b][stays].tolist(), words.end[a:b][stays].tolist()
                raw = words.raw
                kept.append(b" ".join(raw[x:y].tobytes() for x, y in zip(begin, end)) if removed[-1] else
                            b" ".join(raw[words.offsets[i]: words.offsets[i + 1]].tobytes().split()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    some, plain = split_rows(docs.select("doc_id", "text"), by_doc)
    plain = plain.mapInArrow(keep, RESULT)
    some = some.withColumn("print", F.xxhash64("text"))
    some = some.join(by_doc, ["doc_id", "print"], "left").select("doc_id", "text", "starts", "sizes").mapInArrow(keep, RESULT)
    return plain.unionByName(some)


def op8_substring_dedup(spark, sf_dir):
    kept = dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))

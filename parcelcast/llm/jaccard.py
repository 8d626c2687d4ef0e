"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters.

A document's set holds the distinct word shingles of its lower-cased (A-Z) text, as 64-bit hashes; a text of fewer words is
one shingle. Two documents link when ``100 * intersection >= percent * union``.

1. Documents with equal sets (128-bit fingerprints) form a class; the smallest id stands for it.
2. Shingles are ordered by rarity. The order comes from counts of all shingles in 2**19 hash buckets, an array of a fixed
   2 MB: any fixed order is right, and this one puts what is frequent in the corpus last. A set's prefix is its first
   n - ceil(t n) + 1 shingles; sets that link share a prefix shingle.
3. Prefix shingles that two classes or more share give candidates. Every class meets the first and the last class
   (by id) of each of its shingles, which is linear in the rows however large a group of near copies is. The length
   filter, the positional filter and the suffix filter (set sizes by hash bucket bound the symmetric
   difference) leave pairs that are verified once on the sets.
4. Shingles whose classes are by then in one component need nothing more. The classes of the others meet each
   other, unless already in one component, under the same filters, and are verified too. So no link between different
   components is lost, and copies are not expanded into all pairs.

Null and empty texts, and those without words, have an empty set and link with nothing. A row with a null id has no
component and is linked with nothing. Rows with equal ids are judged each by its own text: where the smallest id of two classes
is the same, the classes go by hashes of id and fingerprint instead, and a component is named by its smallest id in the end.
Very long texts are read whole; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from parcelcast.llm.common import (
    Words, bitmap, bound_batches, distinct, held, lists, mix, scan, split_rows, store, table, text_slices,
)
from parcelcast.llm.components import components

BUCKET_BITS, CHUNKS, SUFFIX_BUCKETS, TOKEN_BITS = 19, 128, 32, 25
TEXT_BYTES = 1 << 18  # text whose shingles a task holds at once; a longer document is taken by itself


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a slice."""
    grams, out = words.grams(size), []
    for a, b in words.spans():
        if b - a >= size:
            out.append(distinct(grams[a: b - size + 1]))
        elif b > a:
            short = object.__new__(Words)
            short.hash = words.hash[a:b]
            out.append(short.grams(b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def bucket_counts(docs: DataFrame, size: int) -> np.ndarray:
    """How many sets hold a shingle of each hash bucket, over all documents: 2**BUCKET_BITS counts."""
    per_chunk = (1 << BUCKET_BITS) // CHUNKS

    def count(batches):
        total = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
        for _, words in scan(batches, lower=True, limit=TEXT_BYTES):
            sets = shingle_sets(words, size)
            if sets:
                total += np.bincount((np.concatenate(sets) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=len(total))
        if total.any():
            yield _chunk_rows({c: total[c * per_chunk: (c + 1) * per_chunk] for c in range(CHUNKS)})

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts, dtype="<i8")
        if sums:
            yield _chunk_rows(sums)

    schema = "chunk int, counts binary"
    rows = docs.select("text").mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema)
    out = np.zeros((CHUNKS, per_chunk), dtype=np.int64)
    got = rows.toArrow()  # CHUNKS rows, 4 MB, whatever the input
    for chunk, counts in zip(got["chunk"].to_pylist(), got["counts"].to_pylist()):
        out[chunk] += np.frombuffer(counts, dtype="<i8")
    return np.minimum(out.ravel(), 2**32 - 1).astype(np.uint32)


def _chunk_rows(chunks: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(chunks), pa.int32()), pa.array([c.astype("<i8").tobytes() for c in chunks.values()], pa.binary())],
        names=["chunk", "counts"])


def signatures(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, row (hash of the text), n, fingerprint (fp1, fp2), rare-first prefix, and set sizes by hash bucket."""
    counts = bucket_counts(docs, size)

    def run(batches):
        for batch, words in scan(batches, lower=True, limit=TEXT_BYTES):
            sets = shingle_sets(words, size)
            prefixes, sizes, prints, hist = [], [], [], []
            for s in sets:
                n = len(s)
                keep = n - (percent * n + 99) // 100 + 1 if n else 0
                rank = counts[(s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
                prefixes.append(s[np.argsort(rank, kind="stable")[:keep]])  # ties by hash: s is sorted
                sizes.append(n)
                prints.append(_fingerprint(s))
                hist.append(np.bincount((s & np.uint64(SUFFIX_BUCKETS - 1)).astype(np.int64), minlength=SUFFIX_BUCKETS))
            fp = np.array(prints, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(fp[:, 0].copy()), pa.array(fp[:, 1].copy()),
                 lists(np.concatenate(prefixes).view(np.int64), [len(p) for p in prefixes]),
                 lists(np.concatenate(hist).astype(np.int32), [SUFFIX_BUCKETS] * len(hist))],
                names=["doc_id", "row", "n", "fp1", "fp2", "prefix", "hist"])

    return docs.select("doc_id", F.xxhash64("text").alias("row"), "text").mapInArrow(
        run, "doc_id long, row long, n long, fp1 long, fp2 long, prefix array<long>, hist array<int>")


def _needed(n: Column, m: Column, percent: int) -> Column:
    """The least intersection of linked sets of n and m shingles."""
    return F.ceil((n + m) * percent / (100 + percent)).cast("long")


def _may_link(n: Column, i: Column, m: Column, j: Column, percent: int) -> Column:
    """Length filter, and positional filter for a shared shingle at places i and j."""
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (F.least(n - i, m - j) >= _needed(n, m, percent))


def _suffix_filter(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    side = lambda k: classes.select(F.col("rep").alias(k), F.col("n").alias(f"n_{k}"), F.col("hist").alias(f"h_{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    apart = F.aggregate(F.zip_with("h_a", "h_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    return both.filter(apart <= F.col("n_a") + F.col("n_b") - 2 * _needed(F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    return (int(mix(s).sum()), int(mix(s ^ np.uint64(0x5DEECE66D)).sum())) if len(s) else (0, 0)


def _verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int, named: DataFrame | None = None) -> DataFrame:
    """The pairs (a, b) of classes whose sets link; sets are made anew for the documents that are in a pair.

    ``named``: rep, doc_id and fp1 of the classes, where ids alone do not tell them apart.
    """
    reps = store(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct(), "pair-ids")
    if named is None:
        ids = reps.select(F.col("rep").alias("doc_id"))
    else:
        own = store(reps.join(named, "rep"), "pair-classes")
        ids = store(own.select("doc_id").distinct(), "pair-ids")
    texts, _ = split_rows(docs.select("doc_id", "text"), ids)
    texts = texts.join(ids, "doc_id").select("doc_id", "text")
    if named is not None:
        def with_print(batches):
            for batch, words in scan(batches, lower=True, limit=TEXT_BYTES):
                prints = np.array([_fingerprint(s)[0] for s in shingle_sets(words, size)], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints), batch.column(1)], names=["doc_id", "fp1", "text"])

        marked = texts.mapInArrow(with_print, "doc_id long, fp1 long, text string")
        texts = marked.join(own, ["doc_id", "fp1"]).select("rep", "text")
    else:
        texts = texts.select(F.col("doc_id").alias("rep"), "text")
    # texts go to the pairs, not sets: hashes do not compress
    texts = store(texts, "pair-texts")
    if texts.groupBy("rep").count().filter("count > 1").limit(1).count():  # repeated rows: their sets are equal
        texts = store(texts.dropDuplicates(["rep"]), "pair-texts")
    side = lambda k: texts.select(F.col("rep").alias(k), F.col("text").alias(f"t_{k}"))

    def run(batches):
        for batch in batches:
            ids = np.concatenate([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            known, first, at = np.unique(ids, return_index=True, return_inverse=True)
            each = pa.chunked_array([batch.column(2), batch.column(3)]).combine_chunks().take(pa.array(first))
            sets: list[np.ndarray] = []
            for lo, hi in text_slices(each, TEXT_BYTES):
                sets += shingle_sets(Words(each.slice(lo, hi - lo), lower=True), size)
            keep = []
            for i, j in zip(at[: batch.num_rows].tolist(), at[batch.num_rows:].tolist()):
                x, y = (sets[i], sets[j]) if len(sets[i]) <= len(sets[j]) else (sets[j], sets[i])
                common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(y) else 0
                keep.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
            if any(keep):
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    joined = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "t_a", "t_b")
    return store(joined.mapInArrow(run, "a long, b long"), "links")


def near_components(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    return _components(docs, size, percent).select("doc_id", "n_shingles", "component_id")


def _components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``near_components`` with ``row``, the hash of the text, and ``part``, which tells components apart where ids do not."""
    signed = store(signatures(bound_batches(docs), size, percent), "signatures")
    key = ["fp1", "fp2", "n"]
    classes = store(signed.filter("n > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(
        F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix"), F.first("hist").alias("hist")), "classes")
    named = None
    clashes = classes.groupBy("rep").count().filter("count > 1").select("rep", F.lit(True).alias("clash"))
    if clashes.limit(1).count():
        classes = store(classes.join(clashes, "rep", "left").withColumnRenamed("rep", "doc_id").withColumn(
            "rep", F.when(F.col("clash"), F.xxhash64("doc_id", "fp1", "fp2")).otherwise(F.col("doc_id"))).drop("clash"), "classes")
        named = classes.select("rep", "doc_id", "fp1")
    # bare tokens are counted first, so that most, which one class has alone, are shuffled without their places
    tokens = classes.select(F.explode("prefix").alias("token")).groupBy("token").count()
    twice = store(tokens.filter("count > 1").select("token"), "shared-tokens")
    known = bitmap(twice, F.shiftrightunsigned("token", 64 - TOKEN_BITS), TOKEN_BITS)

    def shared_tokens(batches):
        for batch in batches:
            lengths = np.diff(batch.column(2).offsets.to_numpy())
            prefix = batch.column(2).flatten().to_numpy()
            keep = held(known, (prefix.view(np.uint64) >> np.uint64(64 - TOKEN_BITS)).astype(np.int64))
            owner = np.repeat(np.arange(batch.num_rows), lengths)
            pos = np.arange(len(prefix)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            owner = pa.array(owner[keep])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(pos[keep].astype(np.int32)), pa.array(prefix[keep])],
                names=["rep", "n", "pos", "token"])

    # a bitmap of a fixed size spares the shuffle of most tokens that one class has alone, and the join of the others
    some = classes.select("rep", "n", "prefix").mapInArrow(shared_tokens, "rep long, n long, pos int, token long")
    entry = F.struct("rep", "n", "pos")
    ends = some.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min(entry).alias("lo"), F.max(entry).alias("hi"))
    ends = store(ends.filter("c > 1").drop("c"), "shared")
    hits = store(some.join(ends, "token"), "hits")

    def with_end(end: str) -> DataFrame:
        e = F.col(end)
        return hits.filter((e["rep"] != F.col("rep")) & _may_link(F.col("n"), F.col("pos"), e["n"], e["pos"], percent)).select(
            F.least("rep", e["rep"]).alias("a"), F.greatest("rep", e["rep"]).alias("b"))

    pairs = store(with_end("lo").union(with_end("hi")).distinct(), "pairs")
    first = _verified(store(_suffix_filter(pairs, classes, percent), "pairs"), docs, size, percent, named)
    labels = components(first)
    rows = store(hits.drop("lo", "hi").join(labels, hits["rep"] == labels["node"], "left").select(
        "token", "rep", "n", "pos", F.coalesce("label", "rep").alias("label")), "labelled")
    open_tokens = rows.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("token")
    rows = store(rows.join(open_tokens, "token"), "open")
    x, y = rows.alias("x"), rows.alias("y")
    meet = (F.col("x.token") == F.col("y.token")) & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.label") != F.col("y.label"))
    rest = x.join(y, meet & _may_link(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"), percent)).select(
        F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti")
    rest = store(_suffix_filter(store(rest, "rest"), classes, percent), "rest")
    second = _verified(rest, docs, size, percent, named)
    if second.limit(1).count():
        # components of components: the later links join labels of the first round
        of = lambda k: labels.select(F.col("node").alias(k), F.col("label").alias(f"l_{k}"))
        joined = second.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
            F.coalesce("l_a", "a").alias("a"), F.coalesce("l_b", "b").alias("b"))
        upper = components(joined).select(F.col("node").alias("label"), F.col("label").alias("top"))
        alone = upper.join(labels.select(F.col("node")), upper["label"] == F.col("node"), "left_anti")
        labels = labels.join(upper, "label", "left").select("node", F.coalesce("top", "label").alias("label")).unionByName(
            alone.select(F.col("label").alias("node"), F.col("top").alias("label")))
        labels = store(labels, "labels")
    classes = classes.join(labels, classes["rep"] == labels["node"], "left").withColumn("label", F.coalesce("label", "rep"))
    if named is not None:
        names = classes.groupBy("label").agg(F.min("doc_id").alias("name"))
        classes = classes.drop("doc_id").join(names, "label")
    else:
        classes = classes.withColumn("name", F.col("label"))
    found = signed.select("doc_id", "row", *key).join(classes.select(*key, "label", "name"), key, "left")
    return found.select("doc_id", "row", F.col("n").alias("n_shingles"), F.col("label").alias("part"), F.when(
        F.col("doc_id").isNotNull(), F.coalesce("name", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """One document of each group of near copies: the one of the smallest id, equal ids by a hash of the text.

    Of equal rows one stays. Rows with a null id and texts without words are nobody's copy and all stay. Only rows whose id is
    that of a copy are shuffled.
    """
    found = store(_components(docs, size, percent).filter("doc_id IS NOT NULL AND part IS NOT NULL"), "components")
    best = found.groupBy("part").agg(F.min(F.struct("doc_id", "row")).alias("best"))
    rows = found.groupBy("doc_id", "row", "part").count()
    told = rows.join(best, "part").withColumn("stays", F.struct("doc_id", "row") == F.col("best"))
    touched = store(told.filter("NOT stays OR count > 1").select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "stays"), "copies")
    marked = docs.withColumn("_row", F.xxhash64("text"))
    some, rest = split_rows(marked, touched.select(F.col("_id").alias("doc_id")).distinct())
    joined = some.join(touched.withColumnRenamed("_row", "_touched"), (some["doc_id"] == F.col("_id")) & (some["_row"] == F.col("_touched")), "left")
    once = joined.filter("stays").dropDuplicates(["_id", "_touched"])
    untouched = joined.filter("stays IS NULL")
    return once.unionByName(untouched).select(*docs.columns).unionByName(rest.select(*docs.columns))


def op4_ngram_jaccard(spark, sf_dir):
    return near_components(table(spark, sf_dir, "documents"))

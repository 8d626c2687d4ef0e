"""Interaction audit of five document filters: what each filter removes in each of the 120 orders.

A document fails a set of filters, its mask; it does not matter which document it is. So documents are counted by part and
mask, and the orders are reckoned from these counts. In an order, a document goes at the first filter of its mask. The
orders that begin with a given prefix are neighbours in the lexicographic list: the Lehmer digits of the prefix give the
first of them, and there are (filters left)! of them. Hence a mask removes its documents at step s on one interval
of ranks for each prefix of s letters whose last one alone is in the mask. Its counts are added where an interval begins and
taken off where it ends; a running sum over the ranks then holds the totals of all orders at once.

Filter E asks for an equal text with a smaller id anywhere. Texts are known by their SHA-256, and no group of copies is
gathered: the smallest id of a text is an aggregate that combines map-side, and only a row that holds the smallest id of its
text, found by text and id together, escapes the filter.

Null text counts as empty, a null source as the empty string. A null id is smaller than no other and no other is smaller,
so its row never fails E; rows that share an id and a text count one by one, none making the others fail. An id labelled
several times counts with its largest labels; without a label a document is neither good nor toxic. Long texts are
looked at whole. An empty table gives no rows. Other columns of the table are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from parcelcast.llm.common import WORD, store, table

FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT, MARKS = 200, 50, 2, "[#$%&*|]"
_LONGS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
RESULT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _LONGS)
PARTS_AT_ONCE = 64  # parts whose 600 rows a task holds at once


def text_mask(text: Column) -> Column:
    """Bits of the filters that a text fails by itself; bit i is filter i."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    failed = [
        F.size(words) < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * F.size(words),
        100 * F.regexp_count(text, F.lit("[A-Z]")) > MAX_CAPITAL_PERCENT * F.length(text),
        text.rlike(MARKS),
    ]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0)).cast("int")


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask and, of its documents, n, good and toxic."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), text_mask(text).alias("mask"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("print"))
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    rows = store(rows.join(marks, "doc_id", "left").fillna(0, ["good", "toxic"]), "audit-rows")
    duplicate = 1 << FILTERS.index("E")
    least = rows.filter(F.col("doc_id").isNotNull()).groupBy("print").agg(F.min("doc_id").alias("doc_id"))
    first = rows.join(least, ["print", "doc_id"], "left_semi").select("part", "mask", "good", "toxic").unionByName(
        rows.filter(F.col("doc_id").isNull()).select("part", "mask", "good", "toxic"))
    tally = [F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")]
    every, spared = (x.groupBy("part", "mask").agg(*tally) for x in (rows, first))
    # all count as copies, then the first holders are moved to their mask without E
    moved = spared.select("part", F.explode(F.array(
        F.struct("mask", "n", "good", "toxic"),
        F.struct((F.col("mask") + duplicate).alias("mask"), *[(-F.col(c)).alias(c) for c in ("n", "good", "toxic")]))).alias("m"))
    signed = every.withColumn("mask", F.col("mask") + duplicate).unionByName(moved.select("part", "m.*"))
    return signed.groupBy("part", "mask").agg(*[F.sum(c).cast("long").alias(c) for c in ("n", "good", "toxic")]).filter("n > 0")


def orders(filters: int) -> np.ndarray:
    """(orders x filters) filter numbers, in lexicographic order."""
    return np.array(list(itertools.permutations(range(filters))))


def lehmer_rank(prefix: tuple[int, ...], filters: int) -> int:
    """Rank of the first order that begins with ``prefix``: digit i counts the smaller letters not used before it."""
    return sum(
        sum(1 for x in range(letter) if x not in prefix[:i]) * math.factorial(filters - 1 - i)
        for i, letter in enumerate(prefix))


def removal_intervals(filters: int) -> np.ndarray:
    """(mask, step, first rank, rank after the last) of all intervals of orders at whose step the mask's documents go."""
    out = []
    for step in range(filters):
        for prefix in itertools.permutations(range(filters), step + 1):
            begin = lehmer_rank(prefix, filters)
            end = begin + math.factorial(filters - 1 - step)
            others = [x for x in range(filters) if x not in prefix]
            for more in itertools.chain.from_iterable(itertools.combinations(others, k) for k in range(len(others) + 1)):
                out.append((sum(1 << x for x in (prefix[-1], *more)), step, begin, end))
    return np.array(out)


class Audit:
    """Totals of all orders from counts by mask; the intervals depend on the number of filters alone."""

    def __init__(self, letters: str = FILTERS):
        k = len(letters)
        self.letters, self.orders = letters, orders(k)
        self.names = ["".join(letters[x] for x in order) for order in self.orders]
        self.mask, self.step, self.begin, self.end = removal_intervals(k).T
        self.holds = (np.arange(1 << k)[:, None] >> np.arange(k)) & 1  # mask x filter

    def totals(self, counts: np.ndarray) -> dict[str, np.ndarray]:
        """``counts``: (parts x masks x [n, good, toxic]); results are (parts x orders x steps)."""
        parts, k, ranks = len(counts), len(self.letters), len(self.orders)
        change = np.zeros((k, ranks + 1, parts, 3), dtype=np.int64)
        added = counts[:, self.mask].transpose(1, 0, 2)
        np.add.at(change, (self.step, self.begin), added)
        np.add.at(change, (self.step, self.end), -added)
        gone = np.cumsum(change, axis=1)[:, :ranks].transpose(2, 1, 0, 3)  # part, rank, step, count
        removed = gone[..., 0]
        n = counts[..., 0]
        fails, alone = n @ self.holds, n[:, 1 << np.arange(k)]
        here = self.orders[None].repeat(parts, axis=0).reshape(parts, -1)

        def of_filter(values: np.ndarray) -> np.ndarray:
            return np.take_along_axis(values, here, axis=1).reshape(removed.shape)

        shares = np.stack([np.where(self.orders[None] == f, removed, 0).sum(axis=(1, 2)) for f in range(k)], axis=1)
        return {
            "kept": n.sum(axis=1)[:, None, None] - np.cumsum(removed, axis=2), "removed": removed,
            "redundant": of_filter(fails) - removed, "unique_fails": of_filter(alone),
            "good_lost": gone[..., 1], "toxic_lost": gone[..., 2], "shapley": of_filter(shares),
        }


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter order and step, zeros included."""
    counted = mask_counts(docs, labels)
    # at most 32 masks a part
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))

    def run(batches):
        audit = Audit()
        steps = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(audit.names))
        for batch in batches:
            for lo in range(0, batch.num_rows, PARTS_AT_ONCE):
                piece = batch.slice(lo, PARTS_AT_ONCE)
                counts = np.zeros((piece.num_rows, 1 << len(FILTERS), 3), dtype=np.int64)
                for p, masks in enumerate(piece.column(1).to_pylist()):
                    for m in masks:
                        counts[p, m["mask"]] += (m["n"], m["good"], m["toxic"])
                totals = audit.totals(counts)
                part = piece.column(0).take(pa.array(np.repeat(np.arange(piece.num_rows), len(steps))))
                names = np.tile(np.repeat(np.array(audit.names), len(FILTERS)), piece.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part, pa.array(names), pa.array(np.tile(steps, piece.num_rows)), *[pa.array(totals[c].ravel()) for c in _LONGS]],
                    names=["part", "filter_order", "step", *_LONGS])

    return parts.mapInArrow(run, RESULT)


def op13_filter_audit(spark, sf_dir):
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = rf"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents)
, worded AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts)
, lowest AS (SELECT text, min(doc_id) AS low FROM texts GROUP BY text)
, marked AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id)
, judged AS (SELECT w.part, [len(words) < {MIN_WORDS}, 100*len(list_distinct(words)) < {MIN_DISTINCT_PERCENT}*len(words),
    100*len(regexp_extract_all(w.text, '[A-Z]')) > {MAX_CAPITAL_PERCENT}*length(w.text), regexp_matches(w.text, '{MARKS}'),
    coalesce(w.doc_id > l.low, false)] AS bad, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM worded w JOIN lowest l ON w.text = l.text LEFT JOIN marked m ON w.doc_id = m.doc_id)
, counted AS (SELECT part, bad, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY ALL)
, letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS f)
, orders AS (SELECT [a.f, b.f, c.f, d.f, e.f] AS ord FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5)
, steps AS (SELECT ord, unnest([1, 2, 3, 4, 5]) AS step FROM orders)
, tried AS (SELECT part, ord, step, ord[step] AS f, n, good, toxic, bad[ord[step]] AS fails,
    len(list_filter(ord[1:step - 1], lambda x: bad[x])) > 0 AS before, len(list_filter(bad, lambda x: x)) = 1 AS alone
  FROM counted, steps)
, summed AS (SELECT part, ord, step, f, sum(CASE WHEN NOT fails AND NOT before THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN fails AND NOT before THEN n ELSE 0 END) AS removed, sum(CASE WHEN fails AND before THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails AND alone THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN fails AND NOT before THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN fails AND NOT before THEN toxic ELSE 0 END) AS toxic_lost FROM tried GROUP BY ALL)
SELECT part, list_aggregate(list_transform(ord, lambda x: chr(64 + x)), 'string_agg', '') AS filter_order, step,
  CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM summed
"""

"""Line dedup by an exact set-similarity join over words, in DataFrame functions only.

A line's set holds its distinct words. A line goes if the Jaccard similarity with an earlier line (by id, then by line number)
is ``tenths`` tenths or more; lines are judged on the input. Lines without words stay and match nothing.

1. Words are ordered by rarity: their counts in 2**16 hash buckets (a constant, whatever the input) give a level,
   and ties go by hash. A word is a 64-bit key that sorts in this order.
2. Lines with equal sets (128-bit fingerprints) form a class, known by its first line. All but that first line go.
3. The prefix of a class, n - ceil(t n) + 1 of its rarest words, is joined on the words' keys, shortened to 32 bits: a chance
   match costs a comparison only. Length and positional filters and 128-bit parity signatures (a word that differs turns
   one bit over, however many words there are) leave pairs whose similarity is verified on the sets.
4. Words in the prefixes of more than ``hot`` classes are dealt with in two steps, so that no group is expanded into all
   pairs: each class meets the first class of the word; only classes without a match yet meet all that precede them.

Null and empty texts are one line without words. A null id counts as the largest id. Rows with equal ids have lines at equal
places, none of which is earlier than the other, so such lines are not removed for each other's sake; each is judged by its
own words. Lines may be of any length. Of ``docs`` only ``doc_id`` and ``text`` are read; an empty table has no lines.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from parcelcast.llm.common import store, table

TENTHS, HOT = 8, 256
BUCKETS = 1 << 16
LAST = (1 << 63) - 1
SIGNATURE = ["s1", "s2"]
_SPACE = r"[\x20\x09-\x0D]+"


def lines_of(docs: DataFrame) -> DataFrame:
    """d (id, LAST for null), l (line number from 0) and line."""
    return docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("d"),
                       F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("l", "line"))


def _words(text: Column) -> Column:
    """The words of a text; where blanks are its only white space, it is split without a pattern."""
    others = reduce(lambda x, y: x | y, (F.contains(text, F.lit(c)) for c in "\t\n\x0b\x0c\r"))
    return F.array_remove(F.when(others, F.split(text, _SPACE)).otherwise(F.split(text, " ")), "")


def rarity_levels(docs: DataFrame) -> bytes:
    """A level from 1 to 127 for each hash bucket: rounded logarithm of the words in it."""
    words = docs.select(F.explode(_words(F.replace("text", F.lit("\n"), F.lit(" ")))).alias("word"))  # line ends are white space
    bucket = F.shiftrightunsigned(F.xxhash64("word"), 48)
    counts = words.groupBy(bucket.alias("bucket")).count().toArrow()  # at most BUCKETS rows
    levels = bytearray(b"\x01" * BUCKETS)
    for at, count in zip(counts["bucket"].to_pylist(), counts["count"].to_pylist()):
        levels[at] = min(127, 1 + round(4 * math.log2(1 + count)))
    return bytes(levels)


def with_sets(lines: DataFrame, levels: bytes) -> DataFrame:
    """Adds t, the keys of a line's distinct words from the rarest on."""
    # a constant array of small numbers; functions of array elements are interpreted, so each step of them counts
    table_of_levels = F.split(F.lit(",".join(map(str, levels))), ",").cast("array<tinyint>")

    def key(code: Column) -> Column:
        level = F.get(table_of_levels, F.shiftrightunsigned(code, 48)).cast("long")
        return F.shiftleft(level, 56).bitwiseOR(F.shiftrightunsigned(code, 8))

    codes = F.transform(_words(F.col("line")), lambda word: F.xxhash64(word))
    return lines.withColumn("t", F.sort_array(F.array_distinct(F.transform(codes, key))))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, levels: bytes, tenths: int) -> DataFrame:
    """c of the classes that are similar to an earlier one, of pairs (x, y) of class numbers."""
    asked = pairs.select(F.col("x").alias("c")).union(pairs.select("y")).distinct()
    # written, so that its size is known when the join with the lines is planned
    places = store(classes.join(asked, "c").select("c", "fp1", "f.d", "f.l"), "line-places")
    # rows with equal ids have several lines at a place: the fingerprint tells them apart (as an equality it would become a
    # key of the join, and the sets of all lines would be built for it)
    sets = with_sets(lines_of(docs).join(places, ["d", "l"]), levels).filter(F.xxhash64("t").bitwiseXOR(F.col("fp1")) == 0)
    sets = store(sets.select("c", "d", "l", "t").dropDuplicates(["c"]), "line-sets")
    side = lambda k: sets.select(F.col("c").alias(k), F.struct("d", "l").alias(f"{k}f"), F.col("t").alias(f"{k}t"))
    both = pairs.join(side("x"), "x").join(side("y"), "y")
    common, total = F.size(F.array_intersect("xt", "yt")), F.size("xt") + F.size("yt")
    later = F.when(F.col("xf") > F.col("yf"), F.col("x")).when(F.col("yf") > F.col("xf"), F.col("y"))
    return both.filter(common * 10 >= (total - common) * tenths).select(later.alias("c")).filter("c IS NOT NULL").distinct()


def _pairs(x: DataFrame, y: DataFrame, order: Column, tenths: int) -> DataFrame:
    """Distinct (x, y) of class numbers with a shared prefix word, in ``order``, that pass all filters."""
    x, y = x.alias("x"), y.alias("y")
    n, m = F.col("x.n"), F.col("y.n")
    need = F.ceil((n + m) * tenths / (10 + tenths))
    differ = sum(F.bit_count(F.col(f"x.{s}").bitwiseXOR(F.col(f"y.{s}"))) for s in SIGNATURE)
    fits = (F.least(n, m) * 10 >= F.greatest(n, m) * tenths) & (
        F.least(n - F.col("x.pos"), m - F.col("y.pos")) >= need) & (differ <= n + m - 2 * need)
    return x.join(y, (F.col("x.word") == F.col("y.word")) & order & fits).select(
        F.col("x.c").alias("x"), F.col("y.c").alias("y")).distinct()


def _parity(t: Column, half: int) -> Column:
    """64 bits, each the parity of the number of words that fall on it: a word more or less turns one bit over."""
    def turned(s: Column, w: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), w.bitwiseAND(F.lit(63).cast("long")).cast("int"))
        return F.when(w.bitwiseAND(F.lit(64).cast("long")) == 64 * half, s.bitwiseXOR(bit)).otherwise(s)

    return F.aggregate(t, F.lit(0).cast("long"), turned)


def removed_lines(docs: DataFrame, tenths: int = TENTHS, hot: int = HOT) -> DataFrame:
    """d, l, n (words of the set) and gone for every line."""
    levels = rarity_levels(docs)
    t, n = F.col("t"), F.size("t")
    keep = (n - F.floor((n * tenths + 9) / 10) + 1).cast("int")
    marked = with_sets(lines_of(docs), levels).select(
        "d", "l", n.alias("n"), F.xxhash64("t").alias("fp1"), F.xxhash64(F.lit("second"), "t").alias("fp2"),
        *(_parity(t, half).alias(s) for half, s in enumerate(SIGNATURE)),
        F.when(n > 0, F.transform(F.slice(t, F.lit(1), F.greatest(keep, F.lit(1))), lambda w: F.shiftright(w, 32).cast("int"))).alias("prefix"))
    marked = store(marked, "lines")
    key = ["fp1", "fp2", "n"]
    classes = store(marked.filter("n > 0").groupBy(*key).agg(
        F.min(F.struct("d", "l")).alias("f"), *(F.first(c).alias(c) for c in (*SIGNATURE, "prefix"))).withColumn(
        "c", F.monotonically_increasing_id()), "line-classes")  # numbered once, in the written table
    words = classes.select("c", "f", "n", *SIGNATURE, F.posexplode("prefix").alias("pos", "word"))
    often = store(words.groupBy("word").count().filter(F.col("count") > hot).select("word"), "frequent-words")
    rare = words.drop("f").join(often, "word", "left_anti")
    some = store(words.join(often, "word"), "frequent-places")
    first_of = some.groupBy("word").agg(F.min(F.struct("f", "c", "n", *SIGNATURE, "pos")).alias("lo")).select("word", "lo.*").distinct()
    earlier = F.col("y.f") < F.col("x.f")
    met = store(_pairs(some, first_of, earlier, tenths), "line-pairs")
    flagged = store(_verified(met, classes, docs, levels, tenths), "flagged")
    still = some.join(flagged, "c", "left_anti")
    rest = store(_pairs(rare, rare, F.col("y.c") < F.col("x.c"), tenths).union(_pairs(still, some, earlier, tenths)).distinct(), "line-pairs")
    flagged = flagged.union(_verified(rest, classes, docs, levels, tenths)).distinct().withColumn("flag", F.lit(True))
    judged = classes.join(flagged, "c", "left").select(*key, "f", F.coalesce("flag", F.lit(False)).alias("flag"))
    later = (F.col("d") > F.col("f.d")) | ((F.col("d") == F.col("f.d")) & (F.col("l") > F.col("f.l")))
    return marked.select("d", "l", *key).join(judged, key, "left").select(
        "d", "l", "n", F.coalesce(later | F.col("flag"), F.lit(False)).alias("gone"))


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the removed lines cut out of ``text``; all columns and rows stay, and a null text stays null."""
    gone = removed_lines(docs, **options).filter("gone").groupBy("d").agg(F.collect_set("l").alias("_gone"))
    joined = docs.join(gone, F.coalesce(docs["doc_id"], F.lit(LAST)) == gone["d"], "left")
    kept = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("_gone", i))
    return joined.withColumn("text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))).select(
        *docs.columns)


def op3_line_dedup(spark, sf_dir):
    lines = removed_lines(table(spark, sf_dir, "documents"))
    return lines.groupBy("d").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("gone").cast("long")).alias("n_removed"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("gone"), F.col("l")))), ",").alias("removed"),
    ).select(F.nullif("d", F.lit(LAST)).alias("doc_id"), "n_lines", "n_removed", "removed")


ORACLE = r"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS l FROM documents)
, sets AS (SELECT doc_id, l, list_sort(list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))) AS t FROM lines)
, distinct_sets AS (SELECT t, len(t) AS n, min(doc_id * 1000000 + l) AS f FROM sets WHERE len(t) > 0 GROUP BY t)
, words AS (SELECT f, n, unnest(t) AS w FROM distinct_sets)
, df AS (SELECT w, count(*) AS c FROM words GROUP BY w)
, ranked AS (SELECT f, n, w, row_number() OVER (PARTITION BY f ORDER BY c, w) AS r FROM words JOIN df USING (w))
, prefix AS (SELECT f, n, w FROM ranked WHERE r <= n - (8*n + 9) // 10 + 1)
, pairs AS (SELECT DISTINCT x.f AS x, y.f AS y FROM prefix x JOIN prefix y ON x.w = y.w AND y.f < x.f
    AND 10*least(x.n, y.n) >= 8*greatest(x.n, y.n))
, alike AS (SELECT DISTINCT p.x FROM pairs p JOIN distinct_sets a ON a.f = p.x JOIN distinct_sets b ON b.f = p.y
  WHERE 10*len(list_intersect(a.t, b.t)) >= 8*(a.n + b.n - len(list_intersect(a.t, b.t))))
, judged AS (SELECT s.doc_id, s.l, d.f IS NOT NULL AND (s.doc_id * 1000000 + s.l > d.f OR d.f IN (SELECT x FROM alike)) AS gone
  FROM sets s LEFT JOIN distinct_sets d ON s.t = d.t)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_removed,
  coalesce(string_agg(CASE WHEN gone THEN CAST(l AS VARCHAR) END, ',' ORDER BY l), '') AS removed FROM judged GROUP BY doc_id
"""

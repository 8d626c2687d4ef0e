"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree, in DataFrame functions only.

Sources in code-point order, null last, weigh 1, 2, 3, repeating. Their targets share the words of all documents by weight;
no target exceeds ``most_repeats`` times its source, and what is cut goes to the others by weight.

Each source is dealt into blocks by a hash of the id. A source takes all its blocks as often as its target holds it whole;
the rest of the target is a quota that is drawn exactly: blocks in permuted order as long as they fit, then the parts of the
block at the border, then its documents, the last of them if at least half of it fits. The block draws are the units of a
tree that halves them level by level: at each node a random half of the units goes left. So the counts of the sources
among a node's children are a multivariate-hypergeometric draw with exact sums, and the leaves, the output shards,
hold disjoint units. Inside its shard a copy has a random ``place``.

Everything is a function of ids, sizes and the seed, so reruns agree on any layout. Null text has no words. A null id is
an id of its own; rows with the same id and size get equal treatment, except that one of them may be the border of a
draw. Without words all targets are 0 and nothing is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelcast.llm.common import WORD, store, table

BLOCKS, PARTS, SHARDS, SEED = 64, 1024, 8, "mix-1"


def _number(text: Column, start: int) -> Column:
    return F.conv(F.substring(F.md5(text), start, 8), 16, 10).cast("long")


def sized(docs: DataFrame, blocks: int = BLOCKS, parts: int = PARTS, seed: str = SEED) -> DataFrame:
    """Narrow rows: id, source key (null sorts last), size in words, and the block, part and order drawn from the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))
    return docs.select(
        "doc_id", F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("a"), "source")).alias("src"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        (_number(key, 1) % blocks).alias("block"), (_number(key, 9) % parts).alias("part"), F.md5(key).alias("ord"),
    )


def targets(totals: DataFrame, most_repeats: int = 3) -> DataFrame:
    """src, source_size and target from (src, source_size), one row per source."""
    by_name, before = Window.orderBy("src"), Window.orderBy("ratio", "src").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    cap = F.lit(most_repeats) * F.col("source_size")
    weighed = totals.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long"))
    stepped = weighed.withColumn("ratio", cap / F.col("weight")).withColumn(
        # what a unit of weight gets if all sources before this one are held at their cap
        "level", (F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0)))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    return stepped.select(
        "src", "source_size", F.least(cap.cast("double"), F.max("level").over(every) * F.col("weight")).alias("target"))


def _drawn(rows: DataFrame, group: list[str], order: list[Column], size: str, quota: str) -> DataFrame:
    """Adds the sizes before a row in the order of its group."""
    running = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("ahead", F.coalesce(F.sum(size).over(running), F.lit(0))).withColumn(
        "fits", F.col("ahead") + F.col(size) <= F.col(quota)).withColumn(
        "border", ~F.col("fits") & (F.col("ahead") < F.col(quota)))


def split_tree(units: DataFrame, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """Adds ``shard``: units are halved at random, level by level, until there are ``shards`` leaves."""
    levels, out = max(0, (shards - 1).bit_length()), units.withColumn("shard", F.lit(0).cast("long"))
    for level in range(levels):
        key = F.md5(F.concat_ws(":", F.lit(f"{seed}:{level}"), "src", "block", "turn"))
        node = Window.partitionBy("shard")
        rank = F.row_number().over(node.orderBy(key, "src", "block", "turn"))
        # two windows over one partitioning: one exchange a level
        out = out.withColumn("_rank", rank).withColumn("_n", F.count(F.lit(1)).over(node)).withColumn(
            "shard", F.col("shard") * 2 + F.when(F.col("_rank") * 2 <= F.col("_n") + 1, 0).otherwise(1)).drop("_rank", "_n")
    return out


def mix(docs: DataFrame, blocks: int = BLOCKS, parts: int = PARTS, shards: int = SHARDS, seed: str = SEED,
        most_repeats: int = 3) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and the shards of the copies, for every document.

    ``shards`` lists the shard of each copy in order of the passes.
    """
    rows = store(sized(docs, blocks, parts, seed), "mix-sizes")
    by_block = rows.groupBy("src", "block").agg(F.sum("size").alias("block_size"))
    by_block = store(by_block, "mix-blocks")
    goal = targets(by_block.groupBy("src").agg(F.sum("block_size").alias("source_size")), most_repeats)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("whole", whole).withColumn("quota", F.col("target") - F.col("whole") * F.col("source_size"))
    blocked = _drawn(by_block.join(goal, "src"), ["src"],
                     [F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), "src", "block")), F.col("block")], "block_size", "quota")
    blocked = store(blocked.withColumn("turns", F.col("whole") + F.when(F.col("fits") | F.col("border"), 1).otherwise(0)),
                    "mix-draws")
    turn = F.explode(F.sequence(F.lit(1), F.col("turns").cast("int")))
    units = split_tree(blocked.filter("turns > 0").select("src", "block", turn.alias("turn")), shards, seed)
    placed = units.groupBy("src", "block").agg(F.array_sort(F.collect_list(F.struct("turn", "shard"))).alias("leaves"))
    plan = blocked.join(placed, ["src", "block"], "left").select(
        "src", "block", "source_size", "target", "whole", "fits", "border", F.coalesce(
            F.transform("leaves", lambda x: x["shard"]), F.array().cast("array<long>")).alias("leaves"))
    # the border blocks: at most one a source
    edge = blocked.filter("border").select("src", "block", (F.col("quota") - F.col("ahead")).alias("left_over"))
    edge_parts = _drawn(
        rows.join(edge, ["src", "block"]).groupBy("src", "block", "part", "left_over").agg(F.sum("size").alias("part_size")),
        ["src", "block"], [F.col("part")], "part_size", "left_over")
    edge_parts = store(edge_parts.select("src", "block", "part", "fits", "border",
                                         (F.col("left_over") - F.col("ahead")).alias("remaining")), "mix-parts")
    last = rows.join(edge_parts.filter("border").drop("fits", "border"), ["src", "block", "part"])
    order = Window.partitionBy("src", "block", "part").orderBy("ord", "doc_id", "size")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = last.withColumn("within", before + F.col("size") * 0.5 <= F.col("remaining")).withColumn(
        "nth", F.row_number().over(order))
    whole_parts = rows.join(edge_parts.filter("fits").select("src", "block", "part"), ["src", "block", "part"], "left_semi")
    drawn = last.filter("within").select("ord", "doc_id", "size").unionByName(whole_parts.select("ord", "doc_id", "size"))
    drawn = drawn.groupBy("ord", "size").agg(F.count(F.lit(1)).alias("hits"))
    # rows alike in id and size are told apart by number: the first ``hits`` of them are drawn
    alike = Window.partitionBy("ord", "size").orderBy("doc_id")
    edged = rows.join(edge.drop("left_over"), ["src", "block"], "left_semi").withColumn("nth", F.row_number().over(alike))
    edged = edged.join(drawn, ["ord", "size"], "left").withColumn("extra", F.col("nth") <= F.coalesce("hits", F.lit(0)))
    rest = rows.join(edge.drop("left_over"), ["src", "block"], "left_anti").withColumn("extra", F.lit(False))
    both = edged.select(*rows.columns, "extra").unionByName(rest.select(*rows.columns, "extra"))
    copies = F.col("whole") + F.when(F.col("fits") | F.col("extra"), 1).otherwise(0)
    return both.join(plan, ["src", "block"]).select(
        "doc_id", "size", F.col("source_size").cast("long"), "target", (copies * F.col("size")).alias("taken"),
        copies.alias("copies"), F.slice("leaves", F.lit(1), copies.cast("int")).alias("shards"))


def draw(docs: DataFrame, mixed: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: a row of ``docs`` for every copy, with ``shard`` and a random ``place`` to sort by in its shard.

    An id that occurs more than once in ``docs`` takes the largest of its rows' copies.
    """
    per_id = mixed.groupBy("doc_id").agg(F.max_by("shards", "copies").alias("shards")).withColumnRenamed("doc_id", "_id")
    leaf = F.posexplode("_shards")
    joined = docs.join(per_id.withColumnRenamed("shards", "_shards"), docs["doc_id"].eqNullSafe(F.col("_id")))
    return joined.select(*[docs[c] for c in docs.columns], leaf.alias("_pass", "shard")).withColumn(
        "place", F.md5(F.concat_ws(":", F.lit(f"{seed}:place"), "shard", F.col("doc_id").cast("string"), "_pass"))).drop("_pass")


def op7_mixing(spark, sf_dir):
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.withColumn("shards", F.array_join("shards", ","))


_N = "CAST('0x' || substr(md5({key}), {at}, 8) AS BIGINT)"
_TREE = "".join(f"""
, ranked{i} AS (SELECT src, block, turn, shard, row_number() OVER (PARTITION BY shard
    ORDER BY md5('{SEED}:{i}:' || src || ':' || block || ':' || turn), src, block, turn) AS r, count(*) OVER (PARTITION BY shard) AS n
  FROM tree{i})
, tree{i + 1} AS (SELECT src, block, turn, shard*2 + CASE WHEN r*2 <= n + 1 THEN 0 ELSE 1 END AS shard FROM ranked{i})"""
                for i in range(3))
ORACLE = rf"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 'a' || source END AS src,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    '{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'none') AS k FROM documents)
, rowset AS (SELECT doc_id, src, size, md5(k) AS ord, {_N.format(key='k', at=1)} % {BLOCKS} AS block,
    {_N.format(key='k', at=9)} % {PARTS} AS part FROM sized)
, blocks AS (SELECT src, block, CAST(sum(size) AS BIGINT) AS block_size FROM rowset GROUP BY ALL)
, totals AS (SELECT src, CAST(sum(block_size) AS BIGINT) AS source_size FROM blocks GROUP BY ALL)
, weighed AS (SELECT *, (row_number() OVER (ORDER BY src) - 1) % 3 + 1 AS weight FROM totals)
, stepped AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3*source_size) OVER w, 0) AS DOUBLE)
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS DOUBLE) AS level FROM weighed
  WINDOW w AS (ORDER BY CAST(3*source_size AS DOUBLE)/weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
, goal AS (SELECT src, source_size, least(CAST(3*source_size AS DOUBLE), max(level) OVER () * weight) AS target FROM stepped)
, goal2 AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target/source_size) AS BIGINT) ELSE 0 END AS whole FROM goal)
, goal3 AS (SELECT *, target - whole*source_size AS quota FROM goal2)
, ahead AS (SELECT b.*, g.* EXCLUDE (src), coalesce(sum(block_size) OVER (PARTITION BY b.src
    ORDER BY md5('{SEED}:order:' || b.src || ':' || block), block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM blocks b JOIN goal3 g ON b.src = g.src)
, drawn AS (SELECT *, ahead + block_size <= quota AS fits, ahead + block_size > quota AND ahead < quota AS border FROM ahead)
, tree0 AS (SELECT src, block, unnest(range(1, whole + CASE WHEN fits OR border THEN 2 ELSE 1 END)) AS turn, 0 AS shard FROM drawn)
{_TREE}
, leaves AS (SELECT src, block, list(shard ORDER BY turn) AS leaves FROM tree3 GROUP BY ALL)
, parts AS (SELECT r.src, r.block, r.part, any_value(d.quota - d.ahead) AS left_over, sum(r.size) AS part_size
  FROM rowset r JOIN drawn d ON r.src = d.src AND r.block = d.block WHERE d.border GROUP BY r.src, r.block, r.part)
, part_ahead AS (SELECT *, coalesce(sum(part_size) OVER (PARTITION BY src, block ORDER BY part
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pa FROM parts)
, rows2 AS (SELECT r.*, d.source_size, d.target, d.whole, d.fits, l.leaves, p.left_over - p.pa AS remaining,
    p.pa + p.part_size <= p.left_over AS part_fits, p.pa + p.part_size > p.left_over AND p.pa < p.left_over AS part_border,
    coalesce(sum(r.size) OVER (PARTITION BY r.src, r.block, r.part ORDER BY r.ord, r.doc_id, r.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rowset r JOIN drawn d ON r.src = d.src AND r.block = d.block
  LEFT JOIN leaves l ON r.src = l.src AND r.block = l.block
  LEFT JOIN part_ahead p ON r.src = p.src AND r.block = p.block AND r.part = p.part)
, copied AS (SELECT *, whole + CASE WHEN fits OR coalesce(part_fits, false)
    OR (coalesce(part_border, false) AND before + size*0.5 <= remaining) THEN 1 ELSE 0 END AS copies FROM rows2)
SELECT doc_id, size, source_size, target, copies*size AS taken, copies,
  coalesce(array_to_string(leaves[1:copies], ','), '') AS shards FROM copied
"""

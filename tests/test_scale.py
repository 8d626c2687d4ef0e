"""Plans and results under skew: a third of all rows on one key."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from parcelcast import contracts as K
from parcelcast.operators import evaluation, features, ordering, profiling, selection, splits, trees
from parcelcast.plans import jobs
from parcelcast.sources import files, standins

SF = "/root/testdata/sf0.001"
QUERIES = ["feature_table", "chronological_split", "expanding_folds", "ranking_metrics", "segment_reports",
           "threshold_sweep", "calibration_table", "drift_summary", "foreign_key_check", "geo_lookup",
           "matured_label_quality", "delay_histogram", "fold_metrics"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_cross_join_and_no_raw_rows_in_one_task(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(entry_point.queries()[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    lines = text.split("\n")
    for line, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in line:
            # only partial totals, or one row per partition
            assert re.search(r"Aggregate\(keys?=\[(_part#\d+)?\]", below), below


def test_columns_and_filters_reach_the_scan(spark):
    orders = files.read_parquet(spark, f"{SF}/orders.parquet", ["o_orderkey", "o_orderdate"])
    text = plan(orders.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_written_splits_are_pruned(spark, tmp_path):
    df = spark.range(10).select("id", F.when(F.col("id") < 7, "train").otherwise("test").alias("split"))
    df.write.partitionBy("split").parquet(str(tmp_path / "s"))
    text = plan(spark.read.parquet(str(tmp_path / "s")).filter("split = 'test'"))
    assert "PartitionFilters: [isnotnull(split" in text


@pytest.fixture()
def hot_items(spark):
    """Order lines where one order, one product and one seller each hold at least a third of the rows."""
    items = standins.view(spark, SF, "order_items")
    roll = F.pmod(F.xxhash64("order_id", "order_item_id", "product_id"), F.lit(3))
    return items.select(
        F.when(roll == 0, F.lit(1)).otherwise(F.col("order_id")).alias("order_id"), "order_item_id",
        F.when(roll == 1, F.lit(7)).otherwise(F.col("product_id")).alias("product_id"),
        F.when(roll == 2, F.lit(3)).otherwise(F.col("seller_id")).alias("seller_id"), "price", "freight_value",
    )


def test_hot_order_keeps_all_its_lines(spark, hot_items):
    got = features.order_item_features(hot_items).filter("order_id = 1").first()
    lines = hot_items.filter("order_id = 1").toPandas()
    assert got.item_count == len(lines) > 1500
    assert got.unique_products == lines["product_id"].nunique() and got.seller_count == lines["seller_id"].nunique()
    assert got.total_price == pytest.approx(lines["price"].sum())


def test_skewed_product_join_is_split_at_run_time(spark, hot_items):
    tuned = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in tuned.items():
        spark.conf.set(k, v)
    try:
        df = features.product_enrichment(hot_items.repartition(8), standins.view(spark, SF, "products"),
                                         standins.view(spark, SF, "category_translation"))
        rows = df.collect()
        assert "skew=true" in plan(df)
        assert len(rows) == hot_items.count()
    finally:
        for k in tuned:
            spark.conf.unset(k)


def test_hot_score_and_hot_segment(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 20)).alias("segment"),
        F.when(F.col("id") % 3 == 1, F.lit(0.5)).otherwise((F.col("id") * 37 % 1000) / 1000.0).alias("probability"),
        (F.pmod(F.xxhash64("id"), F.lit(4)) == 0).cast("int").alias("late_delivery"),
    )
    rows = evaluation.segment_metrics(df, "segment", 1, 1).collect()
    assert sum(r["rows"] for r in rows) == 3000 and rows[0].segment == "hot" and rows[0]["rows"] == 1000
    exact = df.filter("segment = 'hot'")
    assert rows[0].pr_auc == pytest.approx(evaluation.ranking_metrics(exact).first().pr_auc)


def test_hot_foreign_key(spark):
    child = spark.range(900).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    r = profiling.foreign_key_check(child, "k", spark.range(900).withColumnRenamed("id", "k"), "k", "x").first()
    assert (r.child_rows_non_null, r.unknown_fk_rows, r.unknown_fk_unique_values) == (900, 300, 1)


def test_rank_is_the_same_after_recomputation(spark):
    df = spark.range(2000).select("id", (F.col("id") % 11).alias("t"))
    ranked = ordering.global_rank(df.repartition(6), ["t", "id"])
    assert ranked.exceptAll(ordering.global_rank(df.repartition(3), ["t", "id"])).count() == 0


def test_feature_shuffles_follow_the_rows_not_the_session(spark, monkeypatch):
    """Rows by order are placed once a path, by a number of partitions of their own: no wide row is shuffled again."""
    monkeypatch.setattr(features, "PARTITION_ROWS", 500)
    tables = {name: standins.view(spark, SF, name) for name in jobs.FEATURE_INPUTS}
    want = features._parts(tables["order_items"], tables["payments"])
    assert want == -(-tables["order_items"].count() // 500) > 8
    tuned = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in tuned.items():
        spark.conf.set(k, v)
    try:
        text = plan(jobs.build_features(spark, SF))
    finally:
        for k in tuned:
            spark.conf.unset(k)
    placed = re.findall(r"Exchange hashpartitioning\(order_id#\d+L, (\d+)\)", text)
    assert len(placed) >= 5 and set(placed) == {str(want)}
    assert not re.search(r"Exchange hashpartitioning\(order_id#\d+L, (product_id|category|seller_id|seller_state)", text)


def test_product_features_place_rows_by_order_once(spark, monkeypatch):
    """(order, product) and (order, category) take no shuffle of their own, and what a task holds does not grow."""
    monkeypatch.setattr(features, "PARTITION_ROWS", 500)
    items, products, translation = (standins.view(spark, SF, n) for n in ("order_items", "products", "category_translation"))
    text = plan(features.order_product_features(items, products, translation))
    parts = features._parts(items)
    assert re.findall(r"Exchange hashpartitioning\(order_id#\d+L[^)]*\)", text) and not re.search(r"hashpartitioning\(order_id#\d+L, (product_id|category)", text)
    assert set(re.findall(r"hashpartitioning\(order_id#\d+L, (\d+)\)", text)) == {str(parts)}


def test_the_sketches_that_are_merged_do_not_grow_with_the_partitions(spark, monkeypatch):
    sc, x = spark.sparkContext, F.col("id").cast("double")
    rows = spark.range(0, 40000, 1, 300)

    def most_tasks(name, work):
        sc.setJobGroup(name, name)
        try:
            found = work()
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        tracker = sc.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup(name) for s in tracker.getJobInfo(j).stageIds]
        return found, max(info.numTasks for info in map(tracker.getStageInfo, stages) if info)

    found, tasks = most_tasks("sketched", lambda: selection.sketched(rows, {"x": x}, {"m": 0.5}, 1000))
    assert tasks <= sc.defaultParallelism and abs(found["x"]["m"] - 20000) <= 100
    assert selection.summarize(rows, {"x": x}, {"m": 0.5})["x"]["m"] == 19999.5
    ranked = rows.select((F.col("id") + 1).alias("row_num"), (F.col("id") % 2).cast("int").alias(K.TARGET),
                         *[x.alias(c) for c in K.NUMERIC_FEATURES], *[F.lit("a").alias(c) for c in K.CATEGORICAL_FEATURES])
    with monkeypatch.context() as m:
        sketches, real = [], trees.for_sketches
        m.setattr(trees, "for_sketches", lambda df: sketches.append(real(df)) or sketches[-1])
        assert trees.fit_bins(ranked, [splits.Fold(1, 40000, 40000)])[1].rows == 40000
    assert sketches[0].rdd.getNumPartitions() <= sc.defaultParallelism

import pytest
from pyspark.sql import functions as F

from parcelcast import contracts as K
from parcelcast.operators import splits


@pytest.fixture(scope="module")
def hours(spark):
    return spark.range(100).select(
        F.concat(F.lit("order_"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("order_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias(K.PREDICTION_TS),
        (F.col("id") % 7 == 0).cast("int").alias(K.TARGET),
    ).repartition(5)


def test_split_is_chronological_and_disjoint(hours):
    split = splits.chronological_split(hours)
    assert {r.split: r["count"] for r in split.groupBy("split").count().collect()} == {
        "train": 70, "validation": 15, "test": 15}
    assert all(r.violations == 0 for r in splits.split_invariants(split).collect())


def test_twenty_rows_split(hours):
    split = splits.chronological_split(hours.filter("order_id < 'order_020'"))
    assert {r.split: r["count"] for r in split.groupBy("split").count().collect()} == {
        "train": 14, "validation": 3, "test": 3}


def test_invariants_notice_overlap(hours):
    wrong = splits.chronological_split(hours).withColumn(
        "split", F.when(F.col("row_num") == 1, F.lit("test")).otherwise(F.col("split")))
    assert {r.rule: r.violations for r in splits.split_invariants(wrong).collect()}["splits_are_in_time_order"] == 1


@pytest.mark.parametrize("fractions", [(0.0, 0.1), (0.9, 0.1), (0.7, 1.0)])
def test_bad_fractions(fractions):
    with pytest.raises(K.ContractError):
        splits.split_bounds(10, *fractions)


def test_fold_sizes_give_the_remainder_to_the_first_blocks(hours):
    folds = splits.fold_bounds(102)
    assert [f.train_end for f in folds] == [51, 64, 77, 90]
    assert [f.validation_end - f.train_end for f in folds] == [13, 13, 13, 12]
    folds = splits.fold_bounds(100)
    assert [f.train_end for f in folds] == [50, 63, 76, 88]
    rows = splits.fold_summary(splits.chronological_order(hours), folds).orderBy("fold").collect()
    assert [(r.train_rows, r.validation_rows) for r in rows] == [(50, 13), (63, 13), (76, 12), (88, 12)]
    assert all(r.train_end <= r.validation_start for r in rows)


def test_train_and_validation_never_share_a_row(hours):
    members = splits.expanding_folds(splits.chronological_order(hours), splits.fold_bounds(100))
    assert members.groupBy("fold", "order_id").count().filter("count > 1").count() == 0


@pytest.mark.parametrize("args", [(100, 1), (100, 4, 0.1), (3, 4, 0.5)])
def test_bad_folds(args):
    with pytest.raises(K.ContractError):
        splits.fold_bounds(*args)

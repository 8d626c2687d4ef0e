"""Chronological order, splits and expanding-window folds."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelcast.contracts import CHRONOLOGICAL, ContractError, ORDER_KEY, PREDICTION_TS, TARGET
from parcelcast.operators.ordering import global_rank

SPLITS = ("train", "validation", "test")


def chronological_order(df: DataFrame) -> DataFrame:
    """Rows with their 1-based position by prediction moment, then order id."""
    return global_rank(df, CHRONOLOGICAL)


def split_bounds(rows: int, train_fraction: float, validation_fraction: float) -> tuple[int, int]:
    """Last positions of train and validation; plain float products, truncated."""
    for name, fraction in (("train", train_fraction), ("validation", validation_fraction)):
        if not 0 < fraction < 1:
            raise ContractError(f"{name} fraction must lie between 0 and 1")
    if train_fraction + validation_fraction >= 1:
        raise ContractError("train and validation fractions must sum to less than 1")
    return int(rows * train_fraction), int(rows * (train_fraction + validation_fraction))


def chronological_split(
    df: DataFrame, train_fraction: float = 0.70, validation_fraction: float = 0.15
) -> DataFrame:
    """Rows with ``row_num`` and ``split``; later splits hold later orders."""
    split_bounds(1, train_fraction, validation_fraction)
    ranked = chronological_order(df)
    train_end, validation_end = split_bounds(ranked.count(), train_fraction, validation_fraction)
    position = F.col("row_num")
    return ranked.withColumn(
        "split",
        F.when(position <= train_end, F.lit("train"))
        .when(position <= validation_end, F.lit("validation"))
        .otherwise(F.lit("test")),
    )


def split_views(split: DataFrame) -> dict[str, DataFrame]:
    return {name: split.filter(F.col("split") == name).drop("split") for name in SPLITS}


def split_summary(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(PREDICTION_TS).alias("start"),
        F.max(PREDICTION_TS).alias("end"),
        F.avg(TARGET).alias("late_rate"),
    )


def split_invariants(split: DataFrame) -> DataFrame:
    """Violations: orders in several splits, splits that overlap in time, rows outside the three splits."""
    place = F.array_position(F.array(*[F.lit(s) for s in SPLITS]), F.col("split"))
    shared = (
        split.groupBy(ORDER_KEY)
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .agg(F.count(F.when(F.col("first") < F.col("last"), F.lit(1))).alias("violations"))
        .select(F.lit("splits_are_disjoint").alias("rule"), "violations")
    )
    spans = split.groupBy("split").agg(F.min(PREDICTION_TS).alias("lo"), F.max(PREDICTION_TS).alias("hi"))
    # three rows, one per split
    previous_end = F.lag("hi").over(Window.partitionBy(F.lit(0)).orderBy(place))
    ordered = (
        spans.withColumn("late_start", F.col("lo") < previous_end)
        .agg(F.count(F.when(F.col("late_start"), F.lit(1))).alias("violations"))
        .select(F.lit("splits_are_in_time_order").alias("rule"), "violations")
    )
    known = F.coalesce(F.col("split").isin(*SPLITS), F.lit(False))
    outside = split.agg(F.count(F.when(~known, F.lit(1))).alias("violations"))
    return shared.unionByName(ordered).unionByName(
        outside.select(F.lit("every_row_has_a_split").alias("rule"), "violations")
    )


def development_union(train: DataFrame, validation: DataFrame) -> DataFrame:
    """Train and validation rows together, re-ranked; the order key must stay unique."""
    both = train.unionByName(validation)
    return chronological_order(both.drop("row_num"))


@dataclass(frozen=True)
class Fold:
    """Positions of one expanding-window fold: train is 1..train_end, validation the block after it."""

    number: int
    train_end: int
    validation_end: int

    def in_train(self, position: Column) -> Column:
        return position <= self.train_end

    def in_validation(self, position: Column) -> Column:
        return (position > self.train_end) & (position <= self.validation_end)


def fold_bounds(rows: int, n_splits: int = 4, initial_train_fraction: float = 0.50) -> list[Fold]:
    """Folds after an initial training window; the first blocks take the remainder, one row each."""
    if n_splits < 2:
        raise ContractError("at least two folds are needed")
    if not 0.2 <= initial_train_fraction < 1.0:
        raise ContractError("the initial train fraction must lie in [0.2, 1)")
    start = int(rows * initial_train_fraction)
    size, remainder = divmod(rows - start, n_splits)
    if size < 1:
        raise ContractError("not enough rows for the requested folds")
    folds = []
    for number in range(1, n_splits + 1):
        end = start + size + (1 if number <= remainder else 0)
        folds.append(Fold(number, start, end))
        start = end
    return folds


def expanding_folds(ranked: DataFrame, folds: Sequence[Fold]) -> DataFrame:
    """One row per (row, fold, role); a train row appears once for each fold that trains on it.

    Membership comes from the row's own position, so no join or shuffle takes place.
    """
    position = F.col("row_num")
    roles = F.array_compact(F.array(*[
        F.when(f.in_train(position), F.struct(F.lit(f.number).alias("fold"), F.lit("train").alias("role")))
        .when(f.in_validation(position), F.struct(F.lit(f.number).alias("fold"), F.lit("validation").alias("role")))
        for f in folds
    ]))
    return ranked.withColumn("_m", F.explode(roles)).select("*", "_m.fold", "_m.role").drop("_m")


def fold_summary(ranked: DataFrame, folds: Sequence[Fold], target: str = TARGET) -> DataFrame:
    """Rows, time span and late rate of the train and validation part of each fold."""
    train, validation = F.col("role") == "train", F.col("role") == "validation"
    members = expanding_folds(ranked.select("row_num", PREDICTION_TS, target), folds)
    return members.groupBy("fold").agg(
        F.count(F.when(train, F.lit(1))).alias("train_rows"),
        F.count(F.when(validation, F.lit(1))).alias("validation_rows"),
        F.min(F.when(train, F.col(PREDICTION_TS))).alias("train_start"),
        F.max(F.when(train, F.col(PREDICTION_TS))).alias("train_end"),
        F.min(F.when(validation, F.col(PREDICTION_TS))).alias("validation_start"),
        F.max(F.when(validation, F.col(PREDICTION_TS))).alias("validation_end"),
        F.avg(F.when(train, F.col(target))).alias("train_late_rate"),
        F.avg(F.when(validation, F.col(target))).alias("validation_late_rate"),
    )


def top_n(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of a report; Spark keeps ``n`` rows per task instead of sorting everything."""
    return df.orderBy(*order).limit(n)

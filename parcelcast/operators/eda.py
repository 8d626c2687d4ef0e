"""Grouped late-rate reports and distribution summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from parcelcast.contracts import SIGNAL_FEATURES, TARGET
from parcelcast.functions.expressions import as_column, flag_count, month_of
from parcelcast.operators.ordering import (
    COLUMN_ID, exact_quantiles, melt_numeric, named_columns, null_safe_match, value_counts_table,
    with_scalar,
)
from parcelcast.operators.selection import describe_columns

# Weekday names, Monday first.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def rate_by(df: DataFrame, key: Column | str, name: str, target: str = TARGET, keep_null: bool = False) -> DataFrame:
    """Orders and late rate per value of ``key``."""
    grouped = df.groupBy(as_column(key).alias(name)).agg(
        F.count(target).alias("orders"), F.avg(target).alias("late_rate")
    )
    return grouped if keep_null else grouped.filter(F.col(name).isNotNull())


def monthly_late_rate(orders: DataFrame) -> DataFrame:
    return rate_by(orders, month_of("order_purchase_timestamp"), "purchase_month").orderBy("purchase_month")


def weekday_late_rate(orders: DataFrame) -> DataFrame:
    """All seven weekdays, also those without orders."""
    rates = rate_by(orders, F.weekday("order_purchase_timestamp"), "weekday")
    names = orders.sparkSession.createDataFrame(list(enumerate(WEEKDAYS)), "weekday int, purchase_weekday string")
    return names.join(rates, "weekday", "left").orderBy("weekday").select(
        "weekday", "purchase_weekday", "orders", "late_rate"
    )


def hourly_late_rate(orders: DataFrame) -> DataFrame:
    return rate_by(orders, F.hour("order_purchase_timestamp"), "purchase_hour").orderBy("purchase_hour")


def state_late_rate(orders: DataFrame, customers: DataFrame, minimum_orders: int = 0) -> DataFrame:
    joined = orders.select("customer_id", TARGET).join(
        customers.select("customer_id", "customer_state"), "customer_id", "left"
    )
    rates = rate_by(joined, "customer_state", "customer_state").filter(F.col("orders") >= minimum_orders)
    return rates.orderBy(F.desc("late_rate"), F.desc("orders"), "customer_state")


def item_count_late_rate(features: DataFrame, n: int = 20) -> DataFrame:
    return rate_by(features, "item_count", "item_count").orderBy("item_count").limit(n)


def seller_count_late_rate(features: DataFrame) -> DataFrame:
    return rate_by(features, "seller_count", "seller_count").orderBy("seller_count")


def payment_type_late_rate(features: DataFrame) -> DataFrame:
    return rate_by(features, "primary_payment_type", "payment_type").orderBy(F.desc("orders"), "payment_type")


def category_late_rate(orders: DataFrame, dominant: DataFrame, n: int = 20) -> DataFrame:
    joined = orders.select("order_id", TARGET).join(dominant, "order_id", "left")
    return rate_by(joined, "dominant_category", "dominant_category").orderBy(
        F.desc("orders"), "dominant_category"
    ).limit(n)


def same_state_late_rate(features: DataFrame) -> DataFrame:
    return rate_by(features, "all_sellers_same_state", "all_sellers_same_state")


def describe_by_target(features: DataFrame, columns: Sequence[str], target: str = TARGET) -> DataFrame:
    return describe_columns(features, columns, [target])


def numeric_signal_summary(features: DataFrame, columns: Sequence[str] = tuple(SIGNAL_FEATURES)) -> DataFrame:
    """Class means of each signal and their difference, in one pass over the table."""
    late, on_time = F.col(TARGET) == 1, F.col(TARGET) == 0
    means = melt_numeric(features, [TARGET], columns).groupBy(COLUMN_ID).agg(
        F.avg(F.when(on_time, F.col("value"))).alias("on_time_mean"),
        F.avg(F.when(late, F.col("value"))).alias("late_mean"),
        flag_count(F.col("value").isNull()).alias("missing"),
    )
    difference = F.col("late_mean") - F.col("on_time_mean")
    named = named_columns(means, columns)
    return named.withColumn("mean_difference_late_minus_on_time", difference).orderBy(
        F.desc(F.abs("mean_difference_late_minus_on_time")), "feature"
    )


def histogram(df: DataFrame, column: str, bins: int, low: float | None = None, high: float | None = None) -> DataFrame:
    """Equal-width bin counts over the observed range; the last bin is closed, empty bins are kept.

    ``low`` and ``high`` filter the rows first.
    """
    x = F.col(column)
    rows = df.filter(x.isNotNull())
    if low is not None and high is not None:
        rows = rows.filter(x.between(F.lit(float(low)), F.lit(float(high))))
    limits = rows.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    low_edge, width = F.col("_range.lo"), (F.col("_range.hi") - F.col("_range.lo")) / F.lit(float(bins))
    position = F.coalesce(F.floor(F.try_divide(x - low_edge, width)), F.lit(0)).cast("int")
    counted = (
        with_scalar(rows.select(column), "_range", limits)
        .groupBy(F.least(position, F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return with_scalar(all_bins.join(counted, "bin", "left"), "_range", limits).select(
        "bin",
        (low_edge + width * F.col("bin")).alias("bin_start"),
        F.coalesce("orders", F.lit(0)).cast("bigint").alias("orders"),
    )


def boxplot_stats(features: DataFrame, columns: Sequence[str], target: str = TARGET) -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 IQR, and the number of outliers by target."""
    groups = [COLUMN_ID, target]
    long = melt_numeric(features, [target], columns)
    counts = value_counts_table(long, groups, "value")
    quartiles = exact_quantiles(long, groups, "value", {"q25": 0.25, "median": 0.5, "q75": 0.75})
    # one row per (feature, class): 2 rows for each requested column
    fences = F.broadcast(quartiles.withColumns({
        "low_fence": F.col("q25") - (F.col("q75") - F.col("q25")) * F.lit(1.5),
        "high_fence": F.col("q75") + (F.col("q75") - F.col("q25")) * F.lit(1.5),
    }))
    inside = F.col("v").between(F.col("low_fence"), F.col("high_fence"))
    boxes = (
        counts.join(fences, null_safe_match(counts, fences, groups))
        .groupBy(counts[COLUMN_ID], counts[target], "q25", "median", "q75")
        .agg(
            F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
        )
    )
    return named_columns(boxes, columns)

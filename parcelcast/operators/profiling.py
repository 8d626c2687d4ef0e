"""Data-quality profiles of the raw tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from parcelcast.contracts import (
    AVAILABILITY_REGISTRY, CLEANING_RULES, JOIN_STRATEGY, LIFECYCLE_RULES, ORDER_TIMESTAMPS,
)
from parcelcast.functions.expressions import flag_count, pct
from parcelcast.operators.ordering import describe_values
from parcelcast.operators.selection import describe_columns


def _stacked(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _rows_from_aggregate(agg: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into a small table: one struct per output row, exploded."""
    structs = [F.struct(*[c.alias(n) for n, c in row.items()]) for row in rows]
    return agg.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def dataset_overview(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and column count per table, largest first."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        for name, df in tables.items()
    ]
    return _stacked(parts).orderBy(F.desc("rows"), "dataset")


def schema_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Position, name and type of each column with its number of present values."""
    parts = []
    for name, df in tables.items():
        agg = df.agg(*[F.count(c).alias(c) for c in df.columns])
        rows = [
            {"dataset": F.lit(name), "position": F.lit(i), "column": F.lit(f.name),
             "type": F.lit(f.dataType.simpleString()), "present": F.col(f"`{f.name}`")}
            for i, f in enumerate(df.schema.fields)
        ]
        parts.append(_rows_from_aggregate(agg, rows))
    return _stacked(parts)


def missing_report(df: DataFrame, columns: Sequence[str] | None = None, keep_zero: bool = False) -> DataFrame:
    """Missing count and percentage per column in one pass."""
    columns = list(columns or df.columns)

    def absent(c: str) -> Column:
        is_float = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
        return F.col(c).isNull() | F.isnan(c) if is_float else F.col(c).isNull()

    agg = df.agg(F.count(F.lit(1)).alias("_all"), *[flag_count(absent(c)).alias(c) for c in columns])
    report = _rows_from_aggregate(
        agg,
        [{"column": F.lit(c), "missing_count": F.col(c), "missing_pct": pct(F.col(c), F.col("_all"))} for c in columns],
    )
    if not keep_zero:
        report = report.filter(F.col("missing_count") > 0)
    return report.orderBy(F.desc("missing_pct"), F.desc("missing_count"), "column")


def duplicate_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Exact duplicate rows per table; the partial aggregate combines hot duplicates before the shuffle."""
    parts = [
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("exact_duplicate_rows"),
        )
        .select(F.lit(name).alias("dataset"), "rows", "exact_duplicate_rows")
        for name, df in tables.items()
    ]
    return _stacked(parts).orderBy(F.desc("exact_duplicate_rows"), "dataset")


def repeated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows share their key with an earlier row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("violations")
    )


def key_check(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Is the column set a key?  NULLs count as one key value."""
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("unique_keys"))
        .select(
            F.lit(table).alias("table"),
            F.lit(" + ".join(columns)).alias("candidate_key"),
            "rows",
            "unique_keys",
            (F.col("rows") - F.col("unique_keys")).alias("duplicate_key_rows"),
            (F.col("rows") == F.col("unique_keys")).alias("is_unique"),
        )
    )


def key_checks(tables: dict[str, DataFrame], keys: dict[str, Sequence[str]]) -> DataFrame:
    return _stacked([key_check(tables[name], cols, name) for name, cols in keys.items()])


def foreign_key_check(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str, relation: str) -> DataFrame:
    """Child values without a parent.

    The child is reduced to one row per distinct value first, so a hot value crosses the shuffle once per
    partition and the join sees unique keys on both sides.
    """
    values = child.filter(F.col(child_col).isNotNull()).groupBy(F.col(child_col).alias("fk")).agg(
        F.count(F.lit(1)).alias("n")
    )
    known = parent.select(F.col(parent_col).alias("fk"), F.lit(True).alias("known")).filter("fk IS NOT NULL").distinct()
    orphan = F.col("known").isNull()
    return (
        values.join(known, "fk", "left")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("child_rows_non_null"),
            F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("unknown_fk_rows"),
            flag_count(orphan).alias("unknown_fk_unique_values"),
        )
        .select(
            F.lit(relation).alias("relationship"), "child_rows_non_null", "unknown_fk_rows",
            "unknown_fk_unique_values", (F.col("unknown_fk_rows") == 0).alias("integrity_ok"),
        )
    )


def foreign_key_checks(tables: dict[str, DataFrame], relations: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    return _stacked([
        foreign_key_check(tables[child], child_col, tables[parent], parent_col,
                          f"{child}.{child_col} -> {parent}.{parent_col}")
        for child, child_col, parent, parent_col in relations
    ])


def customer_identity(customers: DataFrame) -> DataFrame:
    """Do account ids or person ids identify a customer row?"""
    return customers.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("customer_id").alias("distinct_customer_id"),
        F.countDistinct("customer_unique_id").alias("distinct_customer_unique_id"),
    ).select(
        "*",
        (F.col("distinct_customer_id") == F.col("rows")).alias("customer_id_is_unique"),
        (F.col("distinct_customer_unique_id") == F.col("rows")).alias("customer_unique_id_is_unique"),
    )


def records_per_entity(child: DataFrame, key: str) -> DataFrame:
    return child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("records"))


def records_per_entity_summary(children: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Distribution of child records per key for several relations."""
    parts = [
        records_per_entity(df, key).select(F.lit(name).alias("relation"), "records")
        for name, (df, key) in children.items()
    ]
    return describe_values(_stacked(parts), ["relation"], "records")


def top_entities(child: DataFrame, key: str, n: int = 10) -> DataFrame:
    return records_per_entity(child, key).orderBy(F.desc("records"), key).limit(n)


def numeric_describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return describe_columns(df, columns, name="column")


def numeric_sanity(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing, zero and negative values per column in one pass."""
    checks = {
        "missing": lambda x: x.isNull() | F.isnan(x),
        "zero_values": lambda x: x == 0,
        "negative_values": lambda x: x < 0,
    }
    agg = df.agg(*[
        flag_count(test(F.col(c).cast("double"))).alias(f"{c}__{name}") for c in columns for name, test in checks.items()
    ])
    return _rows_from_aggregate(
        agg, [{"column": F.lit(c), **{name: F.col(f"{c}__{name}") for name in checks}} for c in columns]
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage per value, NULL included."""
    total = df.agg(F.count(F.lit(1)).alias("n"))
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("pct", pct(F.col("count"), total.scalar()))
        .orderBy(F.desc("count"), F.asc_nulls_first(column))
    )


def parse_timestamps(df: DataFrame, columns: Sequence[str], fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Text to timestamps; unreadable text becomes NULL."""
    return df.withColumns({c: F.try_to_timestamp(F.col(c).cast("string"), F.lit(fmt)) for c in columns})


def date_ranges(df: DataFrame, columns: Sequence[str] = tuple(ORDER_TIMESTAMPS)) -> DataFrame:
    agg = df.agg(*[
        e for c in columns
        for e in (F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"),
                  flag_count(F.col(c).isNull()).alias(f"{c}__missing"))
    ])
    return _rows_from_aggregate(agg, [
        {"column": F.lit(c), "min": F.col(f"{c}__min"), "max": F.col(f"{c}__max"), "missing": F.col(f"{c}__missing")}
        for c in columns
    ])


def _violation(later: str, earlier: str) -> Column:
    return F.coalesce(F.col(later) < F.col(earlier), F.lit(False))


def lifecycle_checks(orders: DataFrame) -> DataFrame:
    agg = orders.agg(
        F.count(F.lit(1)).alias("_all"),
        *[flag_count(_violation(later, earlier)).alias(rule) for rule, later, earlier in LIFECYCLE_RULES],
    )
    return _rows_from_aggregate(agg, [
        {"check": F.lit(rule), "affected_rows": F.col(rule), "affected_pct": pct(F.col(rule), F.col("_all"))}
        for rule, _, _ in LIFECYCLE_RULES
    ])


def lifecycle_offenders(orders: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` orders by id for each violated rule.

    ``row_number() <= n`` lets Spark keep only ``n`` rows per rule in each task before the shuffle.
    """
    violated = F.array_compact(F.array(*[
        F.when(_violation(later, earlier), F.lit(rule)) for rule, later, earlier in LIFECYCLE_RULES
    ]))
    rows = orders.select(
        F.explode(violated).alias("check"), "order_id", "order_status", *ORDER_TIMESTAMPS
    )
    first = Window.partitionBy("check").orderBy("order_id")
    return rows.withColumn("position", F.row_number().over(first)).filter(F.col("position") <= n)


def availability_by_status(orders: DataFrame) -> DataFrame:
    counted = orders.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count("order_delivered_customer_date").alias("with_customer_delivery"),
        F.count("order_estimated_delivery_date").alias("with_estimated_delivery"),
        F.count("order_approved_at").alias("with_approval"),
    )
    return counted.select(
        "*",
        pct("with_customer_delivery", "orders").alias("customer_delivery_pct"),
        pct("with_estimated_delivery", "orders").alias("estimated_delivery_pct"),
    )


def target_feasibility(orders: DataFrame) -> DataFrame:
    """Orders with both target timestamps, overall (scope 'all') and per status, in one pass."""
    known = F.col("order_delivered_customer_date").isNotNull() & F.col("order_estimated_delivery_date").isNotNull()
    counted = orders.rollup("order_status").agg(
        F.grouping("order_status").alias("_overall"),
        F.count(F.lit(1)).alias("orders"),
        flag_count(known).alias("target_available"),
    )
    return counted.select(
        F.when(F.col("_overall") == 1, F.lit("all")).otherwise(F.lit("status")).alias("scope"),
        "order_status",
        "orders",
        "target_available",
        (F.col("orders") - F.col("target_available")).alias("target_unavailable"),
        pct("target_available", "orders").alias("target_available_pct"),
    )


def geo_variation(geolocation: DataFrame, n: int = 20) -> DataFrame:
    """The zip prefixes with most raw rows, and how much their coordinates and names vary."""
    return (
        geolocation.groupBy("geolocation_zip_code_prefix")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.countDistinct("geolocation_lat").alias("unique_lat"),
            F.countDistinct("geolocation_lng").alias("unique_lng"),
            F.countDistinct("geolocation_city").alias("unique_city"),
            F.countDistinct("geolocation_state").alias("unique_state"),
        )
        .orderBy(F.desc("rows"), "geolocation_zip_code_prefix")
        .limit(n)
    )


def availability_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        AVAILABILITY_REGISTRY, "column string, role string, available_at_prediction boolean, reason string"
    )


def join_strategy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        JOIN_STRATEGY, "table string, relationship_to_orders string, pre_aggregation_needed boolean"
    )


def availability_profile(tables: Sequence[DataFrame]) -> DataFrame:
    """The availability registry with the number of present values of each column found in the tables."""
    counts = schema_report({str(i): df for i, df in enumerate(tables)}).select("column", "present")
    registry = availability_registry(tables[0].sparkSession)
    return registry.join(counts, "column", "left").withColumn("present", F.coalesce("present", F.lit(0)))


def join_strategy_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """The join-strategy registry with the size of each table."""
    registry = join_strategy(next(iter(tables.values())).sparkSession)
    sizes = dataset_overview(tables).select(F.col("dataset").alias("table"), "rows")
    return registry.join(sizes, "table", "left")


def cleaning_rule_impact(orders: DataFrame) -> DataFrame:
    """Each cleaning rule with the raw orders it touches."""
    agg = orders.agg(*[flag_count(F.expr(cond)).alias(f"r{i}") for i, (_, _, cond) in enumerate(CLEANING_RULES)])
    return _rows_from_aggregate(agg, [
        {"rule": F.lit(rule), "action": F.lit(action), "affected_rows": F.col(f"r{i}")}
        for i, (rule, action, _) in enumerate(CLEANING_RULES)
    ])


def key_set_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys found in both sets."""
    return left.select(key).intersect(right.select(key))


def seeded_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """``n`` pseudo-random rows, the same ones on every run and every cluster layout."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(n)

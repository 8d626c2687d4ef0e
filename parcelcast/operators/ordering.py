"""Global order, running totals and exact quantiles without a single sorting task.

Every operator here range-partitions the rows on the whole sort key (Spark samples the key to balance the
ranges, so a hot group is spread over many partitions), writes that placement once, and adds to each row the
total of the partitions before it.  Only one row per partition is ever ordered centrally.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelcast.functions.expressions import as_column, present
from parcelcast.session import materialize

_ROW_BITS = (1 << 33) - 1  # low bits of monotonically_increasing_id: the position in its partition


def with_scalar(df: DataFrame, name: str, one_row: DataFrame) -> DataFrame:
    """Add the single row of ``one_row`` as a struct column; it is computed once, no join takes place."""
    return df.withColumn(name, one_row.select(F.struct("*").alias(name)).scalar())


def null_safe_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def global_rank(df: DataFrame, order: Sequence[Column | str], name: str = "row_num") -> DataFrame:
    """Add the 1-based position of each row in the total order given by ``order``."""
    placed = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    )
    # one row per partition, whatever the size of the data
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_pos") + F.lit(1))
        .drop("_part", "_pos", "_start")
    )


def running_totals(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column | str],
    sums: Sequence[str],
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """Inclusive running sums ``run_<c>`` and group totals ``all_<c>`` for each column of ``sums``.

    ``totals`` adds further group totals, each a sum of the given expression.  ``order`` must be total within
    a group; callers aggregate to one row per (group, sort key) first, so ties do not exist.
    """
    extra = totals or {}
    by_range = [F.col(g) for g in groups] + [as_column(c) for c in order]
    placed = materialize(df.repartitionByRange(*by_range).withColumn("_part", F.spark_partition_id()))
    slices = placed.groupBy(*groups, "_part").agg(
        *[F.sum(c).alias(f"_s_{c}") for c in sums], *[F.sum(e).alias(f"_s_{c}") for c, e in extra.items()]
    )
    # per group at most one row for each partition
    whole = Window.partitionBy(*(groups or [F.lit(0)]))
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        *[F.col(g).alias(f"_g_{g}") for g in groups],
        F.col("_part").alias("_slice"),
        *[F.coalesce(F.sum(f"_s_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
        *[F.sum(f"_s_{c}").over(whole).alias(f"all_{c}") for c in [*sums, *extra]],
    )
    inside = (
        Window.partitionBy(*groups, "_part")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = placed.select("*", *[F.sum(c).over(inside).alias(f"_local_{c}") for c in sums])
    match = F.col("_part") == F.col("_slice")
    for g in groups:
        match = match & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    joined = local.join(offsets, match)
    return joined.select(
        *df.columns,
        *[(F.col(f"_before_{c}") + F.col(f"_local_{c}")).alias(f"run_{c}") for c in sums],
        *[f"all_{c}" for c in [*sums, *extra]],
    )


def value_counts_table(df: DataFrame, groups: Sequence[str], value: Column | str) -> DataFrame:
    """One row per (group, distinct value) with its multiplicity ``n``; missing values are left out."""
    # adding 0.0 merges -0.0 and 0.0
    x = as_column(value).cast("double")
    return (
        df.filter(present(x))
        .groupBy(*groups, (x + F.lit(0.0)).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _picked(prob: float, side: str) -> Column:
    """Value at the floor or ceiling of position ``prob * (rows - 1)``, as an aggregate over ranked values."""
    at = F.lit(float(prob)) * (F.col("all_n") - F.lit(1)).cast("double")
    index = F.floor(at) if side == "lo" else F.ceil(at)
    return F.max(F.when((F.col("run_n") - F.col("n") <= index) & (index < F.col("run_n")), F.col("v")))


def _interpolated(prob: float, rows: Column, lo: Column, hi: Column) -> Column:
    at = F.lit(float(prob)) * (rows - F.lit(1)).cast("double")
    return lo + (hi - lo) * (at - F.floor(at).cast("double"))


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], value: Column | str, probs: dict[str, float], accuracy: int | None = None
) -> DataFrame:
    """Linearly interpolated quantiles per group, one column for each name in ``probs``.

    ``accuracy`` asks for Spark's mergeable sketch instead (relative error 1/accuracy, no interpolation): one
    pass and a small shuffle where an exact order is not worth its price.
    """
    if accuracy:
        sketch = F.percentile_approx(as_column(value).cast("double"), [float(p) for p in probs.values()], accuracy)
        picked = df.filter(present(value)).groupBy(*groups).agg(sketch.alias("_q"))
        return picked.select(*groups, *[F.col("_q")[i].alias(name) for i, name in enumerate(probs)])
    ranked = running_totals(value_counts_table(df, groups, value), groups, ["v"], ["n"])
    picks = ranked.groupBy(*groups).agg(
        F.max("all_n").alias("_rows"),
        *[_picked(p, side).alias(f"_{side}_{name}") for name, p in probs.items() for side in ("lo", "hi")],
    )
    return picks.select(
        *groups,
        *[
            _interpolated(p, F.col("_rows"), F.col(f"_lo_{name}"), F.col(f"_hi_{name}")).alias(name)
            for name, p in probs.items()
        ],
    )


QUARTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def describe_values(
    df: DataFrame, groups: Sequence[str], value: Column | str, accuracy: int | None = None
) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per group.

    ``accuracy`` takes the quartiles from Spark's mergeable sketch, see ``exact_quantiles``.
    """
    if accuracy:
        x = as_column(value).cast("double")
        sketch = F.percentile_approx(x, list(QUARTILES.values()), accuracy)
        stats = df.filter(present(value)).groupBy(*groups).agg(
            F.count(F.lit(1)).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), F.max(x).alias("max"), sketch.alias("_q"),
        )
        quartiles = [F.col("_q")[i].alias(name) for i, name in enumerate(QUARTILES)]
        return stats.filter(F.col("count") > 0).select(*groups, "count", "mean", "std", "min", *quartiles, "max")
    ranked = running_totals(
        value_counts_table(df, groups, value), groups, ["v"], ["n"], {"nv": F.col("n") * F.col("v")}
    ).withColumn("_mean", F.col("all_nv") / F.col("all_n").cast("double"))
    deviation = F.col("v") - F.col("_mean")
    stats = ranked.groupBy(*groups).agg(
        F.max("all_n").alias("count"),
        F.max("_mean").alias("mean"),
        F.sum(F.col("n") * deviation * deviation).alias("_ss"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        *[_picked(p, side).alias(f"_{side}_{name}") for name, p in QUARTILES.items() for side in ("lo", "hi")],
    )
    return stats.filter(F.col("count") > 0).select(
        *groups,
        "count",
        "mean",
        F.when(F.col("count") > 1, F.sqrt(F.col("_ss") / (F.col("count") - F.lit(1)).cast("double"))).alias("std"),
        "min",
        *[
            _interpolated(p, F.col("count"), F.col(f"_lo_{name}"), F.col(f"_hi_{name}")).alias(name)
            for name, p in QUARTILES.items()
        ],
        "max",
    )


COLUMN_ID = "column_id"


def melt_numeric(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Long form (ids, column_id, value) of numeric columns, a narrow step without a shuffle.

    The column is a number, not its name: the long rows are what the quantile operators shuffle and write.
    """
    values = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(*ids, F.posexplode(values).alias(COLUMN_ID, "value"))


def named_columns(long: DataFrame, columns: Sequence[str], name: str = "feature") -> DataFrame:
    """Put names in place of the ids of ``melt_numeric``, once the rows are aggregated."""
    names = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col(COLUMN_ID) + F.lit(1))
    return long.select(names.alias(name), *[c for c in long.columns if c != COLUMN_ID])


def describe_columns(
    df: DataFrame, columns: Sequence[str], groups: Sequence[str] = (), name: str = "feature",
    accuracy: int | None = None,
) -> DataFrame:
    """``describe_values`` of several numeric columns in one job."""
    long = melt_numeric(df, groups, columns)
    return named_columns(describe_values(long, [*groups, COLUMN_ID], "value", accuracy), columns, name)


def quantile_columns(
    df: DataFrame, columns: Sequence[str], probs: dict[str, float], groups: Sequence[str] = (),
    name: str = "feature", accuracy: int | None = None,
) -> DataFrame:
    """``exact_quantiles`` of several numeric columns in one job."""
    long = melt_numeric(df, groups, columns)
    return named_columns(exact_quantiles(long, [*groups, COLUMN_ID], "value", probs, accuracy), columns, name)

"""Population stability of features and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from parcelcast.contracts import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from parcelcast.functions.expressions import pct, present, ratio
from parcelcast.operators.ordering import COLUMN_ID, melt_numeric, named_columns, with_scalar
from parcelcast.operators.selection import ACCURACY, sketched, summarize

SHARE_FLOOR = 1e-6
MISSING_VALUE = "__MISSING__"
_MISSING_BIN = 0


def psi_term(reference_share: Column, comparison_share: Column) -> Column:
    """One bin's contribution to the index; shares are floored to keep the logarithm finite."""
    r = F.greatest(reference_share, F.lit(SHARE_FLOOR))
    c = F.greatest(comparison_share, F.lit(SHARE_FLOOR))
    return (c - r) * F.ln(c / r)


def psi_from_shares(bins: DataFrame, reference_share: str, comparison_share: str, groups: Sequence[str] = ()) -> DataFrame:
    """The stability index of a table with one row per bin."""
    return bins.groupBy(*groups).agg(F.sum(psi_term(F.col(reference_share), F.col(comparison_share))).alias("psi"))


def _index_per_feature(
    counts: DataFrame, key: Sequence[str], sizes: DataFrame, missing_bin: Column, binned: Column
) -> DataFrame:
    """Index and missing shares from (key, bin, reference, comparison) counts; unbinned keys have index 0."""
    n = F.col("_size")
    shares = with_scalar(counts, "_size", sizes).select(
        *key,
        "_size",
        missing_bin.alias("is_missing"),
        "reference",
        "comparison",
        F.when(
            binned, psi_term(ratio("reference", n["reference_rows"]), ratio("comparison", n["comparison_rows"]))
        ).otherwise(F.lit(0.0)).alias("term"),
    )
    summed = shares.groupBy(*key, "_size").agg(
        F.sum("term").alias("psi"),
        pct(F.coalesce(F.sum(F.when(F.col("is_missing"), F.col("reference"))), F.lit(0)),
            n["reference_rows"]).alias("reference_missing_pct"),
        pct(F.coalesce(F.sum(F.when(F.col("is_missing"), F.col("comparison"))), F.lit(0)),
            n["comparison_rows"]).alias("comparison_missing_pct"),
    )
    return summed.drop("_size")


def _sided(reference: DataFrame, comparison: DataFrame) -> DataFrame:
    return reference.withColumn("is_reference", F.lit(True)).unionByName(
        comparison.withColumn("is_reference", F.lit(False))
    )


def _side_counts() -> list[Column]:
    return [
        F.count(F.when(F.col("is_reference"), F.lit(1))).alias("reference"),
        F.count(F.when(~F.col("is_reference"), F.lit(1))).alias("comparison"),
    ]


def _sizes(sided: DataFrame) -> DataFrame:
    return sided.agg(
        F.count(F.when(F.col("is_reference"), F.lit(1))).alias("reference_rows"),
        F.count(F.when(~F.col("is_reference"), F.lit(1))).alias("comparison_rows"),
    )


def numeric_psi(
    reference: DataFrame, comparison: DataFrame, columns: Sequence[str], bins: int = 10, accuracy: int | None = None
) -> DataFrame:
    """Index of each numeric column over reference-quantile bins plus a bin for missing values.

    Fewer than three distinct edges give an index of 0.
    """
    columns = list(columns)
    sided = _sided(reference.select(*columns), comparison.select(*columns))
    probs = {f"e{i}": i / bins for i in range(bins + 1)}
    found = (sketched if accuracy else summarize)(reference, {c: F.col(c) for c in columns}, probs, accuracy or ACCURACY)
    edges = {c: list(dict.fromkeys(found[c][p] for p in probs)) if c in found else [] for c in columns}

    # the bins are counted map-side: a task sends on at most ``bins + 1`` rows a column
    long = melt_numeric(sided, ["is_reference"], columns)
    inner = F.array(*[F.array(*[F.lit(e) for e in edges[c][1:-1]]).cast("array<double>") for c in columns])[F.col(COLUMN_ID)]
    bin_id = F.when(present("value"), F.lit(1) + F.size(F.filter(inner, lambda e: e < F.col("value")))).otherwise(F.lit(_MISSING_BIN))
    counts = long.groupBy(COLUMN_ID, bin_id.alias("bin")).agg(*_side_counts())
    binned = F.array(*[F.lit(len(edges[c]) >= 3) for c in columns])[F.col(COLUMN_ID)]
    shifts = _index_per_feature(counts, [COLUMN_ID], _sizes(sided), F.col("bin") == _MISSING_BIN, binned)
    return named_columns(shifts, columns)


def categorical_psi(reference: DataFrame, comparison: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Index of each text column over the union of its values; a missing value is a value of its own."""
    columns = list(columns)
    sided = _sided(reference.select(*columns), comparison.select(*columns))
    texts = sided.select("is_reference", *[F.col(c).cast("string").alias(c) for c in columns])
    long = texts.unpivot(["is_reference"], columns, "feature", "value")
    counts = long.groupBy("feature", F.coalesce("value", F.lit(MISSING_VALUE)).alias("value")).agg(*_side_counts())
    return _index_per_feature(
        counts, ["feature"], _sizes(sided), F.col("value") == MISSING_VALUE, F.lit(True)
    )


def drift_flag(psi: Column | str) -> Column:
    x = F.col(psi) if isinstance(psi, str) else psi
    return F.when(x <= 0.10, F.lit("low")).when(x <= 0.25, F.lit("moderate")).when(x.isNotNull(), F.lit("high"))


def drift_summary(
    reference: DataFrame,
    comparison: DataFrame,
    numeric: Sequence[str] = tuple(NUMERIC_FEATURES),
    categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES),
    accuracy: int | None = None,
) -> DataFrame:
    """Index, missing shares and flag of every feature, most shifted first."""
    numbers = numeric_psi(reference, comparison, numeric, accuracy=accuracy).withColumn("feature_type", F.lit("numeric"))
    texts = categorical_psi(reference, comparison, categorical).withColumn("feature_type", F.lit("categorical"))
    return (
        numbers.unionByName(texts)
        .select("feature", "feature_type", "psi", "reference_missing_pct", "comparison_missing_pct",
                drift_flag("psi").alias("drift_flag"))
        .orderBy(F.desc("psi"), "feature")
    )

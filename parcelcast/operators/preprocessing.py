"""Imputation, scaling and encoding fitted on training rows only.

Fitted values are a handful of numbers per feature, read on the driver; applying them is a plain projection.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from parcelcast.contracts import CATEGORICAL_FEATURES, MODEL_FEATURES, NUMERIC_FEATURES, TARGET, require_columns
from parcelcast.functions.expressions import present
from parcelcast.operators.selection import describe_columns


@dataclass(frozen=True)
class NumericFit:
    """Training medians, the features that had gaps, and mean and deviation after imputation."""

    medians: dict[str, float]
    gaps: list[str] = field(default_factory=list)
    means: dict[str, float] = field(default_factory=dict)
    scales: dict[str, float] = field(default_factory=dict)

    @property
    def outputs(self) -> list[str]:
        return list(self.medians) + [indicator(c) for c in self.gaps]


def indicator(column: str) -> str:
    return f"missingindicator_{column}"


def fit_numeric(
    train: DataFrame, columns: Sequence[str] = tuple(NUMERIC_FEATURES), accuracy: int | None = None
) -> NumericFit:
    """Exact medians and the moments after imputation, from one summary of all columns.

    Filling g gaps with the median m shifts count, mean and squared deviations in closed form, so the imputed
    table is never scanned.  A column without any value is left out; a constant one keeps scale 1.
    """
    columns = list(columns)
    rows = train.count()
    summary = {r.feature: r for r in describe_columns(train, columns, accuracy=accuracy).collect()}
    found = [c for c in columns if c in summary]
    medians = {c: summary[c]["median"] for c in found}
    gaps = [c for c in found if summary[c]["count"] < rows]
    means, scales = {}, {}
    for c in found:
        n, mean, std, m = summary[c]["count"], summary[c]["mean"], summary[c]["std"] or 0.0, medians[c]
        g = rows - n
        means[c] = (n * mean + g * m) / rows
        squares = std * std * (n - 1) + n * (mean - means[c]) ** 2 + g * (m - means[c]) ** 2
        scales[c] = math.sqrt(squares / rows) if summary[c]["min"] < summary[c]["max"] else 1.0
    for c in gaps:
        share = (rows - summary[c]["count"]) / rows
        means[indicator(c)], scales[indicator(c)] = share, math.sqrt(share * (1.0 - share))
    return NumericFit(medians, gaps, means, scales)


def imputed(fit: NumericFit) -> dict[str, Column]:
    """Filled columns and one flag for each column that had gaps in training."""
    filled = {c: F.when(present(c), F.col(c).cast("double")).otherwise(F.lit(m)) for c, m in fit.medians.items()}
    return {**filled, **{indicator(c): (~present(c)).cast("double") for c in fit.gaps}}


def median_impute(df: DataFrame, fit: NumericFit) -> DataFrame:
    return df.withColumns(imputed(fit))


def standard_scale(df: DataFrame, fit: NumericFit) -> DataFrame:
    """Imputed columns as (x - mean) / population deviation."""
    return df.withColumns({
        name: (c - F.lit(fit.means[name])) / F.lit(fit.scales[name]) for name, c in imputed(fit).items()
    })


def fit_modes(train: DataFrame, columns: Sequence[str] = tuple(CATEGORICAL_FEATURES)) -> dict[str, str]:
    """Most frequent value per text column, the smallest on ties; counts are combined before the shuffle."""
    long = train.select(*columns).unpivot([], list(columns), "feature", "value").filter(F.col("value").isNotNull())
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("feature").agg(F.min(F.struct((-F.col("n")).alias("rank"), "value"))["value"].alias("mode"))
    return {r.feature: r.mode for r in best.collect()}


def mode_impute(df: DataFrame, modes: dict[str, str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in modes.items()})


def fit_categories(train: DataFrame, column: str, modes: dict[str, str]) -> list[str]:
    filled = mode_impute(train, {column: modes[column]})
    return sorted(r[column] for r in filled.select(column).distinct().collect())


def one_hot_wide(df: DataFrame, column: str, categories: Sequence[str]) -> DataFrame:
    """Dense one-hot columns ``<column>_<value>``; an unseen value gives zeros everywhere."""
    flags = {f"{column}_{v}": F.coalesce(F.col(column) == F.lit(v), F.lit(False)).cast("int") for v in categories}
    return df.withColumns(flags)


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _projection(fit: NumericFit, modes: dict[str, str]) -> SQLTransformer:
    """Imputation, flags and scaling as one SQL projection, so that the fitted pipeline can be saved."""
    def is_present(c: str) -> str:
        return f"({c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE)))"

    raw = {c: f"IF({is_present(c)}, CAST({c} AS DOUBLE), {m!r}D)" for c, m in fit.medians.items()}
    raw |= {indicator(c): f"IF({is_present(c)}, 0.0D, 1.0D)" for c in fit.gaps}
    numbers = [f"({e} - {fit.means[n]!r}D) / {fit.scales[n]!r}D AS numeric__{n}" for n, e in raw.items()]
    texts = [f"COALESCE({c}, {_sql_text(m)}) AS filled__{c}" for c, m in modes.items()]
    return SQLTransformer(statement=f"SELECT *, {', '.join(numbers + texts)} FROM __THIS__")


def build_preprocessor(train: DataFrame) -> PipelineModel:
    """Fitted preprocessing: numbers filled, flagged and scaled; texts filled and one-hot encoded.

    Other columns are left out of the feature vector.
    """
    require_columns(train, MODEL_FEATURES, "training rows")
    fit = fit_numeric(train)
    modes = fit_modes(train)
    projection = _projection(fit, modes)
    filled = projection.transform(train)
    names = list(modes)
    indexer = StringIndexer(
        inputCols=[f"filled__{c}" for c in names], outputCols=[f"index__{c}" for c in names],
        handleInvalid="keep", stringOrderType="alphabetAsc",
    ).fit(filled)
    # the kept "unknown" index is the last one and is dropped, which leaves zeros for unseen values
    encoder = OneHotEncoder(
        inputCols=[f"index__{c}" for c in names], outputCols=[f"onehot__{c}" for c in names], dropLast=True
    ).fit(indexer.transform(filled))
    assembler = VectorAssembler(
        inputCols=[f"numeric__{n}" for n in fit.outputs] + [f"onehot__{c}" for c in names], outputCol="features"
    )
    return PipelineModel([projection, indexer, encoder, assembler])


def feature_names(preprocessor: PipelineModel) -> list[str]:
    """Names of the vector's entries: ``numeric__x`` and ``categorical__x_value``."""
    indexer = next(s for s in preprocessor.stages if hasattr(s, "labelsArray"))
    assembler = next(s for s in preprocessor.stages if isinstance(s, VectorAssembler))
    names = [c for c in assembler.getInputCols() if c.startswith("numeric__")]
    for column, labels in zip(indexer.getInputCols(), indexer.labelsArray):
        names += [f"categorical__{column.removeprefix('filled__')}_{v}" for v in labels]
    return names


def class_weights(train: DataFrame, label: str = TARGET) -> dict[str, float]:
    """Balanced weights n / (2 n_c) and the positive scale neg / pos (1 where a fold has no positive)."""
    row = train.agg(F.count(label).alias("n"), F.coalesce(F.sum(label), F.lit(0)).alias("pos")).first()
    n, pos = float(row["n"]), float(row["pos"])
    neg = n - pos
    return {
        "rows": n,
        "positives": pos,
        "balanced_0": n / (2 * neg) if neg else 1.0,
        "balanced_1": n / (2 * pos) if pos else 1.0,
        "scale_pos_weight": neg / pos if pos else 1.0,
    }


def class_weight_table(rows: DataFrame, groups: Sequence[str], label: str = TARGET) -> DataFrame:
    """``class_weights`` as a table, one row per group (say, per fold)."""
    n, pos = F.count(label).cast("double"), F.coalesce(F.sum(label), F.lit(0)).cast("double")
    counted = rows.groupBy(*groups).agg(n.alias("n"), pos.alias("pos"))
    two, one = F.lit(2.0), F.lit(1.0)
    neg = F.col("n") - F.col("pos")
    return counted.select(
        *groups,
        F.col("n").cast("bigint").alias("rows"),
        F.col("pos").cast("bigint").alias("positives"),
        F.coalesce(F.try_divide(F.col("n"), two * neg), one).alias("balanced_0"),
        F.coalesce(F.try_divide(F.col("n"), two * F.col("pos")), one).alias("balanced_1"),
        F.coalesce(F.try_divide(neg, F.col("pos")), one).alias("scale_pos_weight"),
    )

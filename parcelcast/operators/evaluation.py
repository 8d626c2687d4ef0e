"""Ranking, threshold, calibration and segment metrics of scored rows.

Rows are first reduced to one row per distinct score; all curves are running totals over that table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from parcelcast.contracts import ContractError, PREDICTION_TS, SEGMENT_BANDS, TARGET
from parcelcast.functions.expressions import month_of, ratio, upper_closed_band
from parcelcast.operators.ordering import exact_quantiles, running_totals, with_scalar
from parcelcast.operators.profiling import _rows_from_aggregate

SCORE = "probability"
DEFAULT_THRESHOLD = 0.50
TABLE_THRESHOLDS = (0.10, 0.20, 0.30, 0.40, 0.50, 0.60, 0.70)
RECALL_RULE = "maximize_precision_subject_to_recall>={:.2f}"
F1_RULE = "best_oof_f1"
LOG_LOSS_EPS = 2.220446049250313e-16  # double precision epsilon


def sweep_thresholds(start: float = 0.05, stop: float = 0.95, count: int = 19) -> list[float]:
    """Evenly spaced thresholds as ``start + i * step`` in plain doubles, the last one exact."""
    step = (stop - start) / (count - 1)
    return [start + i * step for i in range(count - 1)] + [stop]


def score_table(df: DataFrame, groups: Sequence[str] = (), label: str = TARGET, score: str = SCORE) -> DataFrame:
    """Positives and rows per distinct score; hot scores are combined before the shuffle."""
    return (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*groups, F.col(score).cast("double").alias("score"))
        .agg(F.sum(F.col(label).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n"))
    )


def score_curve(df: DataFrame, groups: Sequence[str] = (), label: str = TARGET, score: str = SCORE) -> DataFrame:
    """Score table with true positives ``run_pos`` and predicted positives ``run_n`` at 'score >= threshold'."""
    return _curve(score_table(df, groups, label, score), groups)


def _curve(table: DataFrame, groups: Sequence[str]) -> DataFrame:
    return running_totals(table, list(groups), [F.desc("score")], ["pos", "n"])


def _average_precision() -> Column:
    gain = ratio("pos", "all_pos") * ratio("run_pos", "run_n")
    return F.coalesce(F.sum(gain), F.lit(0.0))


def _roc_auc() -> Column:
    negatives = (F.col("n") - F.col("pos")).cast("double")
    wins = negatives * (F.col("run_pos").cast("double") - F.col("pos").cast("double") / F.lit(2.0))
    pairs = F.max("all_pos").cast("double") * F.max(F.col("all_n") - F.col("all_pos")).cast("double")
    return ratio(F.sum(wins), pairs)


def _clipped_log(p: Column) -> Column:
    return F.ln(F.greatest(F.least(p, F.lit(1.0 - LOG_LOSS_EPS)), F.lit(LOG_LOSS_EPS)))


def _ranking_aggregates() -> list[Column]:
    p, pos, neg = F.col("score"), F.col("pos"), F.col("n") - F.col("pos")
    squared = pos * (F.lit(1.0) - p) * (F.lit(1.0) - p) + neg * p * p
    surprise = -(pos * _clipped_log(p) + neg * _clipped_log(F.lit(1.0) - p))
    rows = F.max("all_n")
    return [
        rows.alias("rows"),
        F.max("all_pos").alias("positives"),
        ratio(F.max("all_pos"), rows).alias("prevalence"),
        _average_precision().alias("pr_auc"),
        ratio(_average_precision(), ratio(F.max("all_pos"), rows)).alias("pr_auc_lift"),
        _roc_auc().alias("roc_auc"),
        ratio(F.sum(squared), rows).alias("brier_score"),
        ratio(F.sum(surprise), rows).alias("log_loss"),
    ]


def ranking_metrics(df: DataFrame, groups: Sequence[str] = (), label: str = TARGET, score: str = SCORE) -> DataFrame:
    """Rows, prevalence, average precision and lift, ROC-AUC, Brier score and log loss, per group."""
    return score_curve(df, groups, label, score).groupBy(*groups).agg(*_ranking_aggregates())


def ranking_of_counts(counts: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """``ranking_metrics`` of rows that are counted already: positives ``pos`` and rows ``n`` by ``score``, in any number of parts."""
    table = counts.groupBy(*groups, "score").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    return _curve(table, groups).groupBy(*groups).agg(*_ranking_aggregates())


def _confusion(threshold: float) -> dict[str, Column]:
    chosen = F.col("score") >= F.lit(float(threshold))
    tp = F.coalesce(F.sum(F.when(chosen, F.col("pos"))), F.lit(0))
    predicted = F.coalesce(F.sum(F.when(chosen, F.col("n"))), F.lit(0))
    positives, rows = F.sum("pos"), F.sum("n")
    return {"tp": tp, "fp": predicted - tp, "tn": rows - predicted - positives + tp, "fn": positives - tp}


def _rates(tp: Column, fp: Column, tn: Column, fn: Column) -> dict[str, Column]:
    """Precision, recall and F1 (0 where undefined), accuracy and share of predicted positives."""
    rows = tp + fp + tn + fn
    zero = F.lit(0.0)
    return {
        "precision": F.coalesce(ratio(tp, tp + fp), zero),
        "recall": F.coalesce(ratio(tp, tp + fn), zero),
        "f1": F.coalesce(ratio(tp * F.lit(2), tp * F.lit(2) + fp + fn), zero),
        "accuracy": ratio(tp + tn, rows),
        "positive_rate": ratio(tp + fp, rows),
    }


_CELLS = ("tp", "fp", "tn", "fn")


def _cells_at(
    table: DataFrame, groups: Sequence[str], thresholds: Sequence[float], extra: Sequence[Column] = ()
) -> DataFrame:
    """Confusion cells for all thresholds in one pass: one row per group and threshold position."""
    cells = [
        F.struct(F.lit(float(t)).alias("threshold"), *[c.alias(k) for k, c in _confusion(t).items()])
        for t in thresholds
    ]
    agg = table.groupBy(*groups).agg(F.array(*cells).alias("_cells"), *extra)
    others = [c for c in agg.columns if c != "_cells"]
    return agg.select(*others, F.explode("_cells").alias("_c")).select(*others, "_c.*")


def classification_metrics(
    df: DataFrame, threshold: float | Sequence[float] = DEFAULT_THRESHOLD, groups: Sequence[str] = (),
    label: str = TARGET, score: str = SCORE,
) -> DataFrame:
    """Average precision and ROC-AUC with the rates at one or several thresholds, per group."""
    thresholds = list(threshold) if isinstance(threshold, (list, tuple)) else [threshold]
    ranking = [_average_precision().alias("pr_auc"), _roc_auc().alias("roc_auc")]
    rows = _cells_at(score_curve(df, groups, label, score), groups, thresholds, ranking)
    rates = _rates(*[F.col(c) for c in _CELLS])
    return rows.select(*groups, "pr_auc", "roc_auc", *[c.alias(k) for k, c in rates.items()], "threshold")


def threshold_table(df: DataFrame, thresholds: Sequence[float] = TABLE_THRESHOLDS) -> DataFrame:
    return classification_metrics(df, list(thresholds))


def confusion_matrix(
    df: DataFrame, threshold: float = DEFAULT_THRESHOLD, label: str = TARGET, score: str = SCORE
) -> DataFrame:
    """Two rows (actual class) by two columns (predicted class); empty cells are 0."""
    agg = score_table(df, (), label, score).agg(*[c.alias(k) for k, c in _confusion(threshold).items()])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return _rows_from_aggregate(agg, [
        {"actual": F.lit("actual_on_time"), "pred_on_time": zero("tn"), "pred_late": zero("fp")},
        {"actual": F.lit("actual_late"), "pred_on_time": zero("fn"), "pred_late": zero("tp")},
    ])


def pr_curve(df: DataFrame, label: str = TARGET, score: str = SCORE) -> DataFrame:
    """Precision, recall and F1 at each distinct score."""
    curve = score_curve(df, (), label, score)
    tp, predicted, positives = F.col("run_pos"), F.col("run_n"), F.col("all_pos")
    return curve.select(
        F.col("score").alias("threshold"),
        ratio(tp, predicted).alias("precision"),
        F.coalesce(ratio(tp, positives), F.lit(1.0)).alias("recall"),
        F.coalesce(ratio(tp * F.lit(2), predicted + positives), F.lit(0.0)).alias("f1"),
    )


def roc_curve(df: DataFrame, label: str = TARGET, score: str = SCORE) -> DataFrame:
    curve = score_curve(df, (), label, score)
    return curve.select(
        F.col("score").alias("threshold"),
        ratio(F.col("run_n") - F.col("run_pos"), F.col("all_n") - F.col("all_pos")).alias("fpr"),
        ratio("run_pos", "all_pos").alias("tpr"),
    )


def best_f1_threshold(df: DataFrame, label: str = TARGET, score: str = SCORE) -> DataFrame:
    """The threshold with the highest F1; ties go to the lowest threshold."""
    return pr_curve(df, label, score).orderBy(F.desc("f1"), F.asc("threshold")).limit(1).select(
        F.lit(F1_RULE).alias("threshold_rule"), "threshold", "precision", "recall", "f1"
    )


def min_recall_threshold(
    df: DataFrame, minimum_recall: float = 0.50, label: str = TARGET, score: str = SCORE
) -> DataFrame:
    """The most precise threshold with recall of at least ``minimum_recall``, else the one with most recall."""
    if not 0 < minimum_recall <= 1:
        raise ContractError("minimum recall must lie in (0, 1]")
    curve = pr_curve(df, label, score).withColumn("feasible", F.col("recall") >= F.lit(float(minimum_recall)))
    merit = F.when(F.col("feasible"), F.col("precision")).otherwise(F.col("recall"))
    best = curve.orderBy(F.desc("feasible"), F.desc(merit), F.asc("threshold")).limit(1)
    return best.select(
        F.lit(RECALL_RULE.format(minimum_recall)).alias("threshold_rule"), "threshold", "precision", "recall", "f1"
    )


def operating_thresholds(df: DataFrame, minimum_recall: float = 0.50) -> DataFrame:
    return best_f1_threshold(df).unionByName(min_recall_threshold(df, minimum_recall))


def threshold_metrics(df: DataFrame, threshold: float | Sequence[float] = DEFAULT_THRESHOLD, label: str = TARGET,
                      score: str = SCORE) -> DataFrame:
    """Rates and confusion cells at one or several thresholds."""
    thresholds = list(threshold) if isinstance(threshold, (list, tuple)) else [threshold]
    rows = _cells_at(score_table(df, (), label, score), (), thresholds)
    rates = _rates(*[F.col(c) for c in _CELLS])
    rates.pop("accuracy")
    return rows.select("threshold", *[c.alias(k) for k, c in rates.items()], *_CELLS)


def threshold_sweep(df: DataFrame, thresholds: Sequence[float] | None = None) -> DataFrame:
    return threshold_metrics(df, list(thresholds or sweep_thresholds()))


def rule_metrics(df: DataFrame, rules: DataFrame) -> DataFrame:
    """``threshold_metrics`` for the default threshold and each rule of a rule table.

    The rule table has one row per rule by design; its thresholds are read on the driver.
    """
    named = [("default_0.50", DEFAULT_THRESHOLD)] + [(r.threshold_rule, r.threshold) for r in rules.collect()]
    rows = threshold_metrics(df, sorted({t for _, t in named}))
    names = df.sparkSession.createDataFrame(named, "threshold_rule string, threshold double")
    return names.join(rows, "threshold").select("threshold_rule", *rows.columns)


def calibration_table(df: DataFrame, n_bins: int = 10, label: str = TARGET, score: str = SCORE) -> DataFrame:
    """Mean score and observed rate per quantile bin; a score equal to an edge falls below it."""
    table = score_table(df, (), label, score)
    probs = {f"e{i}": i / n_bins for i in range(1, n_bins)}
    bin_id = reduce(lambda a, b: a + b, [(F.col("edges")[e] < F.col("score")).cast("int") for e in probs])
    edged = with_scalar(table, "edges", exact_quantiles(df, [], score, probs))
    binned = edged.withColumn("bin", bin_id).groupBy("bin").agg(
        ratio(F.sum(F.col("score") * F.col("n")), F.sum("n")).alias("mean_predicted_probability"),
        ratio(F.sum("pos"), F.sum("n")).alias("observed_late_rate"),
    )
    gap = F.col("observed_late_rate") - F.col("mean_predicted_probability")
    return binned.withColumn("calibration_gap", gap)


def calibration_gap(df: DataFrame, n_bins: int = 10, label: str = TARGET, score: str = SCORE) -> DataFrame:
    return calibration_table(df, n_bins, label, score).agg(
        F.avg(F.abs("calibration_gap")).alias("mean_absolute_calibration_gap")
    )


def with_segments(df: DataFrame) -> DataFrame:
    """Prediction month and the three right-closed bands."""
    bands = {name: upper_closed_band(source, edges, labels) for name, (source, edges, labels) in SEGMENT_BANDS.items()}
    return df.withColumns({"prediction_month": month_of(PREDICTION_TS), **bands})


def segment_metrics(
    df: DataFrame, segment: str, minimum_rows: int = 100, minimum_positives: int = 5,
    label: str = TARGET, score: str = SCORE,
) -> DataFrame:
    """Ranking metrics per segment, for segments with enough rows, enough positives and some negatives."""
    rows = df.select(F.col(segment).alias("segment"), label, score)
    metrics = ranking_metrics(rows, ["segment"], label, score)
    enough = (
        (F.col("rows") >= minimum_rows)
        & (F.col("positives") >= minimum_positives)
        & (F.col("positives") < F.col("rows"))
    )
    return metrics.filter(enough).orderBy(F.desc("rows"), F.asc_nulls_last("segment"))


SEGMENTS = ("customer_state", "distance_band", "promise_band", "approval_lag_band", "prediction_month")


def segment_reports(df: DataFrame, minimum_rows: int = 100, minimum_positives: int = 10,
                    segments: Sequence[str] = SEGMENTS) -> DataFrame:
    """All segment reports as one job over (kind, segment) groups."""
    kinds = F.explode(F.array(*[
        F.struct(F.lit(s).alias("kind"), F.col(s).cast("string").alias("segment")) for s in segments
    ]))
    rows = df.select(kinds.alias("_s"), TARGET, SCORE).select("_s.*", TARGET, SCORE)
    metrics = ranking_metrics(rows, ["kind", "segment"])
    return metrics.filter(
        (F.col("rows") >= minimum_rows) & (F.col("positives") >= minimum_positives) & (F.col("positives") < F.col("rows"))
    )


def temporal_robustness(fold_metrics: DataFrame, config_id: Column | str) -> DataFrame:
    """One configuration's folds with average precision over the fold's late rate."""
    chosen = F.lit(config_id) if isinstance(config_id, str) else config_id
    return (
        fold_metrics.filter(F.col("config_id") == chosen)
        .withColumn("pr_auc_lift", ratio("pr_auc", "validation_late_rate"))
        .orderBy("fold")
    )

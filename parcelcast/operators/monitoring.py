"""Telemetry and label-based quality over a prediction log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from parcelcast.contracts import PREDICTION_TS
from parcelcast.functions.expressions import flag_count, month_of, ratio
from parcelcast.operators.drift import drift_flag, numeric_psi
from parcelcast.operators.evaluation import SCORE, ranking_metrics
from parcelcast.operators.ordering import with_scalar
from parcelcast.operators.scoring import BANDS


def telemetry_aggregates() -> list[Column]:
    """Counters of a prediction log with a row per prediction, numbered within its request by ``prediction_index``.

    Requests and their latency count at their first prediction; a failed request yields no prediction.
    """
    served, first = ~F.col("failed"), F.col("prediction_index") == 0
    predictions, requests = flag_count(served), flag_count(served & first)

    def mean_of(value: Column) -> Column:
        return F.coalesce(ratio(F.sum(F.when(served, value)), predictions), F.lit(0.0))

    return [
        requests.alias("total_requests"),
        predictions.alias("total_predictions"),
        flag_count(F.col("failed") & first).alias("failed_requests"),
        F.coalesce(ratio(F.sum(F.when(served & first, F.col("latency_ms"))), requests), F.lit(0.0)).alias("average_request_latency_ms"),
        mean_of(F.col("score")).alias("mean_risk_score"),
        mean_of(F.col("requires_review").cast("double")).alias("review_rate"),
        *[flag_count(served & (F.col("risk_band") == band)).alias(f"band_{band}") for band in BANDS],
        F.coalesce(F.sum(F.when(served, F.col("missing_features"))), F.lit(0)).alias("missing_feature_values"),
    ]


def telemetry_snapshot(log: DataFrame) -> DataFrame:
    return log.agg(*telemetry_aggregates())


def telemetry_windows(log: DataFrame, width: str = "1 day") -> DataFrame:
    grouped = log.groupBy(F.window("ts", width).alias("w")).agg(*telemetry_aggregates())
    return grouped.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        *[c for c in grouped.columns if c != "w"],
    )


def score_drift(reference: DataFrame, log: DataFrame, score: str = SCORE) -> DataFrame:
    """Live scores against the reference: means, review and missing rates, and the stability index."""
    ref = reference.select(F.col(score).alias("score"))
    live = log.filter(~F.col("failed"))
    row = live.agg(
        F.count(F.lit(1)).alias("predictions"),
        F.avg("score").alias("live_score_mean"),
        F.avg(F.col("requires_review").cast("double")).alias("review_rate"),
        ratio(F.sum("missing_features"), F.count(F.lit(1))).alias("missing_per_prediction"),
    )
    row = with_scalar(row, "_ref", ref.agg(F.avg("score").alias("mean")))
    row = with_scalar(row, "_shift", numeric_psi(ref, live.select("score"), ["score"]).select("psi"))
    return row.select(
        "predictions", "live_score_mean", F.col("_ref.mean").alias("reference_score_mean"),
        (F.col("live_score_mean") - F.col("_ref.mean")).alias("score_mean_shift"),
        "review_rate", "missing_per_prediction", F.col("_shift.psi").alias("score_psi"),
        drift_flag("_shift.psi").alias("drift_flag"),
    )


def matured_label_quality(predictions: DataFrame, outcomes: DataFrame, groups: Sequence[str] = ("month",)) -> DataFrame:
    """Ranking metrics by prediction month for predictions whose outcome became known afterwards."""
    matured = (
        predictions.select("order_id", PREDICTION_TS, SCORE)
        .join(outcomes.select("order_id", "delivered_at", "late_delivery"), "order_id")
        .filter(F.col("delivered_at") > F.col(PREDICTION_TS))
        .withColumn("month", month_of(PREDICTION_TS))
    )
    return ranking_metrics(matured, list(groups))

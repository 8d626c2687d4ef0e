import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from parcelcast import contracts as K
from parcelcast.operators import evaluation as E

few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
# late at 0.62, 0.37 and 0.93: at 0.5 two of three are caught and two of four on-time rows as well
CONFUSED = ([1, 0, 1, 0, 0, 1, 0], [0.62, 0.58, 0.37, 0.11, 0.49, 0.93, 0.71])
# F1 from the highest score on: 2/5, 1/3, 4/7, 3/4, 2/3, 4/5, 8/11
WAVERING = ([0, 1, 0, 1, 1, 0, 1], [0.12, 0.22, 0.31, 0.47, 0.58, 0.66, 0.83])
# precision and recall from the highest score on: 1 and 1/6, 1/2 and 1/6, 2/3 and 1/3, 3/4 and 1/2, 4/5 and 2/3, 2/3 and 2/3, 5/7 and 5/6, ...
DESCENDING = ([1, 0, 1, 1, 1, 0, 1, 0, 1, 0], [0.97, 0.91, 0.84, 0.77, 0.69, 0.51, 0.44, 0.35, 0.28, 0.16])


def scores(spark, y, p):
    return spark.createDataFrame(list(zip(y, map(float, p))), f"{K.TARGET} int, probability double")


def brute(y, p):
    y, p = np.array(y), np.array(p)
    ap, recall = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        chosen = p >= t
        r = y[chosen].sum() / y.sum()
        ap += (r - recall) * y[chosen].mean()
        recall = r
    wins = sum((a > b) + 0.5 * (a == b) for a in p[y == 1] for b in p[y == 0])
    return ap, wins / ((y == 1).sum() * (y == 0).sum())


def test_perfect_ranking(spark):
    r = E.ranking_metrics(scores(spark, [1, 0, 1, 0, 0], [0.64, 0.21, 0.77, 0.35, 0.08])).first()
    assert (r.pr_auc, r.roc_auc, r.pr_auc_lift, r.prevalence) == (1.0, 1.0, 2.5, 0.4)


@few
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 9)), min_size=4, max_size=80).filter(
    lambda rows: 0 < sum(y for y, _ in rows) < len(rows)))
def test_ranking_matches_brute_force_with_ties(spark, rows):
    y, p = [a for a, _ in rows], [b / 10 for _, b in rows]
    r = E.ranking_metrics(scores(spark, y, p)).first()
    ap, auc = brute(y, p)
    assert r.pr_auc == pytest.approx(ap) and r.roc_auc == pytest.approx(auc)
    assert r.brier_score == pytest.approx(np.mean((np.array(p) - np.array(y)) ** 2))
    clipped = np.clip(p, E.LOG_LOSS_EPS, 1 - E.LOG_LOSS_EPS)
    loss = [-math.log(c) if a else -math.log(max(1 - b, E.LOG_LOSS_EPS)) for a, b, c in zip(y, p, clipped)]
    assert r.log_loss == pytest.approx(np.mean(loss))


def test_single_class_has_no_auc(spark):
    r = E.ranking_metrics(scores(spark, [0, 0], [0.1, 0.2])).first()
    assert r.roc_auc is None and r.pr_auc_lift is None and r.pr_auc == 0.0


def test_confusion_counts(spark):
    df = scores(spark, *CONFUSED)
    r = E.threshold_metrics(df, 0.5).first()
    assert (r.tp, r.fp, r.tn, r.fn) == (2, 2, 2, 1)
    assert [tuple(x)[1:] for x in E.confusion_matrix(df).collect()] == [(2, 2), (1, 2)]


def test_score_equal_to_the_threshold_is_positive(spark):
    assert E.threshold_metrics(scores(spark, [1], [0.5]), 0.5).first().tp == 1


def test_sweep_has_the_float_noise_of_the_grid(spark):
    grid = E.sweep_thresholds()
    assert len(grid) == 19 and grid[-1] == 0.95 and grid == pytest.approx(list(np.linspace(0.05, 0.95, 19)))
    assert grid == [float(x) for x in np.linspace(0.05, 0.95, 19)]
    assert E.threshold_sweep(scores(spark, *CONFUSED)).count() == 19


def test_best_f1(spark):
    r = E.best_f1_threshold(scores(spark, *WAVERING)).first()
    assert (r.threshold, r.precision, r.recall, r.f1) == (0.22, pytest.approx(2 / 3), 1.0, pytest.approx(0.8))


def test_best_f1_ties_go_to_the_lowest_threshold(spark):
    # 0.9 and 0.3 both reach F1 2/3
    r = E.best_f1_threshold(scores(spark, [1, 0, 0, 1], [0.9, 0.8, 0.5, 0.3])).first()
    assert (r.threshold, r.f1) == (0.3, pytest.approx(2 / 3))


def test_recall_floor(spark):
    df = scores(spark, *DESCENDING)
    r = E.min_recall_threshold(df).first()
    assert (r.threshold, r.precision, r.recall) == (0.69, pytest.approx(0.8), pytest.approx(2 / 3))
    assert r.threshold_rule == "maximize_precision_subject_to_recall>=0.50"
    assert [x.threshold_rule for x in E.operating_thresholds(df).collect()][0] == "best_oof_f1"
    with pytest.raises(K.ContractError):
        E.min_recall_threshold(df, 0.0)


def test_calibration_bins(spark):
    df = scores(spark, [0, 0, 1, 0, 1, 1], [0.1, 0.2, 0.3, 0.4, 0.8, 0.9])
    rows = E.calibration_table(df, 3).orderBy("bin").collect()
    assert [r.mean_predicted_probability for r in rows] == pytest.approx([0.15, 0.35, 0.85])
    assert [r.calibration_gap for r in rows] == pytest.approx([-0.15, 0.15, 0.15])
    assert E.calibration_gap(df, 3).first()[0] == pytest.approx(0.15)


def test_segments(spark):
    df = spark.range(200).select(
        F.when(F.col("id") < 100, "SP").when(F.col("id") < 190, "RJ").alias("customer_state"),
        (F.col("id") % 5 == 0).cast("int").alias(K.TARGET), (F.col("id") / 200).alias("probability"),
    )
    rows = {r.segment: r for r in E.segment_metrics(df, "customer_state", 10, 2).collect()}
    assert rows["SP"].rows == 100 and rows["RJ"].rows == 90 and rows[None].rows == 10  # a missing segment stays
    assert {r.segment for r in E.segment_metrics(df, "customer_state", 100).collect()} == {"SP"}
    assert E.segment_metrics(df.withColumn(K.TARGET, F.lit(1)), "customer_state", 10, 2).count() == 0


def test_band_edges_are_upper_closed(spark):
    df = spark.createDataFrame([(250.0, 10.0, 1.0), (250.5, 40.5, 72.5), (None, None, None)],
                               "mean_distance_km double, promised_delivery_days double, approval_lag_hours double")
    rows = E.with_segments(df.withColumn(K.PREDICTION_TS, F.to_timestamp(F.lit("2024-02-03")))).collect()
    assert [r.distance_band for r in rows] == ["<=250 km", "250-500 km", None]
    assert [r.promise_band for r in rows] == ["<=10 days", ">40 days", None]
    assert [r.approval_lag_band for r in rows] == ["<=1 h", ">72 h", None]
    assert rows[0].prediction_month == "2024-02"

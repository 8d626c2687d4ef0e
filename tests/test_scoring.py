import pytest
from pyspark.sql import functions as F

from parcelcast import contracts as K
from parcelcast.operators import evaluation, monitoring, scoring
from parcelcast.sources import standins
from parcelcast.streaming import telemetry
from test_features import toy_features

BANDS = {"low_max": 0.20, "medium_max": 0.40, "high_max": 0.60}


def promise(rows):
    return rows.withColumn("probability", F.greatest(F.least(
        F.lit(0.8) - F.col("promised_delivery_days") / 60.0, F.lit(0.99)), F.lit(0.01)))


@pytest.fixture(scope="module")
def requests(spark):
    return toy_features(spark).drop(K.TARGET).withColumn("customer_state", F.lit("sp"))


def test_batch_score(requests):
    scored, quarantined = scoring.batch_score(requests, promise, BANDS, 0.5, "rule:abc")
    r = scored.first()
    assert r.risk_score == pytest.approx(0.8 - 10 / 60) and r.risk_band == "critical" and r.requires_review
    assert scored.count() == 20 and quarantined.count() == 0


def test_contract_faults(requests):
    bad = requests.withColumn("promised_delivery_days", F.lit(-1.0)).withColumn("item_count", F.lit(None).cast("double"))
    faults = scoring.contract_validation(bad).first().faults
    assert faults == ["promised_delivery_days: below 0", "item_count: required"]
    with pytest.raises(K.ContractError, match="unknown columns"):
        scoring.contract_validation(requests.withColumn("extra", F.lit(1)))
    odd = requests.withColumn("item_count", F.lit(1.5)).withColumn("total_price", F.lit(float("nan")))
    assert scoring.contract_validation(odd).first().faults == ["item_count: not whole", "total_price: below 0"]
    optional = requests.withColumn("payment_value", F.lit(None).cast("double"))
    assert scoring.contract_validation(optional).first().faults == []


def test_normalisation_runs_after_the_check(requests):
    padded = requests.withColumn("customer_state", F.lit(" s")).withColumn("primary_payment_type", F.lit("  "))
    valid, _ = scoring.split_valid(scoring.contract_validation(padded))
    r = scoring.normalize_categories(valid).first()
    assert r.customer_state == "S" and r.primary_payment_type is None


def test_band_edges(spark):
    df = spark.createDataFrame([(0.2,), (0.4,), (0.6,), (0.61,)], "probability double")
    rows = scoring.with_policy(df, BANDS, 0.4).collect()
    assert [r.risk_band for r in rows] == ["low", "medium", "high", "critical"]
    assert [r.requires_review for r in rows] == [False, True, True, True]
    with pytest.raises(K.ContractError):
        scoring.action_threshold(0.5, override=1.5)


@pytest.fixture(scope="module")
def oof(spark):
    return spark.range(100).select(
        F.element_at(F.array(*[F.lit(x) for x in (0, 0, 1, 0, 1)]), (F.col("id") % 5 + 1).cast("int")).alias(K.TARGET),
        (F.lit(0.05) + F.col("id") * (0.85 / 99)).alias("probability"),
    )


def test_deployment_record(spark, oof):
    rules = spark.createDataFrame(
        [("best_oof_f1", 0.55), ("maximize_precision_subject_to_recall>=0.50", 0.50)],
        "threshold_rule string, threshold double")
    r = scoring.deployment_config(oof, rules, "candidate_03", "xgboost", "a" * 64).first()
    assert r.risk_score.action_threshold == 0.50
    b = r.risk_score.bands
    assert b.low_max < b.medium_max < b.high_max and b.low_max == pytest.approx(0.475)
    assert r.monitoring_reference["rows"] == 100 and r.model.feature_count == 41
    only_f1 = rules.filter("threshold_rule = 'best_oof_f1'")
    assert scoring.choose_threshold(only_f1).first().action_threshold == 0.55
    with pytest.raises(Exception, match="no supported operating threshold"):
        scoring.choose_threshold(rules.filter("threshold > 1")).collect()


def test_no_scores_is_an_error(spark):
    empty = spark.createDataFrame([("x",)], "probability string")
    with pytest.raises(Exception, match="no valid scores"):
        scoring.band_thresholds(empty).collect()


def test_payload_round_trip(requests):
    with_gap = requests.withColumn("payment_value", F.lit(None).cast("double"))
    packed = scoring.pack_payload(with_gap)
    assert '"payment_value":null' in packed.first().payload
    back = scoring.unpack_payload(packed).orderBy("order_id").drop("order_id", K.PREDICTION_TS)
    want = with_gap.orderBy("order_id").select(*back.columns)
    assert back.collect() == want.collect()


def test_response_ids_count_from_zero(requests):
    rows = scoring.response_ids(requests.select("order_id"), "r", ["order_id"], "v").orderBy("order_id").collect()
    assert [r.response_id for r in rows] == [f"r:{i}" for i in range(20)]
    assert scoring.model_version("c", "0123456789abcdef") == "c:0123456789ab"


def empty_log(spark):
    return spark.createDataFrame([], "ts timestamp, prediction_index int, failed boolean, score double, missing_features bigint, "
                                     "latency_ms double, risk_band string, requires_review boolean")


def test_empty_log_gives_zeros(spark):
    r = monitoring.telemetry_snapshot(empty_log(spark)).first()
    assert r.total_requests == 0 and r.mean_risk_score == 0.0 and r.missing_feature_values == 0


def test_requests_and_predictions_count_apart(spark):
    log = spark.sql("SELECT timestamp '2024-01-01' AS ts, i AS prediction_index, false AS failed, 0.5D AS score, 0L AS missing_features, "
                    "30D AS latency_ms, 'high' AS risk_band, true AS requires_review FROM (SELECT explode(array(0, 1, 2)) AS i)")
    r = monitoring.telemetry_snapshot(log).first()
    assert (r.total_requests, r.total_predictions, r.average_request_latency_ms) == (1, 3, 30.0)


def test_stream_delivers_every_window(spark, tmp_path):
    folder = "/root/testdata/sf0.001"

    def to_log(events):
        return scoring.with_policy(standins.log_columns(events), BANDS, 0.5, "score")

    got = telemetry.telemetry_job(
        spark, folder, "events.parquet", str(tmp_path / "out"), str(tmp_path / "progress"), to_log)
    batch = monitoring.telemetry_windows(to_log(spark.read.parquet(f"{folder}/events.parquet")))
    want = {r.window_start: r.total_predictions for r in batch.collect()}
    have = {r.window_start: r.total_predictions for r in got.collect()}
    assert have == want
    # a second run finds nothing new and repeats nothing
    again = telemetry.telemetry_job(
        spark, folder, "events.parquet", str(tmp_path / "out"), str(tmp_path / "progress"), to_log)
    assert again.count() == len(have)


def test_labels_known_before_the_score_do_not_count(spark, oof):
    predictions = spark.sql("SELECT 1L AS order_id, timestamp '2024-01-05' AS prediction_timestamp, 0.4D AS probability")
    outcome = predictions.select("order_id", F.lit(1).alias(K.TARGET), F.to_timestamp(F.lit("2024-01-04")).alias("delivered_at"))
    assert monitoring.matured_label_quality(predictions, outcome).count() == 0
    later = outcome.withColumn("delivered_at", F.to_timestamp(F.lit("2024-01-06")))
    assert monitoring.matured_label_quality(predictions, later).first().month == "2024-01"
    assert evaluation.ranking_metrics(oof).first().rows == 100

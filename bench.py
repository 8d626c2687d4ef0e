"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs twice and the faster run counts: the first one pays for class loading and code generation.
The split feature table is timed on its own (``features_split``) and then read by the later stages, as in a
chain of jobs that hand over written tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelcast.operators import training  # noqa: E402
from parcelcast.plans import catalog, jobs  # noqa: E402
from parcelcast.session import local_session, materialize  # noqa: E402

HEADLINE = [
    "dataset_overview", "missing_report", "duplicate_report", "key_check", "foreign_key_check", "lifecycle_checks",
    "numeric_describe_items", "clean_orders_job", "population_funnel", "geo_lookup", "order_item_features",
    "order_payment_features", "order_product_features", "distance_features", "feature_table", "monthly_late_rate",
    "state_late_rate", "describe_by_target", "numeric_signal_summary", "chronological_split", "expanding_folds",
    "fold_summary", "standard_scale", "ranking_metrics", "best_f1_threshold", "threshold_sweep", "calibration_table",
    "segment_reports", "drift_summary", "fold_metrics", "contract_validation", "batch_score", "band_thresholds",
    "telemetry_windows", "matured_label_quality",
]
FITS = ["decision_tree", "logistic_regression"]


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return time.perf_counter() - started


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}

    def record(name: str, work) -> None:
        seconds[name] = round(min(timed(work), timed(work)), 3)

    record("features_split", lambda: materialize(jobs.split_features(spark, sf_dir)))
    catalog.Data(spark, sf_dir).split  # shared by the stages below
    for name in HEADLINE:
        record(name, lambda: drain(catalog.QUERIES[name](spark, sf_dir)))
    train = catalog.Data(spark, sf_dir).part("train")
    for config in training.model_registry():
        if config.config_id in FITS:
            record(f"fit_{config.config_id}", lambda: training.fit_model(train, config))
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

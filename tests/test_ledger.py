"""The evaluation job as a ledger of parts: complete, resumed after a stop, anew for other inputs."""

import json

import pytest
from pyspark.sql import functions as F

from parcelcast import contracts as K
from parcelcast.operators import evaluation, splits, training
from parcelcast.plans import jobs
from parcelcast.plans.ledger import Ledger, content, fingerprint

REPORTS = {"ranking", "rule_metrics", "threshold_sweep", "calibration", "robustness", "segments", "drift", "permutation", "scored",
           "native_importance"}
CONFIGS = [training.ModelConfig("tree", "tree", {"max_depth": 3, "min_samples_leaf": 5}),
           training.ModelConfig("prior", "baseline")]


@pytest.fixture(scope="module")
def split(spark):
    i = F.col("id")
    numbers = {c: (F.xxhash64(F.lit(c), i) % 100).cast("double") for c in K.NUMERIC_FEATURES}
    promise = F.pmod(F.xxhash64(F.lit("p"), i), F.lit(40)).cast("double")
    numbers["promised_delivery_days"] = promise
    frame = spark.range(400).select(
        i.alias("order_id"), (i + 1).alias("row_num"), F.timestamp_seconds(i * 36000).alias(K.PREDICTION_TS),
        *[c.alias(n) for n, c in numbers.items()], F.lit("SP").alias("customer_state"), F.lit("card").alias("primary_payment_type"),
        F.lit("cat").alias("dominant_product_category"), (promise < 12).cast("int").alias(K.TARGET),
        F.when(i < 280, "train").when(i < 340, "validation").otherwise("test").alias("split"))
    return frame


def run(split, path, **options):
    return jobs.evaluation_job(split, CONFIGS, path, repeats=2, n_splits=2, **options)


def test_a_stopped_evaluation_goes_on_where_it_was(spark, split, tmp_path, monkeypatch):
    path = str(tmp_path / "evaluation")
    real, calls = evaluation.calibration_table, []

    def stopped(*args, **kwargs):
        raise RuntimeError("killed")

    monkeypatch.setattr(evaluation, "calibration_table", stopped)
    with pytest.raises(RuntimeError):
        run(split, path)
    searched = training.run_search
    monkeypatch.setattr(training, "run_search", lambda *a, **k: calls.append(1) or searched(*a, **k))
    monkeypatch.setattr(evaluation, "calibration_table", real)
    reports, book = run(split, path)
    assert set(reports) == REPORTS and not calls  # neither the search nor any finished report is done again
    assert book.done[0] == "calibration" and not {"ranking", "scored_rows", "model", "fold_metrics"} & set(book.done)
    assert {r["report"] for r in book.manifest().collect()} == REPORTS | {"fold_metrics", "out_of_fold", "rules", "model", "scored_rows"}
    for row in book.manifest().collect():
        if row["report"] in reports:
            assert content(reports[row["report"]]) == (row["rows"], row["content"]) and (row["rows"] > 0 or row["report"] == "segments")  # too few rows for a segment
    long = jobs.long_reports(reports)
    assert {r["report"] for r in long.select("report").distinct().collect()} == REPORTS
    assert all(json.loads(r["record"]) for r in long.collect())
    again, third = run(split, path)
    assert third.done == [] and again["ranking"].collect() == reports["ranking"].collect()


def test_other_inputs_start_anew(spark, split, tmp_path):
    changed = split.withColumn(K.TARGET, F.when(F.col("order_id") == 7, 1 - F.col(K.TARGET)).otherwise(F.col(K.TARGET)))
    one, two = fingerprint({"split": split}, {}), fingerprint({"split": changed}, {})
    assert one != two and one != fingerprint({"split": split}, {"repeats": 2})
    assert one == fingerprint({"split": split.repartition(7, "customer_state")}, {})
    first, second = Ledger(spark, str(tmp_path), one), Ledger(spark, str(tmp_path), two)
    first.table("r", lambda: spark.range(3).toDF("x"))
    assert first.entry("r")["rows"] == 3 and second.entry("r") is None


def test_a_part_without_a_manifest_does_not_count(spark, tmp_path):
    book = Ledger(spark, str(tmp_path), "f" * 64)
    spark.range(9).toDF("x").write.parquet(f"{book.root}/parts/r-torn")
    assert book.entry("r") is None
    assert book.table("r", lambda: spark.range(2).toDF("x")).count() == 2
    assert book.table("r", lambda: pytest.fail("built twice")).count() == 2 and book.done == ["r"]


def test_repeated_rows_change_the_fingerprint(spark):
    rows = spark.createDataFrame([(1, None, {"a": 1}), (2, [1], None)], "x int, y array<int>, z map<string,int>")
    assert content(rows)[0] == 2 and content(rows) == content(rows.orderBy(F.desc("x")))
    assert content(rows.union(rows))[1] != content(rows)[1]


def test_the_registered_evaluation_searches_the_whole_grid_and_deploys_its_winner(spark, split, tmp_path, monkeypatch):
    from types import SimpleNamespace

    from parcelcast.plans import catalog

    seen, record = {}, spark.range(1)
    found = [(c.config_id, c.family, i, 0.9 if c.config_id == "random_forest_02" else 0.1) for c in training.search_configs() for i in (1, 2)]
    metrics = spark.createDataFrame(found, "config_id string, model_family string, fold int, pr_auc double")
    for name in ("roc_auc", "recall", "precision", "f1"):
        metrics = metrics.withColumn(name, metrics["pr_auc"])
    book = SimpleNamespace(part=lambda name: metrics, entry=lambda name: {"part": "model path"})
    monkeypatch.setattr(catalog, "Data", lambda *_: SimpleNamespace(spark=spark, sf_dir=str(tmp_path), split=split))
    monkeypatch.setattr(jobs, "evaluation_job", lambda split, configs, *_, **options: seen.update(configs=configs, **options) or ({"r": record}, book))
    monkeypatch.setattr(jobs, "deployment_job", lambda spark, path, oof, rules, config: seen.update(winner=config, oof=oof) or record)
    assert catalog.QUERIES["evaluation_job"](spark, "").count() == catalog.QUERIES["deployment_job"](spark, "").count() == 1
    assert seen["configs"] == training.search_configs() and len(seen["configs"]) == 22
    assert seen["winner"].config_id == "random_forest_02" and set(seen) == {"configs", "winner", "oof"}  # all folds, all repeats
    assert {r["config_id"] for r in seen["oof"].collect()} == {"random_forest_02"}  # not the scores of the whole grid

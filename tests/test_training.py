import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from parcelcast import contracts as K
from parcelcast.operators import evaluation, importance, preprocessing, profiling, splits, training, trees
from parcelcast.plans import jobs


@pytest.fixture(scope="module")
def ranked(spark):
    """400 orders whose lateness follows the promise; some gaps, one unseen state in the later rows."""
    i = F.col("id")
    numbers = {c: (F.xxhash64(F.lit(c), i) % 100).cast("double") for c in K.NUMERIC_FEATURES}
    numbers["payment_value"] = F.when(i % 4 != 0, i.cast("double"))
    numbers["purchase_year"] = F.lit(2018.0)
    promise = F.pmod(F.xxhash64(F.lit("p"), i), F.lit(40)).cast("double")
    numbers["promised_delivery_days"] = promise
    return splits.chronological_order(spark.range(400).select(
        i.alias("order_id"), F.timestamp_seconds(i * 3600).alias(K.PREDICTION_TS),
        *[c.alias(n) for n, c in numbers.items()],
        F.when(i < 300, F.element_at(F.array(F.lit("SP"), F.lit("RJ")), (i % 2 + 1).cast("int"))).otherwise("ZZ").alias("customer_state"),
        F.when(i % 5 != 0, F.lit("card's")).alias("primary_payment_type"),
        F.lit("cat").alias("dominant_product_category"),
        (promise < 12).cast("int").alias(K.TARGET),
    ))


def test_numeric_fit_matches_numpy(ranked):
    fit = preprocessing.fit_numeric(ranked, ["payment_value", "purchase_year"])
    raw = np.array([np.nan if i % 4 == 0 else float(i) for i in range(400)])
    filled = np.where(np.isnan(raw), np.nanmedian(raw), raw)
    assert fit.medians["payment_value"] == np.nanmedian(raw) and fit.gaps == ["payment_value"]
    assert fit.means["payment_value"] == pytest.approx(filled.mean())
    assert fit.scales["payment_value"] == pytest.approx(filled.std())
    assert fit.scales["missingindicator_payment_value"] == pytest.approx(math.sqrt(0.25 * 0.75))
    assert fit.scales["purchase_year"] == 1.0
    sketch = preprocessing.fit_numeric(ranked, ["payment_value"], accuracy=10000)
    assert sketch.means["payment_value"] == pytest.approx(fit.means["payment_value"], rel=1e-2)


def test_modes_break_ties_by_name(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("b",), ("a",), (None,)], "t string")
    assert preprocessing.fit_modes(df, ["t"]) == {"t": "a"}


def test_preprocessor_zeroes_unseen_values(ranked):
    train = ranked.filter("row_num <= 300")
    fitted = preprocessing.build_preprocessor(train)
    names = preprocessing.feature_names(fitted)
    states = [i for i, n in enumerate(names) if n.startswith("categorical__customer_state")]
    assert [names[i] for i in states] == ["categorical__customer_state_RJ", "categorical__customer_state_SP"]
    assert "numeric__missingindicator_payment_value" in names
    rows = fitted.transform(ranked).select("order_id", vector_to_array("features").alias("v"))
    unseen = rows.filter("order_id = 350").first().v
    assert len(unseen) == len(names) and [unseen[i] for i in states] == [0.0, 0.0]
    seen = rows.filter("order_id = 2").first().v
    assert [seen[i] for i in states] == [0.0, 1.0]
    assert unseen[names.index("categorical__primary_payment_type_card's")] == 1.0  # gap filled with the mode


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "late_delivery int")
    w = preprocessing.class_weights(df)
    assert (w["balanced_1"], w["scale_pos_weight"]) == (2.0, 3.0) and w["balanced_0"] == pytest.approx(2 / 3)
    assert preprocessing.class_weights(df.filter("late_delivery = 0"))["scale_pos_weight"] == 1.0
    assert preprocessing.class_weight_table(df, []).first().balanced_1 == 2.0


def test_registries():
    full, quick = training.search_configs(), training.search_configs(quick=True)
    assert len(full) == 22 and {c.family for c in quick} == set(training.SEARCH_GRIDS)
    assert full[1].params == {"C": 0.1, "class_weight": "balanced"} and full[1].config_id == "logistic_regression_02"
    assert [c.config_id for c in full if c.family == "xgboost"][-1] == "xgboost_08"
    assert [trees.settings_of(c.family, c.params, 1).max_leaves for c in full if c.family == "hist_gradient_boosting"] == [15, 31, 15, 31]
    xgb = trees.settings_of("xgboost", quick[-1].params, 1)
    assert (xgb.l2, xgb.column_share, xgb.row_share, xgb.min_weight, xgb.late_weight, xgb.patience) == (2.0, 0.85, 0.85, 5, "scale", None)
    assert trees.settings_of("boosting", training.model_registry()[-1].params, 1).patience == 15


def test_temporal_search_end_to_end(ranked, tmp_path):
    folds = splits.fold_bounds(400, n_splits=2, initial_train_fraction=0.5)
    configs = [training.search_configs(quick=True)[0], training.ModelConfig("tree", "tree", {"max_depth": 3, "min_samples_leaf": 5}),
               training.ModelConfig("prior", "baseline")]
    metrics, oof = training.run_search(ranked, folds, configs)
    assert metrics.count() == 6 and oof.count() == 3 * 200
    assert oof.filter("NOT probability BETWEEN 0 AND 1").count() == 0
    summary = training.summarize_search(metrics, training.config_table(ranked.sparkSession, configs))
    best = training.best_config(summary).first()
    assert best.config_id != "prior" and best.mean_pr_auc > 0.9
    model = training.refit_best(ranked, configs[1])
    path = training.save_model(model, str(tmp_path / "model"))
    again = training.load_model(path, ranked)
    a, b = (training.score_rows(m, ranked).select("order_id", "probability").orderBy("order_id").collect() for m in (model, again))
    assert a == b
    native = importance.native_importance(model).first()
    assert native.feature == "numeric__promised_delivery_days"
    shuffled = importance.permutation_importance(model, ranked, 2, columns=K.MODEL_FEATURES).collect()
    assert shuffled[0].feature == "promised_delivery_days" and shuffled[0].importance_mean > 0.2
    assert len(shuffled) == 41 and shuffled[-1].importance_mean == pytest.approx(0, abs=0.05)


def test_shuffle_is_a_permutation_within_each_repeat(ranked):
    pairs = importance.shuffled_pairs(ranked.select("order_id", K.TARGET), 3, 1, [K.TARGET])
    assert pairs.count() == 1200 and pairs.groupBy("repeat").agg(F.countDistinct("order_id").alias("k")).filter("k = 400").count() == 3
    same = pairs.groupBy("repeat").agg(F.sum(f"donor__{K.TARGET}").alias("d"), F.sum(K.TARGET).alias("o")).collect()
    assert all(r.d == r.o for r in same)


def test_boosting_keeps_several_trees(ranked):
    config = training.ModelConfig("b", "boosting", {"learning_rate": 0.1, "max_iter": 5, "max_leaf_nodes": 7, "min_samples_leaf": 5})
    assert training.fit_model(ranked, config).n_trees == 5


def test_unknown_family():
    with pytest.raises(K.ContractError):
        training.build_estimator(training.ModelConfig("x", "svm"), 1.0)


def test_linear_attribution(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 3.0, 4.0)], "order_id bigint, a double, b double")
    rows = importance.global_attribution(importance.linear_contributions(df, {"a": 2.0, "b": 1.0})).collect()
    assert [(r.feature, r.mean_absolute_contribution) for r in rows] == [("a", 2.0), ("b", 0.0)]


def test_baseline_and_deployment_jobs(ranked, tmp_path):
    split = ranked.withColumn("split", F.when(F.col("row_num") <= 280, "train").when(F.col("row_num") <= 340, "validation").otherwise("test"))
    configs = [training.ModelConfig("tree", "tree", {"max_depth": 3, "min_samples_leaf": 5}), training.ModelConfig("prior", "baseline")]
    ranking, best, metrics, matrices = jobs.baseline_job(split, configs)
    assert [r.model for r in ranking.collect()] == ["tree", "prior"]
    assert [r.evaluation for r in metrics.collect()] == ["default_threshold", "validation_tuned_threshold"]
    assert all(sum((r.pred_on_time, r.pred_late)) > 0 for r in matrices.collect())
    path = training.save_model(best, str(tmp_path / "model"))
    oof = training.score_rows(best, split.filter("split = 'validation'"))
    record = jobs.deployment_job(
        ranked.sparkSession, path, oof, evaluation.operating_thresholds(oof), configs[0], str(tmp_path / "config")).first()
    assert len(record.model.sha256) == 64 and record.monitoring_reference["rows"] == 60
    assert 0 <= record.risk_score.action_threshold <= 1


def test_registered_fits_do_the_whole_job(spark, monkeypatch):
    """The search takes the whole grid, the refit its winner, the evaluation job full rounds, five repeats and all reports."""
    from types import SimpleNamespace

    from parcelcast.plans import catalog

    seen = {}
    rows = spark.createDataFrame([(1, 1, "train"), (2, 2, "test")], "order_id long, row_num long, split string")
    data = SimpleNamespace(spark=spark, sf_dir="whole-job-test", split=rows, part=lambda n: rows.filter(rows["split"] == n))
    monkeypatch.setattr(catalog, "Data", lambda *_: data)
    monkeypatch.setattr(catalog.splits, "fold_bounds", lambda n, *_: [])

    def search(ranked, folds, configs, *_):
        seen["configs"] = configs
        found = [(c.config_id, c.family, i, 0.9 if c.config_id == "hist_gradient_boosting_03" else 0.1) for c in configs for i in (1, 2)]
        frame = spark.createDataFrame(found, "config_id string, model_family string, fold int, pr_auc double")
        for name in ("roc_auc", "recall", "precision", "f1"):
            frame = frame.withColumn(name, frame["pr_auc"])
        return frame, None

    def evaluate(split, configs, path, repeats=5):
        seen["tuned"], seen["repeats"] = configs, repeats
        return {"ranking": rows.select("order_id"), "scored": rows}, None

    monkeypatch.setattr(catalog.training, "run_search", search)
    monkeypatch.setattr(catalog.training, "refit_best", lambda development, config: seen.setdefault("refit", config))
    monkeypatch.setattr(catalog.training, "score_rows", lambda model, test: test.selectExpr("order_id", "0.5D AS probability"))
    monkeypatch.setattr(jobs, "evaluation_job", evaluate)
    assert catalog.QUERIES["run_search"](spark, data.sf_dir).count() == 2 * 22
    assert catalog.QUERIES["refit_best"](spark, data.sf_dir).count() == 1
    assert seen["configs"] == training.search_configs() and seen["refit"].config_id == "hist_gradient_boosting_03"
    got = catalog.QUERIES["evaluation_job"](spark, data.sf_dir)
    assert sorted(r["report"] for r in got.collect()) == ["ranking", "ranking", "scored", "scored"]
    assert seen["repeats"] == 5 and [c.params["n_estimators"] for c in seen["tuned"]] == [350]

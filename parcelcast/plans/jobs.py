"""The analysis as composed jobs; each stage hands a table to the next."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cache, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from parcelcast.contracts import ORDER_KEY, PREDICTION_TS, TARGET
from parcelcast.operators import cleaning, drift, evaluation, features, importance, scoring, splits, training
from parcelcast.operators.evaluation import SCORE
from parcelcast.operators.trees import TreeModel
from parcelcast.plans.ledger import Ledger, fingerprint
from parcelcast.session import materialize, scratch_path
from parcelcast.sources import files, standins

FEATURE_INPUTS = ("customers", "order_items", "payments", "products", "sellers", "geolocation", "category_translation")


def cleaned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_orders(standins.view(spark, sf_dir, "orders_raw"))


def build_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tables to the 44-column feature table."""
    tables = {name: standins.view(spark, sf_dir, name) for name in FEATURE_INPUTS}
    return features.feature_table(cleaned_orders(spark, sf_dir), **tables)


def split_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table with ``row_num`` and ``split``.

    Positions are worked out on (moment, id) alone and joined back on the id, so the wide rows are never
    range-partitioned.
    """
    keys = cleaned_orders(spark, sf_dir).select(ORDER_KEY, F.col("order_approved_at").alias(PREDICTION_TS))
    positions = splits.chronological_split(keys).select(ORDER_KEY, "row_num", "split")
    return build_features(spark, sf_dir).join(positions, ORDER_KEY)


def features_job(spark: SparkSession, sf_dir: str, output: str | None = None) -> DataFrame:
    """Build, write, check and return the split feature table.

    It is written once, by split, to ``output`` or to the shared folder; everything later reads the copy.
    """
    path = output or scratch_path(spark, "features")
    files.write_parquet(split_features(spark, sf_dir), path, ["split"])
    written = files.read_parquet(spark, path)
    cleaning.raise_on_violations(features.validate_features(written.drop("split", "row_num")))
    return written


def baseline_job(split: DataFrame, configs: Sequence[training.ModelConfig] | None = None):
    """Compare the baseline models and report the best one on the test split.

    Returns (ranking, best model, test metrics, confusion matrices).
    """
    views = {name: split.filter(F.col("split") == name) for name in splits.SPLITS}
    ranking, models, scores = training.train_compare(views["train"], views["validation"], configs)
    best = training.select_best(ranking).first()["model"]
    if models[best] is None:
        test_scores = training.dummy_prior(views["train"], views["test"])
    else:
        test_scores = training.score_rows(models[best], views["test"])
    test_scores = materialize(test_scores.select(ORDER_KEY, PREDICTION_TS, TARGET, SCORE))
    metrics, matrices = training.holdout_report(scores.filter(F.col("model") == best), test_scores)
    named = F.lit(best).alias("model")
    return ranking, models[best], metrics.select(named, "*"), matrices.select(named, "*")


def tuning_job(split: DataFrame, configs: Sequence[training.ModelConfig], n_splits: int = 4, initial: float = 0.50,
               parallelism: int = 4):
    """Temporal search on train and validation rows, thresholds from out-of-fold scores, and a refit."""
    views = splits.split_views(split)
    development = splits.development_union(views["train"], views["validation"])
    folds = splits.fold_bounds(development.count(), n_splits, initial)
    metrics, scores = training.run_search(development, folds, configs, parallelism)
    summary = training.summarize_search(metrics, training.config_table(split.sparkSession, configs))
    best_id = training.best_config(summary).first()["config_id"]
    best = next(c for c in configs if c.config_id == best_id)
    oof = scores.filter(F.col("config_id") == best_id)
    rules = evaluation.operating_thresholds(oof)
    model = training.refit_best(development, best)
    return {"folds": splits.fold_summary(development, folds), "fold_metrics": metrics, "summary": summary,
            "best": best, "oof": oof, "rules": rules, "model": model, "development": development}


def evaluation_reports(
    model: training.Model, development: DataFrame, test: DataFrame, oof: DataFrame, rules: DataFrame,
    fold_metrics: DataFrame, config_id: str, scored: DataFrame, repeats: int = 5,
) -> dict[str, Callable[[], DataFrame]]:
    """How to build each report of a tuned candidate; ``scored`` holds the test rows with segments and scores."""
    def ranking() -> DataFrame:
        named = [("development_oof", "temporal_oof", oof), ("test", "observed_holdout_diagnostic", scored)]
        return reduce(DataFrame.unionByName, [
            evaluation.ranking_metrics(df).select(F.lit(n).alias("dataset"), F.lit(status).alias("evaluation_status"), "*")
            for n, status, df in named
        ])

    reports = {
        "ranking": ranking,
        "rule_metrics": lambda: evaluation.rule_metrics(scored, rules),
        "threshold_sweep": lambda: evaluation.threshold_sweep(scored),
        "calibration": lambda: evaluation.calibration_table(scored),
        "robustness": lambda: evaluation.temporal_robustness(fold_metrics, config_id),
        "segments": lambda: evaluation.segment_reports(scored),
        "drift": lambda: drift.drift_summary(development, test),
        "permutation": lambda: importance.permutation_importance(model, test, repeats),
        "scored": lambda: scored.select(
            ORDER_KEY, PREDICTION_TS, TARGET, SCORE, "customer_state", "mean_distance_km", "promised_delivery_days",
            "approval_lag_hours", "distance_band", "promise_band", "approval_lag_band", "prediction_month",
        ),
    }
    if isinstance(model, TreeModel):
        reports["native_importance"] = lambda: importance.native_importance(model)
    return reports


def evaluation_job(
    split: DataFrame, configs: Sequence[training.ModelConfig], path: str, repeats: int = 5, n_splits: int = 4,
    initial: float = 0.50,
) -> tuple[dict[str, DataFrame], Ledger]:
    """All reports of the best configuration, with the search and the refit before them, entered in a ledger below ``path``.

    A run that was stopped goes on where it was: the search, the model, the scored rows and every report are parts of
    their own.
    """
    spark = split.sparkSession
    settings = {"configs": [[c.config_id, c.family, c.params] for c in configs], "repeats": repeats, "n_splits": n_splits,
                "initial": initial, "seed": training.SEED}
    book = Ledger(spark, path, fingerprint({"split": split}, settings))
    views = splits.split_views(split)

    @cache
    def development() -> DataFrame:
        return splits.development_union(views["train"], views["validation"])

    @cache
    def searched() -> tuple[DataFrame, DataFrame]:
        rows = development()
        return training.run_search(rows, splits.fold_bounds(rows.count(), n_splits, initial), configs)

    fold_metrics = book.table("fold_metrics", lambda: searched()[0])
    scores = book.table("out_of_fold", lambda: searched()[1])
    best = training.best_config(training.summarize_search(fold_metrics)).first()["config_id"]
    config = next(c for c in configs if c.config_id == best)
    oof = scores.filter(F.col("config_id") == best)
    rules = book.table("rules", lambda: evaluation.operating_thresholds(oof))
    model = book.model("model", lambda: training.refit_best(development(), config))
    test = views["test"]
    scored = book.table("scored_rows", lambda: evaluation.with_segments(training.score_rows(model, test)))
    known = split.filter(F.col("split") != "test")
    builders = evaluation_reports(model, known, test, oof, rules, fold_metrics, best, scored, repeats)
    return {name: book.table(name, build) for name, build in builders.items()}, book


def long_reports(reports: dict[str, DataFrame], written: bool = True) -> DataFrame:
    """All rows of all reports in one table: the report's name and the row as JSON, nulls included.

    A written report without rows is named once, with a record of nulls; others are not looked into before.
    """
    def rows(df: DataFrame) -> DataFrame:
        if written and df.isEmpty():
            return df.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
        return df

    return reduce(DataFrame.unionByName, [
        rows(df).select(F.lit(name).alias("report"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))
        for name, df in reports.items()
    ])


def deployment_job(spark: SparkSession, model_path: str, oof: DataFrame, rules: DataFrame,
                   config: training.ModelConfig, output: str | None = None) -> DataFrame:
    """The deployment record of a saved model."""
    digest = files.artifact_fingerprint(spark, model_path).first()["sha256"]
    record = scoring.deployment_config(oof, rules, config.config_id, config.family, digest)
    if output:
        files.write_metadata(record, output)
    return record

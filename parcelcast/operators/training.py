"""Model registry, temporal cross-validation and search: regressions with Spark ML, trees with `operators.trees`."""

from __future__ import annotations

import itertools
import json
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pyspark.errors import AnalysisException

from parcelcast.contracts import ContractError, ORDER_KEY, PREDICTION_TS, TARGET
from parcelcast.operators.evaluation import (
    SCORE, best_f1_threshold, classification_metrics, confusion_matrix,
)
from parcelcast.operators.preprocessing import build_preprocessor, class_weights
from parcelcast.operators.splits import Fold
from parcelcast.operators.trees import TreeModel, fit_trees, score_many, settings_of
from parcelcast.session import materialize

SEED = 42
_WEIGHT = "_weight"
LINEAR_FAMILIES = ("logistic_regression", "linear")
TREE_FAMILIES = ("tree", "random_forest", "ensemble", "hist_gradient_boosting", "boosting", "xgboost")
Model = PipelineModel | TreeModel


@dataclass(frozen=True)
class ModelConfig:
    config_id: str
    family: str
    params: dict = field(default_factory=dict)
    description: str = ""

    def params_json(self) -> str:
        return json.dumps(self.params, sort_keys=True)


def model_registry() -> list[ModelConfig]:
    """The baseline models, one configuration each."""
    # Model names and hyper-parameters.
    return [
        ModelConfig("dummy_prior", "baseline", {}, "training prevalence for every row"),
        ModelConfig("logistic_regression", "linear", {"C": 1.0, "class_weight": "balanced", "max_iter": 2000},
                    "class-balanced logistic regression"),
        ModelConfig("decision_tree", "tree", {"max_depth": 8, "min_samples_leaf": 50},
                    "class-balanced single tree"),
        ModelConfig("random_forest", "ensemble", {"n_estimators": 300, "max_depth": None, "min_samples_leaf": 5},
                    "class-balanced forest"),
        ModelConfig("hist_gradient_boosting", "boosting",
                    {"learning_rate": 0.08, "max_iter": 180, "max_leaf_nodes": 31, "min_samples_leaf": 30},
                    "class-balanced boosting with early stopping"),
    ]


# The search grid of each family; the last key varies fastest.
SEARCH_GRIDS = {
    "logistic_regression": {"C": [0.1, 1.0, 10.0], "class_weight": [None, "balanced"]},
    "random_forest": {"n_estimators": [300], "max_depth": [12, None], "min_samples_leaf": [5, 20],
                      "max_features": ["sqrt"]},
    "hist_gradient_boosting": {"learning_rate": [0.05, 0.10], "max_leaf_nodes": [15, 31], "min_samples_leaf": [30]},
    "xgboost": {"n_estimators": [300, 500], "max_depth": [3, 5], "learning_rate": [0.03, 0.07],
                "min_child_weight": [5], "subsample": [0.85], "colsample_bytree": [0.85], "reg_lambda": [2.0],
                "scale_pos_weight": ["auto"]},
}

# One representative configuration per family.
QUICK_PARAMS = {
    "logistic_regression": {"C": 1.0, "class_weight": "balanced"},
    "random_forest": {"n_estimators": 250, "max_depth": None, "min_samples_leaf": 5, "max_features": "sqrt"},
    "hist_gradient_boosting": {"learning_rate": 0.08, "max_leaf_nodes": 31, "min_samples_leaf": 30},
    "xgboost": {"n_estimators": 350, "max_depth": 4, "learning_rate": 0.05, "min_child_weight": 5,
                "subsample": 0.85, "colsample_bytree": 0.85, "reg_lambda": 2.0, "scale_pos_weight": "auto"},
}


def expand_grid(family: str, grid: dict[str, Sequence]) -> list[ModelConfig]:
    points = itertools.product(*grid.values())
    return [
        ModelConfig(f"{family}_{i:02d}", family, dict(zip(grid, values))) for i, values in enumerate(points, start=1)
    ]


def search_configs(quick: bool = False) -> list[ModelConfig]:
    if quick:
        return [ModelConfig(f"{family}_quick", family, dict(p)) for family, p in QUICK_PARAMS.items()]
    return [config for family, grid in SEARCH_GRIDS.items() for config in expand_grid(family, grid)]


def config_table(spark: SparkSession, configs: Sequence[ModelConfig]) -> DataFrame:
    rows = [(c.config_id, c.family, c.params_json()) for c in configs]
    return spark.createDataFrame(rows, "config_id string, model_family string, params string")


def registry_table(spark: SparkSession) -> DataFrame:
    rows = [(c.config_id, c.family, c.description) for c in model_registry()]
    return spark.createDataFrame(rows, "model string, family string, description string")


def resolved_configs(ranked: DataFrame, folds: Sequence[Fold], configs: Sequence[ModelConfig]) -> DataFrame:
    """Configurations by fold with the positive weight each fold's training rows call for.

    The fold counts come from one pass over the rows; the grid is attached as an array and exploded.
    """
    position = F.col("row_num")
    counts = ranked.agg(*[
        e for f in folds for e in (
            F.count(F.when(f.in_train(position), F.lit(1))).alias(f"n{f.number}"),
            F.count(F.when(f.in_train(position) & (F.col(TARGET) == 1), F.lit(1))).alias(f"p{f.number}"),
        )
    ])
    per_fold = counts.select(F.explode(F.array(*[
        F.struct(F.lit(f.number).alias("fold"), F.col(f"n{f.number}").alias("train_rows"),
                 F.col(f"p{f.number}").alias("train_positives")) for f in folds
    ])).alias("f")).select("f.*")
    grid = F.array(*[
        F.struct(F.lit(c.config_id).alias("config_id"), F.lit(c.family).alias("model_family"),
                 F.lit(c.params.get("scale_pos_weight") == "auto").alias("auto_weight")) for c in configs
    ])
    negatives = (F.col("train_rows") - F.col("train_positives")).cast("double")
    balance = F.coalesce(F.try_divide(negatives, F.col("train_positives").cast("double")), F.lit(1.0))
    return per_fold.select("*", F.explode(grid).alias("c")).select(
        "c.config_id", "c.model_family", "fold", "train_rows", "train_positives",
        F.when(F.col("c.auto_weight"), balance).alias("scale_pos_weight"),
    )


def _weights(train: DataFrame, params: dict) -> tuple[float, float, float]:
    """(weight of on-time rows, weight of late rows, total weight) of a regression."""
    w = class_weights(train)
    on_time, late = (1.0, 1.0) if params.get("class_weight") is None else (w["balanced_0"], w["balanced_1"])
    return on_time, late, on_time * (w["rows"] - w["positives"]) + late * w["positives"]


def build_estimator(config: ModelConfig, total_weight: float) -> LogisticRegression:
    """The Spark ML estimator of a regression."""
    if config.family not in LINEAR_FAMILIES:
        raise ContractError(f"unknown model family: {config.family}")
    # Spark averages the loss over the weights; the penalty is divided by their sum to match
    return LogisticRegression(
        labelCol=TARGET, featuresCol="features", weightCol=_WEIGHT, elasticNetParam=0.0, standardization=False,
        regParam=1.0 / (config.params.get("C", 1.0) * total_weight), maxIter=config.params.get("max_iter", 2000),
    )


def fit_model(train: DataFrame, config: ModelConfig, preprocessor: PipelineModel | None = None,
              tasks: int | None = None) -> Model:
    """The model fitted on ``train``; ``preprocessor`` may be shared by regressions of the same rows.

    Trees bin the raw rows themselves. ``tasks`` merges the partitions of a regression's vectors into fewer.
    """
    if config.family in TREE_FAMILIES:
        bounds = train.agg(F.min("row_num").alias("lo"), F.max("row_num").alias("hi")).first()
        rows = train.withColumn("row_num", F.col("row_num") - F.lit(bounds["lo"] - 1))
        last = bounds["hi"] - bounds["lo"] + 1
        return fit_trees(rows, [Fold(1, last, last)], [settings_of(config.family, config.params, SEED)])[0][0]
    build_estimator(config, 1.0)  # refuses an unknown family before any job
    preprocessor = preprocessor or build_preprocessor(train)
    on_time, late, total = _weights(train, config.params)
    weighted = train.withColumn(_WEIGHT, F.when(F.col(TARGET) == 1, F.lit(late)).otherwise(F.lit(on_time)))
    # every iteration reads the vectors again; lost blocks are recomputed
    vectors = preprocessor.transform(weighted).select("features", TARGET, _WEIGHT).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = build_estimator(config, total).fit(vectors.coalesce(tasks) if tasks else vectors)
    finally:
        vectors.unpersist()
    return PipelineModel([*preprocessor.stages, model])


def positive_probability(scored: DataFrame) -> Column:
    """Score of the late class; only binary models are accepted."""
    column = vector_to_array(F.col("probability"))
    return F.when(F.size(column) == 2, column[1]).otherwise(F.raise_error(F.lit("expected two classes")))


def score_rows(model: Model, rows: DataFrame) -> DataFrame:
    """``rows`` with a ``probability`` column, without the pipeline's intermediate columns."""
    scored = model.transform(rows)
    return scored.select(*rows.columns, positive_probability(scored).alias(SCORE))


def dummy_prior(train: DataFrame, rows: DataFrame) -> DataFrame:
    """Every row scored with the training prevalence."""
    return rows.withColumn(SCORE, train.agg(F.avg(TARGET).alias("p")).scalar())


def fit_and_score(train: DataFrame, rows: DataFrame, config: ModelConfig, preprocessor: PipelineModel | None = None):
    """(model, scored rows, seconds spent fitting)."""
    if config.family == "baseline":
        return None, dummy_prior(train, rows), 0.0
    started = time.perf_counter()
    model = fit_model(train, config, preprocessor)
    return model, score_rows(model, rows), time.perf_counter() - started


_KEPT = [ORDER_KEY, PREDICTION_TS, TARGET, SCORE]


def side_by_side(spark: SparkSession, work: Callable, tasks: Sequence, parallelism: int) -> list:
    """Run driver-side steps in threads; each step is a chain of distributed jobs of its own."""
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), tasks))


def train_compare(
    train: DataFrame, validation: DataFrame, configs: Sequence[ModelConfig] | None = None, parallelism: int = 4
) -> tuple[DataFrame, dict[str, Model | None], DataFrame]:
    """Fit each model on train and rank them by average precision on validation.

    Returns the ranking, the fitted models, and the validation scores of all models. Trees grow together, beside the
    other fits; their time is shared out evenly.
    """
    configs = list(configs or model_registry())
    others = [c for c in configs if c.family not in TREE_FAMILIES]
    grown = [c for c in configs if c.family in TREE_FAMILIES]
    spark, last = train.sparkSession, train.agg(F.max("row_num")).first()[0]
    preprocessor = build_preprocessor(train) if any(c.family in LINEAR_FAMILIES for c in others) else None

    def work(config: ModelConfig | None):
        if config is not None:
            return fit_and_score(train, validation, config, preprocessor)
        started = time.perf_counter()
        models = fit_trees(train, [Fold(1, last, last)], [settings_of(c.family, c.params, SEED) for c in grown])[0]
        return models, None, time.perf_counter() - started

    *fitted, forest = side_by_side(spark, work, [*others, None], parallelism) if grown else [*side_by_side(spark, work, others, parallelism), None]
    models = {c.config_id: model for c, (model, _, _) in zip(others, fitted)}
    seconds = {c.config_id: spent for c, (_, _, spent) in zip(others, fitted)}
    parts = [scored.select(F.lit(c.config_id).alias("model"), *_KEPT) for c, (_, scored, _) in zip(others, fitted)]
    if forest:
        trees = {c.config_id: m for c, m in zip(grown, forest[0])}
        models |= trees
        seconds |= {c: forest[2] / len(trees) for c in trees}
        parts.append(score_many(validation, trees, _KEPT[:3], "model").select("model", *_KEPT))
    scores = materialize(reduce(DataFrame.unionByName, parts))
    timing = spark.createDataFrame([(c.config_id, c.family, float(seconds[c.config_id])) for c in configs],
                                   "model string, family string, fit_seconds double")
    ranking = classification_metrics(scores, groups=["model"]).join(timing, "model")
    return ranking.orderBy(F.desc("pr_auc"), "model"), models, scores


def select_best(ranking: DataFrame, by: str = "pr_auc", name: str = "model") -> DataFrame:
    """The top row of a ranking, names breaking ties."""
    return ranking.orderBy(F.desc(by), F.asc(name)).limit(1)


def holdout_report(validation_scores: DataFrame, test_scores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Test metrics and confusion matrices at 0.50 and at the threshold tuned on validation."""
    tuned = best_f1_threshold(validation_scores).first()["threshold"]
    named = [("default_threshold", 0.50), ("validation_tuned_threshold", tuned)]
    metrics, matrices = [], []
    for evaluation, threshold in named:
        metrics.append(classification_metrics(test_scores, threshold).select(F.lit(evaluation).alias("evaluation"), "*"))
        matrices.append(confusion_matrix(test_scores, threshold).select(F.lit(evaluation).alias("evaluation"), "*"))
    return metrics[0].unionByName(metrics[1]), matrices[0].unionByName(matrices[1])


def fold_metrics(fold_scores: DataFrame) -> DataFrame:
    """Validation metrics by configuration and fold, from (config_id, model_family, fold, label, score) rows."""
    groups = ["config_id", "model_family", "fold"]
    rates = fold_scores.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("validation_rows"), F.avg(TARGET).alias("validation_late_rate")
    )
    return classification_metrics(fold_scores, groups=groups).join(rates, groups)


def cross_validate(
    ranked: DataFrame, folds: Sequence[Fold], config: ModelConfig, parallelism: int = 4
) -> tuple[DataFrame, DataFrame]:
    """(fold metrics, out-of-fold scores) of one configuration."""
    return run_search(ranked, folds, [config], parallelism)


def run_search(
    ranked: DataFrame, folds: Sequence[Fold], configs: Sequence[ModelConfig], parallelism: int = 4
) -> tuple[DataFrame, DataFrame]:
    """(fold metrics, out-of-fold scores) of all configurations.

    The trees of all (configuration, fold) pairs grow together; the regressions run side by side with them, on
    preprocessing fitted once per fold. Every fit sees rows up to its fold's train end only. The time of the trees is shared
    out evenly.
    """
    spark, position = ranked.sparkSession, F.col("row_num")
    trains = {f.number: ranked.filter(f.in_train(position)) for f in folds}
    grown = [c for c in configs if c.family in TREE_FAMILIES]
    others = [c for c in configs if c.family not in TREE_FAMILIES]
    family = {c.config_id: c.family for c in configs}
    kept = ["config_id", "model_family", *_KEPT, "fold"]

    def forest():
        started = time.perf_counter()
        fitted = fit_trees(ranked, folds, [settings_of(c.family, c.params, SEED) for c in grown])
        spent = (time.perf_counter() - started) / (len(grown) * len(folds))
        named = F.create_map(*[F.lit(x) for c in grown for x in (c.config_id, c.family)])
        parts = [
            score_many(ranked.filter(f.in_validation(position)), {c.config_id: m for c, m in zip(grown, models)}, _KEPT[:3])
            .select("config_id", named[F.col("config_id")].alias("model_family"), *_KEPT, F.lit(f.number).alias("fold"))
            for f, models in zip(folds, fitted)
        ]
        return parts, [(c.config_id, f.number, spent) for c in grown for f in folds]

    def one(task: tuple[ModelConfig, Fold]):
        config, fold = task
        _, scored, spent = fit_and_score(
            trains[fold.number], ranked.filter(fold.in_validation(position)), config, preprocessors.get(fold.number)
        )
        named = scored.withColumns({"config_id": F.lit(config.config_id), "model_family": F.lit(family[config.config_id]),
                                    "fold": F.lit(fold.number)})
        return [named.select(*kept)], [(config.config_id, fold.number, float(spent))]

    preprocessors: dict[int, PipelineModel] = {}
    if any(c.family in LINEAR_FAMILIES for c in others):
        fitted = side_by_side(spark, lambda f: build_preprocessor(trains[f.number]), folds, parallelism)
        preprocessors = {f.number: p for f, p in zip(folds, fitted)}
    tasks = ([None] if grown else []) + [(c, f) for c in others for f in folds]
    done = side_by_side(spark, lambda task: one(task) if task else forest(), tasks, parallelism)
    scores = materialize(reduce(DataFrame.unionByName, [part for parts, _ in done for part in parts]))
    timing = spark.createDataFrame([row for _, rows in done for row in rows], "config_id string, fold int, fit_seconds double")
    return fold_metrics(scores).join(timing, ["config_id", "fold"]), scores


def summarize_search(metrics: DataFrame, configs: DataFrame | None = None) -> DataFrame:
    """Per configuration: spread of average precision over folds and mean rates; the best comes first."""
    aggregates = [
        F.avg("pr_auc").alias("mean_pr_auc"),
        F.coalesce(F.stddev_samp("pr_auc"), F.lit(0.0)).alias("std_pr_auc"),
        F.min("pr_auc").alias("min_pr_auc"),
        F.max("pr_auc").alias("max_pr_auc"),
        F.avg("roc_auc").alias("mean_roc_auc"),
        F.avg("recall").alias("mean_recall"),
        F.avg("precision").alias("mean_precision"),
        F.avg("f1").alias("mean_f1"),
    ]
    if "fit_seconds" in metrics.columns:
        aggregates.append(F.sum("fit_seconds").alias("total_fit_seconds"))
    summary = metrics.groupBy("config_id", "model_family").agg(*aggregates)
    if configs is not None:
        summary = summary.join(configs.select("config_id", "params"), "config_id", "left")
    return summary.orderBy(F.desc("mean_pr_auc"), F.asc("std_pr_auc"), "config_id")


def best_config(summary: DataFrame) -> DataFrame:
    """Highest mean average precision; the steadier configuration on ties, then the first id."""
    return summary.orderBy(F.desc("mean_pr_auc"), F.asc("std_pr_auc"), "config_id").limit(1)


def family_summary(summary: DataFrame) -> DataFrame:
    """Best and median score by model family; a family has as many rows as its grid has points."""
    return summary.groupBy("model_family").agg(
        F.max("mean_pr_auc").alias("best_mean_pr_auc"),
        F.percentile("mean_pr_auc", 0.5).alias("median_mean_pr_auc"),
        F.max("min_pr_auc").alias("best_min_fold_pr_auc"),
        F.count("config_id").alias("configurations"),
    )


def refit_best(development: DataFrame, config: ModelConfig) -> Model:
    return fit_model(development, config)


_TREES = "trees"


def save_model(model: Model, path: str) -> str:
    if isinstance(model, TreeModel):
        model.save(SparkSession.active(), f"{path}/{_TREES}")
    else:
        model.write().overwrite().save(path)
    return path


def load_model(path: str, probe: DataFrame | None = None) -> Model:
    """Reload a model; with ``probe`` rows, refuse it unless every score is finite and within [0, 1]."""
    try:
        model = TreeModel.load(SparkSession.active(), f"{path}/{_TREES}")
    except AnalysisException:  # no such folder: a pipeline
        model = PipelineModel.load(path)
    if probe is not None:
        s = F.col(SCORE)
        bad = score_rows(model, probe).filter(~F.coalesce(s.between(0.0, 1.0), F.lit(False))).limit(1).count()
        if bad:
            raise ContractError("the reloaded model gives scores outside [0, 1]")
    return model

"""Batch scoring: input contract, score bands, review policy and the deployment record."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from parcelcast.contracts import (
    CATEGORICAL_FEATURES, ContractError, FIELD_RULES, MODEL_FEATURES, NUMERIC_FEATURES, ORDER_KEY, PREDICTION_TS,
    TARGET, require_columns,
)
from parcelcast.functions.expressions import as_column, present, upper_closed_band
from parcelcast.operators.evaluation import F1_RULE, RECALL_RULE, SCORE
from parcelcast.operators.ordering import exact_quantiles, global_rank, with_scalar

BANDS = ("low", "medium", "high", "critical")
SCORE_QUANTILES = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q80": 0.8, "q90": 0.9, "q95": 0.95, "q99": 0.99}


def _field_faults() -> list[Column]:
    faults = []
    for rule in FIELD_RULES:
        x = F.col(rule.name)
        if rule.required:
            faults.append(F.when(x.isNull(), F.lit(f"{rule.name}: required")))
        if rule.whole:
            number = x.cast("double")
            faults.append(F.when(F.isnan(number) | (number != F.floor(number)), F.lit(f"{rule.name}: not whole")))
        if rule.low is not None:
            # NaN is above every number here, so it is asked for by name
            faults.append(F.when(F.isnan(x.cast("double")) | (x < rule.low), F.lit(f"{rule.name}: below {rule.low}")))
        if rule.high is not None:
            faults.append(F.when(F.isnan(x.cast("double")) | (x > rule.high), F.lit(f"{rule.name}: above {rule.high}")))
        if rule.min_length is not None:
            faults.append(F.when(F.length(x) < rule.min_length, F.lit(f"{rule.name}: too short")))
        if rule.max_length is not None:
            faults.append(F.when(F.length(x) > rule.max_length, F.lit(f"{rule.name}: too long")))
    return faults


def contract_validation(rows: DataFrame, passthrough: Sequence[str] = (ORDER_KEY, PREDICTION_TS)) -> DataFrame:
    """Rows with the list of broken field rules; an unknown column rejects the whole table."""
    require_columns(rows, MODEL_FEATURES, "scoring input")
    unknown = sorted(set(rows.columns) - set(MODEL_FEATURES) - set(passthrough))
    if unknown:
        raise ContractError(f"unknown columns in scoring input: {unknown}")
    return rows.withColumn("faults", F.array_compact(F.array(*_field_faults())))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the fault list, and the quarantined ones with it."""
    return checked.filter(F.size("faults") == 0).drop("faults"), checked.filter(F.size("faults") > 0)


def normalize_categories(rows: DataFrame) -> DataFrame:
    """Trimmed, upper-case state; trimmed texts with blanks as NULL.  Runs after the contract check."""
    texts = {c: F.nullif(F.trim(c), F.lit("")) for c in CATEGORICAL_FEATURES if c != "customer_state"}
    return rows.withColumns({"customer_state": F.upper(F.trim("customer_state")), **texts})


def risk_band(score: Column | str, low_max: float, medium_max: float, high_max: float) -> Column:
    """low <= low_max < medium <= medium_max < high <= high_max < critical."""
    return upper_closed_band(score, [low_max, medium_max, high_max], BANDS)


def action_threshold(configured: float, override: float | None = None) -> float:
    threshold = float(configured if override is None else override)
    if not 0 <= threshold <= 1:
        raise ContractError("the action threshold must lie in [0, 1]")
    return threshold


def review_flag(score: Column | str, threshold: float) -> Column:
    return as_column(score) >= F.lit(float(threshold))


def with_policy(scored: DataFrame, bands: dict[str, float], threshold: float, score: str = SCORE) -> DataFrame:
    return scored.withColumns({
        "risk_band": risk_band(score, bands["low_max"], bands["medium_max"], bands["high_max"]),
        "requires_review": review_flag(score, threshold),
    })


def batch_score(
    rows: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    bands: dict[str, float],
    threshold: float,
    model_version: str,
) -> tuple[DataFrame, DataFrame]:
    """Check, normalise, score and apply the policy; returns (scored, quarantined).

    ``scorer`` adds the ``probability`` column: a fitted pipeline's ``transform`` or a vectorised function.
    """
    valid, quarantined = split_valid(contract_validation(rows))
    scored = with_policy(scorer(normalize_categories(valid)), bands, action_threshold(threshold))
    return scored.select(
        ORDER_KEY, PREDICTION_TS, F.col(SCORE).alias("risk_score"), "risk_band", "requires_review",
        F.lit(float(threshold)).alias("action_threshold"), F.lit(False).alias("calibrated_probability"),
        F.lit(model_version).alias("model_version"),
    ), quarantined


def score_quantiles(scored: DataFrame, score: str = SCORE) -> DataFrame:
    """One row of score quantiles; texts that are no numbers are left out."""
    return exact_quantiles(scored.select(F.col(score).try_cast("double").alias("s")), [], "s", SCORE_QUANTILES)


def band_thresholds(scored: DataFrame, score: str = SCORE) -> DataFrame:
    """Quantiles with the three band limits; an empty score set is an error when the row is computed."""
    q = score_quantiles(scored, score)
    checked = F.when(F.col("q50").isNull(), F.raise_error(F.lit("no valid scores"))).otherwise(F.col("q50"))
    return q.select(
        *SCORE_QUANTILES, checked.alias("low_max"), F.col("q80").alias("medium_max"), F.col("q95").alias("high_max")
    )


def choose_threshold(rules: DataFrame) -> DataFrame:
    """The recall rule if present, else the F1 rule, else an error (the rule table has a row per rule)."""
    preferred, fallback = RECALL_RULE.format(0.50), F1_RULE
    known = rules.filter(F.col("threshold_rule").isin(preferred, fallback))
    priority = F.when(F.col("threshold_rule") == preferred, F.lit(0)).otherwise(F.lit(1))
    best = F.min_by(F.struct("threshold_rule", "threshold"), priority)
    checked = F.when(best.isNull(), F.raise_error(F.lit("no supported operating threshold"))).otherwise(best)
    return known.agg(checked.alias("r")).select(
        F.col("r.threshold_rule").alias("action_threshold_rule"), F.col("r.threshold").alias("action_threshold")
    )


def monitoring_reference(scored: DataFrame, label: str = TARGET, score: str = SCORE) -> DataFrame:
    """Rows, prevalence and score distribution that live traffic is compared with."""
    s = F.col(score).try_cast("double")
    basics = scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(label).alias("prevalence"),
        F.avg(F.when(present(s), s)).alias("score_mean"),
        F.stddev_samp(F.when(present(s), s)).alias("score_std"),
    )
    return with_scalar(basics, "_q", score_quantiles(scored, score)).select(*basics.columns, "_q.*")


def deployment_config(
    scored: DataFrame, rules: DataFrame, candidate: str, family: str, fingerprint: str
) -> DataFrame:
    """The nested deployment record as one row."""
    limits = band_thresholds(scored).select("low_max", "medium_max", "high_max")
    chosen = choose_threshold(rules)
    record = with_scalar(with_scalar(monitoring_reference(scored), "bands", limits), "chosen", chosen)
    return record.select(
        F.struct(
            F.lit(candidate).alias("candidate"), F.lit(family).alias("family"), F.lit(fingerprint).alias("sha256"),
            F.lit(len(MODEL_FEATURES)).alias("feature_count"),
        ).alias("model"),
        F.struct(
            F.lit(False).alias("calibrated_probability"),
            "bands",
            "chosen.action_threshold",
            "chosen.action_threshold_rule",
        ).alias("risk_score"),
        F.struct(
            "rows", "prevalence", "score_mean", "score_std", F.struct(*SCORE_QUANTILES).alias("score_quantiles")
        ).alias("monitoring_reference"),
    )


def missing_cells(columns: Sequence[str] = tuple(MODEL_FEATURES)) -> Column:
    """Number of missing feature cells of a row."""
    return F.size(F.filter(F.array(*[F.col(c).isNull() for c in columns]), lambda m: m))


def missing_feature_count(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(missing_cells()), F.lit(0)).cast("bigint").alias("missing_feature_values"),
    )


def model_version(candidate: str, fingerprint: str) -> str:
    return f"{candidate}:{fingerprint[:12]}"


def response_ids(rows: DataFrame, request_id: str, order: Sequence[Column | str], version: str) -> DataFrame:
    """Rows with ``request:index`` ids counted from 0 in the given order."""
    ranked = global_rank(rows, order, "_rank")
    return ranked.select(
        *rows.columns,
        F.concat_ws(":", F.lit(request_id), (F.col("_rank") - F.lit(1)).cast("string")).alias("response_id"),
        F.lit(version).alias("model_version"),
    )


def payload_schema() -> T.StructType:
    fields = [T.StructField(c, T.DoubleType()) for c in NUMERIC_FEATURES]
    fields += [T.StructField(c, T.StringType()) for c in CATEGORICAL_FEATURES]
    return T.StructType([
        T.StructField("order_id", T.StringType()),
        T.StructField("prediction_timestamp", T.StringType()),
        T.StructField("features", T.StructType(fields)),
    ])


def pack_payload(rows: DataFrame) -> DataFrame:
    """Each feature row as a nested request document; missing values are written as null."""
    features = F.struct(*[F.col(c).cast("double").alias(c) for c in NUMERIC_FEATURES], *CATEGORICAL_FEATURES)
    document = F.struct(
        F.col(ORDER_KEY).cast("string").alias("order_id"),
        F.date_format(PREDICTION_TS, "yyyy-MM-dd'T'HH:mm:ss").alias("prediction_timestamp"),
        features.alias("features"),
    )
    return rows.select(ORDER_KEY, F.to_json(document, {"ignoreNullFields": "false"}).alias("payload"))


def unpack_payload(documents: DataFrame) -> DataFrame:
    parsed = documents.select(F.from_json("payload", payload_schema()).alias("p"))
    return parsed.select(
        F.col("p.order_id").alias("order_id"),
        F.to_timestamp("p.prediction_timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias(PREDICTION_TS),
        "p.features.*",
    )

"""Registered queries, one or more for each operator, over the stand-in tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from parcelcast import contracts as K
from parcelcast.functions.expressions import haversine_km, safe_divide
from parcelcast.operators import (
    cleaning, drift, eda, evaluation, features, importance, monitoring, preprocessing, profiling, scoring, splits,
    training,
)
from parcelcast.plans import jobs
from parcelcast.session import materialize, scratch_path
from parcelcast.sources import files, standins
from parcelcast.streaming import telemetry

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEYS = {
    "orders_raw": ["order_id"], "order_items": ["order_id", "order_item_id"],
    "payments": ["order_id", "payment_sequential"], "products": ["product_id"],
    "category_translation": ["product_category_name"], "customers": ["customer_id"], "sellers": ["seller_id"],
    "geolocation": ["geolocation_zip_code_prefix"], "reviews": ["review_id"],
}
RELATIONS = [
    ("orders_raw", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders_raw", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("payments", "order_id", "orders_raw", "order_id"),
    ("reviews", "order_id", "orders_raw", "order_id"),
]
PRODUCT_NUMBERS = ["product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
                   "product_width_cm"]
DESCRIBED = ["promised_delivery_days", "item_count", "freight_ratio", "total_price", "max_installments",
             "payment_value", "mean_product_weight_g", "total_product_volume_cm3", "category_count", "seller_count",
             "mean_distance_km"]
BOXED = ["promised_delivery_days", "freight_ratio", "mean_distance_km"]
IMPUTED = ["item_count", "payment_value", "mean_product_weight_g", "mean_distance_km"]
PAYMENT_TYPES = ["boleto", "credit_card", "voucher"]
BAND_LIMITS = {"low_max": 0.20, "medium_max": 0.40, "high_max": 0.60}
ACTION_THRESHOLD = 0.50
LINEAR_WEIGHTS = {"promised_delivery_days": -0.05, "approval_lag_hours": 0.01, "freight_ratio": 2.0,
                  "item_count": 0.1, "mean_distance_km": 0.0005}
# (config id, family, multiplier, modulus, lift of late orders) of the stand-in search scores
SCORE_VARIANTS = [
    ("logistic_regression_01", "logistic_regression", 7919, 800, 200),
    ("logistic_regression_02", "logistic_regression", 7907, 850, 150),
    ("xgboost_01", "xgboost", 7901, 700, 300),
    ("xgboost_02", "xgboost", 7883, 750, 250),
]
EXPECTED_FILES = ["customer.parquet", "events.parquet", "lineitem.parquet", "orders.parquet", "part.parquet",
                  "supplier.parquet"]

# Tables several queries start from, written once per session and data folder.
_SHARED: dict[tuple[str, str, str], DataFrame] = {}


def _shared(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _SHARED:
        _SHARED[key] = build()
    return _SHARED[key]


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison, timestamps without a zone.

    Rounding to 12 digits first removes the last-bit noise that would tip an exact decimal tie either way.
    """
    def column(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(F.round(c.cast("double"), 12), digits)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        return c.alias(f.name)

    return df.select(*[column(f) for f in df.schema.fields])


def query(name: str) -> Callable[[Callable[["Data"], DataFrame]], Callable]:
    def register(build: Callable[["Data"], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return tidy(build(Data(spark, sf_dir)))

        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        return build

    return register


class Data:
    """The tables a query reads."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in standins.VIEWS:
            return standins.view(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    @property
    def raw(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in standins.RAW_TABLES}

    @property
    def cleaned(self) -> DataFrame:
        return jobs.cleaned_orders(self.spark, self.sf_dir)

    @property
    def split(self) -> DataFrame:
        """Feature table with positions and splits."""
        return _shared(self.spark, self.sf_dir, "split", lambda: materialize(
            jobs.split_features(self.spark, self.sf_dir)))

    @property
    def features(self) -> DataFrame:
        return self.split.drop("row_num", "split")

    def part(self, name: str) -> DataFrame:
        return self.split.filter(F.col("split") == name)

    @property
    def lookup(self) -> DataFrame:
        return features.geo_lookup(self.geolocation)

    @property
    def scored(self) -> DataFrame:
        score = F.expr("CAST(((order_id*7919) % 800 + 200*late_delivery)/1000.0 AS DOUBLE)")
        return self.cleaned.select(
            "order_id", F.col("order_approved_at").alias(K.PREDICTION_TS), K.TARGET, score.alias("probability")
        )

    @property
    def scored_features(self) -> DataFrame:
        score = F.expr("CAST(((order_id*7919) % 800 + 200*late_delivery)/1000.0 AS DOUBLE)")
        return self.features.withColumn("probability", score)

    @property
    def ranked(self) -> DataFrame:
        """Cleaned orders in chronological positions."""
        return _shared(self.spark, self.sf_dir, "ranked", lambda: splits.chronological_order(
            self.scored.select("order_id", K.PREDICTION_TS, K.TARGET)))

    @property
    def folds(self) -> list[splits.Fold]:
        return splits.fold_bounds(self.ranked.count())

    @property
    def fold_scores(self) -> DataFrame:
        """Out-of-fold rows of the stand-in configurations."""
        members = splits.expanding_folds(self.ranked, self.folds).filter(F.col("role") == "validation")
        variants = F.array(*[
            F.struct(
                F.lit(config).alias("config_id"), F.lit(family).alias("model_family"),
                F.expr(f"CAST(((order_id*{a}) % {b} + {c}*late_delivery)/1000.0 AS DOUBLE)").alias("probability"),
            )
            for config, family, a, b, c in SCORE_VARIANTS
        ])
        return members.select(K.TARGET, "fold", F.explode(variants).alias("v")).select(K.TARGET, "fold", "v.*")

    @property
    def fold_metrics(self) -> DataFrame:
        return training.fold_metrics(self.fold_scores)

    @property
    def log(self) -> DataFrame:
        return with_log_policy(standins.prediction_log(self.spark, self.sf_dir))


def with_log_policy(log: DataFrame) -> DataFrame:
    return scoring.with_policy(log, BAND_LIMITS, ACTION_THRESHOLD, "score")


# --- sources and sinks ---------------------------------------------------------------------------------------


@query("scan_csv")
def _(d: Data):
    path = files.write_csv(d.order_items, scratch_path(d.spark, "csv"))
    items = files.read_csv(d.spark, path, K.TEXT_SCHEMAS["order_items"])
    return items.groupBy("order_item_id").agg(
        F.count(F.lit(1)).alias("items"), F.countDistinct("order_id").alias("orders"),
        F.min("price").alias("min_price"), F.max("price").alias("max_price"), F.avg("freight_value").alias("mean_freight"),
        F.max("shipping_limit_date").alias("last_limit"),
    )


@query("scan_parquet")
def _(d: Data):
    return files.read_parquet(d.spark, f"{d.sf_dir}/orders.parquet", ["o_orderkey", "o_totalprice", "o_orderdate"])


@query("sink_parquet")
def _(d: Data):
    path = files.write_parquet(d.split.drop("row_num"), scratch_path(d.spark, "features"), ["split"])
    back = files.read_parquet(d.spark, path)
    return back.select("order_id", K.PREDICTION_TS, "total_price", "customer_state", K.TARGET, F.col("split").cast("string"))


@query("sink_csv_report")
def _(d: Data):
    path = files.write_report_csv(splits.split_summary(d.split), scratch_path(d.spark, "report"))
    schema = T.StructType([
        T.StructField("split", T.StringType()), T.StructField("rows", T.LongType()),
        T.StructField("start", T.TimestampType()), T.StructField("end", T.TimestampType()),
        T.StructField("late_rate", T.DoubleType()),
    ])
    return files.read_csv(d.spark, path, schema)


@query("json_metadata")
def _(d: Data):
    reference = scoring.monitoring_reference(d.scored)
    record = reference.select(
        F.lit("stand_in_01").alias("candidate"), F.struct("rows", "prevalence").alias("population"),
        F.struct(F.col("q50").alias("low_max"), F.col("q80").alias("medium_max"), F.col("q95").alias("high_max")).alias("bands"),
    )
    path = files.write_metadata(record, scratch_path(d.spark, "metadata"))
    return files.read_metadata(d.spark, path, record.schema).select("candidate", "population.*", "bands.*")


@query("require_columns")
def _(d: Data):
    checked = K.require_columns(d.features, [K.ORDER_KEY, K.PREDICTION_TS, K.TARGET, *K.MODEL_FEATURES], "features")
    return checked.agg(F.count(F.lit(1)).alias("rows"))


def _tree(d: Data):
    config = next(c for c in training.model_registry() if c.config_id == "decision_tree")
    return training.fit_model(d.part("train"), config)


@query("model_save_load")
def _(d: Data):
    path = training.save_model(_tree(d), scratch_path(d.spark, "model"))
    model = training.load_model(path, d.part("validation"))
    return training.score_rows(model, d.part("validation")).select("order_id", "probability")


@query("artifact_fingerprint")
def _(d: Data):
    return files.artifact_fingerprint(d.spark, training.save_model(_tree(d), scratch_path(d.spark, "model")))


@query("glob_inventory")
def _(d: Data):
    return files.require_files(d.spark, d.sf_dir, EXPECTED_FILES, "*.parquet").select("file", "bytes")


# --- profiling -----------------------------------------------------------------------------------------------


@query("dataset_overview")
def _(d: Data):
    return profiling.dataset_overview(d.raw)


@query("schema_report")
def _(d: Data):
    return profiling.schema_report(d.raw)


@query("missing_report")
def _(d: Data):
    return profiling.missing_report(d.orders_raw)


@query("missing_report_features")
def _(d: Data):
    return profiling.missing_report(d.features, K.MODEL_FEATURES, keep_zero=True)


@query("duplicate_report")
def _(d: Data):
    return profiling.duplicate_report(d.raw)


@query("key_check")
def _(d: Data):
    return profiling.key_checks(d.raw, KEYS)


@query("foreign_key_check")
def _(d: Data):
    return profiling.foreign_key_checks(d.raw, RELATIONS)


@query("customer_identity")
def _(d: Data):
    return profiling.customer_identity(d.customers)


@query("records_per_entity")
def _(d: Data):
    return profiling.records_per_entity_summary({
        "order_items": (d.order_items, "order_id"), "payments": (d.payments, "order_id"),
        "reviews": (d.reviews, "order_id"), "geolocation": (d.geolocation, "geolocation_zip_code_prefix"),
    })


@query("records_per_entity_top")
def _(d: Data):
    return profiling.top_entities(d.order_items, "order_id")


@query("numeric_describe")
def _(d: Data):
    return profiling.numeric_describe(d.products, PRODUCT_NUMBERS)


@query("numeric_describe_items")
def _(d: Data):
    return profiling.numeric_describe(d.order_items, ["price", "freight_value"])


@query("numeric_sanity")
def _(d: Data):
    return profiling.numeric_sanity(d.products, PRODUCT_NUMBERS).unionByName(
        profiling.numeric_sanity(d.order_items, ["price", "freight_value"])
    )


@query("value_counts")
def _(d: Data):
    return profiling.value_counts(d.products, "product_category_name")


@query("parse_timestamps")
def _(d: Data):
    texts = d.orders_raw.select(
        "order_id",
        *[F.when(F.col("order_id") % 5 == 0, F.lit("n/a")).otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss")).alias(c)
          for c in K.ORDER_TIMESTAMPS],
    )
    return profiling.parse_timestamps(texts, K.ORDER_TIMESTAMPS)


@query("date_ranges")
def _(d: Data):
    return profiling.date_ranges(d.orders_raw)


@query("lifecycle_checks")
def _(d: Data):
    return profiling.lifecycle_checks(d.orders_raw)


@query("lifecycle_offenders")
def _(d: Data):
    return profiling.lifecycle_offenders(d.orders_raw)


@query("availability_by_status")
def _(d: Data):
    return profiling.availability_by_status(d.orders_raw)


@query("target_feasibility")
def _(d: Data):
    return profiling.target_feasibility(d.orders_raw)


@query("geo_variation")
def _(d: Data):
    return profiling.geo_variation(d.geolocation)


@query("registries")
def _(d: Data):
    return profiling.availability_profile([d.orders_raw, d.reviews]).drop("reason")


@query("join_strategy")
def _(d: Data):
    return profiling.join_strategy_profile(d.raw)


@query("cleaning_rules")
def _(d: Data):
    return profiling.cleaning_rule_impact(d.orders_raw)


@query("key_set_overlap")
def _(d: Data):
    late = d.orders_raw.filter("order_delivered_customer_date IS NULL")
    unapproved = d.orders_raw.filter("order_approved_at IS NULL")
    return profiling.key_set_overlap(late, unapproved, "order_id")


@query("seeded_sample")
def _(d: Data):
    return profiling.seeded_sample(d.orders_raw, 10, "order_id")


# --- cleaning and target -------------------------------------------------------------------------------------


@query("status_filters")
def _(d: Data):
    return cleaning.status_cohorts(d.orders_raw).select("cohort", "order_id")


@query("invalid_promise")
def _(d: Data):
    return cleaning.invalid_promise(d.orders_raw)


@query("eligible_orders")
def _(d: Data):
    return cleaning.eligible_orders(d.orders_raw)


@query("eligibility_flags")
def _(d: Data):
    return cleaning.with_eligibility(d.orders_raw).select("order_id", *cleaning.eligibility_rules(), "eligible")


@query("population_funnel")
def _(d: Data):
    return cleaning.population_funnel(d.orders_raw)


@query("late_label")
def _(d: Data):
    return cleaning.with_target(cleaning.eligible_orders(d.orders_raw)).select("order_id", K.TARGET)


@query("delay_days")
def _(d: Data):
    return cleaning.with_delay(cleaning.eligible_orders(d.orders_raw)).select("order_id", "delivery_delay_days")


@query("target_distribution")
def _(d: Data):
    return cleaning.target_distribution(d.cleaned)


@query("anomaly_detail")
def _(d: Data):
    return cleaning.anomaly_rows(d.cleaned)


@query("anomaly_summary")
def _(d: Data):
    return cleaning.anomaly_summary(d.cleaned)


@query("anomaly_top")
def _(d: Data):
    return cleaning.largest_anomalies(d.cleaned, "carrier_before_approval")


@query("invariant_check")
def _(d: Data):
    return cleaning.invariant_check(d.cleaned)


@query("clean_orders_job")
def _(d: Data):
    return d.cleaned


# --- features ------------------------------------------------------------------------------------------------


@query("safe_divide")
def _(d: Data):
    return d.order_items.select(
        "order_id", "order_item_id", safe_divide("price", "freight_value").alias("price_per_freight")
    )


@query("haversine_km")
def _(d: Data):
    origin = (F.lit(-23.5), F.lit(-46.6))
    return d.geolocation.select(
        "geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
        haversine_km("geolocation_lat", "geolocation_lng", *origin).alias("km"),
    )


@query("geo_lookup")
def _(d: Data):
    return d.lookup


@query("geo_lookup_raw")
def _(d: Data):
    return features.geo_lookup_raw(d.geolocation)


@query("order_item_features")
def _(d: Data):
    return features.order_item_features(d.order_items)


@query("payment_features")
def _(d: Data):
    return features.payment_features(d.payments)


@query("primary_payment")
def _(d: Data):
    return features.primary_payment(d.payments)


@query("order_payment_features")
def _(d: Data):
    return features.order_payment_features(d.payments)


@query("product_enrichment")
def _(d: Data):
    return features.product_enrichment(d.order_items, d.products, d.category_translation)


@query("order_product_features")
def _(d: Data):
    return features.order_product_features(d.order_items, d.products, d.category_translation)


@query("dominant_category")
def _(d: Data):
    return features.dominant_category(d.order_items, d.products, d.category_translation)


@query("dominant_category_eda")
def _(d: Data):
    return features.dominant_category_eda(d.order_items, d.products, d.category_translation)


@query("customer_geo")
def _(d: Data):
    return features.order_customer(d.cleaned, d.customers, d.lookup)


@query("seller_geo")
def _(d: Data):
    return features.seller_geo(d.sellers, d.lookup)


@query("order_seller_distance")
def _(d: Data):
    return features.order_seller_distance(d.order_items, d.cleaned, d.customers, d.sellers, d.lookup)


@query("distance_features")
def _(d: Data):
    return features.distance_features(d.order_items, d.cleaned, d.customers, d.sellers, d.lookup)


@query("calendar_features")
def _(d: Data):
    derived = features.calendar_features(F.col("order_purchase_timestamp"))
    return d.orders_raw.select("order_id", *[c.alias(n) for n, c in derived.items()])


@query("lag_features")
def _(d: Data):
    return d.orders_raw.select("order_id", *[c.alias(n) for n, c in features.lag_features().items()])


@query("order_base")
def _(d: Data):
    return features.order_base(d.cleaned)


@query("validated_join")
def _(d: Data):
    return features.validated_join(
        d.cleaned.select("order_id", "customer_id"), d.customers.select("customer_id", "customer_state"), ["customer_id"]
    )


def _numbers_as_doubles(table: DataFrame) -> DataFrame:
    """Counts that an outer join may leave empty, as doubles like all other numeric features."""
    return table.withColumns({c: F.col(c).cast("double") for c in K.NUMERIC_FEATURES})


@query("feature_table")
def _(d: Data):
    return _numbers_as_doubles(jobs.build_features(d.spark, d.sf_dir))


@query("validate_features")
def _(d: Data):
    return features.validate_features(d.features, d.cleaned.count())


@query("leakage_audit")
def _(d: Data):
    return features.leakage_audit(d.cleaned)


@query("feature_contract")
def _(d: Data):
    return features.feature_coverage(d.features)


@query("model_matrix")
def _(d: Data):
    return _numbers_as_doubles(features.model_matrix(d.features))


@query("features_job")
def _(d: Data):
    path = scratch_path(d.spark, "features")
    jobs.features_job(d.spark, d.sf_dir, path)
    return splits.split_summary(files.read_parquet(d.spark, path))


# --- exploratory reports -------------------------------------------------------------------------------------


@query("monthly_late_rate")
def _(d: Data):
    return eda.monthly_late_rate(d.cleaned)


@query("weekday_late_rate")
def _(d: Data):
    return eda.weekday_late_rate(d.cleaned)


@query("hourly_late_rate")
def _(d: Data):
    return eda.hourly_late_rate(d.cleaned)


@query("state_late_rate")
def _(d: Data):
    return eda.state_late_rate(d.cleaned, d.customers)


@query("state_late_rate_reliable")
def _(d: Data):
    return eda.state_late_rate(d.cleaned, d.customers, minimum_orders=100)


def _with_items(d: Data) -> DataFrame:
    return d.cleaned.select("order_id", K.TARGET).join(features.order_item_features(d.order_items), "order_id", "left")


@query("item_count_late_rate")
def _(d: Data):
    return eda.item_count_late_rate(_with_items(d))


@query("seller_count_late_rate")
def _(d: Data):
    return eda.seller_count_late_rate(_with_items(d))


@query("payment_type_late_rate")
def _(d: Data):
    return eda.payment_type_late_rate(
        d.cleaned.select("order_id", K.TARGET).join(features.primary_payment(d.payments), "order_id", "left")
    )


@query("category_late_rate")
def _(d: Data):
    dominant = features.dominant_category_eda(d.order_items, d.products, d.category_translation)
    return eda.category_late_rate(d.cleaned, dominant)


@query("same_state_late_rate")
def _(d: Data):
    distances = features.distance_features(d.order_items, d.cleaned, d.customers, d.sellers, d.lookup)
    return eda.same_state_late_rate(d.cleaned.select("order_id", K.TARGET).join(distances, "order_id", "left"))


@query("describe_by_target")
def _(d: Data):
    return eda.describe_by_target(d.features, DESCRIBED)


@query("numeric_signal_summary")
def _(d: Data):
    return eda.numeric_signal_summary(d.features)


@query("delay_histogram")
def _(d: Data):
    return eda.histogram(d.cleaned, "delivery_delay_days", 100)


@query("delay_histogram_zoom")
def _(d: Data):
    return eda.histogram(d.cleaned, "delivery_delay_days", 80, -40, 40)


@query("boxplot_stats")
def _(d: Data):
    return eda.boxplot_stats(d.features, BOXED)


# --- order, splits, folds ------------------------------------------------------------------------------------


@query("chronological_order")
def _(d: Data):
    return splits.chronological_order(d.scored.select("order_id", K.PREDICTION_TS, K.TARGET))


@query("chronological_split")
def _(d: Data):
    return splits.chronological_split(d.scored.select("order_id", K.PREDICTION_TS, K.TARGET))


@query("split_summary")
def _(d: Data):
    return splits.split_summary(d.split)


@query("split_invariants")
def _(d: Data):
    return splits.split_invariants(d.split)


@query("development_union")
def _(d: Data):
    views = splits.split_views(d.split.select("order_id", K.PREDICTION_TS, K.TARGET, "row_num", "split"))
    return splits.development_union(views["train"], views["validation"])


@query("expanding_folds")
def _(d: Data):
    return splits.expanding_folds(d.ranked, d.folds).select("order_id", "row_num", "fold", "role")


@query("fold_summary")
def _(d: Data):
    return splits.fold_summary(d.ranked, d.folds)


@query("top_n")
def _(d: Data):
    return splits.top_n(d.scored, [F.desc("probability"), F.asc("order_id")], 12)


@query("family_summary")
def _(d: Data):
    return training.family_summary(training.summarize_search(d.fold_metrics))


# --- preprocessing and training ------------------------------------------------------------------------------


@query("median_impute")
def _(d: Data):
    fit = preprocessing.fit_numeric(d.part("train"), IMPUTED)
    return preprocessing.median_impute(d.features, fit).select("order_id", *fit.outputs)


@query("standard_scale")
def _(d: Data):
    fit = preprocessing.fit_numeric(d.part("train"), IMPUTED)
    return preprocessing.standard_scale(d.features, fit).select("order_id", *fit.outputs)


@query("mode_impute")
def _(d: Data):
    modes = preprocessing.fit_modes(d.part("train"))
    return preprocessing.mode_impute(d.features, modes).select("order_id", *modes)


@query("one_hot")
def _(d: Data):
    train, column = d.part("train"), "primary_payment_type"
    modes = preprocessing.fit_modes(train, [column])
    known = preprocessing.fit_categories(train, column, modes)
    wide = preprocessing.one_hot_wide(preprocessing.mode_impute(d.features, modes), column, known)
    return wide.select("order_id", *[f"{column}_{v}" for v in known])


@query("preprocessor")
def _(d: Data):
    vectors = preprocessing.build_preprocessor(d.part("train")).transform(d.part("test"))
    entries = vector_to_array("features")
    return vectors.select(
        "order_id", F.size(entries).alias("entries"),
        F.aggregate(entries, F.lit(0.0), lambda a, x: a + F.abs(x)).alias("absolute_sum"),
    )


@query("dummy_prior")
def _(d: Data):
    return training.dummy_prior(d.part("train"), d.part("test")).select("order_id", "probability")


def _model_scores(d: Data, config: training.ModelConfig) -> DataFrame:
    _, scored, _ = training.fit_and_score(d.part("train"), d.part("validation"), config)
    return scored.select("order_id", K.TARGET, "probability")


def _baseline(name: str) -> training.ModelConfig:
    return next(c for c in training.model_registry() if c.config_id == name)


@query("logistic_regression")
def _(d: Data):
    return _model_scores(d, _baseline("logistic_regression"))


@query("decision_tree")
def _(d: Data):
    return _model_scores(d, _baseline("decision_tree"))


@query("random_forest")
def _(d: Data):
    return _model_scores(d, _baseline("random_forest"))


@query("gradient_boosting")
def _(d: Data):
    return _model_scores(d, _baseline("hist_gradient_boosting"))


@query("boosted_trees")
def _(d: Data):
    return _model_scores(d, next(c for c in training.search_configs(quick=True) if c.family == "xgboost"))


@query("class_weights")
def _(d: Data):
    members = splits.expanding_folds(d.ranked, d.folds).filter(F.col("role") == "train")
    return preprocessing.class_weight_table(members, ["fold"])


@query("param_grid")
def _(d: Data):
    return training.resolved_configs(d.ranked, d.folds, training.search_configs())


@query("registry_tables")
def _(d: Data):
    weights = preprocessing.class_weight_table(d.part("train"), []).select(F.struct("*").alias("w")).scalar()
    return training.registry_table(d.spark).select(
        "model", "family", weights["rows"].alias("train_rows"), weights["balanced_1"].alias("late_weight")
    )


def _search(d: Data) -> DataFrame:
    """Fold metrics of the whole grid at full size."""
    def build() -> DataFrame:
        development = d.split.filter(F.col("split") != "test")
        return materialize(training.run_search(development, splits.fold_bounds(development.count()), training.search_configs())[0])

    return _shared(d.spark, d.sf_dir, "search", build)


@query("train_compare")
def _(d: Data):
    return training.train_compare(d.part("train"), d.part("validation"), training.model_registry())[0]


@query("select_best")
def _(d: Data):
    return training.select_best(training.summarize_search(d.fold_metrics), "mean_pr_auc", "config_id")


@query("fold_metrics")
def _(d: Data):
    return d.fold_metrics


@query("cross_validate")
def _(d: Data):
    development = d.split.filter(F.col("split") != "test")
    folds = splits.fold_bounds(development.count())
    config = training.search_configs(quick=True)[0]
    return training.cross_validate(development, folds, config)[1]


@query("summarize_search")
def _(d: Data):
    return training.summarize_search(d.fold_metrics)


@query("run_search")
def _(d: Data):
    return _search(d)


@query("refit_best")
def _(d: Data):
    best = training.best_config(training.summarize_search(_search(d))).first()["config_id"]
    config = next(c for c in training.search_configs() if c.config_id == best)
    model = training.refit_best(d.split.filter(F.col("split") != "test"), config)
    return training.score_rows(model, d.part("test")).select("order_id", "probability")


@query("positive_probability")
def _(d: Data):
    scored = _tree(d).transform(d.part("test"))
    return scored.select("order_id", training.positive_probability(scored).alias("probability"))


# --- evaluation ----------------------------------------------------------------------------------------------


@query("ranking_metrics")
def _(d: Data):
    return evaluation.ranking_metrics(d.scored)


@query("classification_metrics")
def _(d: Data):
    return evaluation.classification_metrics(d.scored)


@query("confusion_matrix")
def _(d: Data):
    return evaluation.confusion_matrix(d.scored)


@query("pr_curve")
def _(d: Data):
    return evaluation.pr_curve(d.scored)


@query("roc_curve")
def _(d: Data):
    return evaluation.roc_curve(d.scored)


@query("best_f1_threshold")
def _(d: Data):
    return evaluation.best_f1_threshold(d.scored)


@query("min_recall_threshold")
def _(d: Data):
    return evaluation.min_recall_threshold(d.scored)


@query("threshold_table")
def _(d: Data):
    return evaluation.threshold_table(d.scored)


@query("threshold_metrics")
def _(d: Data):
    return evaluation.threshold_metrics(d.scored, 0.35)


@query("threshold_sweep")
def _(d: Data):
    return evaluation.threshold_sweep(d.scored)


@query("calibration_table")
def _(d: Data):
    return evaluation.calibration_table(d.scored)


@query("calibration_gap")
def _(d: Data):
    return evaluation.calibration_gap(d.scored)


@query("analysis_segments")
def _(d: Data):
    return evaluation.with_segments(d.features).select("order_id", "prediction_month", *K.SEGMENT_BANDS)


@query("segment_metrics")
def _(d: Data):
    return evaluation.segment_metrics(d.scored_features, "customer_state")


@query("segment_reports")
def _(d: Data):
    return evaluation.segment_reports(evaluation.with_segments(d.scored_features))


@query("temporal_robustness")
def _(d: Data):
    metrics = materialize(d.fold_metrics)
    best = training.best_config(training.summarize_search(metrics)).select("config_id").scalar()
    return evaluation.temporal_robustness(metrics, best)


@query("holdout_report")
def _(d: Data):
    scored = splits.chronological_split(d.scored)
    return training.holdout_report(
        scored.filter(F.col("split") == "validation"), scored.filter(F.col("split") == "test")
    )[0]


@query("holdout_confusion")
def _(d: Data):
    scored = splits.chronological_split(d.scored)
    return training.holdout_report(
        scored.filter(F.col("split") == "validation"), scored.filter(F.col("split") == "test")
    )[1]


@query("operating_thresholds")
def _(d: Data):
    return evaluation.operating_thresholds(d.scored)


@query("rule_metrics")
def _(d: Data):
    return evaluation.rule_metrics(d.scored, evaluation.operating_thresholds(d.scored))


def _evaluated(d: Data):
    """(reports, ledger) of the evaluation: the whole grid is searched, its winner refitted and reported, five repeats."""
    return _shared(d.spark, d.sf_dir, "evaluation", lambda: jobs.evaluation_job(
        d.split, training.search_configs(), scratch_path(d.spark, "evaluation")))


@query("evaluation_job")
def _(d: Data):
    reports, _ = _evaluated(d)
    return jobs.long_reports({name: tidy(report) for name, report in reports.items()})


@query("evaluation_manifest")
def _(d: Data):
    return _evaluated(d)[1].manifest().select("report", "inputs", "rows")


@query("baseline_job")
def _(d: Data):
    ranking, _, metrics, matrices = jobs.baseline_job(d.split)
    return jobs.long_reports({"ranking": tidy(ranking), "metrics": tidy(metrics), "confusion": tidy(matrices)}, written=False)


@query("deployment_job")
def _(d: Data):
    _, book = _evaluated(d)
    best = training.best_config(training.summarize_search(book.part("fold_metrics"))).first()["config_id"]
    config = next(c for c in training.search_configs() if c.config_id == best)
    oof = book.part("out_of_fold").filter(F.col("config_id") == best)
    record = jobs.deployment_job(d.spark, book.entry("model")["part"], oof, book.part("rules"), config)
    return jobs.long_reports({"deployment": record}, written=False)


# --- drift ---------------------------------------------------------------------------------------------------


def _development(d: Data) -> tuple[DataFrame, DataFrame]:
    return d.split.filter(F.col("split") != "test"), d.part("test")


@query("psi_from_shares")
def _(d: Data):
    reference, comparison = _development(d)
    bins = drift._sided(reference.select("customer_state"), comparison.select("customer_state")).groupBy(
        "customer_state").agg(*drift._side_counts())
    sizes = bins.agg(F.struct(F.sum("reference").alias("r"), F.sum("comparison").alias("c")).alias("s")).scalar()
    shares = bins.select(
        (F.col("reference").cast("double") / sizes["r"]).alias("reference_share"),
        (F.col("comparison").cast("double") / sizes["c"]).alias("comparison_share"),
    )
    return drift.psi_from_shares(shares, "reference_share", "comparison_share")


@query("numeric_psi")
def _(d: Data):
    return drift.numeric_psi(*_development(d), K.NUMERIC_FEATURES)


@query("categorical_psi")
def _(d: Data):
    return drift.categorical_psi(*_development(d), K.CATEGORICAL_FEATURES)


@query("drift_summary")
def _(d: Data):
    return drift.drift_summary(*_development(d))


# --- importance ----------------------------------------------------------------------------------------------


@query("native_importance")
def _(d: Data):
    return importance.native_importance(_tree(d))


@query("permutation_importance")
def _(d: Data):
    return importance.permutation_importance(_tree(d), d.part("test"), n_repeats=5)


@query("tree_attribution")
def _(d: Data):
    model = training.fit_model(d.part("train"), _baseline("hist_gradient_boosting"))
    return importance.global_attribution(importance.tree_contributions(model, d.part("test")))


@query("regression_attribution")
def _(d: Data):
    train = d.part("train")
    model = training.fit_model(train, _baseline("logistic_regression"))
    return importance.global_attribution(importance.regression_contributions(model, d.part("test"), train))


@query("global_attribution")
def _(d: Data):
    return importance.global_attribution(importance.linear_contributions(d.features, LINEAR_WEIGHTS))


# --- scoring -------------------------------------------------------------------------------------------------


@query("contract_validation")
def _(d: Data):
    checked = scoring.contract_validation(d.features.drop(K.TARGET))
    return checked.select("order_id", F.size("faults").alias("n_faults"), F.concat_ws("; ", "faults").alias("faults"))


@query("normalize_categories")
def _(d: Data):
    raw = d.features.select(
        "order_id",
        F.concat(F.lit(" "), F.lower("customer_state")).alias("customer_state"),
        F.when(F.col("order_id") % 3 == 0, F.lit("  ")).otherwise(
            F.concat(F.lit(" "), "primary_payment_type", F.lit(" "))).alias("primary_payment_type"),
        F.concat("dominant_product_category", F.lit("  ")).alias("dominant_product_category"),
    )
    return scoring.normalize_categories(raw)


def _promise_scorer(rows: DataFrame) -> DataFrame:
    """Risk falls with the length of the promise."""
    return rows.withColumn("probability", F.least(
        F.greatest(F.lit(0.8) - F.col("promised_delivery_days") / 60.0, F.lit(0.01)), F.lit(0.99)))


@query("batch_score")
def _(d: Data):
    version = scoring.model_version("promise_rule", "a" * 64)
    return scoring.batch_score(d.features.drop(K.TARGET), _promise_scorer, BAND_LIMITS, ACTION_THRESHOLD, version)[0]


@query("batch_quarantine")
def _(d: Data):
    """The rows that batch scoring refuses, with their faults, of a table with planted ones."""
    number, key = F.col("item_count").cast("double"), F.col("order_id")
    planted = d.features.drop(K.TARGET).withColumns({
        "item_count": F.when(key % 5 == 0, number + 0.5).when(key % 7 == 0, F.lit(None)).otherwise(number),
        "total_price": F.when(key % 3 == 0, F.lit(float("nan"))).when(key % 11 == 0, F.lit(-1.0)).otherwise(F.col("total_price")),
    })
    version = scoring.model_version("promise_rule", "a" * 64)
    refused = scoring.batch_score(planted, _promise_scorer, BAND_LIMITS, ACTION_THRESHOLD, version)[1]
    return refused.select("order_id", F.concat_ws("; ", "faults").alias("faults"))


@query("batch_score_model")
def _(d: Data):
    model = _tree(d)
    scored, _ = scoring.batch_score(
        d.part("test").drop(K.TARGET, "split", "row_num"), lambda rows: training.score_rows(model, rows), BAND_LIMITS,
        ACTION_THRESHOLD, "decision_tree:local",
    )
    return scored


@query("risk_band")
def _(d: Data):
    return d.scored.select("order_id", "probability", scoring.risk_band("probability", **BAND_LIMITS).alias("risk_band"))


@query("review_flag")
def _(d: Data):
    threshold = scoring.action_threshold(0.4, override=ACTION_THRESHOLD)
    return d.scored.select("order_id", scoring.review_flag("probability", threshold).alias("requires_review"))


@query("band_thresholds")
def _(d: Data):
    return scoring.band_thresholds(d.scored)


@query("choose_threshold")
def _(d: Data):
    return scoring.choose_threshold(evaluation.operating_thresholds(d.scored))


@query("monitoring_reference")
def _(d: Data):
    return scoring.monitoring_reference(d.scored)


@query("deployment_config")
def _(d: Data):
    rules = evaluation.operating_thresholds(d.scored)
    record = scoring.deployment_config(d.scored, rules, "stand_in_01", "stand_in", "b" * 64)
    return record.select(
        "model.*", "risk_score.bands.*", "risk_score.action_threshold", "risk_score.action_threshold_rule",
        "monitoring_reference.rows", "monitoring_reference.prevalence",
    )


@query("missing_feature_count")
def _(d: Data):
    return scoring.missing_feature_count(d.features)


@query("response_ids")
def _(d: Data):
    version = scoring.model_version("promise_rule", "a" * 64)
    return scoring.response_ids(d.scored.select("order_id", K.PREDICTION_TS), "req-1", K.CHRONOLOGICAL, version)


@query("payload_pack")
def _(d: Data):
    back = scoring.unpack_payload(scoring.pack_payload(d.features))
    return back.select(
        F.col("order_id").cast("bigint").alias("order_id"), K.PREDICTION_TS, "total_price", "payment_value",
        "mean_distance_km", "customer_state", "primary_payment_type",
    )


# --- monitoring ----------------------------------------------------------------------------------------------


@query("telemetry_snapshot")
def _(d: Data):
    return monitoring.telemetry_snapshot(d.log)


@query("telemetry_windows")
def _(d: Data):
    return monitoring.telemetry_windows(d.log)


@query("telemetry_stream")
def _(d: Data):
    return telemetry.telemetry_job(
        d.spark, d.sf_dir, "events.parquet", scratch_path(d.spark, "telemetry"), scratch_path(d.spark, "progress"),
        lambda events: with_log_policy(standins.log_columns(events)),
    )


@query("score_drift")
def _(d: Data):
    return monitoring.score_drift(d.scored, d.log)


@query("matured_label_quality")
def _(d: Data):
    outcomes = d.cleaned.select("order_id", F.col("order_delivered_customer_date").alias("delivered_at"), K.TARGET)
    return monitoring.matured_label_quality(d.scored, outcomes)

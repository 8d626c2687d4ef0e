"""Names, ranges and literal registries of the order-delay data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, types as T

TARGET = "late_delivery"
ORDER_KEY = "order_id"
PREDICTION_TS = "prediction_timestamp"
CHRONOLOGICAL = [PREDICTION_TS, ORDER_KEY]

# The model's feature names in contract order.
NUMERIC_FEATURES = [
    "purchase_year", "purchase_month", "purchase_weekday", "purchase_hour", "purchase_is_weekend",
    "purchase_month_sin", "purchase_month_cos", "purchase_weekday_sin", "purchase_weekday_cos",
    "purchase_hour_sin", "purchase_hour_cos", "approval_lag_hours", "promised_delivery_days", "item_count",
    "unique_products", "seller_count", "total_price", "total_freight", "order_total_value", "mean_item_price",
    "max_item_price", "freight_ratio", "payment_records", "payment_value", "max_installments",
    "payment_type_count", "mean_product_weight_g", "total_product_weight_g", "mean_product_volume_cm3",
    "total_product_volume_cm3", "category_count", "mean_product_photos", "seller_state_count",
    "mean_distance_km", "max_distance_km", "min_distance_km", "all_sellers_same_state",
    "same_state_seller_share",
]
CATEGORICAL_FEATURES = ["customer_state", "primary_payment_type", "dominant_product_category"]
MODEL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES

# Columns known only after the prediction moment, or raw identifiers.
FORBIDDEN_FEATURES = [
    "customer_id", "customer_unique_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    "delivery_delay_days", "review_id", "review_score", "review_comment_title", "review_comment_message",
    "review_creation_date", "review_answer_timestamp",
]

# Numeric signals compared between late and on-time orders.
SIGNAL_FEATURES = [
    "promised_delivery_days", "item_count", "unique_products", "seller_count", "total_price", "total_freight",
    "freight_ratio", "payment_value", "max_installments", "mean_product_weight_g", "total_product_weight_g",
    "mean_product_volume_cm3", "total_product_volume_cm3", "category_count", "mean_distance_km",
    "max_distance_km", "same_state_seller_share",
]

ORDER_TIMESTAMPS = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
]

# Lifecycle rules as (rule, later event, earlier event); a violation is later < earlier.
LIFECYCLE_RULES = [
    ("approval_before_purchase", "order_approved_at", "order_purchase_timestamp"),
    ("carrier_before_approval", "order_delivered_carrier_date", "order_approved_at"),
    ("customer_delivery_before_carrier", "order_delivered_customer_date", "order_delivered_carrier_date"),
    ("customer_delivery_before_purchase", "order_delivered_customer_date", "order_purchase_timestamp"),
    ("estimated_delivery_before_purchase", "order_estimated_delivery_date", "order_purchase_timestamp"),
]

# Upper-closed bands of the evaluation segments as (source, edges, labels).
SEGMENT_BANDS = {
    "distance_band": ("mean_distance_km", [250, 500, 1000, 2000],
                      ["<=250 km", "250-500 km", "500-1000 km", "1000-2000 km", ">2000 km"]),
    "promise_band": ("promised_delivery_days", [10, 20, 30, 40],
                     ["<=10 days", "10-20 days", "20-30 days", "30-40 days", ">40 days"]),
    "approval_lag_band": ("approval_lag_hours", [1, 6, 24, 72], ["<=1 h", "1-6 h", "6-24 h", "24-72 h", ">72 h"]),
}

# Column, role and availability at the prediction moment.
AVAILABILITY_REGISTRY = [
    ("order_purchase_timestamp", "candidate_feature", True, "recorded before approval"),
    ("order_approved_at", "prediction_point", True, "the moment the score is made"),
    ("order_estimated_delivery_date", "candidate_feature", True, "deadline is set before dispatch"),
    ("order_delivered_carrier_date", "forbidden_feature", False, "happens after the score"),
    ("order_delivered_customer_date", "target_construction_only", False, "the outcome itself"),
    ("review_score", "forbidden_feature", False, "written after delivery"),
    ("review_comment_title", "forbidden_feature", False, "written after delivery"),
    ("review_comment_message", "forbidden_feature", False, "written after delivery"),
    ("review_creation_date", "forbidden_feature", False, "written after delivery"),
    ("review_answer_timestamp", "forbidden_feature", False, "written after delivery"),
]

# How each table reaches the order grain.
JOIN_STRATEGY = [
    ("customers", "many-to-one via customer_id", False),
    ("order_items", "one-to-many via order_id", True),
    ("payments", "one-to-many via order_id", True),
    ("reviews", "one-to-many or near one-to-one via order_id", True),
    ("products", "through order_items", True),
    ("sellers", "through order_items", True),
    ("geolocation", "through customer/seller zip prefix", True),
]

# Cleaning rules as (rule, action, SQL condition of a violation).
CLEANING_RULES = [
    ("order_status must be delivered", "exclude otherwise", "order_status IS NULL OR order_status <> 'delivered'"),
    ("order_approved_at must exist", "exclude if missing", "order_approved_at IS NULL"),
    ("actual delivery must exist", "exclude if missing", "order_delivered_customer_date IS NULL"),
    ("estimated delivery must exist", "exclude if missing", "order_estimated_delivery_date IS NULL"),
    ("approval cannot precede purchase", "exclude if violated", "order_approved_at < order_purchase_timestamp"),
    ("actual delivery cannot precede purchase", "exclude if violated",
     "order_delivered_customer_date < order_purchase_timestamp"),
    ("carrier before approval", "keep + document", "order_delivered_carrier_date < order_approved_at"),
    ("delivery before carrier", "investigate", "order_delivered_customer_date < order_delivered_carrier_date"),
    ("estimated delivery cannot precede approval", "exclude if violated",
     "order_estimated_delivery_date < order_approved_at"),
]


@dataclass(frozen=True)
class FieldRule:
    """Contract of one request field: required or not, whole number or not, and its closed range or text length."""

    name: str
    required: bool = True
    low: float | None = None
    high: float | None = None
    min_length: int | None = None
    max_length: int | None = None
    text: bool = False
    whole: bool = False


def _numeric_rules() -> list[FieldRule]:
    optional = {
        "payment_records", "payment_value", "max_installments", "payment_type_count", "mean_product_weight_g",
        "total_product_weight_g", "mean_product_volume_cm3", "total_product_volume_cm3", "mean_product_photos",
        "mean_distance_km", "max_distance_km", "min_distance_km",
    }
    unbounded = {
        "purchase_year", "purchase_month_sin", "purchase_month_cos", "purchase_weekday_sin",
        "purchase_weekday_cos", "purchase_hour_sin", "purchase_hour_cos",
    }
    closed = {
        "purchase_month": (1, 12), "purchase_weekday": (0, 6), "purchase_hour": (0, 23),
        "purchase_is_weekend": (0, 1), "freight_ratio": (0, 1), "all_sellers_same_state": (0, 1),
        "same_state_seller_share": (0, 1),
    }
    at_least_one = {"item_count", "unique_products", "seller_count", "category_count", "seller_state_count"}
    # The fields that take whole numbers
    whole = {
        "purchase_year", "purchase_month", "purchase_weekday", "purchase_hour", "purchase_is_weekend", "item_count",
        "unique_products", "seller_count", "payment_records", "max_installments", "payment_type_count", "category_count",
        "seller_state_count", "all_sellers_same_state",
    }
    rules = []
    for name in NUMERIC_FEATURES:
        low, high = closed.get(name, (1 if name in at_least_one else 0, None))
        if name in unbounded:
            low = None
        rules.append(FieldRule(name, required=name not in optional, low=low, high=high, whole=name in whole))
    return rules


FIELD_RULES = _numeric_rules() + [
    FieldRule("customer_state", min_length=2, max_length=2, text=True),
    FieldRule("primary_payment_type", required=False, text=True),
    FieldRule("dominant_product_category", min_length=1, text=True),
]

# Type of each raw table's columns when read from text files.
TEXT_SCHEMAS = {
    "orders_raw": T.StructType(
        [T.StructField("order_id", T.LongType()), T.StructField("customer_id", T.LongType()),
         T.StructField("order_status", T.StringType())]
        + [T.StructField(c, T.TimestampType()) for c in ORDER_TIMESTAMPS]
    ),
    "order_items": T.StructType([
        T.StructField("order_id", T.LongType()), T.StructField("order_item_id", T.IntegerType()),
        T.StructField("product_id", T.LongType()), T.StructField("seller_id", T.LongType()),
        T.StructField("shipping_limit_date", T.TimestampType()), T.StructField("price", T.DoubleType()),
        T.StructField("freight_value", T.DoubleType()),
    ]),
}


class ContractError(ValueError):
    """A table does not meet the contract an operator relies on."""


def require_columns(df: DataFrame, required, what: str = "input") -> DataFrame:
    """Fail early when columns are missing; looks at the analysed schema only, no job runs."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ContractError(f"{what} is missing columns: {missing}")
    return df

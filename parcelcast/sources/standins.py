"""Stand-in star schema over the test tables.

Each view is a list of (column, expression) pairs over one source, written in the SQL both Spark and the
checking engine understand, so that both sides start from the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_P = "o_orderdate + INTERVAL '1' HOUR * (o_orderkey*7 % 24)"
_AP = f"CASE WHEN o_orderkey % 701 = 0 THEN NULL ELSE {_P} + INTERVAL '1' MINUTE * (o_orderkey*37 % 4320) END"


@dataclass(frozen=True)
class View:
    source: str
    columns: tuple[tuple[str, str], ...]
    where: str | None = None
    distinct: bool = False

    def sql(self) -> str:
        cols = ", ".join(f"{expr} AS {name}" for name, expr in self.columns)
        where = f" WHERE {self.where}" if self.where else ""
        return f"SELECT {'DISTINCT ' if self.distinct else ''}{cols} FROM {self.source}{where}"


VIEWS: dict[str, View] = {
    "orders_raw": View("orders", (
        ("order_id", "o_orderkey"),
        ("customer_id", "o_custkey"),
        ("order_status", "CASE WHEN o_orderstatus='P' THEN 'canceled' ELSE 'delivered' END"),
        ("order_purchase_timestamp", _P),
        ("order_approved_at", _AP),
        ("order_delivered_carrier_date", f"{_AP} + INTERVAL '1' HOUR * ((o_orderkey*11 % 120) - 6)"),
        ("order_delivered_customer_date",
         f"CASE WHEN o_orderkey % 997 = 0 THEN NULL ELSE {_AP} + INTERVAL '1' HOUR * (24 + (o_orderkey*53 % 700)) END"),
        ("order_estimated_delivery_date",
         "CASE WHEN o_orderkey % 1499 = 0 THEN o_orderdate - INTERVAL '1' DAY "
         "ELSE o_orderdate + INTERVAL '1' DAY * (10 + (o_orderkey*13 % 25)) END"),
    )),
    "order_items": View("lineitem", (
        ("order_id", "l_orderkey"), ("order_item_id", "l_linenumber"), ("product_id", "l_partkey"),
        ("seller_id", "l_suppkey"), ("shipping_limit_date", "l_shipdate"), ("price", "l_extendedprice"),
        ("freight_value", "l_extendedprice*l_tax"),
    )),
    "payments": View("lineitem", (
        ("order_id", "l_orderkey"), ("payment_sequential", "l_linenumber"),
        ("payment_type", "CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END"),
        ("payment_installments", "CAST(l_quantity AS INT) % 12 + 1"),
        ("payment_value", "l_extendedprice*(1-l_discount)"),
    )),
    "products": View("part", (
        ("product_id", "p_partkey"),
        ("product_category_name", "CASE WHEN p_partkey % 61 = 0 THEN NULL ELSE lower(p_type) END"),
        ("product_photos_qty", "CASE WHEN p_partkey % 61 = 0 THEN NULL ELSE CAST(p_partkey % 6 + 1 AS DOUBLE) END"),
        ("product_weight_g", "CASE WHEN p_partkey % 199 = 0 THEN NULL ELSE CAST(p_size*100 AS DOUBLE) END"),
        ("product_length_cm", "CAST(10 + p_partkey % 40 AS DOUBLE)"),
        ("product_height_cm", "CAST(5 + p_partkey % 20 AS DOUBLE)"),
        ("product_width_cm", "CAST(8 + p_partkey % 30 AS DOUBLE)"),
    )),
    "category_translation": View("part", (
        ("product_category_name", "lower(p_type)"),
        ("product_category_name_english", "concat('cat_', lower(p_type))"),
    ), distinct=True),
    "customers": View("customer", (
        ("customer_id", "c_custkey"), ("customer_unique_id", "c_custkey % 1200"),
        ("customer_zip_code_prefix", "1000 + c_nationkey*10 + c_custkey % 5"),
        ("customer_city", "lower(c_mktsegment)"), ("customer_state", "concat(chr(65+c_nationkey),'S')"),
    )),
    "sellers": View("supplier", (
        ("seller_id", "s_suppkey"), ("seller_zip_code_prefix", "1000 + s_nationkey*10 + s_suppkey % 5"),
        ("seller_state", "concat(chr(65+s_nationkey),'S')"),
    )),
    "geolocation": View("customer", (
        ("geolocation_zip_code_prefix", "1000 + c_nationkey*10 + c_custkey % 5"),
        ("geolocation_lat", "CAST(-30 + c_acctbal/400.0 AS DOUBLE)"),
        ("geolocation_lng", "CAST(-60 + (c_custkey*37 % 2500)/100.0 AS DOUBLE)"),
        ("geolocation_city", "lower(c_mktsegment)"), ("geolocation_state", "concat(chr(65+c_nationkey),'S')"),
    )),
    "reviews": View("events", (
        ("review_id", "event_id % 9900"), ("order_id", "event_id"),
        ("review_score", "CAST(event_id % 5 + 1 AS INT)"), ("review_creation_date", "ts"),
    )),
}

RAW_TABLES = ("orders_raw", "order_items", "payments", "products", "category_translation", "customers", "sellers",
              "geolocation", "reviews")


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def to_instants(df: DataFrame) -> DataFrame:
    """Zone-less timestamps as instants, which micros arithmetic and watermarks need."""
    return df.select(*[
        F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
        for f in df.schema.fields
    ])


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in table by name."""
    spec = VIEWS[name]
    rows = base_table(spark, sf_dir, spec.source)
    if spec.where:
        rows = rows.filter(spec.where)
    rows = rows.selectExpr(*[f"{expr} AS {col}" for col, expr in spec.columns])
    return to_instants(rows.distinct() if spec.distinct else rows)


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction-log stand-in derived from the event table."""
    return log_columns(base_table(spark, sf_dir, "events"))


def log_columns(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        # every fourth event is a second prediction of the request before it
        F.expr("event_id - CAST(event_id % 4 = 3 AS INT)").alias("request_id"),
        F.expr("CAST(event_id % 4 = 3 AS INT)").alias("prediction_index"),
        (F.col("event_type") == "error").alias("failed"),
        (F.col("value") / (F.col("value") + F.lit(50.0))).alias("score"),
        (F.get_json_object("props", "$.k").cast("bigint") % F.lit(3)).alias("missing_features"),
        F.col("value").alias("latency_ms"),
    )

import math

import pytest
from pyspark.sql import functions as F

from parcelcast import contracts as K
from parcelcast.functions.expressions import equal_flag, haversine_km, safe_divide, upper_closed_band
from parcelcast.operators import cleaning, features
from parcelcast.plans import jobs
from parcelcast.sources import standins

ITEMS = "order_id bigint, order_item_id int, product_id bigint, seller_id bigint, price double, freight_value double"
PRODUCTS = ("product_id bigint, product_category_name string, product_photos_qty double, product_weight_g double, "
            "product_length_cm double, product_height_cm double, product_width_cm double")


@pytest.fixture(scope="module")
def shop(spark):
    items = spark.createDataFrame([
        (1, 1, 10, 7, 5.0, 1.0), (1, 2, 10, 7, 5.0, 1.0), (1, 3, 11, 8, 20.0, 0.0),
        (2, 1, 12, 9, 0.0, 0.0),
        (3, 1, 99, None, 3.0, 1.0),
    ], ITEMS)
    products = spark.createDataFrame([
        (10, "b", 1.0, 100.0, 2.0, 3.0, 4.0), (11, "a", 3.0, None, 1.0, 1.0, 1.0), (12, None, None, None, None, 1.0, 1.0),
    ], PRODUCTS)
    translation = spark.createDataFrame([("a", "cat_a"), ("b", "cat_b")],
                                        "product_category_name string, product_category_name_english string")
    return items, products, translation


def by_order(df):
    return {r.order_id: r for r in df.collect()}


def test_item_features(shop):
    rows = by_order(features.order_item_features(shop[0]))
    one = rows[1]
    assert (one.item_count, one.unique_products, one.seller_count) == (3, 2, 2)
    assert (one.total_price, one.total_freight, one.order_total_value) == (30.0, 2.0, 32.0)
    assert one.mean_item_price == 10.0 and one.max_item_price == 20.0
    assert one.freight_ratio == pytest.approx(2 / 32)
    assert rows[2].freight_ratio is None  # nothing paid: no ratio
    assert rows[3].seller_count == 0  # an unknown seller is not a seller


def test_product_features_and_dominant_category(shop):
    rows = by_order(features.order_product_features(*shop))
    assert rows[1].total_product_weight_g == 200.0 and rows[1].mean_product_weight_g == 100.0
    assert rows[1].total_product_volume_cm3 == 49.0 and rows[1].mean_product_photos == pytest.approx(5 / 3)
    assert rows[1].category_count == 2
    # all weights missing: the sum is 0, the mean is missing
    assert rows[2].total_product_weight_g == 0.0 and rows[2].mean_product_weight_g is None
    dominant = by_order(features.dominant_category(*shop))
    assert dominant[1].dominant_product_category == "cat_b" and dominant[2].dominant_product_category == "unknown"
    assert by_order(features.dominant_category_eda(*shop))[2].dominant_category is None


def test_dominant_category_tie_takes_first_name(spark, shop):
    items = spark.createDataFrame([(1, 1, 10, 7, 1.0, 0.0), (1, 2, 11, 7, 1.0, 0.0)], ITEMS)
    assert by_order(features.dominant_category(items, *shop[1:]))[1].dominant_product_category == "cat_a"


def test_combined_line_features_equal_the_separate_ones(shop):
    combined = by_order(features.order_line_features(*shop))
    item, product = by_order(features.order_item_features(shop[0])), by_order(features.order_product_features(*shop))
    for key, row in combined.items():
        for part in (item[key], product[key]):
            for name, value in part.asDict().items():
                if name in row.asDict():
                    assert row[name] == value, name


def test_primary_payment_is_the_lowest_sequence(spark):
    payments = spark.createDataFrame(
        [(1, 2, "voucher", 1, 5.0), (1, 1, "boleto", 3, 7.0), (2, 1, "card", 2, 9.0), (2, 1, "card", 2, 1.0)],
        "order_id bigint, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    )
    rows = by_order(features.order_payment_features(payments))
    assert rows[1].primary_payment_type == "boleto" and rows[1].payment_type_count == 2
    assert rows[1].payment_value == 12.0 and rows[1].max_installments == 3 and rows[2].payment_records == 2


def test_geo_lookup_drops_repeated_points_first(spark):
    geo = spark.createDataFrame(
        [(1, 0.0, 0.0), (1, 0.0, 0.0), (1, 0.0, 0.0), (1, 10.0, 2.0), (1, 20.0, 4.0), (2, 5.0, 6.0)],
        "geolocation_zip_code_prefix bigint, geolocation_lat double, geolocation_lng double",
    )
    once = {r.geolocation_zip_code_prefix: r for r in features.geo_lookup(geo).collect()}
    raw = {r.geolocation_zip_code_prefix: r for r in features.geo_lookup_raw(geo).collect()}
    assert (once[1].latitude, once[1].longitude) == (10.0, 2.0)
    assert (raw[1].latitude, raw[1].longitude) == (0.0, 0.0)
    assert (once[2].latitude, once[2].longitude) == (5.0, 6.0)


def test_expressions(spark):
    row = spark.range(1).select(
        safe_divide(F.lit(1), F.lit(0)).alias("zero"), safe_divide(F.lit(1), F.lit(4)).alias("quarter"),
        equal_flag(F.lit(None).cast("string"), F.lit(None).cast("string")).alias("nulls"),
        haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("half"),
        upper_closed_band(F.lit(250.0), [250, 500], ["a", "b", "c"]).alias("edge"),
        upper_closed_band(F.lit(250.1), [250, 500], ["a", "b", "c"]).alias("above"),
    ).first()
    assert row.zero is None and row.quarter == 0.25 and row.nulls == 0
    assert row.half == pytest.approx(math.pi * 6371.0088)
    assert (row.edge, row.above) == ("a", "b")


def test_validated_join_refuses_repeated_keys(spark):
    left = spark.createDataFrame([(1, "x"), (1, "y")], "k bigint, a string")
    right = spark.createDataFrame([(1, 5)], "k bigint, b bigint")
    assert features.validated_join(left, right, ["k"]).count() == 2
    with pytest.raises(K.ContractError, match="left side"):
        features.validated_join(left, right, ["k"], validate="one_to_one")
    with pytest.raises(K.ContractError, match="right side"):
        features.validated_join(right, left, ["k"])


def toy_features(spark, promise=10.0):
    numbers = [F.lit(1.0).alias(c) for c in K.NUMERIC_FEATURES if c != "promised_delivery_days"]
    texts = [F.lit("sample").alias(c) for c in K.CATEGORICAL_FEATURES]
    return spark.range(20).select(
        F.concat(F.lit("o"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("order_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 86400).alias(K.PREDICTION_TS),
        *numbers,
        F.when(F.col("id") == 0, F.lit(promise)).otherwise(F.lit(10.0)).alias("promised_delivery_days"),
        *texts, (F.col("id") % 2).cast("int").alias(K.TARGET),
    )


def test_validation_flags_a_negative_promise(spark):
    cleaning.raise_on_violations(features.validate_features(toy_features(spark), 20))
    with pytest.raises(K.ContractError, match="promise_is_not_negative"):
        cleaning.raise_on_violations(features.validate_features(toy_features(spark, -1.0)))


def test_no_forbidden_column_is_a_feature():
    assert not set(K.FORBIDDEN_FEATURES) & set(K.MODEL_FEATURES)
    assert (len(K.NUMERIC_FEATURES), len(K.CATEGORICAL_FEATURES)) == (38, 3)


def test_missing_columns_are_named(spark):
    with pytest.raises(K.ContractError, match="price"):
        features.order_item_features(spark.createDataFrame([(1,)], "order_id bigint"))


@pytest.mark.parametrize("name,key", [("products", "product_id"), ("customers", "customer_id"), ("sellers", "seller_id"),
                                      ("category_translation", "product_category_name")])
def test_duplicate_dimension_rows_are_refused(spark, name, key):
    names = ["customers", "order_items", "payments", "products", "sellers", "geolocation", "category_translation"]
    tables = {n: standins.view(spark, "/root/testdata/sf0.001", n) for n in names}
    tables[name] = tables[name].unionByName(tables[name].limit(1))
    with pytest.raises(K.ContractError, match=f"{name} is not unique on {key}"):
        features.feature_table(jobs.cleaned_orders(spark, "/root/testdata/sf0.001"), **tables)


def test_null_orders_and_sequences(spark):
    rows = [(1, None, "voucher", 1, 1.0), (1, 2, "boleto", 1, 5.0), (None, 1, "boleto", 1, 5.0)]
    payments = spark.createDataFrame(rows, "order_id long, payment_sequential int, payment_type string, payment_installments int, payment_value double")
    assert [tuple(r) for r in features.primary_payment(payments).collect()] == [(1, "boleto")]
    r = features.order_payment_features(payments).collect()
    assert len(r) == 1 and r[0].primary_payment_type == "boleto" and r[0].payment_value == 6.0

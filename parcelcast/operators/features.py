"""The order-level feature table: one row per order, known at approval time.

Every one-to-many table is reduced to the order grain before it is joined.  The reductions and the joins all
hash on ``order_id``, so the aggregates' partitioning serves the joins without another shuffle.

Lines come in any order, so that combining them before a shuffle holds a whole input split and saves nothing.  They go
unsorted to (product or seller, salt), are reduced and enriched there, and then go to their order, where all further
groupings take place: two shuffles a path, into partitions whose number follows the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parcelcast.contracts import (
    ContractError, FORBIDDEN_FEATURES, MODEL_FEATURES, NUMERIC_FEATURES, ORDER_KEY, PREDICTION_TS, TARGET,
    require_columns,
)
from parcelcast.functions.expressions import (
    cycle, days_between, equal_flag, flag_count, haversine_km, hours_between, safe_divide,
)
from parcelcast.operators.ordering import quantile_columns
from parcelcast.operators.profiling import _rows_from_aggregate, repeated_rows

ZIP = "geolocation_zip_code_prefix"
LAT, LNG = "geolocation_lat", "geolocation_lng"


def _median_point(points: DataFrame) -> DataFrame:
    """Median latitude and longitude per zip prefix; both axes go through one exact-quantile job."""
    medians = quantile_columns(points, [LAT, LNG], {"m": 0.5}, [ZIP], "axis")
    return medians.groupBy(ZIP).agg(
        F.max(F.when(F.col("axis") == LAT, F.col("m"))).alias("latitude"),
        F.max(F.when(F.col("axis") == LNG, F.col("m"))).alias("longitude"),
    )


def geo_lookup(geolocation: DataFrame) -> DataFrame:
    """One coordinate per zip prefix: the medians over distinct points."""
    require_columns(geolocation, [ZIP, LAT, LNG], "geolocation")
    return _median_point(geolocation.select(ZIP, LAT, LNG).dropDuplicates())


def geo_lookup_raw(geolocation: DataFrame) -> DataFrame:
    """Exploratory variant: medians over all rows, repeated points included."""
    require_columns(geolocation, [ZIP, LAT, LNG], "geolocation")
    return _median_point(geolocation)


SHARE_DIGITS = 12
PARTITION_ROWS = 250_000
SALTS = 4
_SALT = "_salt"
_ITEM_COLUMNS = ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"]


def _parts(*tables: DataFrame) -> int:
    """Partitions for shuffles of ``tables``, as many more as there are more rows: what a task holds does not grow."""
    most = max(rows.count() for rows in tables)
    return max(tables[0].sparkSession.sparkContext.defaultParallelism, -(-most // PARTITION_ROWS))


def _pairs(items: DataFrame, key: str, parts: int, aggregates: Sequence[Column]) -> DataFrame:
    """Order lines reduced to (order, key), placed by the key and a salt of the order.

    The salt deals a hot key over several tasks. A hot order is dealt by key, and has at most one row for each key left
    when it is brought together.
    """
    salted = items.withColumn(_SALT, F.pmod(F.xxhash64("order_id"), F.lit(SALTS).cast("bigint")))
    return salted.repartition(parts, key, _SALT).groupBy("order_id", key, _SALT).agg(*aggregates)


def _salted(dimension: DataFrame) -> DataFrame:
    """A row for each salt."""
    return dimension.withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))


def _per_product(items: DataFrame, parts: int) -> DataFrame:
    """Order lines reduced to (order, product).

    Distinct products become a plain count of these rows, which spares the row expansion of a distinct aggregate.
    """
    lines = items.select("order_id", "order_item_id", "product_id", "price", "freight_value")
    return _pairs(lines, "product_id", parts, [
        F.count(F.lit(1)).alias("lines"),
        F.count("order_item_id").alias("item_ids"),
        F.sum("price").alias("price"),
        F.count("price").alias("price_n"),
        F.max("price").alias("top_price"),
        F.sum("freight_value").alias("freight"),
    ])


def _item_aggregates(distinct_products: Column) -> dict[str, Column]:
    price, freight = F.coalesce(F.sum("price"), F.lit(0.0)), F.coalesce(F.sum("freight"), F.lit(0.0))
    return {
        "item_count": F.sum("item_ids"),
        "unique_products": distinct_products,
        "total_price": price,
        "total_freight": freight,
        "mean_item_price": safe_divide(F.sum("price"), F.sum("price_n")),
        "max_item_price": F.max("top_price"),
        "order_total_value": price + freight,
        # equal shares differ in their last bit with the order of addition; quantile edges must not fall between them
        "freight_ratio": F.round(safe_divide(freight, price + freight), SHARE_DIGITS),
    }


def _with_order(rows: DataFrame) -> DataFrame:
    """Rows that belong to an order: a NULL id is no order."""
    return rows.filter(F.col("order_id").isNotNull())


def _per_seller(items: DataFrame, parts: int) -> DataFrame:
    lines = _with_order(items).select("order_id", "seller_id")
    return _pairs(lines, "seller_id", parts, [F.count(F.lit(1)).alias("lines")])


def order_item_features(items: DataFrame) -> DataFrame:
    """Counts, values and freight share per order."""
    require_columns(items, _ITEM_COLUMNS, "order_items")
    parts = _parts(items)
    totals = _per_product(items, parts).repartition(parts, "order_id").groupBy("order_id").agg(
        *[c.alias(name) for name, c in _item_aggregates(F.count("product_id")).items()]
    )
    sellers = _per_seller(items, parts).select("order_id", "seller_id").repartition(parts, "order_id").groupBy("order_id").agg(
        F.count("seller_id").alias("seller_count"))
    joined = totals.join(sellers, totals["order_id"].eqNullSafe(sellers["order_id"])).drop(sellers["order_id"])
    return joined.select(
        "order_id", "item_count", "unique_products", "seller_count", "total_price", "total_freight",
        "mean_item_price", "max_item_price", "order_total_value", "freight_ratio",
    )


_PAYMENT_COLUMNS = ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"]


def _first_payment() -> Column:
    """The payment with the lowest sequence number, NULL last; the remaining columns make the order total."""
    return F.min(F.struct(F.isnull("payment_sequential").alias("unnumbered"), "payment_sequential", "payment_value", "payment_type", "payment_installments"))


def payment_features(payments: DataFrame) -> DataFrame:
    require_columns(payments, _PAYMENT_COLUMNS, "payments")
    return _with_order(payments).groupBy("order_id").agg(
        F.count("payment_sequential").alias("payment_records"),
        F.coalesce(F.sum("payment_value"), F.lit(0.0)).alias("payment_value"),
        F.max("payment_installments").alias("max_installments"),
        F.countDistinct("payment_type").alias("payment_type_count"),
    )


def primary_payment(payments: DataFrame) -> DataFrame:
    require_columns(payments, _PAYMENT_COLUMNS, "payments")
    return _with_order(payments).groupBy("order_id").agg(_first_payment()["payment_type"].alias("primary_payment_type"))


def order_payment_features(payments: DataFrame, parts: int | None = None) -> DataFrame:
    """``payment_features`` and ``primary_payment`` from one pass.

    A first aggregate by (order, type) replaces the distinct count and shrinks hot orders before the second.
    """
    require_columns(payments, _PAYMENT_COLUMNS, "payments")
    parts = parts or _parts(payments)
    rows = _with_order(payments).select(*_PAYMENT_COLUMNS).repartition(parts, "order_id", "payment_type")
    # of equal numbers and values the first type is taken, so that nothing after the type decides
    unnumbered = F.isnull("payment_sequential").alias("unnumbered")
    by_type = rows.groupBy("order_id", "payment_type").agg(
        F.count("payment_sequential").alias("records"),
        F.sum("payment_value").alias("value"),
        F.max("payment_installments").alias("installments"),
        F.min(F.struct(unnumbered, "payment_sequential", "payment_value")).alias("lowest"),
    )
    flat = by_type.select("order_id", "payment_type", "records", "value", "installments", "lowest.*")
    return flat.withColumn("first", F.struct("unnumbered", "payment_sequential", "payment_value", "payment_type")).drop(
        "unnumbered", "payment_sequential", "payment_value").repartition(parts, "order_id").groupBy("order_id").agg(
        F.sum("records").alias("payment_records"),
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("payment_value"),
        F.max("installments").alias("max_installments"),
        F.count("payment_type").alias("payment_type_count"),
        F.min("first")["payment_type"].alias("primary_payment_type"),
    )


def enriched_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    require_columns(products, [
        "product_id", "product_category_name", "product_photos_qty", "product_weight_g", "product_length_cm",
        "product_height_cm", "product_width_cm",
    ], "products")
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    return products.join(translation, "product_category_name", "left").select(
        "product_id",
        "product_category_name",
        "product_category_name_english",
        F.col("product_photos_qty").try_cast("double").alias("product_photos_qty"),
        F.col("product_weight_g").try_cast("double").alias("product_weight_g"),
        volume.try_cast("double").alias("product_volume_cm3"),
    )


def _with_product(lines: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    enriched = enriched_products(products, translation)
    if _SALT in lines.columns:
        joined = lines.join(_salted(enriched), ["product_id", _SALT], "left").drop(_SALT)
    else:
        joined = lines.join(enriched, "product_id", "left")
    return joined.withColumn("category", F.coalesce("product_category_name_english", F.lit("unknown")))


def product_enrichment(items: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    """Order lines with their product's attributes; an untranslated category is 'unknown'."""
    return _with_product(items.select("order_id", "product_id"), products, translation)


def _weighted(lines: DataFrame) -> list[Column]:
    """Sums and counts of the product attributes over lines that stand for ``lines`` items each."""
    sums = []
    for name, column in (("weight", "product_weight_g"), ("volume", "product_volume_cm3"), ("photos", "product_photos_qty")):
        sums.append(F.sum(F.col(column) * F.col("lines")).alias(name))
        sums.append(F.sum(F.when(F.col(column).isNotNull(), F.col("lines"))).alias(f"{name}_n"))
    return [F.sum("lines").alias("n"), *sums]


def _product_aggregates() -> dict[str, Column]:
    return {
        "mean_product_weight_g": safe_divide(F.sum("weight"), F.sum("weight_n")),
        "total_product_weight_g": F.coalesce(F.sum("weight"), F.lit(0.0)),
        "mean_product_volume_cm3": safe_divide(F.sum("volume"), F.sum("volume_n")),
        "total_product_volume_cm3": F.coalesce(F.sum("volume"), F.lit(0.0)),
        "category_count": F.count("category"),
        "mean_product_photos": safe_divide(F.sum("photos"), F.sum("photos_n")),
    }


def _dominant(category: str) -> Column:
    """Most frequent category; ties go to the first name."""
    return F.min(F.struct((-F.col("n")).alias("rank"), F.col(category).alias("name")))["name"]


_ATTRIBUTES = ["product_weight_g", "product_volume_cm3", "product_photos_qty"]


def _pairs_with_product(items: DataFrame, products: DataFrame, translation: DataFrame, category: str = "category",
                        attributes: Sequence[str] = ()) -> DataFrame:
    """(order, product) rows with what is asked of the product, all rows of an order in one place."""
    parts = _parts(items)
    pairs = _pairs(items.select("order_id", "product_id"), "product_id", parts, [F.count(F.lit(1)).alias("lines")])
    lines = _with_product(pairs, products, translation).select("order_id", category, "lines", *attributes)
    return lines.repartition(parts, "order_id")


def order_product_features(items: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    lines = _pairs_with_product(items, products, translation, attributes=_ATTRIBUTES)
    per_category = lines.groupBy("order_id", "category").agg(*_weighted(lines))
    return per_category.groupBy("order_id").agg(*[c.alias(n) for n, c in _product_aggregates().items()])


def dominant_category(items: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    lines = _pairs_with_product(items, products, translation)
    per_category = lines.groupBy("order_id", "category").agg(F.sum("lines").alias("n"))
    return per_category.groupBy("order_id").agg(_dominant("category").alias("dominant_product_category"))


def dominant_category_eda(items: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    """Exploratory variant: an untranslated category is a group of its own, placed last on ties."""
    lines = _pairs_with_product(items, products, translation, "product_category_name_english")
    name = F.col("product_category_name_english")
    per_category = lines.groupBy("order_id", name).agg(F.sum("lines").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("rank"), name.isNull().alias("untranslated"), name.alias("name")))
    return per_category.groupBy("order_id").agg(best["name"].alias("dominant_category"))


def order_line_features(items: DataFrame, products: DataFrame, translation: DataFrame, parts: int | None = None) -> DataFrame:
    """Item and product features with the dominant category from one scan of the lines.

    (order, product) -> (order, category) -> order: the last two in the same place.
    """
    parts = parts or _parts(items)
    lines = _with_product(_per_product(items, parts), products, translation).select(
        "order_id", "category", F.col("product_id").isNotNull().cast("bigint").alias("products"), "lines", "item_ids", "price",
        "price_n", "top_price", "freight", *_ATTRIBUTES,
    ).repartition(parts, "order_id")
    per_category = lines.groupBy("order_id", "category").agg(
        *_weighted(lines),
        F.sum("products").alias("products"), F.sum("item_ids").alias("item_ids"), F.sum("price").alias("price"),
        F.sum("price_n").alias("price_n"), F.max("top_price").alias("top_price"), F.sum("freight").alias("freight"),
    )
    aggregates = {
        **_item_aggregates(F.sum("products")), **_product_aggregates(),
        "dominant_product_category": _dominant("category"),
    }
    return per_category.groupBy("order_id").agg(*[c.alias(n) for n, c in aggregates.items()])


def _located(entities: DataFrame, prefix: str, lookup: DataFrame) -> DataFrame:
    points = lookup.select(
        F.col(ZIP).alias(f"{prefix}_zip_code_prefix"),
        F.col("latitude").alias(f"{prefix}_latitude"),
        F.col("longitude").alias(f"{prefix}_longitude"),
    )
    return entities.select(f"{prefix}_id", f"{prefix}_zip_code_prefix", f"{prefix}_state").join(
        points, f"{prefix}_zip_code_prefix", "left"
    )


def order_customer(orders: DataFrame, customers: DataFrame, lookup: DataFrame) -> DataFrame:
    """Customer state and coordinates of each order."""
    return (
        orders.select("order_id", "customer_id")
        .join(_located(customers, "customer", lookup), "customer_id", "left")
        .select("order_id", "customer_state", "customer_latitude", "customer_longitude")
    )


def seller_geo(sellers: DataFrame, lookup: DataFrame) -> DataFrame:
    return _located(sellers, "seller", lookup)


def order_seller_distance(
    items: DataFrame, orders: DataFrame, customers: DataFrame, sellers: DataFrame, lookup: DataFrame
) -> DataFrame:
    """Order lines with the seller-to-customer distance and a same-state flag."""
    lines = items.select("order_id", "order_item_id", "seller_id")
    rows = lines.join(order_customer(orders, customers, lookup), "order_id").join(seller_geo(sellers, lookup), "seller_id", "left")
    return _distances(rows, lines.columns)


def _distances(rows: DataFrame, kept: Sequence[str]) -> DataFrame:
    return rows.select(
        *kept,
        "customer_state",
        "seller_state",
        haversine_km("customer_latitude", "customer_longitude", "seller_latitude", "seller_longitude").alias(
            "distance_km"
        ),
        equal_flag("customer_state", "seller_state").alias("same_state"),
    )


def _seller_aggregates(pairs: DataFrame) -> DataFrame:
    by_state = pairs.groupBy("order_id", "seller_state").agg(
        F.count("seller_id").alias("sellers"),
        F.sum(F.col("distance_km") * F.col("lines")).alias("km"),
        F.sum(F.when(F.col("distance_km").isNotNull(), F.col("lines"))).alias("km_lines"),
        F.max("distance_km").alias("far"),
        F.min("distance_km").alias("near"),
        F.min("same_state").alias("same"),
        F.sum(F.col("same_state") * F.col("lines")).alias("same_lines"),
        F.sum("lines").alias("lines"),
    )
    return by_state.groupBy("order_id").agg(
        F.sum("sellers").alias("seller_count"),
        F.count("seller_state").alias("seller_state_count"),
        safe_divide(F.sum("km"), F.sum("km_lines")).alias("mean_distance_km"),
        F.max("far").alias("max_distance_km"),
        F.min("near").alias("min_distance_km"),
        F.min("same").alias("all_sellers_same_state"),
        safe_divide(F.sum("same_lines"), F.sum("lines")).alias("same_state_seller_share"),
    )


def order_seller_features(
    items: DataFrame, orders: DataFrame, customers: DataFrame, sellers: DataFrame, lookup: DataFrame, parts: int | None = None
) -> DataFrame:
    """Seller count and distance summary per order.

    Lines are first counted per (order, seller) and located there: repeated sellers are located once, and a hot order has
    one row for each of its sellers when it is brought together.
    """
    parts = parts or _parts(items)
    pairs = _per_seller(items, parts).join(_salted(seller_geo(sellers, lookup)), ["seller_id", _SALT], "left")
    located = ["order_id", "seller_id", "seller_state", "seller_latitude", "seller_longitude"]
    # one row each already; a join right after a shuffle would place the rows anew, by the session's number of partitions
    placed = pairs.select(*located, "lines").repartition(parts, "order_id").groupBy(*located).agg(F.sum("lines").alias("lines"))
    rows = placed.join(order_customer(orders, customers, lookup), "order_id")
    return _seller_aggregates(_distances(rows, ["order_id", "seller_id", "lines"]))


def distance_features(
    items: DataFrame, orders: DataFrame, customers: DataFrame, sellers: DataFrame, lookup: DataFrame
) -> DataFrame:
    return order_seller_features(items, orders, customers, sellers, lookup).drop("seller_count")


def calendar_features(ts: Column) -> dict[str, Column]:
    month, weekday, hour = F.month(ts), F.weekday(ts), F.hour(ts)  # weekday: Monday is 0
    month_sin, month_cos = cycle(month - F.lit(1), 12)
    weekday_sin, weekday_cos = cycle(weekday, 7)
    hour_sin, hour_cos = cycle(hour, 24)
    return {
        "purchase_year": F.year(ts),
        "purchase_month": month,
        "purchase_weekday": weekday,
        "purchase_hour": hour,
        "purchase_is_weekend": (weekday >= 5).cast("int"),
        "purchase_month_sin": month_sin,
        "purchase_month_cos": month_cos,
        "purchase_weekday_sin": weekday_sin,
        "purchase_weekday_cos": weekday_cos,
        "purchase_hour_sin": hour_sin,
        "purchase_hour_cos": hour_cos,
    }


def lag_features() -> dict[str, Column]:
    return {
        "approval_lag_hours": hours_between("order_approved_at", "order_purchase_timestamp"),
        "promised_delivery_days": days_between("order_estimated_delivery_date", "order_approved_at"),
    }


def order_base(cleaned: DataFrame) -> DataFrame:
    """Calendar and lag features of each cleaned order; the approval is the prediction moment."""
    require_columns(cleaned, [
        "order_id", "customer_id", "order_purchase_timestamp", "order_approved_at", "order_estimated_delivery_date",
        TARGET,
    ], "orders")
    derived = {**calendar_features(F.col("order_purchase_timestamp")), **lag_features()}
    return cleaned.select(
        "order_id",
        F.col("order_approved_at").alias(PREDICTION_TS),
        *[c.alias(name) for name, c in derived.items()],
        TARGET,
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def require_unique(tables: dict[str, tuple[DataFrame, str]]) -> None:
    """One job over all tables: a key that occurs twice would multiply rows in the joins to come."""
    keys = None
    for name, (df, key) in tables.items():
        rows = df.select(F.lit(name).alias("table"), F.col(key).cast("string").alias("key")).filter(F.col("key").isNotNull())
        keys = rows if keys is None else keys.unionByName(rows)
    clash = duplicate_keys(keys, ["table", "key"]).limit(1).collect()
    if clash:
        raise ContractError(f"{clash[0]['table']} is not unique on {tables[clash[0]['table']][1]}: {clash[0]['key']}")


def validated_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", validate: str = "many_to_one"
) -> DataFrame:
    """Join that refuses keys which would multiply rows.

    ``many_to_one`` needs unique keys on the right, ``one_to_many`` on the left, ``one_to_one`` on both.
    """
    checked = {"many_to_one": [("right", right)], "one_to_many": [("left", left)],
               "one_to_one": [("left", left), ("right", right)]}
    if validate not in checked:
        raise ContractError(f"unknown cardinality: {validate}")
    for side, df in checked[validate]:
        clash = duplicate_keys(df.filter(F.col(on[0]).isNotNull()), on).limit(1).collect()
        if clash:
            raise ContractError(f"{side} side is not unique on {list(on)}: {clash[0].asDict()}")
    return left.join(right, list(on), how)


def feature_table(
    orders_cleaned: DataFrame,
    customers: DataFrame,
    order_items: DataFrame,
    payments: DataFrame,
    products: DataFrame,
    sellers: DataFrame,
    geolocation: DataFrame,
    category_translation: DataFrame,
) -> DataFrame:
    """The 44-column table: id, prediction moment, 41 features and the target."""
    require_unique({"orders": (orders_cleaned, "order_id"), "customers": (customers, "customer_id"),
                    "products": (products, "product_id"), "sellers": (sellers, "seller_id"),
                    "category_translation": (category_translation, "product_category_name")})
    lookup = geo_lookup(geolocation)
    require_columns(order_items, _ITEM_COLUMNS, "order_items")
    count = _parts(order_items, payments)  # one for all, so that no part is shuffled again to meet the others
    parts = [
        order_line_features(order_items, products, category_translation, count),
        order_payment_features(payments, count),
        orders_cleaned.select("order_id", "customer_id")
        .join(customers.select("customer_id", "customer_state"), "customer_id", "left")
        .select("order_id", "customer_state"),
        order_seller_features(order_items, orders_cleaned, customers, sellers, lookup, count),
    ]
    table = order_base(orders_cleaned)
    for part in parts:
        table = table.join(part, "order_id", "left")
    return table.select(ORDER_KEY, PREDICTION_TS, *MODEL_FEATURES, TARGET)


def validate_features(features: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """Rule violations of a feature table: grain, target, timestamps, promise and contract."""
    require_columns(features, [ORDER_KEY, PREDICTION_TS, TARGET, "promised_delivery_days"], "features")
    missing = [c for c in MODEL_FEATURES if c not in features.columns]
    leaked = [c for c in FORBIDDEN_FEATURES if c in features.columns and c != "customer_id"]
    registered = [c for c in FORBIDDEN_FEATURES if c in MODEL_FEATURES]
    target, promise = F.col(TARGET), F.col("promised_delivery_days")
    broken = {
        "target_is_binary": ~F.coalesce(target.isin(0, 1), F.lit(False)),
        "prediction_timestamp_present": F.col(PREDICTION_TS).isNull(),
        "promise_is_not_negative": promise < 0,
    }
    agg = features.agg(F.count(F.lit(1)).alias("_rows"), *[flag_count(c).alias(r) for r, c in broken.items()])
    rows = [{"rule": F.lit(r), "violations": F.col(r)} for r in broken]
    rows += [
        {"rule": F.lit("contract_columns_present"), "violations": F.lit(len(missing)).cast("bigint")},
        {"rule": F.lit("no_forbidden_feature_registered"), "violations": F.lit(len(registered)).cast("bigint")},
        {"rule": F.lit("no_forbidden_column_present"), "violations": F.lit(len(leaked)).cast("bigint")},
    ]
    if expected_rows is not None:
        rows.append({"rule": F.lit("row_count_as_expected"),
                     "violations": F.abs(F.col("_rows") - F.lit(expected_rows))})
    unique = repeated_rows(features, [ORDER_KEY]).select(F.lit("order_id_is_unique").alias("rule"), "violations")
    return unique.unionByName(_rows_from_aggregate(agg, rows))


def leakage_audit(table: DataFrame) -> DataFrame:
    """Each forbidden column: is it registered as a feature, is it in the table, and how many values it has."""
    spark = table.sparkSession
    forbidden = spark.createDataFrame([(c, c in MODEL_FEATURES) for c in FORBIDDEN_FEATURES],
                                      "column string, registered boolean")
    present = [c for c in FORBIDDEN_FEATURES if c in table.columns]
    agg = table.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in present])
    found = _rows_from_aggregate(agg, [
        {"column": F.lit(c), "present": F.lit(True), "values": F.col(c)} for c in present
    ]) if present else spark.createDataFrame([], "column string, present boolean, values bigint")
    return forbidden.join(found, "column", "left").select(
        "column", "registered", F.coalesce("present", F.lit(False)).alias("present"),
        F.coalesce("values", F.lit(0)).cast("bigint").alias("values"),
    )


def feature_contract(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i, c, "numeric" if c in NUMERIC_FEATURES else "categorical") for i, c in enumerate(MODEL_FEATURES, 1)],
        "position int, feature string, type string",
    )


def feature_coverage(features: DataFrame) -> DataFrame:
    """The feature contract with the present values of each feature in a table."""
    agg = features.agg(*[F.count(c).alias(c) for c in MODEL_FEATURES])
    counts = _rows_from_aggregate(agg, [{"feature": F.lit(c), "present_rows": F.col(c)} for c in MODEL_FEATURES])
    return feature_contract(features.sparkSession).join(counts, "feature")


def model_matrix(features: DataFrame) -> DataFrame:
    """The 41 model columns, in contract order."""
    return require_columns(features, MODEL_FEATURES, "features").select(*MODEL_FEATURES)

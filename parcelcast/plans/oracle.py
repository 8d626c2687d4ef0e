"""The registered queries again as SQL over the same tables, for checking results on another engine."""

from __future__ import annotations

from parcelcast import contracts as K
from parcelcast.operators.evaluation import LOG_LOSS_EPS, TABLE_THRESHOLDS, sweep_thresholds
from parcelcast.operators.training import model_registry, search_configs
from parcelcast.plans import catalog as C
from parcelcast.sources.standins import RAW_TABLES, VIEWS

ORACLES: dict[str, str] = {}


def r(expr: str, name: str) -> str:
    """A double result rounded like the query's: to 12 digits, then as a decimal to 6."""
    return f"CAST(round(CAST(CAST({expr} AS DOUBLE) AS DECIMAL(30, 12)), 6) AS DOUBLE) AS {name}"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def pct(a: str, b: str) -> str:
    return f"({div(a, b)} * CAST(100 AS DOUBLE))"


def big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _seconds(later: str, earlier: str) -> str:
    return f"(CAST(epoch_us({later}) - epoch_us({earlier}) AS DOUBLE) / CAST(1000000 AS DOUBLE))"


def _cycle(position: str, period: int) -> str:
    return f"CAST(2 AS DOUBLE) * pi() * CAST({position} AS DOUBLE) / CAST({period} AS DOUBLE)"


def _quantile(column: str, p: float) -> str:
    return f"quantile_cont({column}, {dbl(p)})"


def _haversine(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    return (
        f"CAST(2 * 6371.0088 AS DOUBLE) * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lng2}) - radians({lng1})) / 2), 2)))"
    )


_TS = "order_purchase_timestamp"
_CALENDAR = {
    "purchase_year": f"CAST(year({_TS}) AS INT)", "purchase_month": f"CAST(month({_TS}) AS INT)",
    "purchase_weekday": f"CAST(isodow({_TS}) - 1 AS INT)", "purchase_hour": f"CAST(hour({_TS}) AS INT)",
    "purchase_is_weekend": f"CAST(isodow({_TS}) >= 6 AS INT)",
    "purchase_month_sin": f"sin({_cycle(f'month({_TS}) - 1', 12)})",
    "purchase_month_cos": f"cos({_cycle(f'month({_TS}) - 1', 12)})",
    "purchase_weekday_sin": f"sin({_cycle(f'isodow({_TS}) - 1', 7)})",
    "purchase_weekday_cos": f"cos({_cycle(f'isodow({_TS}) - 1', 7)})",
    "purchase_hour_sin": f"sin({_cycle(f'hour({_TS})', 24)})",
    "purchase_hour_cos": f"cos({_cycle(f'hour({_TS})', 24)})",
}
_LAGS = {
    "approval_lag_hours": f"{_seconds('order_approved_at', _TS)} / CAST(3600 AS DOUBLE)",
    "promised_delivery_days": f"{_seconds('order_estimated_delivery_date', 'order_approved_at')} / CAST(86400 AS DOUBLE)",
}
_CALENDAR_INTS = {c for c in _CALENDAR if not c.endswith(("_sin", "_cos"))}
_INT_FEATURES = _CALENDAR_INTS | {
    "item_count", "unique_products", "seller_count", "payment_records", "max_installments", "payment_type_count",
    "category_count", "seller_state_count", "all_sellers_same_state",
}
_ELIGIBLE = (
    "order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL AND order_approved_at IS NOT NULL AND "
    "order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL AND "
    "order_estimated_delivery_date >= order_approved_at"
)
_PRODUCT_AGG = (
    "avg(product_weight_g) AS mean_product_weight_g, coalesce(sum(product_weight_g), 0) AS total_product_weight_g, "
    "avg(product_volume_cm3) AS mean_product_volume_cm3, coalesce(sum(product_volume_cm3), 0) AS total_product_volume_cm3, "
    "count(DISTINCT category) AS category_count, avg(product_photos_qty) AS mean_product_photos"
)

# name -> (views it reads, SQL)
CTES: dict[str, tuple[tuple[str, ...], str]] = {name: ((), v.sql()) for name, v in VIEWS.items()}
CTES |= {
    "orders_cleaned": (("orders_raw",), (
        "SELECT *, CAST(order_delivered_customer_date > order_estimated_delivery_date AS INT) AS late_delivery, "
        f"{_seconds('order_delivered_customer_date', 'order_estimated_delivery_date')} / CAST(86400 AS DOUBLE) "
        f"AS delivery_delay_days FROM orders_raw WHERE {_ELIGIBLE}")),
    "geo_lookup": (("geolocation",), (
        "SELECT geolocation_zip_code_prefix, quantile_cont(geolocation_lat, 0.5) AS latitude, "
        "quantile_cont(geolocation_lng, 0.5) AS longitude FROM (SELECT DISTINCT geolocation_zip_code_prefix, "
        "geolocation_lat, geolocation_lng FROM geolocation) GROUP BY 1")),
    "item_features": (("order_items",), (
        "SELECT *, total_price + total_freight AS order_total_value, "
        f"round({div('total_freight', '(total_price + total_freight)')}, 12) AS freight_ratio FROM (SELECT order_id, "
        "count(order_item_id) AS item_count, count(DISTINCT product_id) AS unique_products, "
        "count(DISTINCT seller_id) AS seller_count, sum(price) AS total_price, sum(freight_value) AS total_freight, "
        "avg(price) AS mean_item_price, max(price) AS max_item_price FROM order_items GROUP BY order_id)")),
    "payment_features": (("payments",), (
        "SELECT order_id, count(payment_sequential) AS payment_records, sum(payment_value) AS payment_value, "
        "max(payment_installments) AS max_installments, count(DISTINCT payment_type) AS payment_type_count "
        "FROM payments GROUP BY order_id")),
    "primary_payment": (("payments",), (
        "SELECT order_id, payment_type AS primary_payment_type FROM (SELECT *, row_number() OVER (PARTITION BY order_id "
        "ORDER BY payment_sequential, payment_value, payment_type, payment_installments) AS rn FROM payments) WHERE rn = 1")),
    "item_products": (("order_items", "products", "category_translation"), (
        "SELECT i.order_id, i.product_id, p.product_category_name, t.product_category_name_english, "
        "p.product_photos_qty, p.product_weight_g, "
        "p.product_length_cm * p.product_height_cm * p.product_width_cm AS product_volume_cm3, "
        "coalesce(t.product_category_name_english, 'unknown') AS category FROM order_items i "
        "LEFT JOIN products p ON i.product_id = p.product_id "
        "LEFT JOIN category_translation t ON p.product_category_name = t.product_category_name")),
    "product_features": (("item_products",), f"SELECT order_id, {_PRODUCT_AGG} FROM item_products GROUP BY order_id"),
    "dominant_category": (("item_products",), (
        "SELECT order_id, category AS dominant_product_category FROM (SELECT order_id, category, row_number() OVER "
        "(PARTITION BY order_id ORDER BY count(*) DESC, category) AS rn FROM item_products GROUP BY order_id, category) "
        "WHERE rn = 1")),
    "dominant_category_eda": (("item_products",), (
        "SELECT order_id, c AS dominant_category FROM (SELECT order_id, product_category_name_english AS c, row_number() "
        "OVER (PARTITION BY order_id ORDER BY count(*) DESC, product_category_name_english ASC NULLS LAST) AS rn "
        "FROM item_products GROUP BY order_id, product_category_name_english) WHERE rn = 1")),
    "order_customer": (("orders_cleaned", "customers", "geo_lookup"), (
        "SELECT o.order_id, c.customer_state, g.latitude AS customer_latitude, g.longitude AS customer_longitude "
        "FROM orders_cleaned o LEFT JOIN customers c ON o.customer_id = c.customer_id "
        "LEFT JOIN geo_lookup g ON c.customer_zip_code_prefix = g.geolocation_zip_code_prefix")),
    "seller_geo": (("sellers", "geo_lookup"), (
        "SELECT s.seller_id, s.seller_zip_code_prefix, s.seller_state, g.latitude AS seller_latitude, "
        "g.longitude AS seller_longitude FROM sellers s LEFT JOIN geo_lookup g "
        "ON s.seller_zip_code_prefix = g.geolocation_zip_code_prefix")),
    "distance_rows": (("order_items", "order_customer", "seller_geo"), (
        "SELECT i.order_id, i.order_item_id, i.seller_id, o.customer_state, s.seller_state, "
        + _haversine("o.customer_latitude", "o.customer_longitude", "s.seller_latitude", "s.seller_longitude")
        + " AS distance_km, CAST(coalesce(o.customer_state = s.seller_state, false) AS INT) AS same_state "
        "FROM order_items i JOIN order_customer o ON i.order_id = o.order_id "
        "LEFT JOIN seller_geo s ON i.seller_id = s.seller_id")),
    "distance_features": (("distance_rows",), (
        "SELECT order_id, count(DISTINCT seller_state) AS seller_state_count, avg(distance_km) AS mean_distance_km, "
        "max(distance_km) AS max_distance_km, min(distance_km) AS min_distance_km, "
        "min(same_state) AS all_sellers_same_state, avg(same_state) AS same_state_seller_share "
        "FROM distance_rows GROUP BY order_id")),
    "order_base": (("orders_cleaned",), (
        "SELECT order_id, order_approved_at AS prediction_timestamp, "
        + ", ".join(f"{e} AS {n}" for n, e in {**_CALENDAR, **_LAGS}.items())
        + ", late_delivery FROM orders_cleaned")),
    "features": (
        ("order_base", "item_features", "payment_features", "primary_payment", "product_features", "dominant_category",
         "order_customer", "distance_features"),
        "SELECT order_id, prediction_timestamp, " + ", ".join(K.MODEL_FEATURES) + ", late_delivery FROM order_base "
        "LEFT JOIN item_features USING (order_id) LEFT JOIN payment_features USING (order_id) "
        "LEFT JOIN primary_payment USING (order_id) LEFT JOIN product_features USING (order_id) "
        "LEFT JOIN dominant_category USING (order_id) LEFT JOIN order_customer USING (order_id) "
        "LEFT JOIN distance_features USING (order_id)"),
    "split": (("features",), (
        "SELECT *, CASE WHEN row_num <= floor(n * CAST('0.7' AS DOUBLE)) THEN 'train' "
        f"WHEN row_num <= floor(n * {dbl(0.70 + 0.15)}) THEN 'validation' ELSE 'test' END AS split FROM (SELECT *, "
        "row_number() OVER (ORDER BY prediction_timestamp, order_id) AS row_num, CAST(count(*) OVER () AS DOUBLE) AS n "
        "FROM features)")),
    "scored": (("orders_cleaned",), (
        "SELECT order_id, order_approved_at AS prediction_timestamp, late_delivery, "
        "CAST(((order_id*7919) % 800 + 200*late_delivery)/1000.0 AS DOUBLE) AS probability FROM orders_cleaned")),
    "ranked": (("scored",), (
        "SELECT *, row_number() OVER (ORDER BY prediction_timestamp, order_id) AS row_num FROM scored")),
    "scored_split": (("ranked",), (
        "SELECT *, CASE WHEN row_num <= floor(n * CAST('0.7' AS DOUBLE)) THEN 'train' "
        f"WHEN row_num <= floor(n * {dbl(0.70 + 0.15)}) THEN 'validation' ELSE 'test' END AS split FROM (SELECT *, "
        "CAST(count(*) OVER () AS DOUBLE) AS n FROM ranked)")),
    "folds": (("ranked",), (
        "SELECT CAST(k AS INT) AS fold, s + (k - 1) * ((n - s) // 4) + least(k - 1, (n - s) % 4) AS train_end, "
        "s + k * ((n - s) // 4) + least(k, (n - s) % 4) AS validation_end FROM (SELECT count(*) AS n, "
        "CAST(floor(count(*) * CAST('0.5' AS DOUBLE)) AS BIGINT) AS s FROM ranked), range(1, 5) t(k)")),
    "members": (("ranked", "folds"), (
        "SELECT r.*, f.fold, CASE WHEN row_num <= train_end THEN 'train' ELSE 'validation' END AS role "
        "FROM ranked r JOIN folds f ON r.row_num <= f.validation_end")),
    "fold_scores": (("members",), " UNION ALL ".join(
        f"SELECT late_delivery, fold, '{config}' AS config_id, '{family}' AS model_family, "
        f"CAST(((order_id*{a}) % {b} + {c}*late_delivery)/1000.0 AS DOUBLE) AS probability FROM members "
        "WHERE role = 'validation'" for config, family, a, b, c in C.SCORE_VARIANTS)),
    "log": ((), (
        "SELECT *, CASE WHEN score <= 0.20 THEN 'low' WHEN score <= 0.40 THEN 'medium' WHEN score <= 0.60 THEN 'high' "
        "ELSE 'critical' END AS risk_band, score >= 0.50 AS requires_review FROM (SELECT ts, event_id - CAST(event_id % 4 = 3 AS INT) AS request_id, "
        "CAST(event_id % 4 = 3 AS INT) AS prediction_index, event_type = 'error' AS failed, value / (value + CAST(50 AS DOUBLE)) AS score, "
        "CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS missing_features, value AS latency_ms FROM events)")),
}


def needed(names) -> list[str]:
    """Views in an order in which each follows what it reads."""
    out: list[str] = []

    def visit(name: str) -> None:
        for dep in CTES[name][0]:
            visit(dep)
        if name not in out:
            out.append(name)

    for name in names:
        visit(name)
    return out


def put(key: str, reads: str, body: str) -> None:
    views = needed(reads.split())
    head = "WITH " + ", ".join(f"{name} AS ({CTES[name][1]})" for name in views) + " " if views else ""
    ORACLES[key] = head + body


def rounded(columns, ints=()) -> str:
    return ", ".join(c if c in ints else r(c, c) for c in columns)


def _describe(value: str, suffix: str = "") -> str:
    return ", ".join([
        f"count({value}) AS count", r(f"avg({value})", "mean"), r(f"stddev_samp({value})", "std"),
        r(f"min({value})", "min"), r(_quantile(value, 0.25), "q25"), r(_quantile(value, 0.5), "median"),
        r(_quantile(value, 0.75), "q75"), r(f"max({value})", "max"),
    ])


# --- sources and sinks ---------------------------------------------------------------------------------------

put("scan_csv", "order_items", (
    "SELECT order_item_id, count(*) AS items, count(DISTINCT order_id) AS orders, "
    + r("min(price)", "min_price") + ", " + r("max(price)", "max_price") + ", " + r("avg(freight_value)", "mean_freight")
    + ", max(shipping_limit_date) AS last_limit FROM order_items GROUP BY order_item_id"))
put("scan_parquet", "", (
    "SELECT o_orderkey, " + r("o_totalprice", "o_totalprice") + ", o_orderdate FROM orders"))
put("sink_parquet", "split", (
    "SELECT order_id, prediction_timestamp, " + r("total_price", "total_price")
    + ", customer_state, late_delivery, split FROM split"))
_SPLIT_SUMMARY = (
    'SELECT split, count(*) AS rows, min(prediction_timestamp) AS "start", max(prediction_timestamp) AS "end", '
    + r("avg(late_delivery)", "late_rate") + " FROM split GROUP BY split")
put("sink_csv_report", "split", _SPLIT_SUMMARY)
put("json_metadata", "scored", (
    "SELECT 'stand_in_01' AS candidate, count(*) AS rows, " + r("avg(late_delivery)", "prevalence") + ", "
    + r(_quantile("probability", 0.5), "low_max") + ", " + r(_quantile("probability", 0.8), "medium_max") + ", "
    + r(_quantile("probability", 0.95), "high_max") + " FROM scored"))
put("require_columns", "features", "SELECT count(*) AS rows FROM features")

# --- profiling -----------------------------------------------------------------------------------------------

_COLUMNS = {name: [c for c, _ in VIEWS[name].columns] for name in RAW_TABLES}
_ALL_RAW = " ".join(RAW_TABLES)
put("dataset_overview", _ALL_RAW, " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, count(*) AS rows, CAST({len(_COLUMNS[t])} AS INT) AS columns FROM {t}" for t in RAW_TABLES))


def _missing(view: str, columns, where: str = "") -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, "
        + r(pct(f"count(*) - count({c})", "count(*)"), "missing_pct") + f" FROM {view}" for c in columns)
    return f"SELECT * FROM ({rows}) {where}"


put("missing_report", "orders_raw", _missing("orders_raw", _COLUMNS["orders_raw"], "WHERE missing_count > 0"))
put("missing_report_features", "features", _missing("features", K.MODEL_FEATURES))
put("duplicate_report", _ALL_RAW, " UNION ALL ".join(
    f"SELECT '{t}' AS dataset, (SELECT count(*) FROM {t}) AS rows, (SELECT count(*) FROM {t}) - "
    f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {t})) AS exact_duplicate_rows" for t in RAW_TABLES))
put("key_check", _ALL_RAW, " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", '{' + '.join(k)}' AS candidate_key, a.n AS rows, b.n AS unique_keys, "
    f"a.n - b.n AS duplicate_key_rows, a.n = b.n AS is_unique FROM (SELECT count(*) AS n FROM {t}) a, "
    f"(SELECT count(*) AS n FROM (SELECT DISTINCT {', '.join(k)} FROM {t})) b" for t, k in C.KEYS.items()))
put("foreign_key_check", _ALL_RAW, " UNION ALL ".join(
    f"SELECT '{ct}.{cc} -> {pt}.{pc}' AS relationship, (SELECT count({cc}) FROM {ct}) AS child_rows_non_null, "
    f"count({cc}) AS unknown_fk_rows, count(DISTINCT {cc}) AS unknown_fk_unique_values, count({cc}) = 0 AS integrity_ok "
    f"FROM {ct} WHERE {cc} IS NOT NULL AND {cc} NOT IN (SELECT {pc} FROM {pt} WHERE {pc} IS NOT NULL)"
    for ct, cc, pt, pc in C.RELATIONS))
put("customer_identity", "customers", (
    "SELECT count(*) AS rows, count(DISTINCT customer_id) AS distinct_customer_id, "
    "count(DISTINCT customer_unique_id) AS distinct_customer_unique_id, "
    "count(DISTINCT customer_id) = count(*) AS customer_id_is_unique, "
    "count(DISTINCT customer_unique_id) = count(*) AS customer_unique_id_is_unique FROM customers"))
put("records_per_entity", "order_items payments reviews geolocation", " UNION ALL ".join(
    f"SELECT '{t}' AS relation, {_describe('n')} FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM {t} GROUP BY {k})"
    for t, k in [("order_items", "order_id"), ("payments", "order_id"), ("reviews", "order_id"),
                 ("geolocation", "geolocation_zip_code_prefix")]))
put("records_per_entity_top", "order_items", (
    "SELECT order_id, count(*) AS records FROM order_items GROUP BY order_id ORDER BY records DESC, order_id LIMIT 10"))


def _describe_columns(view: str, columns) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {_describe(c)} FROM {view}" for c in columns)


put("numeric_describe", "products", _describe_columns("products", C.PRODUCT_NUMBERS))
put("numeric_describe_items", "order_items", _describe_columns("order_items", ["price", "freight_value"]))
put("numeric_sanity", "products order_items", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, count(*) FILTER ({c} = 0) AS zero_values, "
    f"count(*) FILTER ({c} < 0) AS negative_values FROM {t}"
    for t, cols in [("products", C.PRODUCT_NUMBERS), ("order_items", ["price", "freight_value"])] for c in cols))
put("value_counts", "products", (
    "SELECT product_category_name, count(*) AS count, " + r(pct("count(*)", "sum(count(*)) OVER ()"), "pct")
    + " FROM products GROUP BY product_category_name"))
put("parse_timestamps", "orders_raw", "SELECT order_id, " + ", ".join(
    f"CASE WHEN order_id % 5 <> 0 THEN {c} END AS {c}" for c in K.ORDER_TIMESTAMPS) + " FROM orders_raw")
put("date_ranges", "orders_raw", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", min({c}) AS \"min\", max({c}) AS \"max\", count(*) - count({c}) AS missing FROM orders_raw"
    for c in K.ORDER_TIMESTAMPS))
put("lifecycle_checks", "orders_raw", " UNION ALL ".join(
    f"SELECT '{rule}' AS \"check\", count(*) FILTER ({a} < {b}) AS affected_rows, "
    + r(pct(f"count(*) FILTER ({a} < {b})", "count(*)"), "affected_pct") + " FROM orders_raw"
    for rule, a, b in K.LIFECYCLE_RULES))
put("lifecycle_offenders", "orders_raw", (
    "SELECT * FROM (SELECT \"check\", order_id, order_status, " + ", ".join(K.ORDER_TIMESTAMPS)
    + ", CAST(row_number() OVER (PARTITION BY \"check\" ORDER BY order_id) AS INT) AS position FROM ("
    + " UNION ALL ".join(f"SELECT '{rule}' AS \"check\", * FROM orders_raw WHERE {a} < {b}"
                         for rule, a, b in K.LIFECYCLE_RULES) + ")) WHERE position <= 10"))
put("availability_by_status", "orders_raw", (
    "SELECT order_status, count(*) AS orders, count(order_delivered_customer_date) AS with_customer_delivery, "
    "count(order_estimated_delivery_date) AS with_estimated_delivery, count(order_approved_at) AS with_approval, "
    + r(pct("count(order_delivered_customer_date)", "count(*)"), "customer_delivery_pct") + ", "
    + r(pct("count(order_estimated_delivery_date)", "count(*)"), "estimated_delivery_pct")
    + " FROM orders_raw GROUP BY order_status"))
_KNOWN = "count(*) FILTER (order_delivered_customer_date IS NOT NULL AND order_estimated_delivery_date IS NOT NULL)"
_FEASIBLE = (f"count(*) AS orders, {_KNOWN} AS target_available, count(*) - {_KNOWN} AS target_unavailable, "
             + r(pct(_KNOWN, "count(*)"), "target_available_pct"))
put("target_feasibility", "orders_raw", (
    f"SELECT 'all' AS scope, NULL AS order_status, {_FEASIBLE} FROM orders_raw UNION ALL "
    f"SELECT 'status' AS scope, order_status, {_FEASIBLE} FROM orders_raw GROUP BY order_status"))
put("geo_variation", "geolocation", (
    "SELECT geolocation_zip_code_prefix, count(*) AS rows, count(DISTINCT geolocation_lat) AS unique_lat, "
    "count(DISTINCT geolocation_lng) AS unique_lng, count(DISTINCT geolocation_city) AS unique_city, "
    "count(DISTINCT geolocation_state) AS unique_state FROM geolocation GROUP BY 1 ORDER BY rows DESC, 1 LIMIT 20"))
put("registries", "orders_raw reviews", (
    "SELECT v.\"column\", v.role, v.available_at_prediction, coalesce(c.present, 0) AS present FROM (VALUES "
    + ", ".join(f"('{c}', '{role}', {str(a).lower()})" for c, role, a, _ in K.AVAILABILITY_REGISTRY)
    + ") v(\"column\", role, available_at_prediction) LEFT JOIN ("
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS present FROM {t}"
                         for t in ("orders_raw", "reviews") for c in _COLUMNS[t])
    + ") c ON v.\"column\" = c.\"column\""))
put("join_strategy", _ALL_RAW, (
    "SELECT v.\"table\", v.relationship_to_orders, v.pre_aggregation_needed, c.rows FROM (VALUES "
    + ", ".join(f"('{t}', '{rel}', {str(p).lower()})" for t, rel, p in K.JOIN_STRATEGY)
    + ") v(\"table\", relationship_to_orders, pre_aggregation_needed) LEFT JOIN ("
    + " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in RAW_TABLES)
    + ") c ON v.\"table\" = c.\"table\""))
put("cleaning_rules", "orders_raw", " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, '{action}' AS action, count(*) FILTER ({cond}) AS affected_rows FROM orders_raw"
    for rule, action, cond in K.CLEANING_RULES))
put("key_set_overlap", "orders_raw", (
    "SELECT order_id FROM orders_raw WHERE order_delivered_customer_date IS NULL INTERSECT "
    "SELECT order_id FROM orders_raw WHERE order_approved_at IS NULL"))

# --- cleaning and target -------------------------------------------------------------------------------------

put("status_filters", "orders_raw", " UNION ALL ".join(
    f"SELECT '{name}' AS cohort, order_id FROM orders_raw WHERE {cond}" for name, cond in [
        ("delivered", "order_status = 'delivered'"),
        ("delivered_without_delivery_time", "order_status = 'delivered' AND order_delivered_customer_date IS NULL"),
        ("delivered_without_approval", "order_status = 'delivered' AND order_approved_at IS NULL"),
        ("canceled_with_delivery_time", "order_status = 'canceled' AND order_delivered_customer_date IS NOT NULL"),
    ]))
put("invalid_promise", "orders_raw", "SELECT * FROM orders_raw WHERE order_estimated_delivery_date < order_approved_at")
put("eligible_orders", "orders_raw", f"SELECT * FROM orders_raw WHERE {_ELIGIBLE}")
put("eligibility_flags", "orders_raw", (
    "SELECT order_id, order_status = 'delivered' AS is_delivered, "
    "order_purchase_timestamp IS NOT NULL AS has_purchase_timestamp, order_approved_at IS NOT NULL AS has_prediction_point, "
    "order_delivered_customer_date IS NOT NULL AS has_actual_delivery, "
    "order_estimated_delivery_date IS NOT NULL AS has_estimated_delivery, "
    "coalesce(order_estimated_delivery_date >= order_approved_at, false) AS has_valid_promised_window, "
    f"coalesce({_ELIGIBLE}, false) AS eligible FROM orders_raw"))
_RULES = _ELIGIBLE.split(" AND ")
_STEPS = [("Raw orders", "true"), ("Delivered", _RULES[0])]
_STEPS += [(label, " AND ".join(_RULES[: i + 2])) for i, label in enumerate([
    "Delivered + purchase timestamp", "Delivered + prediction point", "Delivered + actual delivery",
    "Delivered + estimated delivery", "Delivered + valid promised window"])]
_STEPS.append(("Final eligible population", _ELIGIBLE))
put("population_funnel", "orders_raw", " UNION ALL ".join(
    f"SELECT CAST({i} AS INT) AS position, '{label}' AS step, count(*) FILTER ({cond}) AS orders, "
    + r(pct(f"count(*) FILTER ({cond})", "count(*)"), "retained_pct") + " FROM orders_raw"
    for i, (label, cond) in enumerate(_STEPS)))
put("late_label", "orders_cleaned", "SELECT order_id, late_delivery FROM orders_cleaned")
put("delay_days", "orders_cleaned", "SELECT order_id, " + r("delivery_delay_days", "delivery_delay_days") + " FROM orders_cleaned")
put("target_distribution", "orders_cleaned", (
    "SELECT CASE WHEN late_delivery = 1 THEN 'late' ELSE 'on_time' END AS target, count(*) AS count, "
    + r(pct("count(*)", "sum(count(*)) OVER ()"), "pct") + " FROM orders_cleaned GROUP BY late_delivery"))
_ANOMALY_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS anomaly, {_seconds(later, earlier)} / CAST(3600 AS DOUBLE) AS gap_hours, order_id, late_delivery "
    f"FROM orders_cleaned WHERE {earlier} < {later}" for name, later, earlier in [
        ("carrier_before_approval", "order_approved_at", "order_delivered_carrier_date"),
        ("delivery_before_carrier", "order_delivered_carrier_date", "order_delivered_customer_date"),
    ])
_GAP = "anomaly, " + r("gap_hours", "gap_hours") + ", order_id, late_delivery"
put("anomaly_detail", "orders_cleaned", f"SELECT {_GAP} FROM ({_ANOMALY_ROWS})")
put("anomaly_summary", "orders_cleaned", f"SELECT anomaly, {_describe('gap_hours')} FROM ({_ANOMALY_ROWS}) GROUP BY anomaly")
put("anomaly_top", "orders_cleaned", (
    f"SELECT {_GAP} FROM (SELECT * FROM ({_ANOMALY_ROWS}) WHERE anomaly = 'carrier_before_approval' "
    "ORDER BY gap_hours DESC, order_id LIMIT 20)"))
put("invariant_check", "orders_cleaned", (
    "SELECT 'order_id_is_unique' AS rule, count(*) - count(DISTINCT order_id) AS violations FROM orders_cleaned UNION ALL "
    + " UNION ALL ".join(f"SELECT '{rule}' AS rule, count(*) FILTER ({cond}) AS violations FROM orders_cleaned" for rule, cond in [
        ("order_status_is_delivered", "order_status <> 'delivered'"),
        ("purchase_timestamp_present", "order_purchase_timestamp IS NULL"),
        ("approval_present", "order_approved_at IS NULL"),
        ("actual_delivery_present", "order_delivered_customer_date IS NULL"),
        ("estimated_delivery_present", "order_estimated_delivery_date IS NULL"),
        ("target_is_binary", "late_delivery NOT IN (0, 1)"),
        ("approval_not_before_purchase", "order_approved_at < order_purchase_timestamp"),
        ("delivery_not_before_purchase", "order_delivered_customer_date < order_purchase_timestamp"),
        ("promise_not_before_approval", "order_estimated_delivery_date < order_approved_at"),
        ("late_means_positive_delay", "late_delivery = 1 AND delivery_delay_days <= 0"),
        ("on_time_means_no_positive_delay", "late_delivery = 0 AND delivery_delay_days > 0"),
    ])))
put("clean_orders_job", "orders_cleaned", (
    "SELECT " + ", ".join(_COLUMNS["orders_raw"]) + ", late_delivery, " + r("delivery_delay_days", "delivery_delay_days")
    + " FROM orders_cleaned"))

# --- features ------------------------------------------------------------------------------------------------

put("safe_divide", "order_items", "SELECT order_id, order_item_id, " + r(div("price", "freight_value"), "price_per_freight") + " FROM order_items")
put("haversine_km", "geolocation", (
    "SELECT geolocation_zip_code_prefix, " + rounded(["geolocation_lat", "geolocation_lng"]) + ", "
    + r(_haversine("geolocation_lat", "geolocation_lng", "CAST(-23.5 AS DOUBLE)", "CAST(-46.6 AS DOUBLE)"), "km") + " FROM geolocation"))
_POINT = rounded(["latitude", "longitude"])
put("geo_lookup", "geo_lookup", f"SELECT geolocation_zip_code_prefix, {_POINT} FROM geo_lookup")
put("geo_lookup_raw", "geolocation", (
    "SELECT geolocation_zip_code_prefix, " + r("quantile_cont(geolocation_lat, 0.5)", "latitude") + ", "
    + r("quantile_cont(geolocation_lng, 0.5)", "longitude") + " FROM geolocation GROUP BY 1"))
_ITEM = ["item_count", "unique_products", "seller_count", "total_price", "total_freight", "mean_item_price",
         "max_item_price", "order_total_value", "freight_ratio"]
put("order_item_features", "item_features", f"SELECT order_id, {rounded(_ITEM, _INT_FEATURES)} FROM item_features")
_PAY = ["payment_records", "payment_value", "max_installments", "payment_type_count"]
put("payment_features", "payment_features", f"SELECT order_id, {rounded(_PAY, _INT_FEATURES)} FROM payment_features")
put("primary_payment", "primary_payment", "SELECT order_id, primary_payment_type FROM primary_payment")
put("order_payment_features", "payment_features primary_payment", (
    f"SELECT order_id, {rounded(_PAY, _INT_FEATURES)}, primary_payment_type FROM payment_features JOIN primary_payment USING (order_id)"))
put("product_enrichment", "item_products", (
    "SELECT product_id, order_id, product_category_name, product_category_name_english, "
    + rounded(["product_photos_qty", "product_weight_g", "product_volume_cm3"]) + ", category FROM item_products"))
_PROD = ["mean_product_weight_g", "total_product_weight_g", "mean_product_volume_cm3", "total_product_volume_cm3",
         "category_count", "mean_product_photos"]
put("order_product_features", "product_features", f"SELECT order_id, {rounded(_PROD, _INT_FEATURES)} FROM product_features")
put("dominant_category", "dominant_category", "SELECT * FROM dominant_category")
put("dominant_category_eda", "dominant_category_eda", "SELECT * FROM dominant_category_eda")
put("customer_geo", "order_customer", (
    "SELECT order_id, customer_state, " + rounded(["customer_latitude", "customer_longitude"]) + " FROM order_customer"))
put("seller_geo", "seller_geo", (
    "SELECT seller_zip_code_prefix, seller_id, seller_state, " + rounded(["seller_latitude", "seller_longitude"]) + " FROM seller_geo"))
put("order_seller_distance", "distance_rows", (
    "SELECT order_id, order_item_id, seller_id, customer_state, seller_state, " + r("distance_km", "distance_km")
    + ", same_state FROM distance_rows"))
_DIST = ["seller_state_count", "mean_distance_km", "max_distance_km", "min_distance_km", "all_sellers_same_state",
         "same_state_seller_share"]
put("distance_features", "distance_features", f"SELECT order_id, {rounded(_DIST, _INT_FEATURES)} FROM distance_features")
put("calendar_features", "orders_raw", "SELECT order_id, " + ", ".join(
    f"{e} AS {n}" if n in _CALENDAR_INTS else r(e, n) for n, e in _CALENDAR.items()) + " FROM orders_raw")
put("lag_features", "orders_raw", "SELECT order_id, " + ", ".join(r(e, n) for n, e in _LAGS.items()) + " FROM orders_raw")
put("order_base", "order_base", (
    "SELECT order_id, prediction_timestamp, " + rounded([*_CALENDAR, *_LAGS], _INT_FEATURES) + ", late_delivery FROM order_base"))
put("validated_join", "orders_cleaned customers", (
    "SELECT customer_id, order_id, customer_state FROM orders_cleaned LEFT JOIN customers USING (customer_id)"))
_MODEL = rounded(K.MODEL_FEATURES, set(K.CATEGORICAL_FEATURES))
put("feature_table", "features", f"SELECT order_id, prediction_timestamp, {_MODEL}, late_delivery FROM features")
put("validate_features", "features orders_cleaned", (
    "SELECT 'order_id_is_unique' AS rule, count(*) - count(DISTINCT order_id) AS violations FROM features UNION ALL "
    "SELECT 'target_is_binary', count(*) FILTER (late_delivery NOT IN (0, 1)) FROM features UNION ALL "
    "SELECT 'prediction_timestamp_present', count(*) FILTER (prediction_timestamp IS NULL) FROM features UNION ALL "
    "SELECT 'promise_is_not_negative', count(*) FILTER (promised_delivery_days < 0) FROM features UNION ALL "
    "SELECT 'contract_columns_present', CAST(0 AS BIGINT) UNION ALL "
    "SELECT 'no_forbidden_feature_registered', CAST(0 AS BIGINT) UNION ALL "
    "SELECT 'no_forbidden_column_present', CAST(0 AS BIGINT) UNION ALL "
    "SELECT 'row_count_as_expected', abs((SELECT count(*) FROM features) - (SELECT count(*) FROM orders_cleaned))"))
_CLEANED_COLUMNS = [*_COLUMNS["orders_raw"], "late_delivery", "delivery_delay_days"]
put("leakage_audit", "orders_cleaned", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {str(c in K.MODEL_FEATURES).lower()} AS registered, "
    + (f"true AS present, (SELECT count({c}) FROM orders_cleaned) AS values" if c in _CLEANED_COLUMNS
       else "false AS present, CAST(0 AS BIGINT) AS values") for c in K.FORBIDDEN_FEATURES))
put("feature_contract", "features", " UNION ALL ".join(
    f"SELECT CAST({i} AS INT) AS position, '{c}' AS feature, '{'numeric' if c in K.NUMERIC_FEATURES else 'categorical'}' AS type, "
    f"count({c}) AS present_rows FROM features" for i, c in enumerate(K.MODEL_FEATURES, 1)))
put("model_matrix", "features", f"SELECT {_MODEL} FROM features")
put("features_job", "split", _SPLIT_SUMMARY)

# --- exploratory reports -------------------------------------------------------------------------------------


def _rate(key: str, name: str, source: str, tail: str = "") -> str:
    return (f"SELECT {key} AS {name}, count(late_delivery) AS orders, " + r("avg(late_delivery)", "late_rate")
            + f" FROM {source} WHERE {key} IS NOT NULL GROUP BY {key} {tail}")


put("monthly_late_rate", "orders_cleaned", _rate(f"strftime({_TS}, '%Y-%m')", "purchase_month", "orders_cleaned"))
put("weekday_late_rate", "orders_cleaned", (
    "SELECT v.weekday, v.purchase_weekday, a.orders, a.late_rate FROM (VALUES "
    + ", ".join(f"(CAST({i} AS INT), '{w}')" for i, w in enumerate(["Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
                                                                  "Saturday", "Sunday"]))
    + ") v(weekday, purchase_weekday) LEFT JOIN (" + _rate(f"CAST(isodow({_TS}) - 1 AS INT)", "weekday", "orders_cleaned")
    + ") a ON v.weekday = a.weekday"))
put("hourly_late_rate", "orders_cleaned", _rate(f"CAST(hour({_TS}) AS INT)", "purchase_hour", "orders_cleaned"))
_STATES = "orders_cleaned LEFT JOIN customers USING (customer_id)"
put("state_late_rate", "orders_cleaned customers", _rate("customer_state", "customer_state", _STATES))
put("state_late_rate_reliable", "orders_cleaned customers", _rate("customer_state", "customer_state", _STATES, "HAVING count(late_delivery) >= 100"))
_ITEMS = "orders_cleaned LEFT JOIN item_features USING (order_id)"
put("item_count_late_rate", "orders_cleaned item_features", _rate("item_count", "item_count", _ITEMS, "ORDER BY item_count LIMIT 20"))
put("seller_count_late_rate", "orders_cleaned item_features", _rate("seller_count", "seller_count", _ITEMS))
put("payment_type_late_rate", "orders_cleaned primary_payment", _rate(
    "primary_payment_type", "payment_type", "orders_cleaned LEFT JOIN primary_payment USING (order_id)"))
put("category_late_rate", "orders_cleaned dominant_category_eda", _rate(
    "dominant_category", "dominant_category", "orders_cleaned LEFT JOIN dominant_category_eda USING (order_id)",
    "ORDER BY orders DESC, dominant_category LIMIT 20"))
put("same_state_late_rate", "orders_cleaned distance_features", _rate(
    "all_sellers_same_state", "all_sellers_same_state", "orders_cleaned LEFT JOIN distance_features USING (order_id)"))
put("describe_by_target", "features", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, late_delivery, {_describe(f'CAST({c} AS DOUBLE)')} FROM features WHERE {c} IS NOT NULL "
    "GROUP BY late_delivery" for c in C.DESCRIBED))
put("numeric_signal_summary", "features", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, " + r(f"avg({c}) FILTER (late_delivery = 0)", "on_time_mean") + ", "
    + r(f"avg({c}) FILTER (late_delivery = 1)", "late_mean") + f", count(*) - count({c}) AS missing, "
    + r(f"avg({c}) FILTER (late_delivery = 1) - avg({c}) FILTER (late_delivery = 0)", "mean_difference_late_minus_on_time")
    + " FROM features" for c in K.SIGNAL_FEATURES))


def _histogram(bins: int, where: str) -> str:
    return (
        f", rows AS (SELECT delivery_delay_days AS x FROM orders_cleaned {where}), "
        f"lim AS (SELECT min(x) AS lo, (max(x) - min(x)) / CAST({bins} AS DOUBLE) AS w FROM rows), "
        f"cnt AS (SELECT least(CAST(floor((x - lo) / w) AS INT), {bins - 1}) AS bin, count(*) AS n FROM rows, lim GROUP BY 1) "
        f"SELECT CAST(k AS INT) AS bin, " + r("lo + w * k", "bin_start") + ", CAST(coalesce(n, 0) AS BIGINT) AS orders "
        f"FROM range({bins}) t(k), lim LEFT JOIN cnt ON cnt.bin = k")


def put_with(key: str, reads: str, body: str) -> None:
    """Like ``put`` for a body that goes on with further views (it starts with a comma)."""
    views = needed(reads.split())
    ORACLES[key] = "WITH " + ", ".join(f"{name} AS ({CTES[name][1]})" for name in views) + body


put_with("delay_histogram", "orders_cleaned", _histogram(100, ""))
put_with("delay_histogram_zoom", "orders_cleaned", _histogram(80, "WHERE delivery_delay_days BETWEEN -40 AND 40"))
put("boxplot_stats", "features", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, late_delivery, " + r("any_value(q25)", "q25") + ", " + r("any_value(median)", "median") + ", "
    + r("any_value(q75)", "q75") + ", "
    + r("min(x) FILTER (x BETWEEN lo AND hi)", "whisker_low") + ", " + r("max(x) FILTER (x BETWEEN lo AND hi)", "whisker_high")
    + ", count(*) FILTER (NOT x BETWEEN lo AND hi) AS outliers FROM (SELECT *, "
    "q25 - (q75 - q25) * CAST(1.5 AS DOUBLE) AS lo, q75 + (q75 - q25) * CAST(1.5 AS DOUBLE) AS hi FROM ("
    f"SELECT late_delivery, {c} AS x, {_quantile(c, 0.25)} OVER (PARTITION BY late_delivery) AS q25, "
    f"{_quantile(c, 0.5)} OVER (PARTITION BY late_delivery) AS median, "
    f"{_quantile(c, 0.75)} OVER (PARTITION BY late_delivery) AS q75 FROM features WHERE {c} IS NOT NULL)) "
    "GROUP BY late_delivery" for c in C.BOXED))

# --- order, splits, folds ------------------------------------------------------------------------------------

put("chronological_order", "ranked", "SELECT order_id, prediction_timestamp, late_delivery, row_num FROM ranked")
put("chronological_split", "scored_split", "SELECT order_id, prediction_timestamp, late_delivery, row_num, split FROM scored_split")
put("split_summary", "split", _SPLIT_SUMMARY)
put("split_invariants", "split", (
    "SELECT 'splits_are_disjoint' AS rule, count(*) AS violations FROM (SELECT order_id FROM split GROUP BY order_id "
    "HAVING count(DISTINCT split) > 1) UNION ALL SELECT 'splits_are_in_time_order', count(*) FILTER (lo < prev) FROM "
    "(SELECT lo, lag(hi) OVER (ORDER BY k) AS prev FROM (SELECT CASE split WHEN 'train' THEN 1 WHEN 'validation' THEN 2 "
    "ELSE 3 END AS k, min(prediction_timestamp) AS lo, max(prediction_timestamp) AS hi FROM split GROUP BY 1)) UNION ALL "
    "SELECT 'every_row_has_a_split', count(*) FILTER (split NOT IN ('train', 'validation', 'test')) FROM split"))
put("development_union", "split", (
    "SELECT order_id, prediction_timestamp, late_delivery, row_number() OVER (ORDER BY prediction_timestamp, order_id) "
    "AS row_num FROM split WHERE split IN ('train', 'validation')"))
put("expanding_folds", "members", "SELECT order_id, row_num, fold, role FROM members")
put("fold_summary", "members", (
    "SELECT fold, " + ", ".join(f"count(*) FILTER (role = '{x}') AS {x}_rows" for x in ("train", "validation")) + ", "
    + ", ".join(f"{f}(prediction_timestamp) FILTER (role = '{x}') AS {x}_{n}" for x in ("train", "validation")
                for f, n in (("min", "start"), ("max", "end"))) + ", "
    + ", ".join(r(f"avg(late_delivery) FILTER (role = '{x}')", f"{x}_late_rate") for x in ("train", "validation"))
    + " FROM members GROUP BY fold"))
put("top_n", "scored", (
    "SELECT order_id, prediction_timestamp, late_delivery, " + r("probability", "probability")
    + " FROM (SELECT * FROM scored ORDER BY probability DESC, order_id LIMIT 12)"))

# --- evaluation ----------------------------------------------------------------------------------------------


def _curve(source: str, groups: str = "", where: str = "") -> str:
    """Views ``st`` and ``curve`` of a scored source, to be followed by a SELECT."""
    g = f"{groups}, " if groups else ""
    part = f"PARTITION BY {groups} " if groups else ""
    return (
        f", st AS (SELECT {g}probability AS s, CAST(sum(late_delivery) AS DOUBLE) AS pos, CAST(count(*) AS DOUBLE) AS n "
        f"FROM {source} {where} GROUP BY {g}probability), "
        f"curve AS (SELECT *, sum(pos) OVER ({part}ORDER BY s DESC) AS tp, sum(n) OVER ({part}ORDER BY s DESC) AS pp, "
        f"sum(pos) OVER ({part}) AS p, sum(n) OVER ({part}) AS t FROM st) ")


_AP = "coalesce(sum(pos / nullif(p, 0) * tp / pp), 0)"
_AUC = "sum((n - pos) * (tp - pos / 2)) / nullif(max(p) * max(t - p), 0)"
_E = dbl(LOG_LOSS_EPS)
_ONE_E = dbl(1.0 - LOG_LOSS_EPS)


def _ln(x: str) -> str:
    return f"ln(greatest(least({x}, {_ONE_E}), {_E}))"


_RANKING = ", ".join([
    big("max(t)", "rows"), big("max(p)", "positives"), r("max(p) / max(t)", "prevalence"), r(_AP, "pr_auc"),
    r(f"{_AP} / nullif(max(p) / max(t), 0)", "pr_auc_lift"), r(_AUC, "roc_auc"),
    r("sum(pos * (1 - s) * (1 - s) + (n - pos) * s * s) / max(t)", "brier_score"),
    r(f"sum(-(pos * {_ln('s')} + (n - pos) * {_ln('1 - s')})) / max(t)", "log_loss"),
])


def _cells(threshold: str) -> dict[str, str]:
    tp, pp = f"coalesce(sum(pos) FILTER (s >= {threshold}), 0)", f"coalesce(sum(n) FILTER (s >= {threshold}), 0)"
    return {"tp": tp, "fp": f"{pp} - {tp}", "tn": f"sum(n) - {pp} - sum(pos) + {tp}", "fn": f"sum(pos) - {tp}"}


def _rates(c: dict[str, str], accuracy: bool = True) -> str:
    tp, fp, tn, fn = (f"({c[k]})" for k in ("tp", "fp", "tn", "fn"))
    out = [
        r(f"coalesce({tp} / nullif({tp} + {fp}, 0), 0)", "precision"),
        r(f"coalesce({tp} / nullif({tp} + {fn}, 0), 0)", "recall"),
        r(f"coalesce(2 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 0)", "f1"),
    ]
    if accuracy:
        out.append(r(f"({tp} + {tn}) / sum(n)", "accuracy"))
    return ", ".join([*out, r(f"({tp} + {fp}) / sum(n)", "positive_rate")])


def _classification(threshold: str, groups: str = "") -> str:
    g = f"{groups}, " if groups else ""
    return (f"SELECT {g}{r(_AP, 'pr_auc')}, {r(_AUC, 'roc_auc')}, {_rates(_cells(threshold))}, "
            f"{r(threshold, 'threshold')} FROM curve" + (f" GROUP BY {groups}" if groups else ""))


def _threshold_metrics(threshold: str, lead: str = "", source: str = "st") -> str:
    c = _cells(threshold)
    return (f"SELECT {lead}{r(threshold, 'threshold')}, {_rates(c, accuracy=False)}, "
            + ", ".join(big(c[k], k) for k in ("tp", "fp", "tn", "fn")) + f" FROM {source}")


def _confusion(threshold: str, lead: str = "", source: str = "st") -> str:
    c = _cells(threshold)
    return (f"SELECT {lead}'actual_on_time' AS actual, {big(c['tn'], 'pred_on_time')}, {big(c['fp'], 'pred_late')} FROM {source} "
            f"UNION ALL SELECT {lead}'actual_late' AS actual, {big(c['fn'], 'pred_on_time')}, {big(c['tp'], 'pred_late')} FROM {source}")


_PR = "s AS threshold, tp / pp AS precision, tp / p AS recall, 2 * tp / (pp + p) AS f1"
_BEST_F1 = f"(SELECT {_PR} FROM curve ORDER BY f1 DESC, threshold LIMIT 1)"
_MIN_RECALL = (
    f"(SELECT * FROM (SELECT {_PR} FROM curve) ORDER BY recall >= 0.5 DESC, "
    "CASE WHEN recall >= 0.5 THEN precision ELSE recall END DESC, threshold LIMIT 1)")
_PRF = rounded(["threshold", "precision", "recall", "f1"])
_RECALL_NAME = "maximize_precision_subject_to_recall>=0.50"

put_with("ranking_metrics", "scored", _curve("scored") + f"SELECT {_RANKING} FROM curve")
put_with("classification_metrics", "scored", _curve("scored") + _classification(dbl(0.5)))
put_with("confusion_matrix", "scored", _curve("scored") + _confusion(dbl(0.5)))
put_with("pr_curve", "scored", _curve("scored") + f"SELECT {_PRF} FROM (SELECT {_PR} FROM curve)")
put_with("roc_curve", "scored", _curve("scored") + (
    f"SELECT {r('s', 'threshold')}, {r('(pp - tp) / (t - p)', 'fpr')}, {r('tp / p', 'tpr')} FROM curve"))
put_with("best_f1_threshold", "scored", _curve("scored") + f"SELECT 'best_oof_f1' AS threshold_rule, {_PRF} FROM {_BEST_F1}")
put_with("min_recall_threshold", "scored", _curve("scored") + f"SELECT '{_RECALL_NAME}' AS threshold_rule, {_PRF} FROM {_MIN_RECALL}")
put_with("threshold_table", "scored", _curve("scored") + " UNION ALL ".join(_classification(dbl(t)) for t in TABLE_THRESHOLDS))
put_with("threshold_metrics", "scored", _curve("scored") + _threshold_metrics(dbl(0.35)))
put_with("threshold_sweep", "scored", _curve("scored") + " UNION ALL ".join(_threshold_metrics(dbl(t)) for t in sweep_thresholds()))
_BINS = (
    ", edges AS (SELECT " + ", ".join(f"{_quantile('probability', i / 10)} AS e{i}" for i in range(1, 10)) + " FROM scored), "
    "binned AS (SELECT CAST(" + " + ".join(f"CAST(e{i} < probability AS INT)" for i in range(1, 10))
    + " AS INT) AS bin, probability, late_delivery FROM scored, edges), "
    "bins AS (SELECT bin, avg(probability) AS m, avg(late_delivery) AS o FROM binned GROUP BY bin) ")
put_with("calibration_table", "scored", _BINS + (
    f"SELECT bin, {r('m', 'mean_predicted_probability')}, {r('o', 'observed_late_rate')}, {r('o - m', 'calibration_gap')} FROM bins"))
put_with("calibration_gap", "scored", _BINS + f"SELECT {r('avg(abs(o - m))', 'mean_absolute_calibration_gap')} FROM bins")


def _band(source: str, edges, labels) -> str:
    whens = " ".join(f"WHEN {source} <= {e} THEN '{label}'" for e, label in zip(edges, labels))
    return f"CASE WHEN {source} IS NULL THEN NULL {whens} ELSE '{labels[-1]}' END"


_SEGMENT_COLUMNS = "strftime(prediction_timestamp, '%Y-%m') AS prediction_month, " + ", ".join(
    f"{_band(*spec)} AS {name}" for name, spec in K.SEGMENT_BANDS.items())
put("analysis_segments", "features", f"SELECT order_id, {_SEGMENT_COLUMNS} FROM features")
_SCORED_FEATURES = (
    f", sf AS (SELECT *, {_SEGMENT_COLUMNS}, CAST(((order_id*7919) % 800 + 200*late_delivery)/1000.0 AS DOUBLE) AS probability "
    "FROM features)")
put_with("segment_metrics", "features", _SCORED_FEATURES + _curve(
    "(SELECT customer_state AS segment, late_delivery, probability FROM sf)", "segment") + (
    f"SELECT segment, {_RANKING} FROM curve GROUP BY segment HAVING max(t) >= 100 AND max(p) >= 5 AND max(p) < max(t)"))
put_with("segment_reports", "features", _SCORED_FEATURES + ", kinds AS (" + " UNION ALL ".join(
    f"SELECT '{s}' AS kind, {s} AS segment, late_delivery, probability FROM sf"
    for s in ("customer_state", "distance_band", "promise_band", "approval_lag_band", "prediction_month")) + ")"
    + _curve("kinds", "kind, segment") + (
    f"SELECT kind, segment, {_RANKING} FROM curve GROUP BY kind, segment HAVING max(t) >= 100 AND max(p) >= 10 AND max(p) < max(t)"))
_VAL_CURVE = _curve("scored_split", "", "WHERE split = 'validation'")
_TEST_ST = (
    ", tuned AS (SELECT threshold FROM " + _BEST_F1 + "), test_st AS (SELECT probability AS s, "
    "CAST(sum(late_delivery) AS DOUBLE) AS pos, CAST(count(*) AS DOUBLE) AS n FROM scored_split WHERE split = 'test' "
    "GROUP BY probability), test_curve AS (SELECT *, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(n) OVER (ORDER BY s DESC) AS pp, "
    "sum(pos) OVER () AS p, sum(n) OVER () AS t FROM test_st) ")
_EVALUATIONS = [("default_threshold", dbl(0.5)), ("validation_tuned_threshold", "(SELECT threshold FROM tuned)")]
put_with("holdout_report", "scored_split", _VAL_CURVE + _TEST_ST + " UNION ALL ".join(
    f"SELECT '{name}' AS evaluation, " + _classification(t).removeprefix("SELECT ").replace("FROM curve", "FROM test_curve")
    for name, t in _EVALUATIONS))
put_with("holdout_confusion", "scored_split", _VAL_CURVE + _TEST_ST + " UNION ALL ".join(
    _confusion(t, f"'{name}' AS evaluation, ", "test_st") for name, t in _EVALUATIONS))
_RULE_ROWS = (f"SELECT 'best_oof_f1' AS threshold_rule, {_PRF} FROM {_BEST_F1} UNION ALL "
              f"SELECT '{_RECALL_NAME}' AS threshold_rule, {_PRF} FROM {_MIN_RECALL}")
put_with("operating_thresholds", "scored", _curve("scored") + _RULE_ROWS)
put_with("rule_metrics", "scored", _curve("scored") + " UNION ALL ".join(
    _threshold_metrics(t, f"'{name}' AS threshold_rule, ") for name, t in [
        ("default_0.50", dbl(0.5)), ("best_oof_f1", f"(SELECT threshold FROM {_BEST_F1})"),
        (_RECALL_NAME, f"(SELECT threshold FROM {_MIN_RECALL})")]))

# --- search over stand-in configurations ---------------------------------------------------------------------

_FOLD_GROUPS = "config_id, model_family, fold"
_FOLD_EXACT = _curve("fold_scores", _FOLD_GROUPS) + (
    f", fm AS (SELECT {_FOLD_GROUPS}, {_AP} AS pr_auc, {_AUC} AS roc_auc, "
    + ", ".join(f"({e}) AS {k}" for k, e in _cells(dbl(0.5)).items())
    + ", sum(n) AS rows, sum(pos) AS positives FROM curve GROUP BY " + _FOLD_GROUPS + "), "
    "fold_metrics AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, "
    "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, (tp + tn) / rows AS accuracy, (tp + fp) / rows AS positive_rate, "
    "positives / rows AS validation_late_rate FROM fm), "
    "summary AS (SELECT config_id, model_family, avg(pr_auc) AS mean_pr_auc, coalesce(stddev_samp(pr_auc), 0) AS std_pr_auc, "
    "min(pr_auc) AS min_pr_auc, max(pr_auc) AS max_pr_auc, avg(roc_auc) AS mean_roc_auc, avg(recall) AS mean_recall, "
    "avg(precision) AS mean_precision, avg(f1) AS mean_f1 FROM fold_metrics GROUP BY config_id, model_family) ")
_FOLD_COLUMNS = (
    _FOLD_GROUPS + ", " + rounded(["pr_auc", "roc_auc", "precision", "recall", "f1", "accuracy", "positive_rate"]) + ", "
    + r("0.5", "threshold") + ", CAST(rows AS BIGINT) AS validation_rows, " + r("validation_late_rate", "validation_late_rate"))
_SUMMARY = ["mean_pr_auc", "std_pr_auc", "min_pr_auc", "max_pr_auc", "mean_roc_auc", "mean_recall", "mean_precision", "mean_f1"]
put_with("fold_metrics", "fold_scores", _FOLD_EXACT + f"SELECT {_FOLD_COLUMNS} FROM fold_metrics")
put_with("summarize_search", "fold_scores", _FOLD_EXACT + f"SELECT config_id, model_family, {rounded(_SUMMARY)} FROM summary")
put_with("select_best", "fold_scores", _FOLD_EXACT + (
    f"SELECT config_id, model_family, {rounded(_SUMMARY)} FROM (SELECT * FROM summary ORDER BY mean_pr_auc DESC, config_id LIMIT 1)"))
put_with("family_summary", "fold_scores", _FOLD_EXACT + (
    "SELECT model_family, " + r("max(mean_pr_auc)", "best_mean_pr_auc") + ", " + r("quantile_cont(mean_pr_auc, 0.5)", "median_mean_pr_auc")
    + ", " + r("max(min_pr_auc)", "best_min_fold_pr_auc") + ", count(config_id) AS configurations FROM summary GROUP BY model_family"))
put_with("temporal_robustness", "fold_scores", _FOLD_EXACT + (
    f"SELECT {_FOLD_COLUMNS}, {r('pr_auc / validation_late_rate', 'pr_auc_lift')} FROM fold_metrics WHERE config_id = "
    "(SELECT config_id FROM summary ORDER BY mean_pr_auc DESC, std_pr_auc, config_id LIMIT 1)"))

# --- preprocessing -------------------------------------------------------------------------------------------

_TRAIN_MEDIANS = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}" for c in C.IMPUTED)
_IMPUTED = {**{c: f"coalesce(CAST({c} AS DOUBLE), m_{c})" for c in C.IMPUTED},
            **{f"missingindicator_{c}": f"CAST({c} IS NULL AS DOUBLE)" for c in C.IMPUTED}}
_MED = f", med AS (SELECT {_TRAIN_MEDIANS} FROM split WHERE split = 'train')"
put_with("median_impute", "split", _MED + " SELECT order_id, " + ", ".join(r(e, n) for n, e in _IMPUTED.items()) + " FROM split, med")
put_with("standard_scale", "split", (
    _MED + ", imp AS (SELECT order_id, split, " + ", ".join(f"{e} AS {n}" for n, e in _IMPUTED.items()) + " FROM split, med), "
    "st AS (SELECT " + ", ".join(f"avg({n}) AS a_{n}, coalesce(nullif(stddev_pop({n}), 0), 1) AS s_{n}" for n in _IMPUTED)
    + " FROM imp WHERE split = 'train') SELECT order_id, " + ", ".join(r(f"({n} - a_{n}) / s_{n}", n) for n in _IMPUTED)
    + " FROM imp, st"))


def _mode(column: str) -> str:
    return (f"(SELECT {column} FROM split WHERE split = 'train' AND {column} IS NOT NULL GROUP BY {column} "
            f"ORDER BY count(*) DESC, {column} LIMIT 1)")


put("mode_impute", "split", "SELECT order_id, " + ", ".join(
    f"coalesce({c}, {_mode(c)}) AS {c}" for c in K.CATEGORICAL_FEATURES) + " FROM split")
put("one_hot", "split", "SELECT order_id, " + ", ".join(
    f"CAST(coalesce(primary_payment_type, {_mode('primary_payment_type')}) = '{v}' AS INT) AS primary_payment_type_{v}"
    for v in C.PAYMENT_TYPES) + " FROM split")
put("dummy_prior", "split", (
    "SELECT order_id, " + r("(SELECT avg(late_delivery) FROM split WHERE split = 'train')", "probability")
    + " FROM split WHERE split = 'test'"))
_POS = "CAST(sum(late_delivery) AS DOUBLE)"
_N = "CAST(count(*) AS DOUBLE)"
put("class_weights", "members", (
    f"SELECT fold, count(*) AS rows, {big('sum(late_delivery)', 'positives')}, "
    + r(f"coalesce({_N} / nullif(2 * ({_N} - {_POS}), 0), 1)", "balanced_0") + ", "
    + r(f"coalesce({_N} / nullif(2 * {_POS}, 0), 1)", "balanced_1") + ", "
    + r(f"coalesce(({_N} - {_POS}) / nullif({_POS}, 0), 1)", "scale_pos_weight")
    + " FROM members WHERE role = 'train' GROUP BY fold"))
put("param_grid", "members", (
    "SELECT v.config_id, v.model_family, f.fold, f.rows AS train_rows, CAST(f.pos AS BIGINT) AS train_positives, "
    + r("CASE WHEN v.model_family = 'xgboost' THEN coalesce((f.rows - f.pos) / nullif(f.pos, 0), 1) END", "scale_pos_weight")
    + " FROM (SELECT fold, count(*) AS rows, CAST(sum(late_delivery) AS DOUBLE) AS pos FROM members WHERE role = 'train' "
    "GROUP BY fold) f, (VALUES " + ", ".join(f"('{c.config_id}', '{c.family}')" for c in search_configs())
    + ") v(config_id, model_family)"))
put("registry_tables", "split", (
    "SELECT v.model, v.family, w.n AS train_rows, " + r("w.n / (2 * CAST(w.pos AS DOUBLE))", "late_weight") + " FROM (VALUES "
    + ", ".join(f"('{c.config_id}', '{c.family}')" for c in model_registry())
    + ") v(model, family), (SELECT count(*) AS n, sum(late_delivery) AS pos FROM split WHERE split = 'train') w"))

# --- drift ---------------------------------------------------------------------------------------------------


def _term(ref: str, cmp: str) -> str:
    a, b = f"greatest({ref}, {dbl(1e-6)})", f"greatest({cmp}, {dbl(1e-6)})"
    return f"({b} - {a}) * ln({b} / {a})"


_DRIFT_SIDES = (
    ", sides AS (SELECT *, CAST(split <> 'test' AS INT) AS ref FROM split), "
    "sizes AS (SELECT CAST(sum(ref) AS DOUBLE) AS rn, CAST(sum(1 - ref) AS DOUBLE) AS cn FROM sides)")
_SHIFT = ("sum(" + _term("r / rn", "c / cn") + ")")
_MISSING_PCT = (
    r("100 * coalesce(sum(r) FILTER (missing), 0) / any_value(rn)", "reference_missing_pct") + ", "
    + r("100 * coalesce(sum(c) FILTER (missing), 0) / any_value(cn)", "comparison_missing_pct"))


def _numeric_psi_views() -> str:
    long = " UNION ALL ".join(f"SELECT '{c}' AS feature, ref, CAST({c} AS DOUBLE) AS x FROM sides" for c in K.NUMERIC_FEATURES)
    quantiles = ", ".join(_quantile("x", i / 10) for i in range(11))
    return (
        f", long AS ({long}), edges AS (SELECT feature, list_sort(list_distinct([{quantiles}])) AS e FROM long "
        "WHERE ref = 1 AND x IS NOT NULL GROUP BY feature), "
        "binned AS (SELECT l.feature, l.ref, x IS NULL AS missing, CASE WHEN x IS NULL THEN 0 ELSE 1 + "
        "len(list_filter(e[2:len(e) - 1], lambda v: v < x)) END AS bin FROM long l LEFT JOIN edges USING (feature)), "
        "counts AS (SELECT feature, bin, missing, CAST(sum(ref) AS DOUBLE) AS r, CAST(sum(1 - ref) AS DOUBLE) AS c "
        "FROM binned GROUP BY feature, bin, missing), "
        "numeric_shift AS (SELECT feature, CASE WHEN coalesce(max(len(e)), 0) >= 3 THEN " + _SHIFT + " ELSE 0 END AS psi, "
        + _MISSING_PCT + " FROM counts LEFT JOIN edges USING (feature), sizes GROUP BY feature)")


def _categorical_psi_views() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, ref, coalesce({c}, '__MISSING__') AS v FROM sides" for c in K.CATEGORICAL_FEATURES)
    return (
        f", texts AS ({long}), text_counts AS (SELECT feature, v = '__MISSING__' AS missing, CAST(sum(ref) AS DOUBLE) AS r, "
        "CAST(sum(1 - ref) AS DOUBLE) AS c FROM texts GROUP BY feature, v), "
        "text_shift AS (SELECT feature, " + _SHIFT + " AS psi, " + _MISSING_PCT + " FROM text_counts, sizes GROUP BY feature)")


_FLAG = "CASE WHEN psi <= 0.10 THEN 'low' WHEN psi <= 0.25 THEN 'moderate' WHEN psi IS NOT NULL THEN 'high' END AS drift_flag"
_PSI_COLUMNS = r("psi", "psi") + ", reference_missing_pct, comparison_missing_pct"
put_with("psi_from_shares", "split", _DRIFT_SIDES + (
    " SELECT " + r(_SHIFT, "psi") + " FROM (SELECT customer_state, CAST(sum(ref) AS DOUBLE) AS r, "
    "CAST(sum(1 - ref) AS DOUBLE) AS c FROM sides GROUP BY customer_state), sizes"))
put_with("numeric_psi", "split", _DRIFT_SIDES + _numeric_psi_views() + f" SELECT feature, {_PSI_COLUMNS} FROM numeric_shift")
put_with("categorical_psi", "split", _DRIFT_SIDES + _categorical_psi_views() + f" SELECT feature, {_PSI_COLUMNS} FROM text_shift")
put_with("drift_summary", "split", _DRIFT_SIDES + _numeric_psi_views() + _categorical_psi_views() + (
    f" SELECT feature, 'numeric' AS feature_type, {_PSI_COLUMNS}, {_FLAG} FROM numeric_shift UNION ALL "
    f"SELECT feature, 'categorical' AS feature_type, {_PSI_COLUMNS}, {_FLAG} FROM text_shift"))

# --- importance ----------------------------------------------------------------------------------------------

put("global_attribution", "features", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, " + r(f"avg(abs(coalesce({dbl(w)} * (CAST({c} AS DOUBLE) - m), 0)))", "mean_absolute_contribution")
    + f" FROM features, (SELECT avg({c}) AS m FROM features)" for c, w in C.LINEAR_WEIGHTS.items()))

# --- scoring -------------------------------------------------------------------------------------------------


# written out here once more, so that the twin notices a change of the contract
_WHOLE_FIELDS = set(
    "purchase_year purchase_month purchase_weekday purchase_hour purchase_is_weekend item_count unique_products seller_count "
    "payment_records max_installments payment_type_count category_count seller_state_count all_sellers_same_state".split())


def _fault_list() -> str:
    faults = []
    for rule in K.FIELD_RULES:
        c = rule.name
        checks = [
            (rule.required, f"{c} IS NULL", "required"),
            (c in _WHOLE_FIELDS, f"isnan(CAST({c} AS DOUBLE)) OR CAST({c} AS DOUBLE) <> floor(CAST({c} AS DOUBLE))", "not whole"),
            (rule.low is not None, f"isnan(CAST({c} AS DOUBLE)) OR {c} < {rule.low}", f"below {rule.low}"),
            (rule.high is not None, f"isnan(CAST({c} AS DOUBLE)) OR {c} > {rule.high}", f"above {rule.high}"),
            (rule.min_length is not None, f"length({c}) < {rule.min_length}", "too short"),
            (rule.max_length is not None, f"length({c}) > {rule.max_length}", "too long"),
        ]
        faults += [f"CASE WHEN {cond} THEN '{c}: {text}' END" for wanted, cond, text in checks if wanted]
    return "list_filter([" + ", ".join(faults) + "], lambda f: f IS NOT NULL)"


put("contract_validation", "features", (
    "SELECT order_id, CAST(len(faults) AS INT) AS n_faults, coalesce(array_to_string(faults, '; '), '') AS faults "
    f"FROM (SELECT order_id, {_fault_list()} AS faults FROM features)"))
_PLANTED = (
    ", planted AS (SELECT * REPLACE (CASE WHEN order_id % 5 = 0 THEN item_count + 0.5 WHEN order_id % 7 = 0 THEN NULL ELSE item_count "
    "END AS item_count, CASE WHEN order_id % 3 = 0 THEN CAST('NaN' AS DOUBLE) WHEN order_id % 11 = 0 THEN -1 ELSE total_price END AS total_price) "
    "FROM features)")
put_with("batch_quarantine", "features", _PLANTED + (
    ", judged AS (SELECT order_id, " + _fault_list() + " AS faults FROM planted) SELECT order_id, array_to_string(faults, '; ') AS faults "
    "FROM judged WHERE len(faults) > 0"))
put("normalize_categories", "features", (
    "SELECT order_id, customer_state, CASE WHEN order_id % 3 = 0 THEN NULL ELSE primary_payment_type END AS "
    "primary_payment_type, dominant_product_category FROM features"))
_BAND_SQL = "CASE WHEN {0} <= 0.20 THEN 'low' WHEN {0} <= 0.40 THEN 'medium' WHEN {0} <= 0.60 THEN 'high' ELSE 'critical' END"
put("batch_score", "features", (
    "SELECT order_id, prediction_timestamp, " + r("s", "risk_score") + ", " + _BAND_SQL.format("s") + " AS risk_band, "
    "s >= 0.5 AS requires_review, " + r("0.5", "action_threshold") + ", false AS calibrated_probability, "
    f"'promise_rule:{'a' * 12}' AS model_version FROM (SELECT *, "
    "least(greatest(0.8 - promised_delivery_days / 60.0, 0.01), 0.99) AS s, " + _fault_list() + " AS faults FROM features) "
    "WHERE len(faults) = 0"))
put("risk_band", "scored", "SELECT order_id, " + r("probability", "probability") + ", " + _BAND_SQL.format("probability") + " AS risk_band FROM scored")
put("review_flag", "scored", "SELECT order_id, probability >= 0.5 AS requires_review FROM scored")
_SCORE_Q = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q80": 0.8, "q90": 0.9, "q95": 0.95, "q99": 0.99}
_Q_COLUMNS = ", ".join(r(_quantile("probability", p), n) for n, p in _SCORE_Q.items())
_LIMITS = ", ".join(r(_quantile("probability", p), n) for n, p in (("low_max", 0.5), ("medium_max", 0.8), ("high_max", 0.95)))
put("band_thresholds", "scored", f"SELECT {_Q_COLUMNS}, {_LIMITS} FROM scored")
put_with("choose_threshold", "scored", _curve("scored") + (
    f"SELECT '{_RECALL_NAME}' AS action_threshold_rule, {r('threshold', 'action_threshold')} FROM {_MIN_RECALL}"))
put("monitoring_reference", "scored", (
    "SELECT count(*) AS rows, " + r("avg(late_delivery)", "prevalence") + ", " + r("avg(probability)", "score_mean") + ", "
    + r("stddev_samp(probability)", "score_std") + f", {_Q_COLUMNS} FROM scored"))
put_with("deployment_config", "scored", _curve("scored") + (
    f"SELECT 'stand_in_01' AS candidate, 'stand_in' AS family, '{'b' * 64}' AS sha256, CAST(41 AS INT) AS feature_count, {_LIMITS}, "
    f"any_value(m.action_threshold) AS action_threshold, '{_RECALL_NAME}' AS action_threshold_rule, count(*) AS rows, "
    + r("avg(late_delivery)", "prevalence") + f" FROM scored, (SELECT {r('threshold', 'action_threshold')} FROM {_MIN_RECALL}) m"))
put("missing_feature_count", "features", (
    "SELECT count(*) AS rows, CAST(" + " + ".join(f"(count(*) - count({c}))" for c in K.MODEL_FEATURES)
    + " AS BIGINT) AS missing_feature_values FROM features"))
put("response_ids", "ranked", (
    "SELECT order_id, prediction_timestamp, concat('req-1:', CAST(row_num - 1 AS VARCHAR)) AS response_id, "
    f"'promise_rule:{'a' * 12}' AS model_version FROM ranked"))
put("payload_pack", "features", (
    "SELECT order_id, prediction_timestamp, " + rounded(["total_price", "payment_value", "mean_distance_km"])
    + ", customer_state, primary_payment_type FROM features"))

# --- monitoring ----------------------------------------------------------------------------------------------

_OK = "FILTER (NOT failed)"


def _served_mean(e: str) -> str:
    return f"coalesce(CAST(sum({e}) {_OK} AS DOUBLE) / nullif(count(*) {_OK}, 0), 0)"


_TELEMETRY = ", ".join([
    "count(*) FILTER (NOT failed AND prediction_index = 0) AS total_requests", f"count(*) {_OK} AS total_predictions", "count(*) FILTER (failed AND prediction_index = 0) AS failed_requests",
    r("coalesce(CAST(sum(latency_ms) FILTER (NOT failed AND prediction_index = 0) AS DOUBLE) / "
      "nullif(count(*) FILTER (NOT failed AND prediction_index = 0), 0), 0)", "average_request_latency_ms"), r(_served_mean("score"), "mean_risk_score"),
    r(_served_mean("CAST(requires_review AS DOUBLE)"), "review_rate"),
    *[f"count(*) FILTER (NOT failed AND risk_band = '{b}') AS band_{b}" for b in ("low", "medium", "high", "critical")],
    big(f"coalesce(sum(missing_features) {_OK}, 0)", "missing_feature_values"),
])
put("telemetry_snapshot", "log", f"SELECT {_TELEMETRY} FROM log")
_WINDOWS = (
    "SELECT date_trunc('day', ts) + INTERVAL '0' DAY AS window_start, date_trunc('day', ts) + INTERVAL '1' DAY AS window_end, "
    f"{_TELEMETRY} FROM log GROUP BY date_trunc('day', ts)")
put("telemetry_windows", "log", _WINDOWS)
put("telemetry_stream", "log", _WINDOWS)
put_with("score_drift", "scored log", (
    ", live AS (SELECT * FROM log WHERE NOT failed), both_sides AS (SELECT probability AS x, 1 AS ref FROM scored UNION ALL "
    "SELECT score, 0 FROM live), edges AS (SELECT list_sort(list_distinct(["
    + ", ".join(_quantile("probability", i / 10) for i in range(11)) + "])) AS e FROM scored), "
    "sizes AS (SELECT CAST(sum(ref) AS DOUBLE) AS rn, CAST(sum(1 - ref) AS DOUBLE) AS cn FROM both_sides), "
    "counts AS (SELECT CASE WHEN x IS NULL THEN 0 ELSE 1 + len(list_filter(e[2:len(e) - 1], lambda v: v < x)) END AS bin, "
    "CAST(sum(ref) AS DOUBLE) AS r, CAST(sum(1 - ref) AS DOUBLE) AS c FROM both_sides, edges GROUP BY 1), "
    f"shift AS (SELECT {_SHIFT} AS psi FROM counts, sizes), ref AS (SELECT avg(probability) AS m FROM scored), "
    "l AS (SELECT count(*) AS predictions, avg(score) AS s, avg(CAST(requires_review AS DOUBLE)) AS rr, "
    "CAST(sum(missing_features) AS DOUBLE) / count(*) AS mp FROM live) SELECT predictions, " + r("s", "live_score_mean") + ", "
    + r("m", "reference_score_mean") + ", " + r("s - m", "score_mean_shift") + ", " + r("rr", "review_rate") + ", "
    + r("mp", "missing_per_prediction") + ", " + r("psi", "score_psi") + f", {_FLAG} FROM l, ref, shift"))
put_with("matured_label_quality", "scored orders_cleaned", (
    ", matured AS (SELECT strftime(s.prediction_timestamp, '%Y-%m') AS month, s.probability, o.late_delivery FROM scored s "
    "JOIN orders_cleaned o USING (order_id) WHERE o.order_delivered_customer_date > s.prediction_timestamp)"
    + _curve("matured", "month") + f"SELECT month, {_RANKING} FROM curve GROUP BY month"))

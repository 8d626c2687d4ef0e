"""Eligible population, target and data invariants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from parcelcast.contracts import ContractError, TARGET
from parcelcast.functions.expressions import days_between, flag_count, hours_between, pct
from parcelcast.operators.ordering import describe_values
from parcelcast.operators.profiling import _rows_from_aggregate, repeated_rows


def status_cohorts(orders: DataFrame) -> DataFrame:
    """Rows of the four status cohorts under review, labelled by cohort."""
    delivered = F.col("order_status") == "delivered"
    cohorts = F.array_compact(F.array(
        F.when(delivered, F.lit("delivered")),
        F.when(delivered & F.col("order_delivered_customer_date").isNull(), F.lit("delivered_without_delivery_time")),
        F.when(delivered & F.col("order_approved_at").isNull(), F.lit("delivered_without_approval")),
        F.when(
            (F.col("order_status") == "canceled") & F.col("order_delivered_customer_date").isNotNull(),
            F.lit("canceled_with_delivery_time"),
        ),
    ))
    return orders.select(F.explode(cohorts).alias("cohort"), *orders.columns)


def invalid_promise(orders: DataFrame) -> DataFrame:
    """Orders promised for a date before their approval."""
    return orders.filter(F.col("order_estimated_delivery_date") < F.col("order_approved_at"))


def eligibility_rules() -> dict[str, Column]:
    """The six rules an order must meet to be modelled."""
    return {
        "is_delivered": F.col("order_status") == "delivered",
        "has_purchase_timestamp": F.col("order_purchase_timestamp").isNotNull(),
        "has_prediction_point": F.col("order_approved_at").isNotNull(),
        "has_actual_delivery": F.col("order_delivered_customer_date").isNotNull(),
        "has_estimated_delivery": F.col("order_estimated_delivery_date").isNotNull(),
        "has_valid_promised_window": F.col("order_estimated_delivery_date") >= F.col("order_approved_at"),
    }


def with_eligibility(orders: DataFrame) -> DataFrame:
    """Each rule as a boolean column, and their conjunction as ``eligible``."""
    rules = {name: F.coalesce(rule, F.lit(False)) for name, rule in eligibility_rules().items()}
    flagged = orders.withColumns(rules)
    return flagged.withColumn("eligible", reduce(lambda a, b: a & b, [F.col(n) for n in rules]))


def eligible_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(reduce(lambda a, b: a & b, eligibility_rules().values()))


_FUNNEL_STEPS = [
    "Delivered", "Delivered + purchase timestamp", "Delivered + prediction point", "Delivered + actual delivery",
    "Delivered + estimated delivery", "Delivered + valid promised window",
]


def population_funnel(orders: DataFrame) -> DataFrame:
    """Orders left after each rule is added, in one pass."""
    rules = list(eligibility_rules().values())
    cumulative = [reduce(lambda a, b: a & b, rules[: i + 1]) for i in range(len(rules))]
    agg = orders.agg(F.count(F.lit(1)).alias("raw"), *[flag_count(c).alias(f"s{i}") for i, c in enumerate(cumulative)])
    steps = [("Raw orders", F.col("raw"))]
    steps += [(label, F.col(f"s{i}")) for i, label in enumerate(_FUNNEL_STEPS)]
    steps.append(("Final eligible population", F.col(f"s{len(rules) - 1}")))
    return _rows_from_aggregate(agg, [
        {"position": F.lit(i), "step": F.lit(label), "orders": n, "retained_pct": pct(n, F.col("raw"))}
        for i, (label, n) in enumerate(steps)
    ])


def late_label() -> Column:
    return (F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")).cast("int")


def delay_days() -> Column:
    return days_between("order_delivered_customer_date", "order_estimated_delivery_date")


def with_target(orders: DataFrame) -> DataFrame:
    return orders.withColumn(TARGET, late_label())


def with_delay(orders: DataFrame) -> DataFrame:
    """Delay in days; for analysis only, it knows the outcome."""
    return orders.withColumn("delivery_delay_days", delay_days())


def clean_orders(orders: DataFrame) -> DataFrame:
    """Eligible orders with target and delay."""
    return with_delay(with_target(eligible_orders(orders)))


def target_distribution(orders: DataFrame) -> DataFrame:
    total = orders.filter(F.col(TARGET).isNotNull()).agg(F.count(F.lit(1)).alias("n"))
    return (
        orders.filter(F.col(TARGET).isNotNull())
        .groupBy(TARGET)
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            F.when(F.col(TARGET) == 1, F.lit("late")).otherwise(F.lit("on_time")).alias("target"),
            "count",
            pct(F.col("count"), total.scalar()).alias("pct"),
        )
    )


_ANOMALIES = {
    "carrier_before_approval": ("order_approved_at", "order_delivered_carrier_date"),
    "delivery_before_carrier": ("order_delivered_carrier_date", "order_delivered_customer_date"),
}


def anomaly_rows(orders: DataFrame) -> DataFrame:
    """Orders whose events run backwards, with the gap in hours, one row per order and anomaly."""
    found = F.array_compact(F.array(*[
        F.when(
            F.col(expected_first) > F.col(came_first),
            F.struct(F.lit(name).alias("anomaly"), hours_between(expected_first, came_first).alias("gap_hours")),
        )
        for name, (expected_first, came_first) in _ANOMALIES.items()
    ]))
    return orders.select(F.explode(found).alias("a"), "order_id", TARGET).select("a.*", "order_id", TARGET)


def anomaly_summary(orders: DataFrame) -> DataFrame:
    return describe_values(anomaly_rows(orders), ["anomaly"], "gap_hours")


def largest_anomalies(orders: DataFrame, anomaly: str, n: int = 20) -> DataFrame:
    rows = anomaly_rows(orders).filter(F.col("anomaly") == anomaly)
    return rows.orderBy(F.desc("gap_hours"), "order_id").limit(n)


def invariant_check(cleaned: DataFrame) -> DataFrame:
    """Violations per rule of the cleaned population; zero everywhere when it is sound.

    Only the uniqueness rule shuffles, and only the id; the row-wise rules are one aggregate without a shuffle
    of rows.
    """
    late, delay = F.col(TARGET), F.col("delivery_delay_days")
    broken = {
        "order_status_is_delivered": ~F.coalesce(F.col("order_status") == "delivered", F.lit(False)),
        "purchase_timestamp_present": F.col("order_purchase_timestamp").isNull(),
        "approval_present": F.col("order_approved_at").isNull(),
        "actual_delivery_present": F.col("order_delivered_customer_date").isNull(),
        "estimated_delivery_present": F.col("order_estimated_delivery_date").isNull(),
        "target_is_binary": ~F.coalesce(late.isin(0, 1), F.lit(False)),
        "approval_not_before_purchase": F.col("order_approved_at") < F.col("order_purchase_timestamp"),
        "delivery_not_before_purchase": F.col("order_delivered_customer_date") < F.col("order_purchase_timestamp"),
        "promise_not_before_approval": F.col("order_estimated_delivery_date") < F.col("order_approved_at"),
        "late_means_positive_delay": (late == 1) & ~F.coalesce(delay > 0, F.lit(False)),
        "on_time_means_no_positive_delay": (late == 0) & ~F.coalesce(delay <= 0, F.lit(False)),
    }
    agg = cleaned.agg(*[flag_count(cond).alias(rule) for rule, cond in broken.items()])
    unique = repeated_rows(cleaned, ["order_id"]).select(F.lit("order_id_is_unique").alias("rule"), "violations")
    return unique.unionByName(
        _rows_from_aggregate(agg, [{"rule": F.lit(r), "violations": F.col(r)} for r in broken])
    )


def raise_on_violations(checks: DataFrame) -> None:
    """Stop a job when a rule table reports violations (the table has one row per rule)."""
    bad = [(r.rule, r.violations) for r in checks.filter(F.col("violations") > 0).collect()]
    if bad:
        raise ContractError(f"violated rules: {bad}")

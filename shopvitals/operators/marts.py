"""Daily marts.

All groupings are algebraic, so rows are combined before the shuffle and one busy day or
city costs no more than any other. Sums stay integer or decimal until the last step, which
keeps results independent of how rows are partitioned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shopvitals.functions.numeric import exact_mean, int_mean, rate, raw_rate

c = F.col


def _tier(value: Column, critical: float, warning: float) -> Column:
    return F.when(value >= critical, "critical").when(value >= warning, "warning").otherwise("healthy")


def order_measures() -> list[Column]:
    return [
        F.count("*").alias("total_orders"),
        F.count_if(~c("is_cancelled")).alias("active_orders"),
        F.count_if("is_cancelled").alias("cancelled_orders"),
        F.sum("order_amount").alias("total_revenue"),
    ]


def mart_order_summary(stg_orders: DataFrame, cfg=None, as_of=None) -> DataFrame:
    """Orders per day and city. Revenue counts cancelled orders too."""
    return finish_order_summary(
        stg_orders.groupBy("order_date", "city").agg(
            *order_measures(), F.countDistinct("customer_id").alias("unique_customers")
        )
    )


def finish_order_summary(totals: DataFrame) -> DataFrame:
    named = ["order_date", "city", "total_orders", "unique_customers", "active_orders", "cancelled_orders", "total_revenue"]
    return totals.select(*named).select(
        "*",
        exact_mean(c("total_revenue"), c("total_orders"), 2).alias("avg_order_value"),
        rate(c("cancelled_orders"), c("total_orders")).alias("cancellation_rate"),
    )


def payment_measures() -> list[Column]:
    none = F.lit(0).cast("decimal(10,2)")
    return [
        F.count("*").alias("total_payments"),
        F.count_if("is_success").alias("successful_payments"),
        F.count_if("is_failed").alias("failed_payments"),
        F.sum(F.when(c("is_success"), c("amount")).otherwise(none)).alias("successful_revenue"),
        F.sum(F.when(c("is_failed"), c("amount")).otherwise(none)).alias("failed_revenue"),
    ]


def mart_payment_health(stg_payments: DataFrame, cfg=None, as_of=None) -> DataFrame:
    """Payments per day and method. Tiers use the unrounded failure rate."""
    return finish_payment_health(stg_payments.groupBy("payment_date", "payment_method").agg(*payment_measures()))


def finish_payment_health(totals: DataFrame) -> DataFrame:
    total, failed = c("total_payments"), c("failed_payments")
    return totals.select(
        "payment_date",
        "payment_method",
        "total_payments",
        "successful_payments",
        "failed_payments",
        rate(c("successful_payments"), total).alias("success_rate"),
        rate(failed, total).alias("failure_rate"),
        "successful_revenue",
        "failed_revenue",
        _tier(raw_rate(failed, total), 0.30, 0.20).alias("health_status"),
    )


_AVERAGED = ("promised", "actual", "delay")


def delivery_measures() -> list[Column]:
    return [
        F.count("*").alias("total_deliveries"),
        F.count_if(~c("is_delayed")).alias("on_time_deliveries"),
        F.count_if("is_delayed").alias("delayed_deliveries"),
        *[F.sum(f"{name}_minutes").alias(f"_{name}") for name in _AVERAGED],
        F.max("delay_minutes").alias("max_delay_minutes"),
    ]


def mart_delivery_performance(stg_deliveries: DataFrame, cfg=None, as_of=None) -> DataFrame:
    """Deliveries per day, city and partner. Tiers use the unrounded delay rate."""
    return finish_delivery_performance(
        stg_deliveries.groupBy("delivery_date", "city", "delivery_partner").agg(*delivery_measures())
    )


def finish_delivery_performance(totals: DataFrame) -> DataFrame:
    total = c("total_deliveries")
    return totals.select(
        "delivery_date",
        "city",
        "delivery_partner",
        "total_deliveries",
        "on_time_deliveries",
        "delayed_deliveries",
        rate(c("on_time_deliveries"), total).alias("on_time_rate"),
        rate(c("delayed_deliveries"), total).alias("delay_rate"),
        *[int_mean(c(f"_{name}"), total, 1).alias(f"avg_{name}_minutes") for name in _AVERAGED],
        "max_delay_minutes",
        _tier(raw_rate(c("delayed_deliveries"), total), 0.40, 0.25).alias("health_status"),
    )


def complaint_measures() -> list[Column]:
    return [
        F.count("*").alias("total_complaints"),
        F.count_if("is_severe").alias("severe_complaints"),
        F.count_if("is_critical").alias("critical_complaints"),
        F.sum("severity_score").alias("_score"),
    ]


def mart_complaint_insights(stg_complaints: DataFrame, cfg=None, as_of=None) -> DataFrame:
    keys = ("complaint_date", "ai_category", "ai_severity", "customer_emotion")
    return finish_complaint_insights(stg_complaints.groupBy(*keys).agg(*complaint_measures()))


def finish_complaint_insights(totals: DataFrame) -> DataFrame:
    total = c("total_complaints")
    return totals.select(
        *[name for name in totals.columns if name != "_score"],
        rate(c("severe_complaints"), total).alias("severe_rate"),
        int_mean(c("_score"), total, 2).alias("avg_severity_score"),
    )


def mart_ai_diagnosis_summary(stg_ai_diagnosis: DataFrame, cfg=None, as_of=None) -> DataFrame:
    """Diagnoses per day; the health score weighs a degraded run as half a healthy one."""
    totals = stg_ai_diagnosis.groupBy("run_date").agg(
        F.count("*").alias("total_diagnoses"),
        F.count_if("is_healthy").alias("healthy_count"),
        F.count_if("is_degraded").alias("degraded_count"),
        F.count_if("is_critical").alias("critical_count"),
        F.count_if("was_alerted").alias("alerts_sent"),
        F.count_if("is_llm_diagnosis").alias("llm_diagnoses"),
        F.count_if(~c("is_llm_diagnosis")).alias("fallback_diagnoses"),
        F.sum(c("severity").cast("decimal(18,9)")).alias("_severity"),
        F.sum(c("confidence").cast("decimal(18,9)")).alias("_confidence"),
    )
    total = c("total_diagnoses")
    score = (c("healthy_count") * 100 + c("degraded_count") * 50).cast("decimal(20,0)")
    return totals.select(
        *[name for name in totals.columns if not name.startswith("_")],
        rate(c("healthy_count"), total).alias("healthy_rate"),
        rate(c("critical_count"), total).alias("critical_rate"),
        rate(c("alerts_sent"), total).alias("alert_rate"),
        rate(c("llm_diagnoses"), total).alias("llm_usage_rate"),
        exact_mean(c("_severity"), total, 3).cast("double").alias("avg_severity"),
        exact_mean(c("_confidence"), total, 3).cast("double").alias("avg_confidence"),
        exact_mean(score, total, 1).cast("double").alias("pipeline_health_score"),
    )


# ---------------------------------------------------------------- business health by day
#
# Second-level rates are unweighted means of rates already rounded per group, so they are
# added up as decimals with the digits the marts round to.


def _sum(name: str) -> Column:
    return F.sum(name).alias(name)


def _mean_of(source: str, name: str, digits: int) -> Column:
    return (
        exact_mean(F.sum(c(source).cast(f"decimal(18,{digits})")), F.count(source), digits)
        .cast("double")
        .alias(name)
    )


_SIDES = {
    "orders": (
        "order_date",
        ("total_revenue", "total_orders"),
        (("avg_order_value", "avg_order_value", 2), ("cancellation_rate", "cancellation_rate", 4)),
    ),
    "payments": (
        "payment_date",
        ("total_payments", "failed_payments"),
        (("failure_rate", "payment_failure_rate", 4), ("success_rate", "payment_success_rate", 4)),
    ),
    "deliveries": (
        "delivery_date",
        ("total_deliveries",),
        (
            ("delay_rate", "delivery_delay_rate", 4),
            ("on_time_rate", "delivery_on_time_rate", 4),
            ("avg_delay_minutes", "avg_delay_minutes", 1),
        ),
    ),
    "complaints": (
        "complaint_date",
        ("total_complaints",),
        (("severe_rate", "complaint_severe_rate", 4),),
    ),
}


def _measures(side: str) -> list[Column]:
    _, sums, means = _SIDES[side]
    return [_sum(name) for name in sums] + [_mean_of(*mean) for mean in means]


def _business_side(side: str, mart: DataFrame) -> DataFrame:
    return mart.groupBy(c(_SIDES[side][0]).alias("dt")).agg(*_measures(side))


def bh_orders(mart_order_summary: DataFrame, cfg=None, as_of=None) -> DataFrame:
    return _business_side("orders", mart_order_summary)


def bh_payments(mart_payment_health: DataFrame, cfg=None, as_of=None) -> DataFrame:
    return _business_side("payments", mart_payment_health)


def bh_deliveries(mart_delivery_performance: DataFrame, cfg=None, as_of=None) -> DataFrame:
    return _business_side("deliveries", mart_delivery_performance)


def bh_complaints(mart_complaint_insights: DataFrame, cfg=None, as_of=None) -> DataFrame:
    return _business_side("complaints", mart_complaint_insights)


def bh_ai(mart_ai_diagnosis_summary: DataFrame, cfg=None, as_of=None) -> DataFrame:
    return mart_ai_diagnosis_summary.select(
        c("run_date").alias("dt"),
        "pipeline_health_score",
        "alerts_sent",
        "llm_usage_rate",
        "avg_severity",
        "avg_confidence",
    )


def mart_business_health_daily(
    mart_order_summary: DataFrame,
    mart_payment_health: DataFrame,
    mart_delivery_performance: DataFrame,
    mart_complaint_insights: DataFrame,
    mart_ai_diagnosis_summary: DataFrame | None = None,
    cfg=None,
    as_of=None,
) -> DataFrame:
    """One row per business day.

    Every side has one row per day, so the full outer chain is a union of the sides' columns
    folded by day: one shuffle in place of four joins, and each side's second-level
    aggregation happens in the same pass. Days known only to the diagnoses are dropped.
    """
    marts = {
        "orders": mart_order_summary,
        "payments": mart_payment_health,
        "deliveries": mart_delivery_performance,
        "complaints": mart_complaint_insights,
    }
    parts = []
    for side, mart in marts.items():
        day, sums, means = _SIDES[side]
        parts.append(
            mart.select(
                c(day).alias("business_date"),
                F.lit(True).alias("_operational"),
                *sums,
                *[source for source, _, _ in means],
            )
        )
    ai_columns = {
        "pipeline_health_score": "pipeline_health_score",
        "alerts_sent": "ai_alerts_sent",
        "llm_usage_rate": "ai_llm_usage_rate",
        "avg_severity": "ai_avg_severity",
        "avg_confidence": "ai_avg_confidence",
    }
    if mart_ai_diagnosis_summary is not None:
        parts.append(
            mart_ai_diagnosis_summary.select(
                c("run_date").alias("business_date"),
                F.lit(False).alias("_operational"),
                *[c(old).alias(new) for old, new in ai_columns.items()],
            )
        )
        ai_measures = [F.max(name).alias(name) for name in ai_columns.values()]
    else:
        ai_measures = [F.lit(None).cast("double").alias(name) for name in ai_columns.values()]

    days = (
        reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        .where(c("business_date").isNotNull())
        .groupBy("business_date")
        .agg(
            F.bool_or("_operational").alias("_operational"),
            *[measure for side in marts for measure in _measures(side)],
            *ai_measures,
        )
        .where("_operational")
    )
    zero = lambda name: F.coalesce(c(name), F.lit(0)).alias(name)
    failures = F.coalesce("payment_failure_rate", F.lit(0.0))
    delays = F.coalesce("delivery_delay_rate", F.lit(0.0))
    return days.select(
        "business_date",
        *[
            zero(name)
            for name in days.columns
            if name not in ("business_date", "_operational", "pipeline_health_score", "ai_alerts_sent")
        ],
        F.coalesce("pipeline_health_score", F.lit(100.0)).alias("pipeline_health_score"),
        F.coalesce(c("ai_alerts_sent").cast("bigint"), F.lit(0)).alias("ai_alerts_sent"),
        F.when(failures > 0.30, "critical")
        .when((failures > 0.20) | (delays > 0.25), "degraded")
        .otherwise("healthy")
        .alias("overall_status"),
    )

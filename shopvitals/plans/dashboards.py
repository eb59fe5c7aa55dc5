"""Queries behind the dashboards. Ordering lives here; stored marts carry none."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shopvitals.functions.numeric import rate

c = F.col


def dash_executive(mart_business_health_daily: DataFrame) -> DataFrame:
    return mart_business_health_daily.select(
        "business_date", "total_orders", "total_revenue", "cancellation_rate", "overall_status"
    ).orderBy("business_date")


def dash_payment_by_method(mart_payment_health: DataFrame) -> DataFrame:
    """Failure rate per method over all days, weighted by payments."""
    return (
        mart_payment_health.groupBy("payment_method")
        .agg(
            F.sum("total_payments").alias("total_payments"),
            F.sum("failed_payments").alias("failed_payments"),
        )
        .withColumn("failure_rate", rate(c("failed_payments"), c("total_payments")))
        .orderBy(c("failure_rate").desc(), "payment_method")
    )


def dash_delay_heatmap(mart_delivery_performance: DataFrame) -> DataFrame:
    """Delay rate per city and day in long form: as many days as the mart holds."""
    return (
        mart_delivery_performance.groupBy("city", "delivery_date")
        .agg(
            F.sum("total_deliveries").alias("total_deliveries"),
            F.sum("delayed_deliveries").alias("delayed_deliveries"),
        )
        .withColumn("delay_rate", rate(c("delayed_deliveries"), c("total_deliveries")))
        .orderBy("city", "delivery_date")
    )


def dash_complaint_severity(mart_complaint_insights: DataFrame) -> DataFrame:
    return (
        mart_complaint_insights.groupBy("ai_severity")
        .agg(F.sum("total_complaints").alias("total_complaints"))
        .orderBy(c("total_complaints").desc(), "ai_severity")
    )


def dash_health_trend(mart_ai_diagnosis_summary: DataFrame) -> DataFrame:
    return mart_ai_diagnosis_summary.select("run_date", "pipeline_health_score").orderBy("run_date")


def dash_llm_usage(mart_ai_diagnosis_summary: DataFrame) -> DataFrame:
    """Runs answered by a model and by the rules, over all days."""
    totals = mart_ai_diagnosis_summary.agg(
        F.sum("total_diagnoses").alias("total_diagnoses"),
        F.sum("llm_diagnoses").alias("llm_diagnoses"),
        F.sum("fallback_diagnoses").alias("fallback_diagnoses"),
    )
    total = c("total_diagnoses")
    return totals.select(
        "*",
        rate(c("llm_diagnoses"), total).alias("llm_usage_rate"),
        rate(c("fallback_diagnoses"), total).alias("fallback_rate"),
    )


def dash_recent_diagnoses(stg_ai_diagnosis: DataFrame, n: int = 20) -> DataFrame:
    """The latest ``n`` diagnoses."""
    return (
        stg_ai_diagnosis.select(
            "diagnosis_id", "run_timestamp", "status", "severity", "confidence", "issue_summary",
            "diagnosis_source",
        )
        .orderBy(c("run_timestamp").desc_nulls_last(), c("diagnosis_id").desc())
        .limit(n)
    )

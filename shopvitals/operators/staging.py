"""Typed, cleaned views of the raw tables: one row in, one row out, NULL keys dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shopvitals.functions.numeric import money, whole_number
from shopvitals.functions.text import clean_label, is_label

c = F.col

# Ordinal of each severity; anything else is 0.
SEVERITY_SCORES = {"low": 1, "medium": 2, "high": 3, "critical": 4}


def _day_and_hour(ts: str, prefix: str) -> list[Column]:
    return [F.to_date(ts).alias(f"{prefix}_date"), F.hour(ts).alias(f"{prefix}_hour")]


def stg_orders(raw_orders: DataFrame, cfg=None, as_of=None) -> DataFrame:
    return raw_orders.where(c("order_id").isNotNull()).select(
        "order_id",
        "customer_id",
        F.coalesce("city", F.lit("Unknown")).alias("city"),
        "order_ts",
        *_day_and_hour("order_ts", "order"),
        money(c("order_amount")).alias("order_amount"),
        clean_label(c("order_status"), "unknown").alias("order_status"),
        is_label(c("order_status"), "cancelled").alias("is_cancelled"),
        is_label(c("order_status"), "delivered", "shipped", "confirmed").alias("is_active"),
        "created_at",
    )


def stg_payments(raw_payments: DataFrame, cfg=None, as_of=None) -> DataFrame:
    failed = is_label(c("payment_status"), "failed")
    reason = F.coalesce(F.lower(F.trim("failure_reason")), F.lit("unknown_failure"))
    return raw_payments.where(c("payment_id").isNotNull()).select(
        "payment_id",
        "order_id",
        "payment_ts",
        *_day_and_hour("payment_ts", "payment"),
        clean_label(c("payment_method"), "unknown").alias("payment_method"),
        clean_label(c("payment_status"), "unknown").alias("payment_status"),
        money(c("amount")).alias("amount"),
        F.when(failed, reason).alias("failure_reason"),
        is_label(c("payment_status"), "success").alias("is_success"),
        failed.alias("is_failed"),
        "created_at",
    )


def stg_deliveries(raw_deliveries: DataFrame, cfg=None, as_of=None) -> DataFrame:
    promised, actual = whole_number(c("promised_minutes")), whole_number(c("actual_minutes"))
    return raw_deliveries.where(c("delivery_id").isNotNull()).select(
        "delivery_id",
        "order_id",
        F.coalesce("city", F.lit("Unknown")).alias("city"),
        F.coalesce("delivery_partner", F.lit("Unknown")).alias("delivery_partner"),
        c("created_at").alias("delivery_ts"),
        *_day_and_hour("created_at", "delivery"),
        promised.alias("promised_minutes"),
        actual.alias("actual_minutes"),
        (actual - promised).alias("delay_minutes"),
        (actual > promised).alias("is_delayed"),
        clean_label(c("delivery_status"), "unknown").alias("delivery_status"),
    )


def stg_complaints(raw_complaints: DataFrame, cfg=None, as_of=None) -> DataFrame:
    severity = F.lower("ai_severity")
    score = F.lit(0)
    for label, value in SEVERITY_SCORES.items():
        score = F.when(severity == label, value).otherwise(score)
    return raw_complaints.where(c("complaint_id").isNotNull()).select(
        "complaint_id",
        "order_id",
        "complaint_ts",
        *_day_and_hour("complaint_ts", "complaint"),
        "complaint_text",
        clean_label(c("ai_category"), "uncategorized").alias("ai_category"),
        *[
            clean_label(c(name), "unknown").alias(name)
            for name in ("ai_severity", "customer_emotion", "business_impact")
        ],
        is_label(c("ai_severity"), "high", "critical").alias("is_severe"),
        is_label(c("ai_severity"), "critical").alias("is_critical"),
        score.alias("severity_score"),
        "created_at",
    )


def stg_refunds(raw_refunds: DataFrame, cfg=None, as_of=None) -> DataFrame:
    return raw_refunds.where(c("refund_id").isNotNull()).select(
        "refund_id",
        "order_id",
        "refund_ts",
        *_day_and_hour("refund_ts", "refund"),
        F.coalesce("refund_amount", F.lit(0)).alias("refund_amount"),
        clean_label(c("refund_reason"), "unknown").alias("refund_reason"),
        "created_at",
    )


def stg_ai_diagnosis(diagnoses: DataFrame, cfg=None, as_of=None) -> DataFrame:
    return diagnoses.where(c("diagnosis_id").isNotNull()).select(
        "diagnosis_id",
        "run_timestamp",
        *_day_and_hour("run_timestamp", "run"),
        clean_label(c("status"), "unknown").alias("status"),
        F.coalesce("severity", F.lit(0.0)).alias("severity"),
        F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
        "issue_summary",
        "root_cause",
        "business_impact",
        "suggested_fix",
        clean_label(c("source"), "unknown").alias("diagnosis_source"),
        F.coalesce("llm_provider", F.lit("n/a")).alias("llm_provider"),
        F.coalesce("llm_model", F.lit("n/a")).alias("llm_model"),
        F.coalesce("llm_latency_ms", F.lit(0)).alias("llm_latency_ms"),
        "alert_fingerprint",
        "alerted_at",
        c("alerted_at").isNotNull().alias("was_alerted"),
        *[
            is_label(c("status"), label).alias(f"is_{label}")
            for label in ("healthy", "degraded", "critical")
        ],
        is_label(c("source"), "llm").alias("is_llm_diagnosis"),
    )


# Which raw table feeds which staging view.
STAGING = {
    "stg_orders": ("raw_orders", stg_orders),
    "stg_payments": ("raw_payments", stg_payments),
    "stg_deliveries": ("raw_deliveries", stg_deliveries),
    "stg_complaints": ("raw_complaints", stg_complaints),
    "stg_refunds": ("raw_refunds", stg_refunds),
    "stg_ai_diagnosis": ("ai_pipeline_diagnosis", stg_ai_diagnosis),
}

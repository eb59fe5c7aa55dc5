"""Rule diagnosis, escalation to a model, and the choice between both answers.

Every step is row-wise over one row per run: (run_timestamp, features, report).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shopvitals.config import DEFAULT, MonitorConfig
from shopvitals.functions.text import percent_text
from shopvitals.operators.features import RUN

c = F.col

# Texts of a rule diagnosis.
RULE_TEXTS = {
    "root_cause": "Rule-based diagnosis. LLM skipped to reduce cost.",
    "business_impact": "Low cost monitoring mode used. Escalate to LLM only for serious issues.",
    "suggested_fix": "Review flagged metrics and run deeper investigation if issue continues.",
    "investigation_sql": (
        "SELECT failure_reason, COUNT(*) FROM raw_payments WHERE payment_status='failed' "
        "AND payment_ts >= NOW() - INTERVAL '1 hour' GROUP BY failure_reason ORDER BY 2 DESC;"
    ),
}
HEALTHY_SUMMARY = "All metrics within normal range."
RULE_CONFIDENCE = 0.5

# Texts of the rows written when a run could not be diagnosed.
FALLBACK_TEXTS = {
    "root_cause": "AI module failed — manual investigation needed",
    "business_impact": "Unknown without AI diagnosis",
    "suggested_fix": "Check AI service logs and Postgres",
    "investigation_sql": (
        "SELECT * FROM raw_payments WHERE payment_status='failed' "
        "AND payment_ts >= NOW() - INTERVAL '1 hour';"
    ),
}

DIAGNOSIS_FIELDS = (
    "status", "severity", "confidence", "issue_summary", "root_cause", "business_impact",
    "suggested_fix", "investigation_sql", "tags",
)
META_FIELDS = ("llm_provider", "llm_model", "llm_latency_ms")


def rule_diagnosis(reports: DataFrame, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    """Reports with ``rule``: the diagnosis struct the thresholds give.

    Issues, their severities and tags are listed in a fixed order; the worst one counts.
    """
    pay = c("features.payments.failure_rate")
    delay = c("features.deliveries.delay_rate")
    severe = c("features.complaints.severe_rate")
    found = c("report.anomaly_count")

    def issue(condition: Column, severity: Column, tag: str, text: Column) -> Column:
        return F.when(
            condition,
            F.struct(severity.alias("severity"), F.lit(tag).alias("tag"), text.alias("text")),
        )

    issues = F.array_compact(
        F.array(
            issue(
                pay > cfg.payment_failure_threshold, F.lit(0.7), "payment",
                F.concat(F.lit("payment failure rate "), percent_text(pay)),
            ),
            issue(
                delay > cfg.delivery_delay_threshold, F.lit(0.6), "delivery",
                F.concat(F.lit("delivery delay rate "), percent_text(delay)),
            ),
            issue(
                severe > cfg.complaint_severity_threshold, F.lit(0.6), "complaints",
                F.concat(F.lit("severe complaint rate "), percent_text(severe)),
            ),
            issue(
                found > 0, c("report.max_severity"), "anomaly",
                F.concat(found.cast("string"), F.lit(" statistical anomalies")),
            ),
            issue(
                c("features.volume.orders") == 0, F.lit(0.5), "volume",
                F.lit("no orders in current window"),
            ),
        )
    )
    listed = c("_issues")
    severity = F.round(
        F.coalesce(F.array_max(F.transform(listed, lambda i: i["severity"])), F.lit(0.0)), 2
    )
    status = (
        F.when(F.size(listed) == 0, "healthy")
        .when(severity >= 0.7, "critical")
        .otherwise("degraded")
    )
    summary = F.when(F.size(listed) == 0, F.lit(HEALTHY_SUMMARY)).otherwise(
        F.array_join(F.transform(listed, lambda i: i["text"]), "; ")
    )
    tags = F.concat(F.array(F.lit("rule_based")), F.transform(listed, lambda i: i["tag"]))
    return reports.withColumn("_issues", issues).select(
        *reports.columns,
        F.struct(
            status.alias("status"),
            severity.alias("severity"),
            F.lit(RULE_CONFIDENCE).alias("confidence"),
            summary.alias("issue_summary"),
            *[F.lit(text).alias(name) for name, text in RULE_TEXTS.items()],
            tags.alias("tags"),
            F.lit("rule_based").alias("llm_provider"),
            F.lit("n/a").alias("llm_model"),
            F.lit(None).cast("int").alias("llm_latency_ms"),
        ).alias("rule"),
    )


def llm_gate(diagnosed: DataFrame, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    """Adds ``escalate``: is this run worth a model call?"""
    serious = (
        (c("rule.severity") >= cfg.gate_min_severity)
        | (c("report.anomaly_count") >= cfg.gate_min_anomalies)
        | (c("report.max_severity") >= cfg.gate_min_anomaly_severity)
    )
    return diagnosed.withColumn(
        "escalate", F.lit(cfg.model_configured) & (c("rule.status") != "healthy") & serious
    )


def diagnosis_select(
    gated: DataFrame, answers: DataFrame | None, cfg: MonitorConfig = DEFAULT, as_of=None
) -> DataFrame:
    """Adds ``diagnosis`` and ``source``.

    ``answers`` holds at most one valid model diagnosis per run (``run_timestamp``,
    ``answer``). An escalated run without one falls back to the rules.
    """
    if answers is None:
        joined = gated.withColumn("answer", F.lit(None).cast(gated.schema["rule"].dataType))
    else:
        joined = gated.join(answers, RUN, "left")
    use_model = c("escalate") & c("answer").isNotNull()
    return joined.select(
        *gated.columns,
        F.when(use_model, c("answer")).otherwise(c("rule")).alias("diagnosis"),
        F.when(use_model, "llm")
        .when(c("escalate"), "fallback")
        .otherwise("rule_based_cost_saved")
        .alias("source"),
    )


def dag_fallback_rows(failed_runs: DataFrame, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    """Audit rows for runs that broke.

    Input: (run_timestamp, orders_count, failure_rate, lost_audit). A run whose diagnosis
    failed gets a full fallback row; one whose audit write failed as well gets the emergency
    row, which has a status and a summary only.
    """
    figures = F.concat(
        F.lit("orders="),
        F.coalesce(c("orders_count").cast("string"), F.lit("None")),
        F.lit(", failure_rate="),
        F.coalesce(c("failure_rate").cast("string"), F.lit("None")),
    )
    lost = c("lost_audit")

    def full_only(value: Column) -> Column:
        return F.when(~lost, value)

    return failed_runs.select(
        RUN,
        F.when(lost, "warning").otherwise("degraded").alias("status"),
        full_only(F.lit(0.5)).alias("severity"),
        full_only(F.lit(0.3)).alias("confidence"),
        F.concat(
            F.when(lost, "Total fallback. ").otherwise("AI unavailable. "), figures
        ).alias("issue_summary"),
        *[full_only(F.lit(text)).alias(name) for name, text in FALLBACK_TEXTS.items()],
        full_only(F.array(F.lit("dag_fallback"))).alias("tags"),
        full_only(F.lit("{}")).alias("features_json"),
        full_only(F.lit("{}")).alias("anomalies_json"),
        F.when(lost, "dag_emergency_fallback").otherwise("dag_fallback").alias("source"),
        full_only(F.lit("fallback")).alias("llm_provider"),
        full_only(F.lit("n/a")).alias("llm_model"),
        F.lit(None).cast("int").alias("llm_latency_ms"),
        full_only(F.lit("dag_fallback")).alias("alert_fingerprint"),
        F.lit(None).cast("timestamp").alias("alerted_at"),
    )

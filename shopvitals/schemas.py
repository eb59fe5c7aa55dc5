"""Schemas of the raw tables, the events on the wire and the audit table."""

from __future__ import annotations

from pyspark.sql import types as T

#: Raw amounts as given: up to 22 whole digits, ten decimals. Rounding belongs to staging.
MONEY = T.DecimalType(32, 10)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_TEXT, _TIME, _INT, _LONG, _DOUBLE = (
    T.StringType(),
    T.TimestampType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
)

RAW_ORDERS = _struct(
    order_id=_TEXT, customer_id=_TEXT, city=_TEXT, order_ts=_TIME,
    order_amount=MONEY, order_status=_TEXT, created_at=_TIME,
)
RAW_PAYMENTS = _struct(
    payment_id=_TEXT, order_id=_TEXT, payment_ts=_TIME, payment_method=_TEXT,
    payment_status=_TEXT, amount=MONEY, failure_reason=_TEXT, created_at=_TIME,
)
RAW_DELIVERIES = _struct(
    delivery_id=_TEXT, order_id=_TEXT, city=_TEXT, delivery_partner=_TEXT,
    promised_minutes=_INT, actual_minutes=_INT, delivery_status=_TEXT, created_at=_TIME,
)
RAW_REFUNDS = _struct(
    refund_id=_TEXT, order_id=_TEXT, refund_ts=_TIME, refund_amount=MONEY,
    refund_reason=_TEXT, created_at=_TIME,
)
RAW_COMPLAINTS = _struct(
    complaint_id=_TEXT, order_id=_TEXT, complaint_ts=_TIME, complaint_text=_TEXT,
    ai_category=_TEXT, ai_severity=_TEXT, customer_emotion=_TEXT, business_impact=_TEXT,
    recommended_action=_TEXT, created_at=_TIME,
)
PIPELINE_LOGS = _struct(
    log_id=_LONG, component=_TEXT, status=_TEXT, message=_TEXT, created_at=_TIME,
)
DIAGNOSES = _struct(
    diagnosis_id=_LONG, run_timestamp=_TIME, status=_TEXT, severity=_DOUBLE,
    confidence=_DOUBLE, issue_summary=_TEXT, root_cause=_TEXT, business_impact=_TEXT,
    suggested_fix=_TEXT, investigation_sql=_TEXT, tags=T.ArrayType(_TEXT),
    features_json=_TEXT, anomalies_json=_TEXT, source=_TEXT, llm_provider=_TEXT,
    llm_model=_TEXT, llm_latency_ms=_INT, alert_fingerprint=_TEXT, alerted_at=_TIME,
    created_at=_TIME,
)

RAW_TABLES: dict[str, T.StructType] = {
    "raw_orders": RAW_ORDERS,
    "raw_payments": RAW_PAYMENTS,
    "raw_deliveries": RAW_DELIVERIES,
    "raw_complaints": RAW_COMPLAINTS,
    "raw_refunds": RAW_REFUNDS,
    "ai_pipeline_diagnosis": DIAGNOSES,
}
TABLE_KEYS = {
    "raw_orders": "order_id",
    "raw_payments": "payment_id",
    "raw_deliveries": "delivery_id",
    "raw_complaints": "complaint_id",
    "raw_refunds": "refund_id",
    "ai_pipeline_diagnosis": "diagnosis_id",
}

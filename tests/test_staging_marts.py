from datetime import date
from decimal import Decimal

import pytest

from shopvitals.operators import marts, staging
from shopvitals.plans import warehouse


def one(frame):
    (row,) = frame.collect()
    return row.asDict()


@pytest.mark.parametrize(
    "amount, expected",
    [("n/a", "0.00"), ("", "0.00"), (None, "0.00"), ("123456789012", "0.00"), ("12.345", "12.35")],
)
def test_unreadable_amounts_count_as_zero(rows, amount, expected):
    raw = rows(
        [("o1", "c1", None, "2024-01-01 05:10:00", amount, None, None)],
        "order_id string, customer_id string, city string, order_ts timestamp, "
        "order_amount string, order_status string, created_at timestamp",
    )
    row = one(staging.stg_orders(raw))
    assert row["order_amount"] == Decimal(expected)
    assert row["city"] == "Unknown" and row["order_status"] == "unknown"
    assert row["is_cancelled"] is False and row["is_active"] is False
    assert row["order_date"] == date(2024, 1, 1) and row["order_hour"] == 5


def test_null_keys_are_dropped(rows):
    raw = rows(
        [(None, "c", None, None, "1", "cancelled", None), ("o", "c", None, None, "1", " Cancelled", None)],
        "order_id string, customer_id string, city string, order_ts timestamp, "
        "order_amount string, order_status string, created_at timestamp",
    )
    row = one(staging.stg_orders(raw))
    # The label is trimmed, the flag is not.
    assert row["order_status"] == "cancelled" and row["is_cancelled"] is False


PAYMENT = (
    "payment_id string, order_id string, payment_ts timestamp, payment_method string, "
    "payment_status string, amount string, failure_reason string, created_at timestamp"
)


@pytest.mark.parametrize(
    "status, reason, label, failed, kept",
    [
        (" Failed", "x", "failed", False, None),
        ("FAILED", None, "failed", True, "unknown_failure"),
        ("failed", " Gateway_Error", "failed", True, "gateway_error"),
        (None, "x", "unknown", False, None),
    ],
)
def test_payment_failure_reason(rows, status, reason, label, failed, kept):
    row = one(staging.stg_payments(rows([("p", "o", None, None, status, "1", reason, None)], PAYMENT)))
    assert (row["payment_status"], row["is_failed"], row["failure_reason"]) == (label, failed, kept)


def test_missing_minutes_count_as_zero(rows):
    raw = rows(
        [("d", "o", None, None, None, "40", None, "2024-01-01 00:00:00")],
        "delivery_id string, order_id string, city string, delivery_partner string, "
        "promised_minutes string, actual_minutes string, delivery_status string, created_at timestamp",
    )
    row = one(staging.stg_deliveries(raw))
    assert row["delay_minutes"] == 40 and row["is_delayed"] is True
    assert row["delivery_partner"] == "Unknown"


@pytest.mark.parametrize(
    "severity, score, severe", [("Critical", 4, True), ("high", 3, True), ("medium", 2, False),
                                ("low", 1, False), ("odd", 0, False), (None, 0, False)]
)
def test_complaint_severity_score(rows, severity, score, severe):
    raw = rows(
        [("c", "o", None, "t", None, severity, None, None, None, None)],
        "complaint_id string, order_id string, complaint_ts timestamp, complaint_text string, "
        "ai_category string, ai_severity string, customer_emotion string, business_impact string, "
        "recommended_action string, created_at timestamp",
    )
    row = one(staging.stg_complaints(raw))
    assert row["severity_score"] == score and row["is_severe"] is severe
    assert row["ai_category"] == "uncategorized"


def payments(rows, statuses):
    return staging.stg_payments(
        rows(
            [(f"p{i}", "o", "2024-01-01 00:00:00", "UPI", s, "1.00", None, None) for i, s in enumerate(statuses)],
            PAYMENT,
        )
    )


@pytest.mark.parametrize("failed, tier", [(1, "healthy"), (2, "warning"), (3, "critical")])
def test_payment_tiers_include_their_bound(rows, failed, tier):
    row = one(marts.mart_payment_health(payments(rows, ["failed"] * failed + ["success"] * (10 - failed))))
    assert row["health_status"] == tier
    assert row["failure_rate"] == failed / 10


def test_cancelled_orders_count_in_revenue(rows):
    raw = rows(
        [("1", "a", "X", "2024-01-01 00:00:00", "10.00", "cancelled", None),
         ("2", "a", "X", "2024-01-01 23:00:00", "0.01", "created", None)],
        "order_id string, customer_id string, city string, order_ts timestamp, "
        "order_amount string, order_status string, created_at timestamp",
    )
    row = one(marts.mart_order_summary(staging.stg_orders(raw)))
    assert row["total_revenue"] == Decimal("10.01")
    assert row["avg_order_value"] == Decimal("5.01")  # 5.005 rounds up
    assert (row["active_orders"], row["cancelled_orders"], row["unique_customers"]) == (1, 1, 1)


DIAGNOSIS = (
    "diagnosis_id bigint, run_timestamp timestamp, status string, severity double, "
    "confidence double, issue_summary string, root_cause string, business_impact string, "
    "suggested_fix string, source string, llm_provider string, llm_model string, "
    "llm_latency_ms int, alert_fingerprint string, alerted_at timestamp"
)


def diagnosis(i, ts, status, severity=None, source="llm"):
    return (i, ts, status, severity, None, None, None, None, None, source, None, None, None, None, None)


def test_emergency_rows_count_but_score_nothing(rows):
    staged = staging.stg_ai_diagnosis(
        rows(
            [diagnosis(1, "2024-01-01 00:00:00", "healthy", 0.4),
             diagnosis(2, "2024-01-01 00:15:00", "warning", None, "dag_emergency_fallback")],
            DIAGNOSIS,
        )
    )
    row = one(marts.mart_ai_diagnosis_summary(staged))
    assert row["total_diagnoses"] == 2 and row["fallback_diagnoses"] == 1
    assert row["pipeline_health_score"] == 50.0 and row["avg_severity"] == 0.2


def test_business_health_days(rows):
    """A day only complaints know is kept, one only diagnoses know is dropped."""
    pay = marts.mart_payment_health(payments(rows, ["failed"] * 4 + ["success"] * 6))
    complaints = rows(
        [("2024-01-02", "x", "low", "calm", 3, 0, 0, 0.0, 1.0), (None, "x", "low", "calm", 3, 0, 0, 0.0, 1.0)],
        "complaint_date date, ai_category string, ai_severity string, customer_emotion string, "
        "total_complaints bigint, severe_complaints bigint, critical_complaints bigint, "
        "severe_rate double, avg_severity_score double",
    )
    ai = marts.mart_ai_diagnosis_summary(
        staging.stg_ai_diagnosis(
            rows([diagnosis(1, "2024-01-01 00:00:00", "degraded"), diagnosis(2, "2024-01-03 00:00:00", "healthy")], DIAGNOSIS)
        )
    )
    orders = rows(
        [],
        "order_date date, city string, total_orders bigint, total_revenue decimal(20,2), "
        "avg_order_value decimal(20,2), cancellation_rate double",
    )
    deliveries = rows(
        [],
        "delivery_date date, total_deliveries bigint, delay_rate double, on_time_rate double, "
        "avg_delay_minutes double",
    )
    days = {
        r["business_date"]: r
        for r in marts.mart_business_health_daily(orders, pay, deliveries, complaints, ai).collect()
    }
    assert set(days) == {date(2024, 1, 1), date(2024, 1, 2)}
    first, second = days[date(2024, 1, 1)], days[date(2024, 1, 2)]
    assert first["overall_status"] == "critical" and first["pipeline_health_score"] == 50.0
    assert second["overall_status"] == "healthy" and second["pipeline_health_score"] == 100.0
    assert second["total_orders"] == 0 and second["total_complaints"] == 3


def test_stored_marts_equal_lazy_marts(spark, tmp_path):
    from registry.inputs import Inputs
    from tests.conftest import TESTDATA

    inputs = Inputs(spark, TESTDATA)
    raw = {**inputs.raw("b"), "ai_pipeline_diagnosis": rows_of_diagnoses(spark)}
    views = warehouse.staging_views(raw, register=True)
    assert spark.table("stg_orders").count() == views["stg_orders"].count()
    stored = warehouse.write_marts(views, str(tmp_path))
    for name, mart in warehouse.mart_frames(views).items():
        assert mart.exceptAll(stored[name]).isEmpty() and stored[name].exceptAll(mart).isEmpty()


def rows_of_diagnoses(spark):
    from shopvitals import schemas

    return spark.createDataFrame([], schemas.DIAGNOSES)


def test_whole_numbers_past_32_bits_are_kept(rows):
    from pyspark.sql import functions as F
    from shopvitals.functions.numeric import whole_number

    frame = rows([("3000000000",), ("2.5",), ("x",), (None,)], "v string")
    assert [r[0] for r in frame.select(whole_number(F.col("v"))).collect()] == [3_000_000_000, 3, 0, 0]

"""Raw tables to staging views to marts, lazily or written out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from shopvitals.operators import marts
from shopvitals.operators.staging import STAGING
from shopvitals.session import side_by_side

# Marts in dependency order with their inputs.
MARTS = {
    "mart_order_summary": (marts.mart_order_summary, ("stg_orders",)),
    "mart_payment_health": (marts.mart_payment_health, ("stg_payments",)),
    "mart_delivery_performance": (marts.mart_delivery_performance, ("stg_deliveries",)),
    "mart_complaint_insights": (marts.mart_complaint_insights, ("stg_complaints",)),
    "mart_ai_diagnosis_summary": (marts.mart_ai_diagnosis_summary, ("stg_ai_diagnosis",)),
    "mart_business_health_daily": (
        marts.mart_business_health_daily,
        (
            "mart_order_summary", "mart_payment_health", "mart_delivery_performance",
            "mart_complaint_insights", "mart_ai_diagnosis_summary",
        ),
    ),
}
# Key of each staging view.
TABLE_KEY = {
    "stg_orders": "order_id", "stg_payments": "payment_id", "stg_deliveries": "delivery_id",
    "stg_complaints": "complaint_id", "stg_refunds": "refund_id",
}
# Column a stored mart is sorted by inside its files, for the readers' min/max pruning.
MART_DAYS = {
    "mart_order_summary": "order_date",
    "mart_payment_health": "payment_date",
    "mart_delivery_performance": "delivery_date",
    "mart_complaint_insights": "complaint_date",
    "mart_ai_diagnosis_summary": "run_date",
    "mart_business_health_daily": "business_date",
}


def staging_views(raw: Mapping[str, DataFrame], register: bool = False) -> dict[str, DataFrame]:
    """The staging layer; with ``register`` also as temporary views under the same names."""
    views = {name: build(raw[table]) for name, (table, build) in STAGING.items() if table in raw}
    if register:
        for name, view in views.items():
            view.createOrReplaceTempView(name)
    return views


def mart_frames(staging: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The marts as plans on top of the staging views."""
    built: dict[str, DataFrame] = dict(staging)
    for name, (build, inputs) in MARTS.items():
        built[name] = build(*[built[i] for i in inputs])
    return {name: built[name] for name in MARTS}


def write_marts(staging: Mapping[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Write each mart under ``root`` and return the stored tables.

    Marts whose inputs are there are written at the same time. The daily health mart reads the
    stored marts, so staging is scanned once per mart.
    """
    built: dict[str, DataFrame] = dict(staging)

    def store(name: str) -> DataFrame:
        build, inputs = MARTS[name]
        mart = build(*[built[i] for i in inputs])
        path = f"{root}/{name}"
        mart.sortWithinPartitions(MART_DAYS[name]).write.mode("overwrite").parquet(path)
        return mart.sparkSession.read.schema(mart.schema).parquet(path)

    waiting = list(MARTS)
    while waiting:
        ready = [name for name in waiting if all(i in built for i in MARTS[name][1])]
        built.update(zip(ready, side_by_side(store, ready)))
        waiting = [name for name in waiting if name not in ready]
    return {name: built[name] for name in MARTS}

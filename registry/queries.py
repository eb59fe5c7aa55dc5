"""The registered queries: name to function of (spark, folder of test data)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from registry.inputs import Inputs, comparable
from shopvitals import schemas
from shopvitals.functions.time import half_hour_bucket
from shopvitals.operators import (
    anomalies, complaints, decisions, diagnosis, features, ingest, marts, model_contract,
    quality, sinks, staging,
)
from shopvitals.operators.features import RUN
from shopvitals.plans import dashboards, incremental, monitor, warehouse
from shopvitals.session import materialize, pin_streaming, shared_dir, side_by_side
from shopvitals.sources.tables import backup_calendar, scan_backup, scan_backup_days
from shopvitals.sources.topics import fixture_messages
from shopvitals.streaming import gate as stream_gate
from shopvitals.streaming import ingest as stream_ingest_jobs
from shopvitals.streaming import monitor as stream_monitor
from shopvitals.streaming import windows as stream_windows
from shopvitals.streaming.sinks import compact, create_table, read_table, write_batch

c = F.col
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

RUN_AT = datetime(2024, 2, 1, 6, 30, 0)  # when the backups of these queries are taken
AS_OF = "2024-01-15 12:00:00"


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(Inputs(spark, sf_dir)))

    QUERIES[build.__name__] = run
    return build


# ------------------------------------------------------------------------ ingest


@query
def decode_messages(inputs):
    """Every message with what is wrong with it, if anything."""
    parts = None
    for kind in ingest.EVENT_KINDS.values():
        rows = ingest.decode(inputs.messages, kind).select(
            "topic", "offset", c(kind.key).alias("event_key"), "problem"
        )
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


@query
def ingest_route(inputs):
    """Rows routed to each table, and messages kept out of it."""
    parts = None
    for table, (rows, bad) in ingest.ingest_route(inputs.messages).items():
        for outcome, frame in (("loadable", rows), ("quarantined", bad)):
            counted = frame.agg(F.count("*").alias("n")).select(
                F.lit(table).alias("table_name"), F.lit(outcome).alias("outcome"), "n"
            )
            parts = counted if parts is None else parts.unionByName(counted)
    return parts


@query
def parse_event_ts(inputs):
    return ingest.parse_event_times(inputs.messages).select("topic", "offset", "event_ts")


@query
def ingest_orders(inputs):
    return ingest.ingest_orders(inputs.messages)


@query
def ingest_payments(inputs):
    return ingest.ingest_payments(inputs.messages)


@query
def ingest_deliveries(inputs):
    return ingest.ingest_deliveries(inputs.messages)


@query
def ingest_refunds(inputs):
    return ingest.ingest_refunds(inputs.messages)


@query
def ingest_complaints(inputs):
    return ingest.ingest_complaints(inputs.messages)


@query
def dedup_first_write(inputs):
    """First write per key of every raw table, less the keys a target already holds (every third event's)."""
    def fresh_of(name):
        kind = ingest.EVENT_KINDS[name]
        rows = ingest.decode(inputs.messages, kind).where(c("problem").isNull()).drop("problem", "topic", "value")
        stored = inputs.view("b_complaint_events" if name == "complaints" else f"b_{kind.table}")
        held = stored.where(F.substring(kind.key, 5, 20).cast("bigint") % 3 == 0)
        return ingest.dedup_first_write(rows, kind.key, existing=held).select(
            F.lit(kind.table).alias("table_name"), c(kind.key).alias("event_key"),
            c("customer_id" if name == "orders" else "order_id").alias("other_id"), "created_at",
        )

    return reduce(DataFrame.unionByName, side_by_side(fresh_of, ingest.EVENT_KINDS))


@query
def quarantine(inputs):
    return ingest.quarantine(inputs.messages).select(
        "component", "status", "message", "created_at"
    )


# ------------------------------------------------------------------------ staging


@query
def stg_orders(inputs):
    return staging.stg_orders(inputs.view("a_raw_orders"))


@query
def stg_payments(inputs):
    return staging.stg_payments(inputs.view("a_raw_payments"))


@query
def stg_deliveries(inputs):
    return staging.stg_deliveries(inputs.view("a_raw_deliveries"))


@query
def stg_complaints(inputs):
    return staging.stg_complaints(inputs.raw("a", "raw_complaints")["raw_complaints"])


@query
def stg_refunds(inputs):
    return staging.stg_refunds(inputs.view("a_raw_refunds"))


@query
def stg_ai_diagnosis(inputs):
    return staging.stg_ai_diagnosis(inputs.audit())


# ------------------------------------------------------------------------ marts


def _mart(inputs: Inputs, family: str, name: str) -> DataFrame:
    build, (source,) = warehouse.MARTS[name]
    table, clean = staging.STAGING[source]
    raw = inputs.audit() if table == "ai_pipeline_diagnosis" else inputs.raw(family, table)[table]
    return build(clean(raw))


@query
def mart_order_summary(inputs):
    return _mart(inputs, "a", "mart_order_summary")


@query
def mart_payment_health(inputs):
    return _mart(inputs, "a", "mart_payment_health")


@query
def mart_delivery_performance(inputs):
    return _mart(inputs, "a", "mart_delivery_performance")


@query
def mart_complaint_insights(inputs):
    return _mart(inputs, "a", "mart_complaint_insights")


@query
def mart_ai_diagnosis_summary(inputs):
    return _mart(inputs, "b", "mart_ai_diagnosis_summary")


@query
def bh_orders(inputs):
    return marts.bh_orders(_mart(inputs, "a", "mart_order_summary"))


@query
def bh_payments(inputs):
    return marts.bh_payments(_mart(inputs, "a", "mart_payment_health"))


@query
def bh_deliveries(inputs):
    return marts.bh_deliveries(_mart(inputs, "a", "mart_delivery_performance"))


@query
def bh_complaints(inputs):
    return marts.bh_complaints(_mart(inputs, "a", "mart_complaint_insights"))


@query
def bh_ai(inputs):
    return marts.bh_ai(_mart(inputs, "b", "mart_ai_diagnosis_summary"))


def _business_health(inputs: Inputs, family: str, with_ai: bool) -> DataFrame:
    names = ("mart_order_summary", "mart_payment_health", "mart_delivery_performance",
             "mart_complaint_insights")
    sides = [_mart(inputs, family, name) for name in names]
    ai = _mart(inputs, family, "mart_ai_diagnosis_summary") if with_ai else None
    return marts.mart_business_health_daily(*sides, ai)


@query
def mart_business_health_daily(inputs):
    """Event grain: days that also have diagnoses."""
    return _business_health(inputs, "b", True)


@query
def mart_business_health_history(inputs):
    """Warehouse grain: years of days, none of them diagnosed."""
    return _business_health(inputs, "a", False)


# ------------------------------------------------------------------------ features


def _pairs(entries: Column, label: str) -> Column:
    """A top list as ``value:count`` text."""
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e[label], F.lit(":"), e["cnt"].cast("string"))), ","
    )


def _flat_features(snapshots: DataFrame) -> DataFrame:
    f = "features."
    return snapshots.select(
        RUN,
        c(f + "window_minutes").alias("window_minutes"),
        c(f + "volume.orders").alias("orders"),
        c(f + "volume.revenue").alias("revenue"),
        _pairs(c(f + "volume.top_order_cities"), "city").alias("top_order_cities"),
        c(f + "payments.total").alias("payments"),
        c(f + "payments.failed").alias("failed"),
        c(f + "payments.success").alias("success"),
        c(f + "payments.failure_rate").alias("failure_rate"),
        _pairs(c(f + "payments.top_failure_reasons"), "failure_reason").alias("top_failure_reasons"),
        c(f + "deliveries.total").alias("deliveries"),
        c(f + "deliveries.delayed").alias("delayed"),
        c(f + "deliveries.delay_rate").alias("delay_rate"),
        c(f + "deliveries.avg_delay_minutes").alias("avg_delay_minutes"),
        _pairs(c(f + "deliveries.top_delayed_cities"), "city").alias("top_delayed_cities"),
        c(f + "complaints.total").alias("complaints"),
        c(f + "complaints.severe").alias("severe"),
        c(f + "complaints.severe_rate").alias("severe_rate"),
        _pairs(c(f + "complaints.top_categories"), "ai_category").alias("top_categories"),
    )


def _history(inputs: Inputs, table: str, *columns: str) -> DataFrame:
    return _flat_features(features.features_replay(inputs.cells(table))).select(RUN, *columns)


@query
def feat_orders(inputs):
    return _history(inputs, "raw_orders", "orders")


@query
def feat_revenue(inputs):
    return _history(inputs, "raw_orders", "revenue")


@query
def feat_top_cities(inputs):
    return _history(inputs, "raw_orders", "top_order_cities")


@query
def feat_payments(inputs):
    return _history(inputs, "raw_payments", "payments", "failed", "success", "failure_rate")


@query
def feat_top_failure_reasons(inputs):
    return _history(inputs, "raw_payments", "top_failure_reasons")


@query
def feat_deliveries(inputs):
    return _history(
        inputs, "raw_deliveries", "deliveries", "delayed", "delay_rate", "avg_delay_minutes"
    )


@query
def feat_top_delayed_cities(inputs):
    return _history(inputs, "raw_deliveries", "top_delayed_cities")


@query
def feat_complaints(inputs):
    return _history(inputs, "raw_complaints", "complaints", "severe", "severe_rate")


@query
def feat_top_categories(inputs):
    return _history(inputs, "raw_complaints", "top_categories")


@query
def features_history(inputs):
    return _flat_features(features.features_replay(inputs.cells()))


@query
def features_now(inputs):
    """The snapshot a live run takes, here as of one instant."""
    return _flat_features(features.features_as_of(inputs.activity(), as_of=AS_OF))


@query
def probe_recent_orders(inputs):
    return features.probe_recent_orders(inputs.cells("raw_orders"))


@query
def probe_payment_failure(inputs):
    return features.probe_payment_failure(inputs.cells("raw_payments"))


@query
def investigate_failures(inputs):
    return features.investigate_failures(inputs.cells("raw_payments"))


@query
def failed_payments_last_hour(inputs):
    return features.failed_payments_replay(inputs.view("b_raw_payments")).select(
        RUN, "payment_id", "payment_method", "amount", "failure_reason"
    )


# ------------------------------------------------------------------------ anomalies


@query
def bucket_30min(inputs):
    """Events of every monitored table with their half hour."""
    times = {"raw_orders": "order_ts", "raw_payments": "payment_ts", "raw_deliveries": "created_at", "raw_complaints": "complaint_ts"}
    parts = None
    for name, table in inputs.raw("b", *times).items():
        rows = table.select(c(schemas.TABLE_KEYS[name]).alias("key"), half_hour_bucket(c(times[name])).alias("bucket"))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


def _baseline(inputs: Inputs, table: str) -> DataFrame:
    buckets = anomalies.baseline_buckets(inputs.cells(table))
    return buckets.select(RUN, "bucket", F.round("value", 9).alias("value"))


@query
def baseline_payment_failure(inputs):
    return _baseline(inputs, "raw_payments")


@query
def baseline_delivery_delay(inputs):
    return _baseline(inputs, "raw_deliveries")


@query
def baseline_order_volume(inputs):
    return _baseline(inputs, "raw_orders")


@query
def baseline_complaint_severe(inputs):
    return _baseline(inputs, "raw_complaints")


@query
def baseline_stats(inputs):
    stats = anomalies.baseline_stats(anomalies.baseline_buckets(inputs.cells()))
    return stats.select(
        RUN, "metric", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std")
    )


@query
def anomaly_rows(inputs):
    return anomalies.anomalies(inputs.reports())


@query
def anomaly_summary(inputs):
    return anomalies.anomaly_summary(inputs.reports()).select(
        RUN,
        "anomaly_count",
        "max_severity",
        F.array_join(F.transform("anomalies", lambda a: a["metric"]), ",").alias("metrics"),
    )


# ------------------------------------------------------------------------ complaints


@query
def classify_complaint_rules(inputs):
    return complaints.classify_complaint_rules(inputs.view("a_complaint_events")).select(
        "complaint_id", *complaints.LABEL_FIELDS
    )


@query
def normalize_complaint_labels(inputs):
    return complaints.normalize_complaint_labels(inputs.label_answers()).select(
        "complaint_id", *complaints.LABEL_FIELDS
    )


@query
def complaint_prompt(inputs):
    """Prompts of all complaints with a text, with what they carry."""
    return complaints.complaint_prompt(inputs.view("a_complaint_events")).select(
        "complaint_id", "provider", "model",
        F.get_json_object("user_prompt", "$.complaint_text").alias("complaint_text"),
        c("system_prompt").contains("one of low, medium, high, critical").alias("names_severities"),
    )


@query
def ingest_complaints_model(inputs):
    """Complaints as they are stored with a model's answers."""
    return ingest.ingest_complaints(inputs.messages, answers=inputs.complaint_answers())


# ------------------------------------------------------------------------ diagnosis


def _flat_diagnosis(frame: DataFrame, struct: str, *extra: str) -> DataFrame:
    return frame.select(
        RUN,
        *[c(f"{struct}.{name}").alias(name) for name in diagnosis.DIAGNOSIS_FIELDS],
        *[c(f"{struct}.{name}").alias(name) for name in diagnosis.META_FIELDS],
        *extra,
    )


@query
def rule_diagnosis(inputs):
    return _flat_diagnosis(diagnosis.rule_diagnosis(inputs.reports()), "rule")


@query
def llm_gate(inputs):
    gated = diagnosis.llm_gate(diagnosis.rule_diagnosis(inputs.reports()))
    return gated.select(RUN, c("rule.status").alias("status"), "escalate")


@query
def diagnosis_select(inputs):
    return _flat_diagnosis(inputs.selected(), "diagnosis", "source")


@query
def dag_fallback_rows(inputs):
    """Fallback rows for every tick; each third one also lost its audit write."""
    cell_rows = inputs.cells("raw_orders", "raw_payments")
    probes = features.probe_recent_orders(cell_rows).join(
        features.probe_payment_failure(cell_rows), RUN
    )
    broken = probes.select(
        RUN,
        "orders_count",
        F.round("failure_rate", 4).alias("failure_rate"),
        (F.unix_seconds(RUN) / 900 % 3 == 0).alias("lost_audit"),
    )
    return diagnosis.dag_fallback_rows(broken)


def _json_number(text: str, path: str) -> Column:
    return F.get_json_object(text, path).cast("double")


@query
def llm_prompt(inputs):
    """Prompts, with the figures read back out of their JSON parts."""
    gated = diagnosis.llm_gate(diagnosis.rule_diagnosis(inputs.reports()))
    prompts = model_contract.llm_prompt(gated)
    read = {
        "window_minutes": "$.window_minutes",
        "orders": "$.metrics.volume.orders",
        "revenue": "$.metrics.volume.revenue",
        "failure_rate": "$.metrics.payments.failure_rate",
        "delay_rate": "$.metrics.deliveries.delay_rate",
        "severe_rate": "$.metrics.complaints.severe_rate",
        "anomaly_count": "$.anomalies.anomaly_count",
        "max_severity": "$.anomalies.max_severity",
    }
    return prompts.select(
        RUN, "provider", "model", *[_json_number("user_prompt", path).alias(name) for name, path in read.items()]
    )


@query
def validate_llm_response(inputs):
    """Every answer, two per event, with the reason it is refused for."""
    checked = model_contract.validate_llm_response(inputs.answers_per_event())
    return checked.select(
        "n",
        "attempt",
        "reason",
        c("answer.status").alias("status"),
        c("answer.severity").alias("severity"),
        c("answer.confidence").alias("confidence"),
        c("answer.issue_summary").alias("issue_summary"),
        c("answer.tags").alias("tags"),
    )


@query
def llm_answer_meta(inputs):
    """Provider, model, latency and attempt of the answer each run gets."""
    checked = model_contract.validate_llm_response(inputs.answers_per_tick())
    return model_contract.first_valid_answer(checked).select(
        RUN,
        "attempt",
        *[c(f"answer.{name}").alias(name) for name in diagnosis.META_FIELDS],
    )


# ------------------------------------------------------------------------ decisions


@query
def alert_fingerprint(inputs):
    return decisions.alert_fingerprint(inputs.selected()).select(
        RUN, c("diagnosis.status").alias("status"), "alert_fingerprint"
    )


@query
def alert_candidates(inputs):
    return decisions.alert_candidates(inputs.selected()).select(RUN, "candidate")


@query
def alert_suppress(inputs):
    return monitor.decide(inputs.selected()).select(
        RUN, "alert_fingerprint", "candidate", "should_alert", "suppression_reason"
    )


@query
def recently_alerted(inputs):
    """Candidates whose fingerprint the audit table shows as alerted within the window."""
    decided = monitor.decide(inputs.selected())
    history = decided.select(
        "alert_fingerprint", F.when(c("should_alert"), c(RUN)).alias("alerted_at")
    )
    asked = decided.where("candidate").select(RUN, "alert_fingerprint")
    return decisions.recently_alerted(asked, history)


@query
def alert_routing(inputs):
    return decisions.alert_routing(inputs.selected()).select(
        RUN,
        c("diagnosis.status").alias("status"),
        c("diagnosis.severity").alias("severity"),
        "routing",
    )


@query
def alert_message(inputs):
    return decisions.alert_message(monitor.decide(inputs.selected())).select(RUN, "message")


@query
def diagnosis_record(inputs):
    """The audit table; its JSON columns appear as figures read back out of them."""
    rows = inputs.audit()
    kept = [name for name in rows.columns if not name.endswith("_json")]
    return rows.select(
        *kept,
        _json_number("features_json", "$.volume.orders").alias("json_orders"),
        _json_number("features_json", "$.deliveries.avg_delay_minutes").alias("json_avg_delay"),
        F.get_json_object("features_json", "$.payments.top_failure_reasons[0].failure_reason").alias(
            "json_top_reason"
        ),
        _json_number("anomalies_json", "$.anomaly_count").alias("json_anomaly_count"),
        F.get_json_object("anomalies_json", "$.anomalies[0].metric").alias("json_first_metric"),
    )


# ------------------------------------------------------------------------ sinks


def _root(inputs: Inputs, label: str) -> str:
    return shared_dir(inputs.spark, label)


def _content(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, n_values, digest) of every column and of whole rows, but for generated text.

    JSON text and the ids of log rows, which SQL does not form, are only counted.
    """
    parts = None
    for name, table in tables.items():
        generated = [column for column in table.columns if column.lower().endswith("_json") or column.lower() == "log_id"]
        counted = sinks.content(table).where(c("column_name").isin(*generated)).withColumn("digest", F.lit(None).cast("string"))
        rows = sinks.content(table.drop(*generated))
        rows = (rows.unionByName(counted) if generated else rows).withColumn("table_name", F.lit(name))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


@query
def export_csv(inputs):
    """The content of all seven tables as read back from their CSV export."""
    root = _root(inputs, "csv")
    tables = inputs.movement(logs=True)
    sinks.export_csv(tables, root)
    return _content({name: sinks.read_csv(inputs.spark, f"{root}/{name}", table.schema) for name, table in tables.items()})


@query
def backup_parquet(inputs):
    """Rows per table and date partition of a backup of all tables."""
    root = _root(inputs, "backup")
    tables = inputs.movement()
    sinks.backup_parquet(tables, root, RUN_AT)
    parts = None
    for name in tables:
        rows = (
            inputs.spark.read.parquet(f"{root}/{name}")
            .groupBy("year", "month", "day")
            .agg(F.count("*").alias("n"))
            .withColumn("table_name", F.lit(name))
        )
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


@query
def scan_backup_day(inputs):
    """Orders read from one date partition of a backup taken on two days."""
    root = _root(inputs, "backup")
    orders = {"raw_orders": inputs.view("b_raw_orders")}
    sinks.backup_parquet(orders, root, RUN_AT)
    sinks.backup_parquet(orders, root, datetime(2024, 2, 2, 6, 30, 0))
    day = scan_backup(inputs.spark, root, "raw_orders", "2024-02-01")
    return day.select("order_id", "customer_id", "order_ts", "order_amount")


@query
def scan_backup_weekdays(inputs):
    """Orders read from the Mondays of a backup that has a partition for each day of orders."""
    root = f"{_root(inputs, 'backup')}/raw_orders"
    orders = inputs.view("b_raw_orders")
    dated = orders.withColumns({"year": F.year("order_ts"), "month": F.month("order_ts"), "day": F.day("order_ts")})
    dated.repartition("year", "month", "day").write.partitionBy("year", "month", "day").parquet(root)
    calendar = materialize(backup_calendar(inputs.spark, "2023-12-01", "2024-03-31"), "calendar")
    mondays = scan_backup_days(inputs.spark.read.parquet(root), calendar.where("weekday = 2"))
    return mondays.select("order_id", "customer_id", "order_ts", "order_amount")


def _loaded(inputs: Inputs, root: str, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: sinks.read_refreshed(inputs.spark, f"{root}/{name.upper()}") for name in tables}


@query
def warehouse_refresh(inputs):
    """The content of all six tables in the warehouse after two refreshes."""
    root = _root(inputs, "warehouse")
    tables = inputs.movement("a")
    for _ in range(2):
        sinks.warehouse_refresh(tables, root)
    return _content(_loaded(inputs, root, tables))


@query
def clean_for_load(inputs):
    """The content of all six tables in their warehouse form."""
    return _content({name: sinks.clean_for_load(table) for name, table in inputs.movement().items()})


@query
def cleaned_orders(inputs):
    """Every value of the cleaned orders."""
    return sinks.clean_for_load(inputs.view("b_raw_orders"))


@query
def verify_content(inputs):
    """The loaded tables against their source, and payments against a load that went wrong.

    In the wrong ones two columns are swapped, amounts are rounded, instants have lost their microseconds,
    and one row is there twice while another one is lost.
    """
    root = _root(inputs, "warehouse")
    tables = inputs.movement("a")
    sinks.warehouse_refresh(tables, root)
    payments = inputs.view("b_raw_payments")
    some = c("payment_id").endswith("7")
    ends = payments.agg(F.min("payment_id").alias("least"), F.max("payment_id").alias("most")).first()
    wrong = {
        "swapped": payments.withColumns({"payment_method": c("payment_status"), "payment_status": c("payment_method")}),
        "rounded": payments.withColumn("amount", F.when(some, F.round("amount", 0)).otherwise(c("amount"))),
        "shifted": payments.withColumn("payment_ts", F.when(some, F.date_trunc("second", "payment_ts")).otherwise(c("payment_ts"))),
        "traded": payments.where(c("payment_id") != ends["most"]).unionByName(payments.where(c("payment_id") == ends["least"])),
    }
    source = {**tables, **dict.fromkeys(wrong, payments)}
    loaded = {**_loaded(inputs, root, tables), **{name: sinks.clean_for_load(table) for name, table in wrong.items()}}
    return sinks.verify_content(source, loaded)


@query
def verify_counts(inputs):
    """The source tables, and the tables loaded from them."""
    root = _root(inputs, "warehouse")
    tables = inputs.movement("a")
    sinks.warehouse_refresh(tables, root)
    loaded = {f"loaded_{name}": table for name, table in _loaded(inputs, root, tables).items()}
    others = {f"b_{name}": table for name, table in inputs.raw("b").items()}
    return sinks.verify_counts({**tables, **others, **loaded})


@query
def load_summary(inputs):
    """Rows per table as counted while a backup wrote them, and all in all."""
    summary = sinks.backup_parquet(inputs.movement("a"), _root(inputs, "backup"), RUN_AT)
    total = sinks.summary_totals(summary).select(
        F.lit("all").alias("table_name"), "rows",
        F.concat_ws(" ", "succeeded", "skipped", "failed").alias("status"), (c("size_kb") > 0).alias("has_size"),
    )
    return summary.select("table_name", "rows", "status", (c("size_kb") > 0).alias("has_size")).unionByName(total)


@query
def evolve_schema(inputs):
    """Payments without a few columns, brought to the full schema, twice."""
    old = inputs.view("a_raw_payments").drop("failure_reason", "created_at")
    once = sinks.evolve_schema(old, schemas.RAW_PAYMENTS)
    return sinks.evolve_schema(once, schemas.RAW_PAYMENTS)


@query
def evolve_unreadable(inputs):
    """Values of the raw tables that do not read as their schema's type."""
    parts = None
    for name, table in inputs.raw("a").items():
        rows = sinks.unreadable(table, schemas.RAW_TABLES[name]).withColumn("table_name", F.lit(name))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts.where(c("rows") > 0)


@query
def stored_marts(inputs):
    """The daily health mart as stored by a whole warehouse build."""
    stored = warehouse.write_marts(inputs.staging("b"), _root(inputs, "marts"))
    return stored["mart_business_health_daily"]


def _updated(inputs: Inputs, name: str) -> str:
    """A mart brought up to date by three batches, the last ones with late rows, and the second written twice."""
    root = _root(inputs, "daily")
    views = warehouse.staging_views(inputs.raw("b"))
    source = incremental.DAILY[name].source
    part = F.greatest(F.pmod(F.crc32(warehouse.TABLE_KEY[source]), F.lit(10)) - 7, F.lit(0))
    for number in (0, 1, 1, 2):
        incremental.update_marts({source: views[source].where(part == number)}, root, number)
    return root


@query
def incremental_order_summary(inputs):
    return incremental.read_mart(inputs.spark, _updated(inputs, "mart_order_summary"), "mart_order_summary")


@query
def incremental_delivery_performance(inputs):
    return incremental.read_mart(inputs.spark, _updated(inputs, "mart_delivery_performance"), "mart_delivery_performance")


@query
def customers_of_span(inputs):
    """Distinct customers of each city in a week, and whether the estimate from daily sketches is within three errors."""
    orders = staging.stg_orders(inputs.view("b_raw_orders"))
    sketches = materialize(incremental.customer_sketches(orders), "sketches")
    about = incremental.customers_of_span(sketches, "2024-01-08", "2024-01-14").withColumnRenamed("customers", "_about")
    week = orders.where(c("order_date").between(F.lit("2024-01-08").cast("date"), F.lit("2024-01-14").cast("date")))
    exact = week.groupBy("city").agg(F.count_distinct("customer_id").alias("customers"))
    near = F.abs(c("_about") - c("customers")) <= F.greatest(3 * incremental.SKETCH_ERROR * c("customers"), F.lit(1))
    return exact.join(about, "city").select("city", "customers", near.alias("within"))


# ------------------------------------------------------------------------ quality


@query
def dq_unique(inputs):
    """The key of every raw table, and the order each of its rows names."""
    parts = None
    for name, table in inputs.raw("a").items():
        for column in dict.fromkeys((schemas.TABLE_KEYS[name], "order_id")):
            rows = quality.dq_unique(table, column).withColumn("table_name", F.lit(name))
            parts = rows if parts is None else parts.unionByName(rows)
    return parts


@query
def dq_not_null(inputs):
    """Every column of every raw table."""
    parts = None
    for name, table in inputs.raw("a").items():
        rows = quality.dq_not_null(table, table.columns).withColumn("table_name", F.lit(name))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


@query
def dq_accepted_values(inputs):
    """Statuses, methods, partners, reasons and labels of the raw tables."""
    accepted = {
        "raw_orders": {"order_status": ("confirmed", "Delivered", "CANCELLED")},
        "raw_payments": {"payment_status": ("success", "failed"), "payment_method": ("UPI", "Wallet", "COD")},
        "raw_deliveries": {"delivery_status": ("on_time", "delayed"), "delivery_partner": ("Delhivery", "BlueDart")},
        "raw_complaints": {"ai_severity": ("low", "medium", "high", "critical"), "ai_category": ("app_issue",)},
        "raw_refunds": {"refund_reason": ("payment_failed", "wrong_product")},
    }
    parts = None
    for name, table in inputs.raw("a").items():
        rows = quality.dq_accepted_values(table, accepted[name]).withColumn("table_name", F.lit(name))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


@query
def dq_report(inputs):
    """All 69 tests of the raw tables, staging views and marts."""
    raw = inputs.movement("a")
    views = warehouse.staging_views(raw)
    stored = warehouse.write_marts(views, _root(inputs, "marts"))
    return quality.dq_report({**raw, **views, **stored})


@query
def dq_on_write(inputs):
    """The tests of staging views and marts, counted while they are written, and what readers then see."""
    views = warehouse.staging_views(inputs.movement("a"))
    return quality.publish_tested(views, _root(inputs, "published"), warehouse.MARTS)


# ------------------------------------------------------------------------ dashboards


@query
def dash_executive(inputs):
    return dashboards.dash_executive(_business_health(inputs, "a", False))


@query
def dash_payment_by_method(inputs):
    return dashboards.dash_payment_by_method(_mart(inputs, "a", "mart_payment_health"))


@query
def dash_delay_heatmap(inputs):
    return dashboards.dash_delay_heatmap(_mart(inputs, "a", "mart_delivery_performance"))


@query
def dash_complaint_severity(inputs):
    return dashboards.dash_complaint_severity(_mart(inputs, "a", "mart_complaint_insights"))


@query
def dash_health_trend(inputs):
    return dashboards.dash_health_trend(_mart(inputs, "b", "mart_ai_diagnosis_summary"))


@query
def dash_llm_usage(inputs):
    return dashboards.dash_llm_usage(_mart(inputs, "b", "mart_ai_diagnosis_summary"))


@query
def dash_recent_diagnoses(inputs):
    return dashboards.dash_recent_diagnoses(staging.stg_ai_diagnosis(inputs.audit()))


# ------------------------------------------------------------------------ streams


@query
def stream_ingest(inputs):
    """Raw tables filled by the ingest stream, run twice over the same messages."""
    root = _root(inputs, "ingest")
    for run in range(2):
        messages = fixture_messages(inputs.event_stream())
        stream_ingest_jobs.stream_ingest(
            messages, f"{root}/tables", f"{root}/checkpoint"
        ).awaitTermination()
    parts = None
    for kind in ingest.EVENT_KINDS.values():
        rows = read_table(
            inputs.spark, f"{root}/tables/{kind.table}", schemas.RAW_TABLES[kind.table]
        ).select(F.lit(kind.table).alias("table_name"), c(kind.key).alias("event_key"), "order_id", "created_at")
        parts = rows if parts is None else parts.unionByName(rows)
    logs = read_table(inputs.spark, f"{root}/tables/pipeline_logs", schemas.PIPELINE_LOGS)
    return parts.unionByName(
        logs.select(
            F.lit("pipeline_logs").alias("table_name"), c("message").alias("event_key"),
            c("status").alias("order_id"), "created_at",
        )
    )


@query
def compacted_batches(inputs):
    """Orders written as eight batches, the last one twice, compacted after each third; and what is then read."""
    path = f"{_root(inputs, 'batches')}/raw_orders"
    orders = inputs.view("b_raw_orders")
    create_table(inputs.spark, path, orders.schema)
    dealt = orders.withColumn("part", F.pmod(F.xxhash64("order_id"), F.lit(8)))
    folders = _root(inputs, "orders")
    dealt.write.partitionBy("part").parquet(folders)  # so that a batch reads its own rows only
    stored = inputs.spark.read.schema(dealt.schema).parquet(folders)
    for number in (0, 1, 2, 3, 4, 5, 6, 7, 7):
        write_batch(stored.where(c("part") == number).drop("part"), path, number)
        if number % 3 == 2:
            compact(inputs.spark, path, orders.schema)
    compact(inputs.spark, path, orders.schema)
    return read_table(inputs.spark, path, orders.schema)


@query
def stream_dedup(inputs):
    """Distinct event keys per topic after bounded-state deduplication, and every message without one."""
    root = _root(inputs, "dedup")
    distinct = stream_ingest_jobs.stream_dedup(fixture_messages(inputs.event_stream()))
    stream_windows.append_parquet(
        distinct.select("topic", "event_key", F.when(c("event_key").isNull(), c("offset")).alias("unkeyed_offset")),
        f"{root}/keys", f"{root}/checkpoint"
    ).awaitTermination()
    return inputs.spark.read.parquet(f"{root}/keys")


@query
def stream_window_metrics(inputs):
    root = _root(inputs, "windows")
    metrics = stream_windows.stream_window_metrics(inputs.activity(inputs.event_stream()))
    stream_windows.append_parquet(metrics, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return inputs.spark.read.parquet(f"{root}/out")


@query
def stream_sliding_features(inputs):
    root = _root(inputs, "sliding")
    sliding = stream_windows.stream_sliding_features(inputs.activity(inputs.event_stream()))
    stream_windows.append_parquet(sliding, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return inputs.spark.read.parquet(f"{root}/out")


@query
def stream_doctor(inputs):
    """Audit rows of the ticks whose cells the stream has closed, with the model's answers."""
    root = _root(inputs, "doctor")
    stream_monitor.stream_doctor(
        inputs.activity(inputs.event_stream()), root, f"{root}/checkpoint", responses=inputs.answers_per_tick()
    ).awaitTermination()
    rows = read_table(inputs.spark, f"{root}/ai_pipeline_diagnosis", schemas.DIAGNOSES)
    return rows.select(
        RUN, "status", "severity", "issue_summary", "tags", "source", "alert_fingerprint", "alerted_at"
    )


@query
def stream_alert_dedup(inputs):
    """Suppression over a stream of the replay's candidates."""
    root = _root(inputs, "alerts")
    flagged = decisions.alert_candidates(decisions.alert_fingerprint(inputs.selected()))
    rows = flagged.where("candidate").select("alert_fingerprint", RUN)
    rows.write.parquet(f"{root}/candidates")
    stream = inputs.spark.readStream.schema(rows.schema).parquet(f"{root}/candidates")
    stream_monitor.stream_alert_dedup(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return read_table(inputs.spark, f"{root}/out", stream_monitor.ALERTS)


@query
def stream_alert_gate(inputs):
    """Suppression in operator state over the replay's candidates, which come in three shuffled parts."""
    root = _root(inputs, "gate")
    flagged = decisions.alert_candidates(decisions.alert_fingerprint(inputs.selected()))
    rows = flagged.where("candidate").select("alert_fingerprint", RUN)
    placed = rows.withColumn("part", F.pmod(F.xxhash64("alert_fingerprint", RUN), F.lit(3)))
    placed.write.partitionBy("part").parquet(f"{root}/candidates")
    stored = inputs.spark.read.schema(rows.schema).parquet(f"{root}/candidates")
    span = stored.agg(F.max(RUN).alias("last"), F.date_diff(F.max(RUN), F.min(RUN)).alias("days")).first()
    days = (span["days"] or 0) + 2
    # A candidate of no alert, long after the others, lets the stream decide them all.
    end = stored.groupBy().agg(F.lit("end").alias("alert_fingerprint"), (F.max(RUN) + F.make_dt_interval(F.lit(2 * days))).alias(RUN))
    end.where(c(RUN).isNotNull()).write.parquet(f"{root}/candidates/part=3")
    parts = ["part=0", "part=1", "part=2", "part=3"]
    for part in parts:  # one part after another, by one stream that is started anew
        stream = pin_streaming(inputs.spark).readStream.schema(rows.schema).parquet(f"{root}/candidates/{{{','.join(parts[:parts.index(part) + 1])}}}")
        decided = stream_gate.stream_alert_gate(stream, f"{days} days")
        stream_windows.append_parquet(decided, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return inputs.spark.read.parquet(f"{root}/out")


@query
def late_policy(inputs):
    """Batches of a stream whose second part arrives late, with the rows that came too late."""
    root = _root(inputs, "late")
    straggler = c("event_id") % 50 == 0
    for part, rows in enumerate((inputs.events.where(~straggler), inputs.events.where(straggler))):
        rows.write.mode("append").parquet(f"{root}/arrivals/part={part}")
        stream = inputs.spark.readStream.schema(inputs.events.schema).parquet(
            f"{root}/arrivals/part=*"
        )
        stream_windows.late_policy(
            stream.select(c("ts").alias("event_ts")), f"{root}/log", f"{root}/checkpoint"
        ).awaitTermination()
    return (
        inputs.spark.read.parquet(f"{root}/log")
        .where(c("batch_id") >= 0)
        .select("batch_id", "rows", "late_rows", "max_event_ts")
    )

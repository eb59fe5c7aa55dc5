"""The monitor: features, scoring, diagnosis and decision, for one run or a whole history."""

from __future__ import annotations

from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shopvitals import schemas
from shopvitals.config import DEFAULT, MonitorConfig
from shopvitals.functions.time import instant, within_last
from shopvitals.operators import anomalies, decisions, diagnosis, model_contract
from shopvitals.operators.features import (
    RUN, activity, cells, features_as_of, features_replay, single_run,
)
from shopvitals.operators.sinks import append_diagnoses
from shopvitals.session import discard, materialize, materialize_at

MONITORED = ("raw_orders", "raw_payments", "raw_deliveries", "raw_complaints")


def history_cells(raw: dict[str, DataFrame]) -> DataFrame:
    """Cells of the raw tables given, written once: each table is scanned a single time."""
    tables = {name: raw[name] for name in MONITORED if name in raw}
    return materialize(cells(activity(**tables)), "cells")


def reports_replay(cell_rows: DataFrame, cfg: MonitorConfig = DEFAULT) -> DataFrame:
    """(run_timestamp, features, report) at every tick of the history in ``cell_rows``."""
    stats = anomalies.baselines(anomalies.baseline_buckets(cell_rows, cfg))
    return anomalies.anomaly_report(features_replay(cell_rows, cfg), stats, cfg)


def reports_as_of(
    rows: DataFrame, cfg: MonitorConfig = DEFAULT, as_of: datetime | str | None = None
) -> DataFrame:
    """The same for a single run; ``rows`` are activity rows."""
    run = F.current_timestamp() if as_of is None else instant(as_of)
    buckets = anomalies.baseline_buckets_as_of(rows, run, cfg, as_of)
    return anomalies.anomaly_report(
        features_as_of(rows, cfg, as_of), anomalies.baselines(buckets), cfg
    )


def select_diagnoses(
    reports: DataFrame, responses: DataFrame | None = None, cfg: MonitorConfig = DEFAULT
) -> DataFrame:
    """Rule diagnosis, gate, and the model's answer where one is asked for and valid."""
    gated = diagnosis.llm_gate(diagnosis.rule_diagnosis(reports, cfg), cfg)
    answers = None
    if responses is not None:
        answers = model_contract.first_valid_answer(model_contract.validate_llm_response(responses))
    return diagnosis.diagnosis_select(gated, answers, cfg)


def decide(
    selected: DataFrame,
    cfg: MonitorConfig = DEFAULT,
    history: DataFrame | None = None,
    folders: list[str] | None = None,
) -> DataFrame:
    """Fingerprint, alert or not, and where to. The runs are read twice, so they are written.

    Folders that the result reads are added to ``folders`` for the caller to discard when it is stored.
    """
    flagged = decisions.alert_candidates(decisions.alert_fingerprint(selected, cfg), cfg)
    flagged, folder = materialize_at(flagged, "runs")
    if folders is not None:
        folders.append(folder)
    return decisions.alert_routing(decisions.alert_suppress(flagged, cfg, history, folders), cfg)


def audit_rows(
    reports: DataFrame,
    responses: DataFrame | None = None,
    cfg: MonitorConfig = DEFAULT,
    history: DataFrame | None = None,
    folders: list[str] | None = None,
) -> DataFrame:
    """Rows for the audit table. ``folders`` as for ``decide``."""
    decided = decide(select_diagnoses(reports, responses, cfg), cfg, history, folders)
    return decisions.with_ids(decisions.diagnosis_record(decided, cfg))


def replay(
    raw: dict[str, DataFrame], responses: DataFrame | None = None, cfg: MonitorConfig = DEFAULT
) -> DataFrame:
    """Audit rows of the whole history of the raw tables, one job."""
    return audit_rows(reports_replay(history_cells(raw), cfg), responses, cfg)


def run_once(
    raw: dict[str, DataFrame],
    audit_path: str,
    responses: DataFrame | None = None,
    cfg: MonitorConfig = DEFAULT,
    as_of: datetime | str | None = None,
) -> None:
    """One scheduled run: diagnose, decide against the stored audit table, append the row.

    The run never passes silently: when it breaks, a fallback row with the probes' figures is
    appended instead, and if those cannot be had either, the emergency row. Running it again for
    the same instant replaces its row.
    """
    rows = activity(**{name: raw[name] for name in MONITORED})
    spark = rows.sparkSession
    # The run's instant is fixed here, so that every part of the job sees the same one.
    run = as_of or single_run(spark, None).select(F.col(RUN).cast("string")).first()[0]
    folders: list[str] = []
    try:
        recent = recent_alerts(spark, audit_path, run, cfg)
        record = audit_rows(reports_as_of(rows, cfg, run), responses, cfg, recent, folders)
        append_diagnoses(record, audit_path, replace_run=True)
    except (PySparkException, Py4JJavaError):
        try:
            figures = probes_as_of(rows, cfg, run).first()
            failed = spark.createDataFrame([(*figures, False)], FAILED_RUN)
        except (PySparkException, Py4JJavaError):
            failed = spark.createDataFrame([(None, None, True)], FAILED_RUN)
        broken = diagnosis.dag_fallback_rows(failed.select(instant(run).alias(RUN), "*"), cfg)
        append_diagnoses(decisions.with_ids(broken), audit_path, replace_run=True)
    finally:
        for folder in folders:
            discard(spark, folder)


def recent_alerts(
    spark: SparkSession, audit_path: str, run: datetime | str, cfg: MonitorConfig = DEFAULT
) -> DataFrame | None:
    """What the audit table says was sent in the window before ``run``; None before its first row.

    A row of the run itself, left by an earlier try, does not count.

    The day filter reads only the folders of the days the window touches, and of later ones.
    """
    schema = T.StructType([*schemas.DIAGNOSES.fields, T.StructField("run_date", T.DateType())])
    try:
        stored = spark.read.schema(schema).parquet(audit_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    since = instant(run) - F.make_dt_interval(mins=F.lit(cfg.alert_dedup_minutes))
    sent = (F.col("run_date") >= F.to_date(since)) & (F.col("alerted_at") >= since)
    return stored.where(sent & (F.col(RUN) < instant(run)))


FAILED_RUN = "orders_count bigint, failure_rate double, lost_audit boolean"


def probes_as_of(rows: DataFrame, cfg: MonitorConfig, as_of: datetime | str | None) -> DataFrame:
    """(orders_count, failure_rate) as the health probes of a single run see them."""
    recent = within_last(F.col("event_ts"), cfg.recent_orders_minutes, as_of)
    hour = within_last(F.col("event_ts"), cfg.payment_probe_hours * 60, as_of)
    paid = F.col("domain") == "payments"
    return rows.where(hour).agg(
        F.count_if((F.col("domain") == "orders") & recent).alias("orders_count"),
        F.coalesce(
            F.count_if(paid & F.col("hit")).cast("double")
            / F.nullif(F.count_if(paid), F.lit(0)).cast("double"),
            F.lit(0.0),
        ).alias("failure_rate"),
    )

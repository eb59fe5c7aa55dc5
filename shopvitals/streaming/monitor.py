"""The monitor as a stream, and alert suppression over a stream of candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from shopvitals import schemas
from shopvitals.config import CELL_SECONDS, DEFAULT, MonitorConfig
from shopvitals.functions.time import cell_of, tick_time
from shopvitals.operators import anomalies, decisions
from shopvitals.operators.features import RUN, snapshot, ticks, windowed
from shopvitals.plans.monitor import audit_rows
from shopvitals.session import discard
from shopvitals.streaming.sinks import (
    create_table, day_of, first_number, last_progress, read_days, write_batch, write_days,
)

c = F.col

CELLS_A_DAY = 86400 // CELL_SECONDS
#: What a batch notes for the next one.
LAST_CELL = T.StructType([T.StructField("cell", T.LongType())])
LAST_RUN = T.StructType([T.StructField("us", T.LongType())])

CELLS = T.StructType(
    [
        T.StructField("domain", T.StringType()),
        T.StructField("cell", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("hits", T.LongType()),
        T.StructField("oks", T.LongType()),
        T.StructField("revenue", T.DecimalType(38, 10)),
        T.StructField("delay", T.LongType()),
    ]
)
ALERTS = T.StructType(
    [
        T.StructField("alert_fingerprint", T.StringType()),
        T.StructField(RUN, T.TimestampType()),
        T.StructField("should_alert", T.BooleanType()),
        T.StructField("suppression_reason", T.StringType()),
    ]
)


#: How far an event may be dated ahead of the clock and still count.
AHEAD = "1 day"


def not_ahead(rows: DataFrame, bound: str = AHEAD) -> DataFrame:
    """Rows that are not dated further ahead of the clock than ``bound``.

    One far event would carry the watermark with it, and every row after it would come too late.
    """
    return rows.where(c("event_ts") <= F.current_timestamp() + F.expr(f"INTERVAL {bound}"))


def stream_ahead(
    rows: DataFrame, path: str, checkpoint: str, bound: str = AHEAD, trigger: dict | None = None
) -> StreamingQuery:
    """Quarantine for what ``not_ahead`` leaves out: rows dated too far ahead, with the time they were seen at."""
    seen = rows.withColumn("seen_at", F.current_timestamp())
    return (
        seen.where(c("event_ts") > c("seen_at") + F.expr(f"INTERVAL {bound}"))
        .writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def closed_cells(rows: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Activity cells, each emitted once, when the watermark has passed its end."""
    return (
        rows.withWatermark("event_ts", delay)
        .groupBy(F.window("event_ts", f"{CELL_SECONDS} seconds"), "domain", "label")
        .agg(
            F.count("*").alias("n"),
            F.count_if("hit").alias("hits"),
            F.count_if("ok").alias("oks"),
            F.sum("revenue").alias("revenue"),
            F.sum("delay").cast("bigint").alias("delay"),
        )
        .select(
            "domain",
            cell_of(c("window.start")).alias("cell"),
            "label",
            *["n", "hits", "oks", "revenue", "delay"],
        )
    )


def stream_doctor(
    rows: DataFrame,
    root: str,
    checkpoint: str,
    delay: str = "10 minutes",
    cfg: MonitorConfig = DEFAULT,
    trigger: dict | None = None,
    responses: DataFrame | None = None,
    ahead: str = AHEAD,
) -> StreamingQuery:
    """Diagnose every tick once its cells are closed, and append the audit rows.

    Rows dated further ahead of the clock than ``ahead`` do not count (``stream_ahead`` keeps them), and quiet
    days are left out as a replay leaves them out (``ticks``).

    A batch stores the cells it closes, then evaluates the ticks they complete against the
    last day of stored cells with the same operators a replay uses. Alerts sent by earlier batches
    open the suppression. Cells and audit rows lie in a folder per day, and each batch notes the
    last cell, so a batch reads the days it needs and nothing older. ``responses`` holds model answers for escalated runs, as a replay takes
    them; a run without a valid one at the time of its batch falls back to the rules.
    """
    spark = rows.sparkSession
    cells_path, audit_path = f"{root}/cells", f"{root}/ai_pipeline_diagnosis"
    progress = f"{root}/progress"
    create_table(spark, cells_path, CELLS, by_day=True)
    create_table(spark, audit_path, schemas.DIAGNOSES, by_day=True)
    create_table(spark, progress, LAST_CELL)
    first = first_number(spark, checkpoint, cells_path, audit_path, progress)

    def evaluate(batch: DataFrame, batch_id: int) -> None:
        number = first + batch_id
        session = batch.sparkSession
        batch.persist()
        try:
            write_days(batch, cells_path, number, F.floor(c("cell") / F.lit(CELLS_A_DAY)).cast("bigint"))
            span = batch.agg(F.min("cell").alias("first"), F.max("cell").alias("last")).first()
        finally:
            batch.unpersist()
        noted = last_progress(session, progress, number, LAST_CELL)
        done = None if noted is None else noted["cell"]
        last = max((x for x in (done, span["last"]) if x is not None), default=None)
        if span["first"] is not None:
            diagnose(session, number, span["first"] + 1 if done is None else done + 2, last + 1, done)
        write_batch(session.createDataFrame([(last,)], LAST_CELL).coalesce(1), progress, number)

    def diagnose(session: SparkSession, number: int, first_tick: int, last_tick: int, done: int | None) -> None:
        if first_tick > last_tick:
            return
        oldest = first_tick - cfg.baseline_cells
        recent = read_days(
            session, cells_path, CELLS, oldest // CELLS_A_DAY, last_tick // CELLS_A_DAY, number + 1
        ).where(c("cell") >= oldest)
        # The last cell of the batches before tells which quiet days still belong to a busy one.
        known = recent.where(c("cell") >= first_tick - 1).select("cell")
        if done is not None:
            known = known.unionByName(session.createDataFrame([(done,)], LAST_CELL))
        runs = ticks(known, cfg, first_tick, last_tick)
        due = (
            (c(RUN) >= tick_time(F.lit(first_tick))) & (c(RUN) <= tick_time(F.lit(last_tick)))
        )
        snapshots = snapshot(windowed(recent, cfg.window_cells).where(due), runs, cfg)
        stats = anomalies.baselines(anomalies.baseline_buckets(recent, cfg).where(due))
        reports = anomalies.anomaly_report(snapshots, stats, cfg)
        window = F.make_dt_interval(mins=F.lit(cfg.alert_dedup_minutes))
        before = (first_tick * CELL_SECONDS - cfg.alert_dedup_minutes * 60) // 86400
        alerted = (
            read_days(session, audit_path, schemas.DIAGNOSES, before, last_tick // CELLS_A_DAY, number)
            .where(c("alerted_at") >= tick_time(F.lit(first_tick)) - window)
            .select("alert_fingerprint", "alerted_at")
        )
        answers = None if responses is None else responses.where(due)
        folders: list[str] = []
        try:
            records = audit_rows(reports, answers, cfg, alerted, folders)
            write_days(records.select(*schemas.DIAGNOSES.names), audit_path, number, day_of(c(RUN)))
        finally:
            for folder in folders:
                discard(session, folder)

    return (
        closed_cells(not_ahead(rows, ahead), delay)
        .writeStream.outputMode("append")
        .foreachBatch(evaluate)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_alert_dedup(
    candidates: DataFrame,
    path: str,
    checkpoint: str,
    cfg: MonitorConfig = DEFAULT,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Suppress repeats in a stream of (alert_fingerprint, run_timestamp) candidates.

    What earlier batches sent is read from the sink as far back as the window reaches, so the
    memory between batches lives in the table and not in operator state. The sink has a folder per
    day and the latest instant is noted beside the table, so only the days in reach are read.
    """
    progress = f"{path}_progress"
    create_table(candidates.sparkSession, path, ALERTS, by_day=True)
    create_table(candidates.sparkSession, progress, LAST_RUN)
    first = first_number(candidates.sparkSession, checkpoint, path, progress)

    def suppress(batch: DataFrame, batch_id: int) -> None:
        number = first + batch_id
        session = batch.sparkSession
        span = batch.agg(F.unix_micros(F.min(RUN)).alias("first"), F.unix_micros(F.max(RUN)).alias("last")).first()
        noted = last_progress(session, progress, number, LAST_RUN)
        done = None if noted is None else noted["us"]
        last = max((x for x in (done, span["last"]) if x is not None), default=None)
        if span["first"] is not None:
            decide(session, batch, number, span["first"], last)
        write_batch(session.createDataFrame([(last,)], LAST_RUN).coalesce(1), progress, number)

    def decide(session: SparkSession, batch: DataFrame, number: int, start: int, last: int) -> None:
        window = F.make_dt_interval(mins=F.lit(cfg.alert_dedup_minutes))
        oldest = (start - cfg.alert_dedup_minutes * 60_000_000) // 86_400_000_000
        sent = (
            read_days(session, path, ALERTS, oldest, last // 86_400_000_000, number)
            .where(c("should_alert") & (c(RUN) >= F.timestamp_micros(F.lit(start)) - window))
            .select("alert_fingerprint", c(RUN).alias("alerted_at"))
        )
        flagged = batch.select("alert_fingerprint", RUN, F.lit(True).alias("candidate"))
        folders: list[str] = []
        try:
            decided = decisions.alert_suppress(flagged, cfg, sent, folders)
            write_days(decided.select(*ALERTS.names), path, number, day_of(c(RUN)))
        finally:
            for folder in folders:
                discard(session, folder)

    return (
        candidates.writeStream.foreachBatch(suppress)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )

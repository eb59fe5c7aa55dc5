"""Windowed metrics and features over the activity stream, and what arrives too late."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shopvitals.config import DEFAULT, MonitorConfig
from shopvitals.functions.numeric import int_mean, rate
from shopvitals.streaming.sinks import create_table, first_number, last_progress, write_batch

c = F.col

LATE_LOG = T.StructType(
    [
        T.StructField("rows", T.LongType()),
        T.StructField("late_rows", T.LongType()),
        T.StructField("max_event_ts", T.TimestampType()),
        T.StructField("high_us", T.LongType()),  # the latest event time up to and with the batch
    ]
)


def stream_window_metrics(rows: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Per domain and 30-minute window: rows, hits and their share (activity stream in)."""
    return (
        rows.withWatermark("event_ts", delay)
        .groupBy(F.window("event_ts", "30 minutes"), "domain")
        .agg(F.count("*").alias("total"), F.count_if("hit").alias("hits"))
        .select(
            c("window.start").alias("window_start"),
            c("window.end").alias("window_end"),
            "domain",
            "total",
            "hits",
            rate(c("hits"), c("total")).alias("hit_rate"),
        )
    )


def _of(domain: str, condition: Column | None = None) -> Column:
    inside = c("domain") == domain
    return inside if condition is None else inside & condition


def stream_sliding_features(
    rows: DataFrame, delay: str = "10 minutes", cfg: MonitorConfig = DEFAULT
) -> DataFrame:
    """The window features every 15 minutes, as the scheduled runs see them."""
    window = F.window("event_ts", f"{cfg.window_minutes} minutes", "15 minutes")
    totals = (
        rows.withWatermark("event_ts", delay)
        .groupBy(window)
        .agg(
            F.count_if(_of("orders")).alias("orders"),
            F.sum(F.when(_of("orders"), c("revenue"))).alias("revenue"),
            F.count_if(_of("payments")).alias("payments"),
            F.count_if(_of("payments", c("hit"))).alias("failed"),
            F.count_if(_of("deliveries")).alias("deliveries"),
            F.count_if(_of("deliveries", c("hit"))).alias("delayed"),
            F.sum(F.when(_of("deliveries"), c("delay"))).alias("_delay"),
            F.count_if(_of("complaints")).alias("complaints"),
            F.count_if(_of("complaints", c("hit"))).alias("severe"),
        )
    )

    def share(hits: str, total: str, name: str) -> Column:
        return F.coalesce(rate(c(hits), c(total)), F.lit(0.0)).alias(name)

    return totals.select(
        c("window.end").alias("run_timestamp"),
        "orders",
        F.coalesce(c("revenue").cast("double"), F.lit(0.0)).alias("revenue"),
        "payments",
        "failed",
        share("failed", "payments", "failure_rate"),
        "deliveries",
        "delayed",
        share("delayed", "deliveries", "delay_rate"),
        F.coalesce(int_mean(c("_delay"), c("deliveries"), 1), F.lit(0.0)).alias("avg_delay_minutes"),
        "complaints",
        "severe",
        share("severe", "complaints", "severe_rate"),
    )


def append_parquet(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Closed windows as Parquet files, each exactly once."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def late_policy(
    rows: DataFrame,
    log_path: str,
    checkpoint: str,
    delay_minutes: int = 10,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Count, per batch, the rows whose 30-minute window was closed before they came.

    Such rows are missing from the windowed results but stay in the raw tables. The mark a
    batch is judged by is the latest event time of the batches before it, less the delay.
    """
    spark = rows.sparkSession
    create_table(spark, log_path, LATE_LOG)
    first = first_number(spark, checkpoint, log_path)

    def judge(batch: DataFrame, batch_id: int) -> None:
        number = first + batch_id
        noted = last_progress(batch.sparkSession, log_path, number, LATE_LOG)
        high = None if noted is None else noted["high_us"]
        window_end = F.window("event_ts", "30 minutes").end
        if high is None:
            late = F.lit(False)
        else:
            mark = F.timestamp_micros(F.lit(high)) - F.make_dt_interval(
                mins=F.lit(delay_minutes)
            )
            late = c("_end") <= mark
        counted = batch.withColumn("_end", window_end).agg(
            F.count("*").alias("rows"),
            F.count_if(late).alias("late_rows"),
            F.max("event_ts").alias("max_event_ts"),
        ).withColumn("high_us", F.greatest(F.unix_micros("max_event_ts"), F.lit(high).cast("bigint")))
        write_batch(counted, log_path, number)

    return (
        rows.writeStream.foreachBatch(judge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )

"""Current values against the 24-hour baseline of 30-minute buckets."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from shopvitals.config import DEFAULT, MonitorConfig
from shopvitals.functions.time import half_hour_bucket, tick_time, within_last
from shopvitals.operators.features import RUN

c = F.col

# Metric, the domain it comes from, where its current value sits in the features.
METRICS = (
    ("payment_failure_rate", "payments", "payments.failure_rate"),
    ("delivery_delay_rate", "deliveries", "deliveries.delay_rate"),
    ("order_volume", "orders", "volume.orders"),
    ("complaint_severe_rate", "complaints", "complaints.severe_rate"),
)


def _bucket_value(n: Column, hits: Column) -> Column:
    """Order volume is the count itself, the other metrics are shares of hits; NULL if empty."""
    count = F.nullif(n, F.lit(0)).cast("double")
    return F.when(c("domain") == "orders", count).otherwise(hits.cast("double") / count)


def bucket_rows(rows: DataFrame) -> DataFrame:
    """Each 30-minute bucket of each domain with its row count."""
    return rows.groupBy("domain", half_hour_bucket(c("event_ts")).alias("bucket")).agg(
        F.count("*").alias("n")
    )


def baseline_buckets(cell_rows: DataFrame, cfg: MonitorConfig = DEFAULT) -> DataFrame:
    """(run, domain, bucket, value) over the baseline window before every tick.

    Buckets without rows do not exist. A bucket is two cells: nearly every tick that sees it
    sees both, so its value is computed once; the tick right after its first cell and the one
    the first cell has just left see one half.
    """
    cell, span = c("cell"), cfg.baseline_cells
    even = F.pmod(cell, F.lit(2)) == 0
    halves = cell_rows.groupBy("domain", F.floor(cell / F.lit(2)).alias("half_hour")).agg(
        *[
            F.coalesce(F.sum(F.when(half, c(name))), F.lit(0)).alias(f"{name}_{place}")
            for place, half in (("first", even), ("second", ~even))
            for name in ("n", "hits")
        ]
    )
    first = c("half_hour") * F.lit(2)

    def seen(start: Column, end: Column, n: Column, hits: Column) -> Column:
        return F.struct(
            start.cast("bigint").alias("from_tick"),
            end.cast("bigint").alias("to_tick"),
            _bucket_value(n, hits).alias("value"),
        )

    values = halves.select(
        "domain",
        tick_time(first).alias("bucket"),
        F.inline(
            F.array(
                seen(first + 1, first + 1, c("n_first"), c("hits_first")),
                seen(
                    first + 2,
                    first + span,
                    c("n_first") + c("n_second"),
                    c("hits_first") + c("hits_second"),
                ),
                seen(first + 1 + span, first + 1 + span, c("n_second"), c("hits_second")),
            )
        ),
    ).where(c("value").isNotNull())
    run = F.explode(F.transform(F.sequence("from_tick", "to_tick"), tick_time)).alias(RUN)
    return values.select(run, "domain", "bucket", "value")


def baseline_buckets_as_of(
    rows: DataFrame, runs: Column, cfg: MonitorConfig = DEFAULT, as_of: datetime | str | None = None
) -> DataFrame:
    """``baseline_buckets`` for a single run."""
    inside = rows.where(within_last(c("event_ts"), cfg.baseline_hours * 60, as_of))
    counted = inside.groupBy("domain", half_hour_bucket(c("event_ts")).alias("bucket")).agg(
        F.count("*").alias("n"), F.count_if("hit").alias("hits")
    )
    return counted.select(
        F.when(c("n") > 0, runs).alias(RUN),
        "domain",
        "bucket",
        _bucket_value(c("n"), c("hits")).alias("value"),
    )


def baselines(buckets: DataFrame) -> DataFrame:
    """One row per run with a struct (mean, std) per metric, NULL without buckets.

    All metrics in one aggregation, combined before its shuffle. A single bucket has no
    spread, which counts as zero.
    """
    def of(domain: str) -> Column:
        value = F.when(c("domain") == domain, c("value"))
        return F.when(
            F.count(value) > 0,
            F.struct(
                F.avg(value).alias("mean"),
                F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std"),
            ),
        )

    return buckets.groupBy(RUN).agg(*[of(domain).alias(metric) for metric, domain, _ in METRICS])


def baseline_stats(buckets: DataFrame) -> DataFrame:
    """(run, metric, mean, std) of every metric that has a baseline."""
    rows = F.array(
        *[
            F.struct(
                F.lit(metric).alias("metric"),
                c(f"{metric}.mean").alias("mean"),
                c(f"{metric}.std").alias("std"),
            )
            for metric, _, _ in METRICS
        ]
    )
    return baselines(buckets).select(RUN, F.inline(rows)).where(c("mean").isNotNull())


def anomaly_report(
    snapshots: DataFrame, per_run: DataFrame, cfg: MonitorConfig = DEFAULT
) -> DataFrame:
    """Snapshots with ``report``: struct(anomalies, anomaly_count, max_severity).

    ``per_run`` holds the ``baselines``. A metric without spread, or without a baseline, is
    skipped.
    """

    def scored(metric: str, path: str) -> Column:
        mean, std = c(f"{metric}.mean"), c(f"{metric}.std")
        current = c(f"features.{path}").cast("double")
        z = (current - mean) / F.nullif(std, F.lit(0.0))
        severity = F.least(F.abs(z) / F.lit(cfg.zscore_full_severity), F.lit(1.0))
        return F.when(
            F.abs(z) >= cfg.zscore_threshold,
            F.struct(
                F.lit(metric).alias("metric"),
                F.round(current, 4).alias("current"),
                F.round(mean, 4).alias("baseline_mean"),
                F.round(std, 4).alias("baseline_std"),
                F.round(z, 2).alias("z_score"),
                F.when(z > 0, "spike").otherwise("drop").alias("direction"),
                F.round(severity, 2).alias("severity"),
            ),
        )

    found = F.array_compact(F.array(*[scored(metric, path) for metric, _, path in METRICS]))
    worst = F.coalesce(F.array_max(F.transform("_found", lambda a: a["severity"])), F.lit(0.0))
    return (
        snapshots.join(per_run, RUN, "left")
        .withColumn("_found", found)
        .select(
            *snapshots.columns,
            F.struct(
                c("_found").alias("anomalies"),
                F.size("_found").alias("anomaly_count"),
                worst.alias("max_severity"),
            ).alias("report"),
        )
    )


def anomalies(reports: DataFrame) -> DataFrame:
    """One row per run and anomalous metric."""
    return reports.select(RUN, F.inline("report.anomalies"))


def anomaly_summary(reports: DataFrame) -> DataFrame:
    return reports.select(RUN, "report.anomaly_count", "report.max_severity", "report.anomalies")

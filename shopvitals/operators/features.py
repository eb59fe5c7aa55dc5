"""Windowed operational features.

The four raw tables are read as one stream of *activity* rows. Evaluating many instants at
once goes through 15-minute cells (one shuffle of the data, combined before it); evaluating
a single instant filters the window instead. Both end in the same ``snapshot``.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shopvitals import schemas
from shopvitals.config import DEFAULT, MonitorConfig
from shopvitals.functions.numeric import int_mean, rate
from shopvitals.functions.time import cell_of, instant, served_ticks, tick_time, within_last

c = F.col

RUN = "run_timestamp"
_MONEY = schemas.MONEY.simpleString()


# ------------------------------------------------------------------------ activity rows


def activity(
    raw_orders: DataFrame | None = None,
    raw_payments: DataFrame | None = None,
    raw_deliveries: DataFrame | None = None,
    raw_complaints: DataFrame | None = None,
) -> DataFrame:
    """Rows of (domain, event_ts, hit, ok, revenue, delay, label) from the tables given.

    ``hit`` marks a failed payment, a delayed delivery or a severe complaint, ``ok`` a
    successful payment. ``label`` is the value a top list counts, NULL if the row is in none.
    Statuses are compared as written, without trimming or case folding.
    """
    parts = []
    if raw_orders is not None:
        counted = ~c("order_status").isin("cancelled", "failed")
        parts.append(
            raw_orders.select(
                F.lit("orders").alias("domain"),
                c("order_ts").alias("event_ts"),
                F.lit(False).alias("hit"),
                F.lit(False).alias("ok"),
                F.when(counted, c("order_amount").try_cast(_MONEY)).alias("revenue"),
                F.lit(None).cast("int").alias("delay"),
                c("city").alias("label"),
            )
        )
    if raw_payments is not None:
        failed = F.coalesce(c("payment_status") == "failed", F.lit(False))
        parts.append(
            raw_payments.select(
                F.lit("payments").alias("domain"),
                c("payment_ts").alias("event_ts"),
                failed.alias("hit"),
                F.coalesce(c("payment_status") == "success", F.lit(False)).alias("ok"),
                F.lit(None).cast(_MONEY).alias("revenue"),
                F.lit(None).cast("int").alias("delay"),
                F.when(failed, c("failure_reason")).alias("label"),
            )
        )
    if raw_deliveries is not None:
        late = c("actual_minutes") > c("promised_minutes")
        parts.append(
            raw_deliveries.where(
                c("actual_minutes").isNotNull() & c("promised_minutes").isNotNull()
            ).select(
                F.lit("deliveries").alias("domain"),
                c("created_at").alias("event_ts"),
                late.alias("hit"),
                F.lit(False).alias("ok"),
                F.lit(None).cast(_MONEY).alias("revenue"),
                (c("actual_minutes") - c("promised_minutes")).alias("delay"),
                F.when(late, c("city")).alias("label"),
            )
        )
    if raw_complaints is not None:
        parts.append(
            raw_complaints.select(
                F.lit("complaints").alias("domain"),
                c("complaint_ts").alias("event_ts"),
                F.coalesce(c("ai_severity").isin("high", "critical"), F.lit(False)).alias("hit"),
                F.lit(False).alias("ok"),
                F.lit(None).cast(_MONEY).alias("revenue"),
                F.lit(None).cast("int").alias("delay"),
                c("ai_category").alias("label"),
            )
        )
    return reduce(DataFrame.unionByName, parts).where(c("event_ts").isNotNull())


def _row_measures() -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.count_if("hit").alias("hits"),
        F.count_if("ok").alias("oks"),
        F.sum("revenue").alias("revenue"),
        F.sum("delay").alias("delay"),
    ]


def _merge_measures() -> list[Column]:
    return [F.sum(name).alias(name) for name in ("n", "hits", "oks", "revenue", "delay")]


# ------------------------------------------------------------------------ many instants


def cells(rows: DataFrame) -> DataFrame:
    """Activity per domain, 15-minute cell and label: the only step sized by the data."""
    return rows.groupBy("domain", cell_of(c("event_ts")).alias("cell"), "label").agg(
        *_row_measures()
    )


def ticks(
    cell_rows: DataFrame, cfg: MonitorConfig = DEFAULT, first: int | None = None, last: int | None = None
) -> DataFrame:
    """Every evaluation instant from the first cell's end to the last cell's end, quiet days left out.

    One row per quarter hour of the days that have a cell and of ``cfg.quiet_days`` after each, whether
    or not anything happened in it; later ones would see neither activity nor a baseline. So what a
    calendar costs follows the days with events, and one event far away adds a few days. ``first`` and
    ``last`` number the quarter hours to lay out at most. Days are dealt to the tasks, which lay out theirs.
    """
    bounds = cell_rows.agg(F.min("cell").alias("_first"), F.max("cell").alias("_last")).select(
        F.struct(
            F.greatest(c("_first") + 1, F.lit(first).cast("bigint")).alias("first"),
            F.least(c("_last") + 1, F.lit(last).cast("bigint")).alias("last"),
        ).alias("bounds")
    )
    active = cell_rows.select(F.floor(c("cell") / 96).alias("_day")).distinct()
    days = active.select(F.explode(F.sequence(c("_day"), c("_day") + cfg.quiet_days)).alias("day")).distinct()
    due = days.select("day", bounds.scalar().alias("bounds")).select("day", "bounds.first", "bounds.last")
    start, end = c("day") * 96, c("day") * 96 + 95
    due = due.where((c("first") <= end) & (c("last") >= start))
    cells_of_day = F.sequence(F.greatest("first", start), F.least("last", end))
    return due.select(F.explode(F.transform(cells_of_day, tick_time)).alias(RUN))


def serve_ticks(cell_rows: DataFrame, window_cells: int) -> DataFrame:
    """Each cell once per tick whose window holds it, placed by tick.

    Everything after this groups by the tick (and more), so it needs no further shuffle. A
    tick holds at most ``window_cells`` rows per distinct label, however busy it was.
    """
    return cell_rows.select(
        served_ticks(c("cell"), window_cells).alias(RUN), *cell_rows.columns
    ).repartition(RUN)


def windowed(cell_rows: DataFrame, window_cells: int) -> DataFrame:
    """Activity per run, domain and label in the window before the run."""
    return serve_ticks(cell_rows, window_cells).groupBy(RUN, "domain", "label").agg(
        *_merge_measures()
    )


# ------------------------------------------------------------------------ one instant


def windowed_as_of(
    rows: DataFrame, minutes: int, as_of: datetime | str | None
) -> DataFrame:
    """``windowed`` for a single run; the time filter reaches the scans.

    The run's instant hangs on a column: as a mere constant it would be folded out of the joins
    on it, and they would no longer be joins on equality.
    """
    run = F.current_timestamp() if as_of is None else instant(as_of)
    return (
        rows.where(within_last(c("event_ts"), minutes, as_of))
        .groupBy("domain", "label")
        .agg(*_row_measures())
        .withColumn(RUN, F.when(c("n") > 0, run))
    )


def single_run(spark: SparkSession, as_of: datetime | str | None) -> DataFrame:
    run = F.current_timestamp() if as_of is None else instant(as_of)
    return spark.range(1).select(F.when(c("id") >= 0, run).alias(RUN))


# ------------------------------------------------------------------------ snapshot

# Field and label name of each domain's top list.
TOP_LISTS = {
    "orders": ("top_order_cities", "city"),
    "payments": ("top_failure_reasons", "failure_reason"),
    "deliveries": ("top_delayed_cities", "city"),
    "complaints": ("top_categories", "ai_category"),
}


def snapshot(windows: DataFrame, runs: DataFrame | None, cfg: MonitorConfig = DEFAULT) -> DataFrame:
    """One row per run: (run_timestamp, features) with the nested feature struct.

    Runs without any activity get zeros and empty lists. Top lists break ties by label.
    """
    counted = F.when(c("domain").isin("payments", "deliveries"), c("hits")).otherwise(c("n"))
    by_count = Window.partitionBy(RUN, "domain").orderBy(
        c("label").isNull(), counted.desc(), "label"
    )
    ranked = windows.withColumn("_cnt", counted).withColumn("_rank", F.row_number().over(by_count))

    def of(domain: str, name: str) -> Column:
        return F.sum(F.when(c("domain") == domain, c(name)))

    def top(domain: str) -> Column:
        listed = (c("domain") == domain) & c("label").isNotNull() & (c("_rank") <= cfg.top_k)
        entry = F.struct("_rank", "label", "_cnt")
        return F.array_sort(F.collect_list(F.when(listed, entry)))

    totals = ranked.groupBy(RUN).agg(
        of("orders", "n").alias("orders"),
        of("orders", "revenue").alias("revenue"),
        of("payments", "n").alias("payments"),
        of("payments", "hits").alias("failed"),
        of("payments", "oks").alias("success"),
        of("deliveries", "n").alias("deliveries"),
        of("deliveries", "hits").alias("delayed"),
        of("deliveries", "delay").alias("delay"),
        of("complaints", "n").alias("complaints"),
        of("complaints", "hits").alias("severe"),
        *[top(domain).alias(f"top_{domain}") for domain in TOP_LISTS],
    )
    if runs is not None:
        totals = runs.join(totals, RUN, "left")

    def number(name: str) -> Column:
        return F.coalesce(c(name), F.lit(0)).cast("bigint")

    def share(hits: str, n: str) -> Column:
        return F.coalesce(rate(c(hits), c(n)), F.lit(0.0))

    def top_list(domain: str) -> Column:
        field, label = TOP_LISTS[domain]
        entries = F.transform(
            f"top_{domain}",
            lambda e: F.struct(e["label"].alias(label), e["_cnt"].alias("cnt")),
        )
        return F.coalesce(entries, F.array().cast(f"array<struct<{label}:string,cnt:bigint>>")).alias(
            field
        )

    return totals.select(
        RUN,
        F.struct(
            F.lit(cfg.window_minutes).alias("window_minutes"),
            F.struct(
                number("orders").alias("orders"),
                F.coalesce(c("revenue").cast("double"), F.lit(0.0)).alias("revenue"),
                top_list("orders"),
            ).alias("volume"),
            F.struct(
                number("payments").alias("total"),
                number("failed").alias("failed"),
                number("success").alias("success"),
                share("failed", "payments").alias("failure_rate"),
                top_list("payments"),
            ).alias("payments"),
            F.struct(
                number("deliveries").alias("total"),
                number("delayed").alias("delayed"),
                share("delayed", "deliveries").alias("delay_rate"),
                F.coalesce(int_mean(c("delay"), c("deliveries"), 1), F.lit(0.0)).alias(
                    "avg_delay_minutes"
                ),
                top_list("deliveries"),
            ).alias("deliveries"),
            F.struct(
                number("complaints").alias("total"),
                number("severe").alias("severe"),
                share("severe", "complaints").alias("severe_rate"),
                top_list("complaints"),
            ).alias("complaints"),
        ).alias("features"),
    )


def features_replay(cell_rows: DataFrame, cfg: MonitorConfig = DEFAULT) -> DataFrame:
    """Snapshots at every tick of the history."""
    return snapshot(windowed(cell_rows, cfg.window_cells), ticks(cell_rows, cfg), cfg)


def features_as_of(
    rows: DataFrame,
    cfg: MonitorConfig = DEFAULT,
    as_of: datetime | str | None = None,
    window_minutes: int | None = None,
) -> DataFrame:
    """The snapshot for one run; without ``as_of`` the run is now."""
    minutes = window_minutes or cfg.window_minutes
    snap = snapshot(
        windowed_as_of(rows, minutes, as_of), single_run(rows.sparkSession, as_of), cfg
    )
    return snap.withColumn(
        "features", c("features").withField("window_minutes", F.lit(minutes))
    )


# ------------------------------------------------------------------------ probes


def probe_recent_orders(order_cells: DataFrame, cfg: MonitorConfig = DEFAULT) -> DataFrame:
    """Orders of the last quarter hour before each tick, and whether that is too few."""
    counts = windowed(order_cells.where(c("domain") == "orders"), cfg.recent_orders_cells)
    per_run = counts.groupBy(RUN).agg(F.sum("n").alias("_n"))
    return (
        ticks(order_cells, cfg)
        .join(per_run, RUN, "left")
        .select(RUN, F.coalesce("_n", F.lit(0)).alias("orders_count"))
        .withColumn("low_volume", c("orders_count") < cfg.min_expected_orders)
    )


def probe_payment_failure(payment_cells: DataFrame, cfg: MonitorConfig = DEFAULT) -> DataFrame:
    """Failure rate of the last hour before each tick, unrounded, and whether it is a breach."""
    counts = windowed(payment_cells.where(c("domain") == "payments"), cfg.payment_probe_cells)
    per_run = counts.groupBy(RUN).agg(F.sum("n").alias("_n"), F.sum("hits").alias("_hits"))
    failure_rate = F.coalesce(
        c("_hits").cast("double") / F.nullif(c("_n"), F.lit(0)).cast("double"), F.lit(0.0)
    )
    return (
        ticks(payment_cells, cfg)
        .join(per_run, RUN, "left")
        .select(
            RUN,
            failure_rate.alias("failure_rate"),
            F.coalesce("_n", F.lit(0)).alias("total_payments"),
        )
        .withColumn("breach", c("failure_rate") > cfg.max_payment_failure_rate)
    )


def investigate_failures(payment_cells: DataFrame, cfg: MonitorConfig = DEFAULT) -> DataFrame:
    """Failed payments per reason in the last hour before each tick."""
    counts = windowed(payment_cells.where(c("domain") == "payments"), cfg.payment_probe_cells)
    return counts.where(c("hits") > 0).select(
        RUN, c("label").alias("failure_reason"), c("hits").alias("failures")
    )


def failed_payments_last_hour(
    raw_payments: DataFrame, cfg: MonitorConfig = DEFAULT, as_of: datetime | str | None = None
) -> DataFrame:
    """The failed payments of the last hour before ``as_of``."""
    return raw_payments.where(
        (c("payment_status") == "failed")
        & within_last(c("payment_ts"), cfg.payment_probe_hours * 60, as_of)
    )


def failed_payments_replay(raw_payments: DataFrame, cfg: MonitorConfig = DEFAULT) -> DataFrame:
    """``failed_payments_last_hour`` at every tick: each failure beside the ticks that see it."""
    seen_by = served_ticks(cell_of(c("payment_ts")), cfg.payment_probe_cells)
    return raw_payments.where(c("payment_status") == "failed").select(seen_by.alias(RUN), "*")


# ------------------------------------------------------------------------ single features


def _counts_as_of(rows, domain, cfg, as_of):
    return rows.where((c("domain") == domain) & within_last(c("event_ts"), cfg.window_minutes, as_of))


def feat_orders(raw_orders, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    return _counts_as_of(activity(raw_orders=raw_orders), "orders", cfg, as_of).agg(
        F.count("*").alias("orders")
    )


def feat_revenue(raw_orders, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    return _counts_as_of(activity(raw_orders=raw_orders), "orders", cfg, as_of).agg(
        F.coalesce(F.sum("revenue").cast("double"), F.lit(0.0)).alias("revenue")
    )


def _top(rows: DataFrame, domain: str, cfg, as_of) -> DataFrame:
    listed = _counts_as_of(rows, domain, cfg, as_of).where(c("label").isNotNull())
    return (
        listed.groupBy(c("label").alias(TOP_LISTS[domain][1]))
        .agg(F.count("*").alias("cnt"))
        .orderBy(c("cnt").desc(), TOP_LISTS[domain][1])
        .limit(cfg.top_k)
    )


def feat_top_cities(raw_orders, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    return _top(activity(raw_orders=raw_orders), "orders", cfg, as_of)


def feat_payments(raw_payments, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    stats = _counts_as_of(activity(raw_payments=raw_payments), "payments", cfg, as_of).agg(
        F.count("*").alias("total"),
        F.count_if("hit").alias("failed"),
        F.count_if("ok").alias("success"),
    )
    return stats.withColumn(
        "failure_rate", F.coalesce(rate(c("failed"), c("total")), F.lit(0.0))
    )


def feat_top_failure_reasons(raw_payments, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    return _top(activity(raw_payments=raw_payments), "payments", cfg, as_of)


def feat_deliveries(raw_deliveries, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    stats = _counts_as_of(activity(raw_deliveries=raw_deliveries), "deliveries", cfg, as_of).agg(
        F.count("*").alias("total"),
        F.count_if("hit").alias("delayed"),
        F.sum("delay").alias("_delay"),
    )
    return stats.select(
        "total",
        "delayed",
        F.coalesce(rate(c("delayed"), c("total")), F.lit(0.0)).alias("delay_rate"),
        F.coalesce(int_mean(c("_delay"), c("total"), 1), F.lit(0.0)).alias("avg_delay_minutes"),
    )


def feat_top_delayed_cities(raw_deliveries, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    return _top(activity(raw_deliveries=raw_deliveries), "deliveries", cfg, as_of)


def feat_complaints(raw_complaints, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    stats = _counts_as_of(activity(raw_complaints=raw_complaints), "complaints", cfg, as_of).agg(
        F.count("*").alias("total"), F.count_if("hit").alias("severe")
    )
    return stats.withColumn("severe_rate", F.coalesce(rate(c("severe"), c("total")), F.lit(0.0)))


def feat_top_categories(raw_complaints, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    return _top(activity(raw_complaints=raw_complaints), "complaints", cfg, as_of)

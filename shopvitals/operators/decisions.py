"""Alert decisions: fingerprint, policy, suppression of repeats, routing, audit row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopvitals.config import DEFAULT, MonitorConfig
from shopvitals.operators.diagnosis import DIAGNOSIS_FIELDS, META_FIELDS
from shopvitals.operators.features import RUN
from shopvitals.operators.model_contract import anomalies_json, features_json
from shopvitals.session import discard, materialize_at

c = F.col

# Icon of each status in an alert, and of any other status.
ICONS = {"healthy": "🟢", "degraded": "🟡", "critical": "🔴"}
OTHER_ICON = "⚪"
REPEAT = "duplicate_within_window"


def fingerprint(status: Column, tags: Column) -> Column:
    """Twelve hex digits that identify a status with its set of tags."""
    ordered = F.array_join(F.array_sort(F.coalesce(tags, F.array().cast("array<string>"))), ",")
    return F.substring(F.sha1(F.concat(status, F.lit("|"), ordered)), 1, 12)


def alert_fingerprint(selected: DataFrame, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    return selected.withColumn(
        "alert_fingerprint", fingerprint(c("diagnosis.status"), c("diagnosis.tags"))
    )


def alert_candidates(selected: DataFrame, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    """Adds ``candidate``: bad and certain enough to alert, repeats aside."""
    return selected.withColumn(
        "candidate",
        F.coalesce(
            c("diagnosis.status").isin("degraded", "critical")
            & (c("diagnosis.severity") >= cfg.alert_min_severity)
            & (c("diagnosis.confidence") >= cfg.alert_min_confidence),
            F.lit(False),
        ),
    )


def recently_alerted(
    candidates: DataFrame, history: DataFrame, cfg: MonitorConfig = DEFAULT
) -> DataFrame:
    """Candidates whose fingerprint the stored history alerted within the window before them.

    Time is cut into slots as long as the window. An alert can only matter in its own slot,
    where it must come first, and in the next, where the slot's latest one decides; so the
    history shrinks to two rows per fingerprint and slot and the join is on equality.
    """
    window_us = cfg.alert_dedup_minutes * 60_000_000
    key = "alert_fingerprint"

    def slot(us: Column) -> Column:
        return F.floor(us / F.lit(window_us)).cast("bigint")

    sent = F.unix_micros("alerted_at")
    per_slot = (
        history.where(c("alerted_at").isNotNull())
        .groupBy(key, slot(sent).alias("_slot"))
        .agg(F.min(sent).alias("_first"), F.max(sent).alias("_last"))
    )
    reach = per_slot.select(
        key,
        F.inline(
            F.array(
                F.struct(c("_slot"), c("_first").alias("_from"), F.lit(True).alias("_same")),
                F.struct(
                    (c("_slot") + 1).alias("_slot"),
                    c("_last").alias("_from"),
                    F.lit(False).alias("_same"),
                ),
            )
        ),
    )
    run = F.unix_micros(RUN)
    covered = (c("_same") & (c("_from") < run)) | (~c("_same") & (c("_from") >= run - window_us))
    asked = candidates.withColumn("_slot", slot(run)).alias("asked")
    return asked.join(
        reach.alias("reach"),
        (c(f"asked.{key}") == c(f"reach.{key}")) & (c("asked._slot") == c("reach._slot")) & covered,
        "left_semi",
    ).drop("_slot")


# ---------------------------------------------------------------- suppression over a history
#
# Whether an alert goes out depends on when the last one of its fingerprint did, so decisions
# chain. Every candidate has one successor: the first candidate after its window, which is the next to
# go out if it does itself. A candidate after a gap longer than the window goes out whatever came
# before. What goes out is what successors reach from there; successors of 1, 2, 4, ... steps
# are joined to themselves, so a chain of n takes log2(n) rounds. No fingerprint's history is one
# list or one task: rows are keyed by fingerprint and instant, or by fingerprint and cell of time.

#: Cells of time a window is cut into; a fingerprint's cells are one row each.
CELLS_A_WINDOW = 16


def _successors(candidates: DataFrame, key: str, window_us: int) -> DataFrame:
    """(fingerprint, at, to, reached): each instant, its successor if one is in its stretch, and whether it opens one.

    Instants and the ends of their windows meet in cells of time. Inside a cell the order decides,
    beyond it the nearest cell before or after that has an instant.
    """
    width = max(1, window_us // CELLS_A_WINDOW)
    at = candidates.select(c(key).alias("fingerprint"), F.unix_micros(RUN).alias("at")).distinct()
    instant, end = F.struct(c("at").alias("value"), F.lit(True).alias("own")), F.struct(
        (c("at") + window_us).alias("value"), F.lit(False).alias("own")
    )
    points = at.select("fingerprint", "at", F.inline(F.array(instant, end))).withColumn(
        "cell", F.floor(c("value") / F.lit(width)).cast("bigint")
    )
    own = F.when(c("own"), c("value"))
    cells = points.groupBy("fingerprint", "cell").agg(F.min(own).alias("first"), F.max(own).alias("last"))
    over = Window.partitionBy("fingerprint")
    before = over.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    after = over.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "fingerprint",
        "cell",
        F.last("last", ignorenulls=True).over(before).alias("_before"),
        F.last("first", ignorenulls=True).over(after).alias("_after"),
    )
    # The end of a window comes before an instant of the same time: its successor is later.
    inside = Window.partitionBy("fingerprint", "cell")
    down = inside.orderBy(F.desc("value"), "own").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    up = inside.orderBy("value", F.desc("own")).rowsBetween(Window.unboundedPreceding, -1)
    placed = points.join(cells, ["fingerprint", "cell"]).select(
        "fingerprint",
        "at",
        "own",
        F.coalesce(F.min(own).over(down), "_after").alias("next"),
        F.coalesce(F.max(own).over(up), "_before").alias("previous"),
    )
    linked = placed.groupBy("fingerprint", "at").agg(
        F.max(F.when(~c("own"), c("next"))).alias("to"), F.max(F.when(c("own"), c("previous"))).alias("previous")
    )
    opens = c("previous").isNull() | (c("at") - c("previous") > window_us)
    return linked.select("fingerprint", "at", "to", opens.alias("reached"))


def _doubled(steps: DataFrame) -> DataFrame:
    """Successors of twice as many steps, and what those reached so far reach by one of theirs."""
    marked = steps.where(c("reached") & c("to").isNotNull()).select("fingerprint", c("to").alias("at"), F.lit(True).alias("_hit"))
    # A successor that is reached already need not be gone through again.
    onward = steps.select("fingerprint", c("at").alias("to"), c("to").alias("_on"))
    return (
        steps.join(onward, ["fingerprint", "to"], "left")
        .join(marked.distinct(), ["fingerprint", "at"], "left")
        .select("fingerprint", "at", c("_on").alias("to"), (c("reached") | F.coalesce("_hit", F.lit(False))).alias("reached"))
    )


def sent_alerts(
    candidates: DataFrame,
    cfg: MonitorConfig = DEFAULT,
    key: str = "alert_fingerprint",
    folders: list[str] | None = None,
) -> DataFrame:
    """(fingerprint, run_timestamp) of the candidates that go out.

    A candidate goes out unless one of the same fingerprint went out at or after the window
    before it; windows may have any length. Rows without a fingerprint do not go out. The result is
    stored; its folder is added to ``folders`` for the caller to discard.
    """
    window_us = cfg.alert_dedup_minutes * 60_000_000
    if window_us <= 0:
        raise ValueError("the suppression window must be positive")
    spark = candidates.sparkSession
    steps, path = materialize_at(_successors(candidates, key, window_us), "steps")
    while not steps.where(c("reached") & c("to").isNotNull()).isEmpty():
        doubled, new_path = materialize_at(_doubled(_doubled(steps)), "steps")  # two doublings a job
        discard(spark, path)
        steps, path = doubled, new_path
    if folders is not None:
        folders.append(path)
    return steps.where("reached").select(c("fingerprint").alias(key), F.timestamp_micros("at").alias(RUN))


def alert_suppress(
    flagged: DataFrame,
    cfg: MonitorConfig = DEFAULT,
    history: DataFrame | None = None,
    folders: list[str] | None = None,
) -> DataFrame:
    """Adds ``should_alert`` and ``suppression_reason`` to runs with ``candidate`` set.

    ``history`` holds (alert_fingerprint, alerted_at) of earlier alerts, none after the first
    run. A candidate is suppressed by any alert of its fingerprint from the window before it on,
    later ones included; the rest follow the chain among themselves. ``folders`` as for ``sent_alerts``.
    """
    key = ["alert_fingerprint", RUN]
    wanted = flagged.where("candidate").select(*key)
    if history is not None:
        last = (
            history.where(c("alerted_at").isNotNull())
            .groupBy("alert_fingerprint")
            .agg(F.max("alerted_at").alias("_last"))
        )
        window = F.make_dt_interval(mins=F.lit(cfg.alert_dedup_minutes))
        wanted = wanted.join(last, "alert_fingerprint", "left").where(
            c("_last").isNull() | (c(RUN) > c("_last") + window)
        ).select(*key)
    sent = sent_alerts(wanted, cfg, folders=folders).withColumn("_sent", F.lit(True))
    out = F.coalesce(c("_sent"), F.lit(False))
    return flagged.join(sent, key, "left").select(
        *flagged.columns,
        (c("candidate") & out).alias("should_alert"),
        F.when(c("candidate") & ~out, REPEAT).alias("suppression_reason"),
    )


def alert_routing(decided: DataFrame, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    """Adds ``routing``, whether or not an alert goes out."""
    paged = (c("diagnosis.status") == "critical") & (
        c("diagnosis.severity") >= cfg.pager_min_severity
    )
    return decided.withColumn(
        "routing", F.when(paged, "telegram+pager").otherwise("telegram")
    )


def _whole_percent(share: Column) -> Column:
    return F.concat((share * 100).cast("int").cast("string"), F.lit("%"))


def alert_message(decided: DataFrame, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    """Text of every alert that goes out."""
    status = c("diagnosis.status")
    icon = F.lit(OTHER_ICON)
    for name, symbol in ICONS.items():
        icon = F.when(status == name, symbol).otherwise(icon)
    # Fixed value: layout of the message.
    lines = (
        F.concat(icon, F.lit(" *Pipeline "), F.upper(status), F.lit("*")),
        F.concat(
            F.lit("*Severity:* "), _whole_percent(c("diagnosis.severity")),
            F.lit(" | *Confidence:* "), _whole_percent(c("diagnosis.confidence")),
        ),
        F.lit(""),
        F.concat(F.lit("*Issue:* "), c("diagnosis.issue_summary")),
        F.concat(F.lit("*Root Cause:* "), c("diagnosis.root_cause")),
        F.concat(F.lit("*Business Impact:* "), c("diagnosis.business_impact")),
        F.concat(F.lit("*Suggested Fix:* "), c("diagnosis.suggested_fix")),
        F.lit(""),
        F.lit("*Investigation SQL:*"),
        F.lit("```"),
        c("diagnosis.investigation_sql"),
        F.lit("```"),
        F.concat(
            F.lit("_Source: "), F.coalesce("diagnosis.llm_provider", F.lit("unknown")),
            F.lit(" | fingerprint: "), c("alert_fingerprint"), F.lit("_"),
        ),
    )
    return decided.where("should_alert").select(
        RUN, "alert_fingerprint", "routing", F.concat_ws("\n", *lines).alias("message")
    )


def diagnosis_record(decided: DataFrame, cfg: MonitorConfig = DEFAULT, as_of=None) -> DataFrame:
    """Audit row of each run. An alert counts as sent at the time of its run."""
    fields = [
        F.coalesce("diagnosis.tags", F.array().cast("array<string>")).alias("tags")
        if name == "tags"
        else c(f"diagnosis.{name}").alias(name)
        for name in DIAGNOSIS_FIELDS
    ]
    return decided.select(
        RUN,
        *fields,
        features_json().alias("features_json"),
        anomalies_json().alias("anomalies_json"),
        "source",
        *[c(f"diagnosis.{name}").alias(name) for name in META_FIELDS],
        "alert_fingerprint",
        F.when(c("should_alert"), c(RUN)).alias("alerted_at"),
    )


def with_ids(records: DataFrame) -> DataFrame:
    """Audit rows as table rows: the id follows from the run, so a replay keeps it."""
    return records.select(
        F.unix_seconds(RUN).alias("diagnosis_id"), "*", c(RUN).alias("created_at")
    )

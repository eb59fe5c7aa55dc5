"""Alert suppression in operator state: candidates of any arrival order, decided in the order of their time.

The state of a fingerprint is the last alert sent and the candidates the watermark has not passed yet.
An event-time timer wakes it when the next of them is due, and once more when the window after the
last alert is over: then nothing is left of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shopvitals.config import DEFAULT, MonitorConfig
from shopvitals.operators.decisions import REPEAT
from shopvitals.operators.features import RUN
from shopvitals.session import pin_streaming

STATE = "last bigint, waiting array<bigint>"
DECIDED = "alert_fingerprint string, at bigint, should_alert boolean"


def decide_due(
    last: int | None, waiting: list[int], mark: int, window_us: int
) -> tuple[int | None, list[int], list[tuple[int, bool]]]:
    """(last alert, candidates still waiting, decisions) once time has passed ``mark``; repeated instants share one."""
    decisions: list[tuple[int, bool]] = []
    due = sorted(t for t in waiting if t <= mark)
    for t in due:
        if decisions and decisions[-1][0] == t:
            decisions.append(decisions[-1])
            continue
        goes = last is None or t - last > window_us
        last = t if goes else last
        decisions.append((t, goes))
    return last, [t for t in waiting if t > mark], decisions


def stream_alert_gate(
    candidates: DataFrame, delay: str = "10 minutes", cfg: MonitorConfig = DEFAULT
) -> DataFrame:
    """(alert_fingerprint, run_timestamp, should_alert, suppression_reason) of a stream of candidates.

    A candidate is decided when the watermark, ``delay`` behind the latest one, has reached it. Those that
    come up to ``delay`` late, in whatever order and batch, are decided as one batch of all would
    decide them; ones that come later are left to ``late_policy``. What a fingerprint costs is its candidates of
    the last ``delay``. Rows without a fingerprint or time have no decision.
    """
    pin_streaming(candidates.sparkSession)
    window_us = cfg.alert_dedup_minutes * 60_000_000

    def gate(key: tuple[str], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, waiting = state.get if state.exists else (None, [])
        waiting = list(waiting or [])
        if not state.hasTimedOut:
            for rows in parts:
                waiting += rows["at"].tolist()
        mark_ms = state.getCurrentWatermarkMs()
        last, waiting, decisions = decide_due(last, waiting, mark_ms * 1000, window_us)
        # A timer rings when the watermark is past it, so it is set a moment before the time it is for.
        wake_us = min(waiting) if waiting else last + window_us + 2000 if last is not None else None
        if not waiting and (wake_us is None or wake_us <= mark_ms * 1000):
            if state.exists:
                state.remove()
        else:
            state.update((last, waiting))
            state.setTimeoutTimestamp(max(-(-wake_us // 1000) - 1, mark_ms + 1))
        if decisions:
            yield pd.DataFrame(
                {"alert_fingerprint": key[0], "at": [t for t, _ in decisions], "should_alert": [s for _, s in decisions]}
            )

    named = candidates.where(F.col("alert_fingerprint").isNotNull() & F.col(RUN).isNotNull())
    decided = (
        named.withWatermark(RUN, delay)
        .select("alert_fingerprint", RUN, F.unix_micros(RUN).alias("at"))
        .groupBy("alert_fingerprint")
        .applyInPandasWithState(gate, DECIDED, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )
    return decided.select(
        "alert_fingerprint", F.timestamp_micros("at").alias(RUN), "should_alert",
        F.when(~F.col("should_alert"), REPEAT).alias("suppression_reason"),
    )

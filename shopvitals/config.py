"""Thresholds and windows, all of them literals handed to plan builders."""

from __future__ import annotations

from dataclasses import dataclass

CELL_SECONDS = 900  # the 15-minute grid on which histories are evaluated


@dataclass(frozen=True)
class MonitorConfig:
    # A rate above its threshold (strictly) is an issue.
    payment_failure_threshold: float = 0.20
    delivery_delay_threshold: float = 0.25
    complaint_severity_threshold: float = 0.30
    # |z| at or above this is an anomaly; five standard deviations is severity 1.
    zscore_threshold: float = 2.5
    zscore_full_severity: float = 5.0

    window_minutes: int = 30
    baseline_hours: int = 24
    alert_dedup_minutes: int = 30
    alert_min_severity: float = 0.5
    alert_min_confidence: float = 0.4
    pager_min_severity: float = 0.85

    # Escalation to a model.
    model_configured: bool = True
    model_provider: str = "openai"
    model_name: str = "gpt-4o-mini"
    gate_min_severity: float = 0.7
    gate_min_anomalies: int = 2
    gate_min_anomaly_severity: float = 0.8

    # Health probes.
    recent_orders_minutes: int = 15
    min_expected_orders: int = 1
    payment_probe_hours: int = 1
    max_payment_failure_rate: float = 0.30

    top_k: int = 5

    @property
    def window_cells(self) -> int:
        return _cells(self.window_minutes * 60)

    @property
    def baseline_cells(self) -> int:
        return _cells(self.baseline_hours * 3600)

    @property
    def recent_orders_cells(self) -> int:
        return _cells(self.recent_orders_minutes * 60)

    @property
    def payment_probe_cells(self) -> int:
        return _cells(self.payment_probe_hours * 3600)

    @property
    def quiet_days(self) -> int:
        """Days after a day with activity that are still evaluated: the baseline's, and one more."""
        return -(-self.baseline_hours // 24) + 1


def _cells(seconds: int) -> int:
    if seconds <= 0 or seconds % CELL_SECONDS:
        raise ValueError(
            f"a window of {seconds} s is no whole number of {CELL_SECONDS}-second cells; "
            "evaluate it with the as_of operators instead"
        )
    return seconds // CELL_SECONDS


DEFAULT = MonitorConfig()

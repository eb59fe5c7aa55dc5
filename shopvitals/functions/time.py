"""Event time: parsing, 30-minute buckets and the 15-minute cell grid."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

from shopvitals.config import CELL_SECONDS


def parse_event_ts(value: Column) -> Column:
    """ISO-8601 text with an offset or ``Z``; empty or unreadable text is NULL."""
    return F.try_to_timestamp(F.nullif(value, F.lit("")))


def half_hour_bucket(ts: Column) -> Column:
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / F.lit(1800)) * F.lit(1800))


def cell_of(ts: Column) -> Column:
    """Index of the 15-minute cell holding ``ts``."""
    return F.floor(F.unix_seconds(ts) / F.lit(CELL_SECONDS)).cast("bigint")


def tick_time(tick: Column) -> Column:
    """The instant at which tick ``n`` is evaluated: the start of cell ``n``."""
    return F.timestamp_seconds(tick * F.lit(CELL_SECONDS))


def served_ticks(cell: Column, cells: int) -> Column:
    """The ticks whose window of ``cells`` cells holds ``cell``, one row each."""
    return F.explode(F.transform(F.sequence(cell + 1, cell + cells), tick_time))


def instant(value: datetime | str) -> Column:
    """A literal instant; text and zoneless datetimes are read in the session zone."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp")


def within_last(ts: Column, minutes: int, as_of: datetime | str | None) -> Column:
    """``ts`` in the ``minutes`` before ``as_of``.

    Without ``as_of`` the window ends now and has no upper bound. The bounds are literals
    and ``ts`` stays bare, so the filter reaches the scan.
    """
    if as_of is None:
        return ts >= F.current_timestamp() - F.make_dt_interval(mins=F.lit(minutes))
    end = instant(as_of)
    return (ts >= end - F.make_dt_interval(mins=F.lit(minutes))) & (ts < end)

"""Rates and averages that come out the same whatever order rows are added in."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def exact_mean(total: Column, count: Column, digits: int) -> Column:
    """``round(total / count, digits)`` in decimal arithmetic, ties away from zero.

    ``total`` must be an exact sum (integer or decimal); the result is NULL for no rows.
    """
    return F.round(total / F.nullif(count, F.lit(0)).cast("decimal(20,0)"), digits)


def rate(hits: Column, count: Column, digits: int = 4) -> Column:
    """Share of ``hits`` in ``count`` as DOUBLE, NULL for no rows."""
    return exact_mean(hits.cast("decimal(20,0)"), count, digits).cast("double")


def int_mean(total: Column, count: Column, digits: int) -> Column:
    return exact_mean(total.cast("decimal(20,0)"), count, digits).cast("double")


def raw_rate(hits: Column, count: Column) -> Column:
    """Unrounded share, for thresholds defined on the unrounded value."""
    return hits.cast("double") / F.nullif(count, F.lit(0)).cast("double")


def money(value: Column) -> Column:
    """DECIMAL(10,2), half-up; what cannot be read as such counts as zero."""
    return F.coalesce(value.try_cast("decimal(10,2)"), F.lit(0).cast("decimal(10,2)"))


def whole_number(value: Column) -> Column:
    """Whole number of up to 18 digits, half-up; what cannot be read as such counts as zero."""
    return F.coalesce(value.try_cast("decimal(38,0)").try_cast("bigint"), F.lit(0).cast("bigint"))

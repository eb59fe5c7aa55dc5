"""Text cleaning and flags."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def clean_label(value: Column, default: str) -> Column:
    return F.lower(F.trim(F.coalesce(value, F.lit(default))))


def is_label(value: Column, *labels: str) -> Column:
    """Case-insensitive membership without trimming; NULL counts as no match."""
    return F.coalesce(F.lower(value).isin(*labels), F.lit(False))


def percent_text(value: Column) -> Column:
    """A rate of four decimals as a percentage with one, e.g. ``22.4%``.

    Done on whole ten-thousandths so that ties do not hinge on binary fractions.
    """
    tenths = F.floor((F.round(value * 10000).cast("bigint") + F.lit(5)) / F.lit(10)).cast("bigint")
    whole = F.floor(tenths / F.lit(10)).cast("bigint")
    return F.concat(whole.cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("%"))

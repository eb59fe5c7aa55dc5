"""Marts kept up to date by partial aggregates of each day.

New staging rows become partial aggregates, a folder per day and batch. Days that got some are finished
again from their partials alone, so a late row costs its day and not the table. Distinct customers are
counted from partials per customer, or for any span of days from mergeable sketches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shopvitals.operators import marts
from shopvitals.plans.warehouse import MART_DAYS
from shopvitals.session import side_by_side
from shopvitals.streaming.sinks import BATCH, DAY, write_days

c = F.col

#: Folder of rows without a day.
NO_DAY = -999_999
#: Logarithm of a sketch's size, and the relative standard error that goes with it.
LG_K = 12
SKETCH_ERROR = 1.04 / 2 ** (LG_K / 2)


@dataclass(frozen=True)
class DailyMart:
    """A mart by day: its staging view, keys, measures of rows, and how totals are finished."""

    source: str
    keys: tuple[str, ...]
    measures: Callable[[], list[Column]]
    finish: Callable[[DataFrame], DataFrame]
    counted: str | None = None  # a column whose distinct values are counted
    as_name: str | None = None
    largest: tuple[str, ...] = ()  # measures that merge by the maximum; others by the sum


DAILY = {
    "mart_order_summary": DailyMart(
        "stg_orders", ("city",), marts.order_measures, marts.finish_order_summary, "customer_id", "unique_customers"
    ),
    "mart_payment_health": DailyMart(
        "stg_payments", ("payment_method",), marts.payment_measures, marts.finish_payment_health
    ),
    "mart_delivery_performance": DailyMart(
        "stg_deliveries", ("city", "delivery_partner"), marts.delivery_measures, marts.finish_delivery_performance,
        largest=("max_delay_minutes",),
    ),
    "mart_complaint_insights": DailyMart(
        "stg_complaints", ("ai_category", "ai_severity", "customer_emotion"), marts.complaint_measures,
        marts.finish_complaint_insights,
    ),
}
HEALTH = "mart_business_health_daily"


def day_number(day: Column) -> Column:
    """Days since 1970 of a date, the folder it goes to."""
    return F.coalesce(F.unix_date(day).cast("bigint"), F.lit(NO_DAY))


def partials(rows: DataFrame, name: str) -> DataFrame:
    """Partial aggregates of staging rows, by day, key and, where one is counted, its value."""
    mart = DAILY[name]
    counted = [mart.counted] if mart.counted else []
    return rows.groupBy(MART_DAYS[name], *mart.keys, *counted).agg(*mart.measures())


def merged(parts: DataFrame, name: str) -> DataFrame:
    """Totals of a mart from partial aggregates, in the types the partials have."""
    mart, day = DAILY[name], MART_DAYS[name]
    by = [day, *mart.keys]
    types = dict(parts.dtypes)
    measures = [m for m in parts.columns if m not in (*by, mart.counted, DAY, BATCH)]

    def sums(rows: DataFrame, keys: list[str], *more: Column) -> DataFrame:
        return rows.groupBy(*keys).agg(
            *[(F.max(m) if m in mart.largest else F.sum(m)).cast(types[m]).alias(m) for m in measures], *more
        )

    if mart.counted is None:
        return sums(parts, by)
    # A value is counted once however many batches have it; null is no value.
    each = sums(parts, [*by, mart.counted])
    return sums(each, by, F.count(mart.counted).alias(mart.as_name))


def _stored(spark: SparkSession, path: str, schema: T.StructType, days: list[int]) -> DataFrame:
    """Rows of the folders of these days alone."""
    named = ",".join(str(day) for day in days)
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{DAY}={{{named}}}")


def update_marts(staging: Mapping[str, DataFrame], root: str, batch_id: int) -> dict[str, list[int]]:
    """Bring the marts below ``root`` up to date with new staging rows; the days that changed, by mart.

    Partials have a folder per day and batch, marts one per day: a first batch of many years writes
    as many folders once.

    ``staging`` holds rows that no batch before had. Writing a batch again replaces what it wrote. The
    days of a batch are listed on the driver, as there are no more of them than days in a calendar.
    """

    def update(name: str) -> list[int]:
        rows, day = staging[DAILY[name].source], MART_DAYS[name]
        spark, path = rows.sparkSession, f"{root}/partials/{name}"
        new = partials(rows, name)
        write_days(new, path, batch_id, day_number(c(day)))
        schema = new.withColumns({DAY: F.lit(0).cast("bigint"), BATCH: F.lit(0).cast("bigint")}).schema
        batch = spark.read.schema(schema).parquet(path).where(c(BATCH) == batch_id)
        days = sorted(row[0] for row in batch.select(DAY).distinct().collect())
        if days:
            done = DAILY[name].finish(merged(_stored(spark, path, schema, days), name))
            _replace_days(done, f"{root}/{name}", day)
        return days

    names = [name for name, mart in DAILY.items() if mart.source in staging]
    changed = dict(zip(names, side_by_side(update, names)))
    days = sorted({day for of in changed.values() for day in of})
    if days:
        changed[HEALTH] = _health(next(iter(staging.values())).sparkSession, root, days)
    return changed


def _replace_days(rows: DataFrame, path: str, day: str) -> None:
    placed = rows.withColumn(DAY, day_number(c(day))).repartition(DAY)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_mart(spark: SparkSession, root: str, name: str, days: list[int] | None = None) -> DataFrame | None:
    """A stored mart, of some days if they are given; None before its first row."""
    path = f"{root}/{name}"
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return (rows if days is None else rows.where(c(DAY).isin(days))).drop(DAY)


def _health(spark: SparkSession, root: str, days: list[int]) -> list[int]:
    """Finish the daily health of ``days`` from the stored marts, once all of them are there."""
    parts = [read_mart(spark, root, name, days) for name in DAILY]
    if any(part is None for part in parts):
        return []
    _replace_days(marts.mart_business_health_daily(*parts), f"{root}/{HEALTH}", MART_DAYS[HEALTH])
    return days


# ----------------------------------------------------------------------- distinct customers


def customer_sketches(stg_orders: DataFrame) -> DataFrame:
    """(order_date, city, customers): a sketch of each day's and city's customers, some kilobytes at most."""
    return stg_orders.groupBy("order_date", "city").agg(
        F.hll_sketch_agg("customer_id", F.lit(LG_K)).alias("customers")
    )


def customers_of_span(sketches: DataFrame, first: str, last: str) -> DataFrame:
    """(city, customers): about how many distinct customers each city had from day ``first`` to ``last``.

    Sketches of days are united, so a customer of several days counts once and no order is read. The
    relative standard error is ``SKETCH_ERROR``, 1.6 %.
    """
    inside = sketches.where(c("order_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return inside.groupBy("city").agg(
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("customers")
    )

"""Marts kept up to date against whole builds, sketches, and scans by a table of days."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from registry.inputs import Inputs
from shopvitals.plans import incremental, warehouse
from shopvitals.sources.tables import backup_calendar, scan_backup_days
from tests.conftest import TESTDATA


@pytest.fixture(scope="module")
def views(spark):
    return warehouse.staging_views(Inputs(spark, TESTDATA).raw("b"))


def part_of(views, keep):
    return {mart.source: views[mart.source].where(keep(F.crc32(warehouse.TABLE_KEY[mart.source]))) for mart in incremental.DAILY.values()}


def test_batches_and_retries_equal_a_whole_build(spark, views, tmp_path):
    root = str(tmp_path)
    for number in (0, 1, 1):
        changed = incremental.update_marts(part_of(views, lambda k, n=number: F.pmod(k, F.lit(2)) == n), root, number)
        assert set(changed) == {*incremental.DAILY, incremental.HEALTH}
    built = {}
    for name in incremental.DAILY:
        build, (source,) = warehouse.MARTS[name]
        built[name] = build(views[source])
        stored = incremental.read_mart(spark, root, name)
        assert stored.columns == built[name].columns and stored.count() == built[name].count() > 0
        assert built[name].exceptAll(stored.select(*built[name].columns)).isEmpty()
    health = warehouse.MARTS[incremental.HEALTH][0](*built.values())
    stored = incremental.read_mart(spark, root, incremental.HEALTH)
    assert health.exceptAll(stored).isEmpty() and stored.exceptAll(health).isEmpty()


def test_late_rows_read_and_write_their_days_only(spark, views, tmp_path):
    root = str(tmp_path)
    incremental.update_marts(part_of(views, lambda k: k >= 0), root, 0)
    written = {p: p.stat().st_mtime_ns for p in Path(root, "mart_order_summary").rglob("*.parquet")}
    day = views["stg_orders"].agg(F.min("order_date").alias("d")).first()["d"]
    late = views["stg_orders"].where(F.col("order_date") == F.lit(day)).limit(3).withColumn("order_id", F.concat("order_id", F.lit("-late")))
    changed = incremental.update_marts({"stg_orders": late}, root, 1)
    assert len(changed["mart_order_summary"]) == 1 and changed[incremental.HEALTH] == changed["mart_order_summary"]
    kept = [p for p, t in written.items() if p.exists() and p.stat().st_mtime_ns == t]
    assert len(written) - len(kept) == 1 and len(kept) > 5
    days = changed["mart_order_summary"]
    schema = spark.read.parquet(f"{root}/partials/mart_order_summary").schema
    files = incremental._stored(spark, f"{root}/partials/mart_order_summary", schema, days).inputFiles()
    assert len(files) <= 9 and all(f"day={days[0]}/" in f for f in files)
    total = incremental.read_mart(spark, root, "mart_order_summary").agg(F.sum("total_orders")).first()[0]
    assert total == views["stg_orders"].count() + 3


def test_customers_are_counted_once_over_batches_and_null_is_none(rows):
    made = rows(
        [("2024-01-01", "x", customer, False, "1.00") for customer in ("a", "a", "b", None)],
        "order_date date, city string, customer_id string, is_cancelled boolean, order_amount decimal(10,2)",
    )
    parts = incremental.partials(made, "mart_order_summary")
    (got,) = incremental.merged(parts.unionByName(parts), "mart_order_summary").collect()
    assert (got.unique_customers, got.total_orders, str(got.total_revenue)) == (2, 8, "8.00")


def test_sketches_of_days_unite(spark):
    orders = spark.range(30_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("order_date"),
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("city"), (F.col("id") % 5000).cast("string").alias("customer_id"),
    )
    sketches = incremental.customer_sketches(orders)
    for first, last in (("2024-01-01", "2024-01-10"), ("2024-01-03", "2024-01-04")):
        exact = dict(map(tuple, orders.where(F.col("order_date").between(first, last)).groupBy("city").agg(F.count_distinct("customer_id")).collect()))
        got = dict(map(tuple, incremental.customers_of_span(sketches, first, last).collect()))
        assert set(got) == set(exact)
        assert all(abs(got[x] - n) <= 3 * incremental.SKETCH_ERROR * n for x, n in exact.items())


def test_a_table_of_days_prunes_the_scan(spark, tmp_path):
    root = str(tmp_path / "backup")
    rows = spark.range(300).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 60).cast("int")).alias("d"))
    rows.select("id", F.year("d").alias("year"), F.month("d").alias("month"), F.day("d").alias("day")).repartition("year", "month", "day").write.partitionBy(
        "year", "month", "day").parquet(root)
    backup_calendar(spark, "2024-01-01", "2024-03-31").write.parquet(str(tmp_path / "calendar"))
    calendar = spark.read.parquet(str(tmp_path / "calendar"))
    mondays = scan_backup_days(spark.read.parquet(root), calendar.where("weekday = 2"))
    plan = mondays._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString().lower()
    got = mondays.collect()
    assert len(got) == sum(1 for i in range(300) if i % 60 % 7 == 0) == 45
    text = mondays._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text.lower()
    twice = scan_backup_days(spark.read.parquet(root), calendar.where("weekday = 2").unionByName(calendar.where("weekday = 2")))
    assert twice.count() == 45

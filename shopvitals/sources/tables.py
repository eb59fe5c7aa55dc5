"""Table scans: Parquet, JDBC and the date-partitioned backup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shopvitals.sources.fixture_sql import VIEWS


def utc_schema(schema: T.StructType) -> T.StructType:
    """The same schema with zoneless timestamps read as instants in UTC."""
    return T.StructType(
        [
            T.StructField(
                f.name,
                T.TimestampType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType,
                f.nullable,
            )
            for f in schema
        ]
    )


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan whose timestamps are TIMESTAMP, so time filters reach the scan."""
    return spark.read.schema(utc_schema(spark.read.parquet(path).schema)).parquet(path)


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 64,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A relational table, read in parallel ranges of ``partition_column`` when one is given."""
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("fetchsize", 10000)
        .options(**(options or {}))
    )
    if partition_column:
        if bounds is None:
            raise ValueError("a partition column needs bounds")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.load()


def scan_backup(
    spark: SparkSession, root: str, table: str, day: str | None = None
) -> DataFrame:
    """Backed-up rows of a table; ``day`` (``yyyy-MM-dd``) prunes to one partition."""
    backup = spark.read.option("recursiveFileLookup", "false").parquet(f"{root}/{table}")
    if day is None:
        return backup
    year, month, date = (int(part) for part in day.split("-"))
    return backup.where(
        (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == date)
    )


def backup_calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """(date, year, month, day, weekday) of the days from ``first`` to ``last``; weekday 1 is Sunday."""
    start, end = F.lit(first).cast("date"), F.lit(last).cast("date")
    days = spark.range(1).select(F.explode(F.sequence(start, end)).alias("date"))
    return days.select(
        "date", F.year("date").alias("year"), F.month("date").alias("month"), F.day("date").alias("day"),
        F.dayofweek("date").alias("weekday"),
    )


def scan_backup_days(backup: DataFrame, days: DataFrame) -> DataFrame:
    """Backed-up rows of the days in a table of (year, month, day), such as a part of ``backup_calendar``.

    A filter on ``days`` reaches the scan when the query runs: the partitions to read are those of the
    days that are left, and no others are listed or opened. A row comes back once, however often its
    day is named.
    """
    keys = ["year", "month", "day"]
    return backup.join(days.select(*keys), keys, "left_semi")


SOURCE_TABLES = ("orders", "customer", "nation", "lineitem", "supplier", "events", "documents")


def fixture_tables(name: str) -> list[str]:
    """Source tables a fixture view reads."""
    return [table for table in SOURCE_TABLES if "{" + table + "}" in VIEWS[name]]


def fixture_view(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """One of the raw tables of ``fixture_sql`` over scans of its source tables."""
    read = {table: tables[table] for table in fixture_tables(name)}
    return next(iter(read.values())).sparkSession.sql(VIEWS[name], **read)

"""Micro-batch sinks that a retried batch does not write twice.

A batch is stored under a number of its table, not under the stream's own batch id: ids start at 0
again with a new checkpoint, numbers go on after the last one stored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F, types as T

from shopvitals.operators.sinks import content_sums
from shopvitals.session import discard

BATCH, DAY = "batch_id", "day"
#: Days that are named in a path; a longer span is found by filtering the folders of all days.
NAMED_DAYS = 400


def create_table(spark: SparkSession, path: str, schema: T.StructType, by_day: bool = False) -> None:
    """An empty table to read from before the first batch; kept if it exists."""
    folder = f"{path}/{DAY}=-1/{BATCH}=-1" if by_day else f"{path}/{BATCH}=-1"
    spark.createDataFrame([], schema).write.mode("ignore").parquet(folder)


def first_number(
    spark: SparkSession, checkpoint: str, *paths: str, prepare: Callable[[], None] | None = None
) -> int:
    """The number of a stream's batch 0: after all that ``paths`` hold when its checkpoint is new.

    Kept inside the checkpoint, so a restart counts on from the same number and a retried batch
    replaces itself. One stream at a time writes to a table. ``prepare`` runs for a new checkpoint
    only, again if it did not end before.
    """
    kept, schema = f"{checkpoint.rstrip('/')}/first_batch", f"{BATCH} long"
    try:
        row = spark.read.schema(schema).parquet(kept).first()
        if row is not None:
            return row[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":  # which is a new checkpoint
            raise
    stored = [last_number_of(spark, path) for path in paths]
    number = max([-1, *(n for n in stored if n is not None)]) + 1
    if prepare is not None:
        prepare()
    spark.createDataFrame([(number,)], schema).coalesce(1).write.mode("overwrite").parquet(kept)
    return number


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """One folder per batch; a retry replaces it."""
    rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


# ----------------------------------------------------------------------- compaction
#
# Small folders are rewritten into segments, and a manifest beside the table names the segments that
# readers get. A version of the manifest is one file, so readers see all of a switch or nothing.

MANIFEST = "segment string, first bigint, last bigint, rows bigint"
#: Bytes of stored data that go into one file of a segment.
SEGMENT_FILE = 128 << 20


def _manifest(spark: SparkSession, path: str) -> tuple[int, list[Row]]:
    """The current version of a table's manifest and its segments; (0, []) before the first."""
    try:
        rows = spark.read.schema(f"{MANIFEST}, version bigint").parquet(f"{path}_manifest").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, []
    version = max((row["version"] for row in rows), default=0)
    return version, sorted((row for row in rows if row["version"] == version), key=lambda row: row["first"])


def _numbered(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])


def _segments(spark: SparkSession, path: str, schema: T.StructType, segments: list[Row]) -> DataFrame:
    return spark.read.schema(_numbered(schema)).parquet(*[f"{path}_segments/{row['segment']}" for row in segments])


def last_number_of(spark: SparkSession, path: str) -> int | None:
    """The number of the last batch that a table holds, in a folder or a segment."""
    _, segments = _manifest(spark, path)
    loose = spark.read.parquet(path).agg(F.max(BATCH).cast("bigint")).first()[0]
    return max((n for n in (loose, *(row["last"] for row in segments)) if n is not None), default=None)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, before_batch: int | None = None
) -> DataFrame:
    """The table, as it was before ``before_batch`` if one is given: its segments and the folders after them."""
    _, segments = _manifest(spark, path)
    rows = spark.read.schema(_numbered(schema)).parquet(path)
    if segments:
        after = max(row["last"] for row in segments)
        rows = rows.where(F.col(BATCH) > after).unionByName(_segments(spark, path, schema, segments))
    if before_batch is not None:
        rows = rows.where(F.col(BATCH) < before_batch)
    return rows.select(*schema.names)


def compact(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Rewrite the batch folders of a table into a segment; how many batches it holds, 0 if none was due.

    The last batch stays a folder, as a retry may still replace it, and batches may be added meanwhile. The
    new segment takes in the segments before it that are no larger than what it has, so there are few
    of them and a row is rewritten only a few times. Its content is compared with that of its sources before
    readers are switched to it. Folders and segments it replaces stay for running readers until
    the next compaction. One compaction of a table runs at a time; one that broke leaves nothing that is read.
    """
    version, segments = _manifest(spark, path)
    covered = max((row["last"] for row in segments), default=-1)
    numbers = _folders(spark, path)
    _remove_replaced(spark, path, numbers, covered, segments)
    due = [number for number in numbers[:-1] if number > covered]
    if not due:
        return 0
    loose = spark.read.schema(_numbered(schema)).parquet(path)
    rows = loose.where(F.col(BATCH).between(due[0], due[-1]))
    n_rows, merged = rows.count(), []
    while segments and segments[-1]["rows"] <= n_rows:
        merged.insert(0, segments.pop())
        n_rows += merged[0]["rows"]
    if merged:
        rows = rows.unionByName(_segments(spark, path, schema, merged))
    name = f"{version + 1}"
    given = Observation()
    sized = rows.select(*_numbered(schema).names)
    sources = [f"{path}/{BATCH}={number}" for number in due] + [f"{path}_segments/{row['segment']}" for row in merged]
    files = max(1, -(-sum(_bytes(spark, folder) for folder in sources) // SEGMENT_FILE))
    sums = content_sums(sized)
    sized.coalesce(files).observe(given, *sums).write.mode("overwrite").parquet(f"{path}_segments/{name}")
    stored = spark.read.schema(_numbered(schema)).parquet(f"{path}_segments/{name}")
    if stored.agg(*sums).first().asDict() != given.get:
        raise RuntimeError(f"segment {name} of {path} does not hold what was written")
    first = merged[0]["first"] if merged else due[0]
    live = [(row["segment"], row["first"], row["last"], row["rows"]) for row in segments] + [(name, first, due[-1], n_rows)]
    spark.createDataFrame(live, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}_manifest/version={version + 1}")
    return len(due)


def _file_system(spark: SparkSession, folder: str):
    """A folder as Spark's file system names it, and that file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _bytes(spark: SparkSession, folder: str) -> int:
    path, system = _file_system(spark, folder)
    return system.getContentSummary(path).getLength()


def _folders(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the batch folders of a table, by their names alone."""
    root, system = _file_system(spark, path)
    names = [status.getPath().getName() for status in system.listStatus(root)]
    numbers = [int(name.split("=")[1]) for name in names if name.startswith(f"{BATCH}=")]
    return sorted(number for number in numbers if number >= 0)


def _remove_replaced(spark: SparkSession, path: str, numbers: list[int], covered: int, segments: list[Row]) -> None:
    """Remove what the current manifest has replaced: readers of the one before it have had a whole interval."""
    for number in numbers:
        if number <= covered:
            discard(spark, f"{path}/{BATCH}={number}")
    folder, system = _file_system(spark, f"{path}_segments")
    if system.exists(folder):
        live = {row["segment"] for row in segments}
        for status in system.listStatus(folder):
            if status.getPath().getName() not in live:
                system.delete(status.getPath(), True)


def day_of(instant: Column) -> Column:
    """Days since 1970 of a timestamp."""
    return F.floor(F.unix_seconds(instant) / F.lit(86400)).cast("bigint")


def write_days(rows: DataFrame, path: str, batch_id: int, day: Column) -> None:
    """A folder per day and batch; a retry of the batch replaces its folders."""
    placed = rows.withColumn(DAY, day).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, BATCH).parquet(path)


def read_days(
    spark: SparkSession, path: str, schema: T.StructType, first: int, last: int, before_batch: int
) -> DataFrame:
    """The rows of the days from ``first`` to ``last``, as they were before ``before_batch``.

    Only the folders of these days are listed and read, so the cost does not grow with the table.
    """
    numbers = T.StructType([*schema.fields, T.StructField(DAY, T.LongType()), T.StructField(BATCH, T.LongType())])
    named = ",".join(str(day) for day in (-1, *range(first, last + 1))) if last - first < NAMED_DAYS else ""
    folders = f"{path}/{DAY}={{{named}}}" if named else path
    rows = spark.read.schema(numbers).option("basePath", path).parquet(folders)
    return rows.where(F.col(DAY).between(first, last) & (F.col(BATCH) < before_batch)).select(*schema.names)


def last_progress(spark: SparkSession, path: str, batch_id: int, schema: T.StructType) -> Row | None:
    """What the batch before ``batch_id`` noted in its one row; None for the first batch."""
    try:
        return spark.read.schema(schema).parquet(f"{path}/{BATCH}={batch_id - 1}").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None

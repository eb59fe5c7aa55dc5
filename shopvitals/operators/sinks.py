"""Writing tables: export, backup, full refresh, checks, schema evolution."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from decimal import Decimal
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from shopvitals.session import discard, side_by_side

c = F.col

SUMMARY = "table_name string, rows bigint, size_kb double, path string, status string"


def stored_kb(spark: SparkSession, path: str) -> float:
    """Size of the data files under ``path``; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.round(F.sum("length") / 1024, 1).alias("kb")).first()["kb"] or 0.0


# ----------------------------------------------------------------------- content
#
# A table's content is told by sums of hashes of its values, each salted with its column's name,
# and of its whole rows. Sums do not depend on order, add up over parts, and can be taken while a
# table is written. A changed, moved, repeated or lost value changes its column's sum and the rows'.
#
# Sums that are only compared with each other are of XXH64 and taken by Spark's own functions; the digests
# that ``content`` returns are of MD5, so that any engine can form them.

ROWS = "*"
CONTENT = "column_name string, n_values bigint, digest string"
#: Hashes have 60 bits and are added up in three parts of 20, as whole numbers that 2**43 rows do not overflow.
_PART = 20
_PARTS = ("a", "b", "c")


def _plain(f: T.StructField) -> Column:
    """A value as text that does not depend on whether it has been loaded: instants to the microsecond, ten decimals."""
    if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(f.name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        return c(f.name).cast("decimal(38,10)").cast("string")
    if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(f.name)
    return c(f.name).cast("string")


def _stored(f: T.StructField) -> Column:
    """A value that hashes alike before and after it is written: flat ones as they are."""
    return _plain(f) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType)) else c(f.name)


def _sums(table: DataFrame, value) -> list[Column]:
    """n_0 and sums a_0, b_0, c_0 of the rows, then of each column: how many values and the parts of their hashes."""
    values = [(f.name.lower(), value(f)) for f in table.schema]
    hashes = [F.when(v.isNotNull(), F.shiftrightunsigned(F.xxhash64(F.lit(name), v), 4)) for name, v in values]
    by_name = sorted(zip([name for name, _ in values], hashes), key=lambda named: named[0])
    row = F.shiftrightunsigned(F.xxhash64(*[F.coalesce(h, F.lit(-1)) for _, h in by_name]), 4)
    out = []
    for i, h in enumerate([row, *hashes]):
        out.append(F.count("*" if i == 0 else h).alias(f"n_{i}"))
        for k, part in enumerate(_PARTS):
            out.append(F.sum(F.shiftright(h, k * _PART).bitwiseAND(F.lit((1 << _PART) - 1))).alias(f"{part}_{i}"))
    return out


def content_sums(table: DataFrame) -> list[Column]:
    """Sums that tell what a table holds, for comparison with those of the same columns elsewhere."""
    return _sums(table, _stored)


def _content_rows(table: DataFrame, sums: Mapping) -> list[tuple]:
    names = [ROWS, *table.columns]
    return [(name, sums[f"n_{i}"], *[sums[f"{part}_{i}"] for part in _PARTS]) for i, name in enumerate(names)]


def _total(i: int) -> Column:
    """The sum of a column's hashes from the sums of its parts."""
    parts = [c(f"{part}_{i}").cast("decimal(20,0)") * F.lit(Decimal(1 << k * _PART)) for k, part in enumerate(_PARTS)]
    return reduce(Column.__add__, parts).cast("decimal(38,0)").cast("string")


def _by_column(table: DataFrame, sums: DataFrame) -> DataFrame:
    rows = [
        F.struct(F.lit(name).alias("column_name"), c(f"n_{i}").alias("n_values"), _total(i).alias("digest"))
        for i, name in enumerate([ROWS, *table.columns])
    ]
    return sums.select(F.inline(F.array(*rows)))


def _digest_sums(table: DataFrame) -> DataFrame:
    """As ``_sums``, of MD5: the first 15 hex digits of a value's digest, salted as ``name=value``.

    Texts go through Python in Arrow batches, where a value that repeats within a batch is hashed once;
    each batch becomes one row of sums.
    """
    names = [name.lower() for name in table.columns]
    sums = [f"{part}_{i}" for i in range(len(names) + 1) for part in ("n", *_PARTS)]
    n_sums, bits, parts = len(sums), _PART, len(_PARTS)

    def add_up(batches):
        from hashlib import md5

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def added(texts, times):
            """Sums of the parts of hashes, each as often as its text occurs."""
            heads = b"".join([md5(text, usedforsecurity=False).digest()[:8] for text in texts])
            hashes = (np.frombuffer(heads, ">u8") >> 4).astype("int64")
            split = [(hashes >> (k * bits)) & ((1 << bits) - 1) for k in range(parts)]
            return [int((part * times).sum()) for part in split]

        order = sorted(range(len(names)), key=names.__getitem__)
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [column.cast(pa.binary()) for column in batch.columns]
            rows = pc.binary_join_element_wise(
                *[columns[i] for i in order], pa.scalar(b"\x1f", pa.binary()), null_handling="replace", null_replacement=b"\\N"
            )
            out = [batch.num_rows, *added(rows.to_numpy(zero_copy_only=False), 1)]
            for name, column in zip(names, columns):
                counted = column.drop_null().value_counts()
                salt, texts = f"{name}=".encode(), counted.field("values").to_numpy(zero_copy_only=False)
                times = counted.field("counts").to_numpy(zero_copy_only=False)
                out += [int(times.sum()), *added([salt + text for text in texts], times)]
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()) for n in out], names=[f"s{i}" for i in range(n_sums)])

    texts = table.select(*[_plain(f).alias(f"v{i}") for i, f in enumerate(table.schema)])
    added = texts.mapInArrow(add_up, ", ".join(f"s{i} bigint" for i in range(n_sums)))
    return added.agg(*[
        (F.coalesce(F.sum(f"s{i}"), F.lit(0)) if name.startswith("n_") else F.sum(f"s{i}")).alias(name)
        for i, name in enumerate(sums)
    ]).withColumns({
        name: F.when(c(f"n_{name.split('_')[1]}") > 0, c(name)) for name in sums if not name.startswith("n_")
    })


def content(table: DataFrame) -> DataFrame:
    """(column_name, n_values, digest) of every column, and of whole rows as ``*``; one scan, one row of sums.

    Digests of a table and of the same rows in another order, with columns in another order or names in
    another case, are equal; that of a column without values is NULL.
    """
    return _by_column(table, _digest_sums(table))


def verify_content(source: Mapping[str, DataFrame], loaded: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, n_source, n_loaded, ok): do the loaded tables hold what was to be loaded?

    Columns are compared by name without case, whole rows as ``*``; a column that one side lacks is
    not ok. ``source`` is taken in its loaded form (``clean_for_load``).
    """

    def every(tables: Mapping[str, DataFrame], side: str) -> DataFrame:
        parts = [
            _by_column(table, table.agg(*_sums(table, _plain))).select(
                F.lit(name).alias("table_name"), F.lower("column_name").alias("column_name"),
                c("n_values").alias(f"n_{side}"), F.coalesce("digest", F.lit("")).alias(f"_{side}"),
            )
            for name, table in tables.items()
        ]
        return reduce(DataFrame.unionByName, parts)

    wanted = every({name: clean_for_load(table) for name, table in source.items()}, "source")
    both = wanted.join(every(loaded, "loaded"), ["table_name", "column_name"], "full")
    return both.select(
        "table_name", "column_name", "n_source", "n_loaded", c("_source").eqNullSafe(c("_loaded")).alias("ok")
    )


def _written(name: str, frame: DataFrame, path: str, write) -> tuple:
    """Write a table, counting its rows on the way; the result is a summary row."""
    rows = Observation()
    write(frame.observe(rows, F.count("*").alias("rows")))
    return (name, rows.get["rows"], stored_kb(frame.sparkSession, path), path, "success")


def _replace(name: str, frame: DataFrame, path: str) -> tuple:
    """Overwrite ``path`` unless the table is empty; a failure becomes a summary row."""
    try:
        if frame.isEmpty():
            return (name, 0, 0.0, path, "skipped")
        return _written(name, frame, path, lambda rows: rows.write.mode("overwrite").parquet(path))
    except (PySparkException, Py4JJavaError) as error:
        return (name, None, None, path, f"failed: {type(error).__name__}")


SWITCHES = "version bigint, rows bigint"


def current_version(spark: SparkSession, path: str) -> int:
    """The version of a refreshed table that readers get, 0 before the first one."""
    try:
        switches = spark.read.schema(SWITCHES).parquet(f"{path}/switches")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return switches.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def switch_readers(spark: SparkSession, path: str, version: int, rows: int) -> None:
    """Let readers see a version that is whole; the one before stays for those still on it, older ones go."""
    spark.createDataFrame([(version, rows)], SWITCHES).coalesce(1).write.mode("append").parquet(f"{path}/switches")
    if version > 2:
        discard(spark, f"{path}/versions/{version - 2}")


def read_refreshed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a refreshed table as of its last complete refresh."""
    return spark.read.parquet(f"{path}/versions/{current_version(spark, path)}")


def _switch(name: str, frame: DataFrame, path: str) -> tuple:
    """Write a new version beside the current one, check its content, then let readers see it.

    The content is summed up while it is written, and once more from what is stored.

    A refresh that fails or is empty leaves the current version as it is. The version before the
    current one stays for readers that are still on it; older ones are removed.
    """
    spark = frame.sparkSession
    try:
        old = current_version(spark, path)
        folder = f"{path}/versions/{old + 1}"
        given = Observation()
        frame.observe(given, *content_sums(frame)).write.mode("overwrite").parquet(folder)
        n = given.get["n_0"]
        if n == 0:
            discard(spark, folder)
            return (name, 0, 0.0, path, "skipped")
        kept = spark.read.parquet(folder)
        wanted, found = _content_rows(frame, given.get), _content_rows(kept, kept.agg(*content_sums(kept)).first())
        if wrong := [column for (column, *_), other in zip(wanted, found) if (column, *_) != other]:
            return (name, found[0][1], None, path, f"failed: content of {', '.join(wrong)} is not what was written")
        switch_readers(spark, path, old + 1, n)
        return (name, n, stored_kb(spark, folder), path, "success")
    except (PySparkException, Py4JJavaError) as error:
        return (name, None, None, path, f"failed: {type(error).__name__}")


def _session(tables: Mapping[str, DataFrame]) -> SparkSession:
    return next(iter(tables.values())).sparkSession


def _as_text(frame: DataFrame) -> list:
    """Columns with nested values as JSON text; flat columns as they are."""
    return [
        F.to_json(f.name).alias(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
        else c(f.name)
        for f in frame.schema
    ]


#: How tables are written and read as CSV: instants to the microsecond, an empty text apart from no value.
CSV = {
    "header": True, "escape": '"', "multiLine": True, "emptyValue": '""', "nullValue": "",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "lineSep": "\n",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An exported table under the schema it had; nested values stay JSON text."""
    flat = T.StructType([
        T.StructField(f.name, T.StringType())
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else T.StructField(f.name, f.dataType)
        for f in schema
    ])
    return spark.read.schema(flat).options(**CSV).csv(path)


def export_csv(tables: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Each table as CSV files with a header under ``root/<table>``."""

    def export(name: str) -> tuple:
        path, table = f"{root}/{name}", tables[name]

        def write(rows: DataFrame) -> None:
            rows.write.mode("overwrite").options(**CSV).csv(path)

        return _written(name, table.select(*_as_text(table)), path, write)

    return load_summary(_session(tables), side_by_side(export, tables))


def backup_parquet(tables: Mapping[str, DataFrame], root: str, run_at: datetime) -> DataFrame:
    """Append each table under ``root/<table>/year=/month=/day=/run=``.

    An empty table is skipped and one table's failure does not stop the others. The run
    folder is overwritten on a retry, so a repeated run does not duplicate its rows. Rows are
    counted while they are written.
    """
    stamp = run_at.strftime("%Y%m%d_%H%M%S")
    day = f"year={run_at:%Y}/month={run_at:%m}/day={run_at:%d}/run={stamp}"

    def back_up(name: str) -> tuple:
        return _replace(name, tables[name], f"{root}/{name}/{day}")

    return load_summary(_session(tables), side_by_side(back_up, tables))


def clean_for_load(table: DataFrame) -> DataFrame:
    """Warehouse form of a table.

    Names in upper case; timestamps, and any column with ``timestamp`` in its name, as text;
    nested values as JSON text; rows without a single value dropped.
    """
    def cell(f: T.StructField):
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(f.name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        if "timestamp" in f.name.lower():
            return c(f.name).cast("string")
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            return F.to_json(f.name)
        return c(f.name)

    kept = table.na.drop("all")
    return kept.select(*[cell(f).alias(f.name.upper()) for f in table.schema])


def warehouse_refresh(tables: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Replace each stored table by its cleaned rows.

    An empty input, or a write that fails, leaves the stored table as it is: a new version is written
    and counted before readers (``read_refreshed``) are switched to it. One table's failure does not
    stop the others. One refresh of a table runs at a time.
    """

    def refresh(name: str) -> tuple:
        return _switch(name, clean_for_load(tables[name]), f"{root}/{name.upper()}")

    return load_summary(_session(tables), side_by_side(refresh, tables))


def warehouse_refresh_jdbc(table: DataFrame, url: str, name: str, options: dict[str, str]) -> None:
    """Truncate and insert over JDBC, keeping the target's definition and grants."""
    cleaned = clean_for_load(table)
    if cleaned.isEmpty():
        return
    (
        cleaned.write.format("jdbc")
        .option("url", url)
        .option("dbtable", name)
        .option("truncate", True)
        .option("batchsize", 10000)
        .options(**options)
        .mode("overwrite")
        .save()
    )


def verify_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows, ok): does every table answer, and with rows?"""
    counts = [
        table.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).withColumn("ok", c("rows") > 0)


def evolve_schema(stored: DataFrame, target: T.StructType) -> DataFrame:
    """Stored rows under the target schema: missing columns added as NULL, types adjusted.

    Text that does not read as the target type becomes NULL; ``unreadable`` counts it beforehand.
    Columns only the stored table has are kept at the end. Applying it again changes nothing.
    """
    have = {f.name: f.dataType for f in stored.schema}

    def column(f: T.StructField):
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        if have[f.name] == f.dataType:
            return c(f.name)
        return c(f.name).try_cast(f.dataType).alias(f.name)

    known = {f.name for f in target}
    return stored.select(
        *[column(f) for f in target], *[name for name in stored.columns if name not in known]
    )


def unreadable(stored: DataFrame, target: T.StructType) -> DataFrame:
    """(column_name, rows): per column of another type, the values ``evolve_schema`` makes NULL."""
    have = {f.name: f.dataType for f in stored.schema}
    changed = [f for f in target if f.name in have and have[f.name] != f.dataType]
    if not changed:
        return stored.sparkSession.createDataFrame([], "column_name string, rows bigint")
    lost = stored.agg(*[
        F.count_if(c(f.name).isNotNull() & c(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in changed
    ])
    return lost.unpivot([], [f.name for f in changed], "column_name", "rows")


def summary_totals(summary: DataFrame) -> DataFrame:
    """One row over a load summary: tables by outcome, rows and size in all."""
    return summary.agg(
        F.count_if(c("status") == "success").alias("succeeded"),
        F.count_if(c("status") == "skipped").alias("skipped"),
        F.count_if(c("status").startswith("failed")).alias("failed"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.round(F.sum("size_kb"), 1), F.lit(0.0)).alias("size_kb"),
    )


def load_summary(spark: SparkSession, results: list[tuple]) -> DataFrame:
    """One row per table of a load, as (table_name, rows, size_kb, path, status)."""
    return spark.createDataFrame(results, SUMMARY)


def append_logs(logs: DataFrame, path: str) -> None:
    logs.write.mode("append").parquet(path)


def append_diagnoses(rows: DataFrame, path: str, replace_run: bool = False) -> None:
    """Append audit rows, partitioned by day so that recent runs are found without a scan.

    With ``replace_run`` each run has a folder of its own inside its day, and writing a run again
    replaces its rows; for single runs, as a whole history would make a folder of every tick.
    """
    run = F.unix_seconds("run_timestamp").cast("string") if replace_run else F.lit("appended")
    dated = rows.withColumn("run_date", F.to_date("run_timestamp")).withColumn("run", run)
    mode = "overwrite" if replace_run else "append"
    dated.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("run_date", "run").parquet(path)

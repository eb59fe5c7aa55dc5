"""Declarative data tests: unique, not null, accepted values."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from shopvitals.operators.sinks import current_version, switch_readers
from shopvitals.session import discard, side_by_side

c = F.col


@dataclass(frozen=True)
class TableTests:
    layer: str
    table: str
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)


_HEALTH = ("healthy", "warning", "critical")

# The columns each table is tested on.
TESTS = (
    TableTests("raw", "raw_orders", ("order_id",), ("order_id", "customer_id", "order_ts")),
    TableTests("raw", "raw_payments", ("payment_id",), ("payment_id", "order_id", "payment_ts")),
    TableTests("raw", "raw_deliveries", ("delivery_id",), ("delivery_id", "order_id")),
    TableTests(
        "raw", "raw_complaints", ("complaint_id",), ("complaint_id", "order_id", "complaint_ts")
    ),
    TableTests("raw", "raw_refunds", ("refund_id",), ("refund_id", "order_id")),
    TableTests(
        "raw", "ai_pipeline_diagnosis", ("diagnosis_id",), ("diagnosis_id", "run_timestamp")
    ),
    TableTests(
        "staging", "stg_orders", ("order_id",),
        ("order_id", "customer_id", "order_ts", "order_amount", "city"),
    ),
    TableTests(
        "staging", "stg_payments", ("payment_id",),
        ("payment_id", "order_id", "payment_ts", "is_success", "is_failed"),
    ),
    TableTests(
        "staging", "stg_deliveries", ("delivery_id",),
        ("delivery_id", "order_id", "city", "is_delayed"),
    ),
    TableTests(
        "staging", "stg_complaints", ("complaint_id",),
        ("complaint_id", "order_id", "severity_score"),
    ),
    TableTests(
        "staging", "stg_refunds", ("refund_id",), ("refund_id", "order_id", "refund_amount")
    ),
    TableTests(
        "staging", "stg_ai_diagnosis", ("diagnosis_id",),
        ("diagnosis_id", "run_timestamp", "severity", "confidence"),
    ),
    TableTests(
        "marts", "mart_order_summary", (),
        ("order_date", "city", "total_orders", "total_revenue"),
    ),
    TableTests(
        "marts", "mart_payment_health", (), ("payment_date", "payment_method"),
        {"health_status": _HEALTH},
    ),
    TableTests(
        "marts", "mart_delivery_performance", (), ("delivery_date", "city"),
        {"health_status": _HEALTH},
    ),
    TableTests(
        "marts", "mart_complaint_insights", (), ("complaint_date", "total_complaints")
    ),
    TableTests(
        "marts", "mart_ai_diagnosis_summary", ("run_date",),
        ("run_date", "pipeline_health_score"),
    ),
    TableTests(
        "marts", "mart_business_health_daily", ("business_date",), ("business_date",),
        {"overall_status": ("healthy", "degraded", "critical")},
    ),
)


def dq_unique(table: DataFrame, column: str) -> DataFrame:
    """Number of values that occur more than once; NULLs do not count.

    Groups on the column alone, so the scan reads nothing else; a value that repeats a lot is
    counted before the shuffle.
    """
    return (
        table.where(c(column).isNotNull())
        .groupBy(column)
        .count()
        .agg(F.count_if(c("count") > 1).alias("failures"))
        .select(F.lit(column).alias("column_name"), F.lit("unique").alias("test"), "failures")
    )


def _row_tests(
    table: DataFrame, tests: list[tuple[str, str, object]], unique: str | None = None
) -> DataFrame:
    """Tests that look at one row at a time, all in one pass without a shuffle of rows.

    With ``unique`` the failures are counted per value of that column first, so one scan serves
    its uniqueness too; what is shuffled is a row of counts per value.
    """
    if not tests and unique is None:
        raise ValueError("no tests given")
    failed = [F.count_if(failing).alias(f"t{i}") for i, (_, _, failing) in enumerate(tests)]
    if unique is None:
        counts = table.agg(*failed)
    else:
        per_value = table.groupBy(c(unique).alias("_value")).agg(F.count("*").alias("_n"), *failed)
        counts = per_value.agg(
            *[F.coalesce(F.sum(f"t{i}"), F.lit(0)).alias(f"t{i}") for i in range(len(tests))],
            F.count_if(c("_value").isNotNull() & (c("_n") > 1)).alias(f"t{len(tests)}"),
        )
        tests = [*tests, (unique, "unique", None)]
    rows = F.array(
        *[
            F.struct(
                F.lit(column).alias("column_name"),
                F.lit(test).alias("test"),
                c(f"t{i}").alias("failures"),
            )
            for i, (column, test, _) in enumerate(tests)
        ]
    )
    return counts.select(F.inline(rows))


def dq_not_null(table: DataFrame, columns: Iterable[str]) -> DataFrame:
    return _row_tests(table, [(name, "not_null", c(name).isNull()) for name in columns])


def dq_accepted_values(table: DataFrame, accepted: dict[str, tuple[str, ...]]) -> DataFrame:
    """Rows outside the set; NULL is not judged."""
    return _row_tests(
        table,
        [(name, "accepted_values", ~c(name).isin(*values)) for name, values in accepted.items()],
    )


def _tests_of_rows(tests: TableTests) -> list[tuple[str, str, object]]:
    return [(name, "not_null", c(name).isNull()) for name in tests.not_null] + [
        (name, "accepted_values", ~c(name).isin(*values))
        for name, values in tests.accepted.items()
    ]


def dq_table(table: DataFrame, tests: TableTests) -> DataFrame:
    row_tests = _tests_of_rows(tests)
    first, others = tests.unique[:1], tests.unique[1:]
    parts = [_row_tests(table, row_tests, *first)] + [dq_unique(table, name) for name in others]
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(tests.layer).alias("layer"),
        F.lit(tests.table).alias("table_name"),
        "column_name",
        "test",
        "failures",
        (c("failures") == 0).alias("passed"),
    )


def dq_report(tables: dict[str, DataFrame]) -> DataFrame:
    """All tests of the tables given: one row per test, with the number of failures."""
    return reduce(
        DataFrame.unionByName,
        [dq_table(tables[tests.table], tests) for tests in TESTS if tests.table in tables],
    )


REPORT = (
    "layer string, table_name string, column_name string, test string, failures bigint, passed boolean, published boolean"
)


def count_repeated(table: DataFrame, column: str) -> int:
    """The failures ``dq_unique`` finds, counted at once.

    Equal texts have equal hashes, so a column of which no hash repeats has no value that does; what is
    shuffled then is eight bytes per value. Only if one repeats are the values themselves counted.
    """
    if table.schema[column].dataType == T.StringType():
        hashes = table.select(F.when(c(column).isNotNull(), F.xxhash64(column)).alias("_hash"))
        if not dq_unique(hashes, "_hash").first()["failures"]:
            return 0
    return dq_unique(table, column).first()["failures"]


def publish_tested(
    tables: Mapping[str, DataFrame],
    root: str,
    derived: Mapping[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] | None = None,
) -> DataFrame:
    """Write the tables given, test them on the way, and let readers see those that pass all their tests.

    The tests of rows are counted while a table is written, so it is computed and read once; uniqueness is
    tested on the one column of what was written. A table that fails a test stays as readers have it
    (``sinks.read_refreshed``), and its new version is removed. The report is that of ``dq_report`` with
    ``published``. One publication of a table runs at a time.

    ``derived`` names tables by how they are built and from which others, inputs first (``warehouse.MARTS``).
    They are built from what was written of their inputs, which is not computed again for each of them, and
    from that of an input that fails a test too: its new version goes when nothing reads it any more.
    """
    derived, spark = derived or {}, next(iter(tables.values())).sparkSession
    tested = {tests.table: tests for tests in TESTS if tests.table in tables or tests.table in derived}
    step = dict.fromkeys(tables, 0)
    for name, (_, inputs) in derived.items():
        step[name] = 1 + max(step[i] for i in inputs)
    frames, folders, versions, found, refused = dict(tables), {}, {}, {}, []

    def write(name: str) -> None:
        if name in derived:
            build, inputs = derived[name]
            frames[name] = build(*[frames[i] for i in inputs])
        if name not in tested:
            return
        table, path = frames[name], f"{root}/{name}"
        versions[name] = current_version(spark, path) + 1
        folders[name], counted = f"{path}/versions/{versions[name]}", Observation(f"tests of {name}")
        row_tests = _tests_of_rows(tested[name])
        failed = [F.count_if(failing).alias(f"t{i}") for i, (_, _, failing) in enumerate(row_tests)]
        table.observe(counted, F.count("*").alias("rows"), *failed).write.mode("overwrite").parquet(folders[name])
        frames[name] = spark.read.schema(table.schema).parquet(folders[name])
        found[name] = counted.get["rows"], [(column, test, counted.get[f"t{i}"]) for i, (column, test, _) in enumerate(row_tests)]

    def judge(name: str) -> list[tuple]:
        tests, (rows, results) = tested[name], found[name]
        results = results + [(column, "unique", count_repeated(frames[name], column)) for column in tests.unique]
        good = not any(failures for _, _, failures in results)
        if good:
            switch_readers(spark, f"{root}/{name}", versions[name], rows)
        else:
            refused.append(folders[name])
        return [(tests.layer, name, *result, result[2] == 0, good) for result in results]

    # Tables are tested beside the writing of those built from them.
    report = []
    try:
        for now in range(max(step.values()) + 2):
            jobs = [(write, name) for name in step if step[name] == now]
            jobs += [(judge, name) for name in step if step[name] == now - 1 and name in tested]
            done = side_by_side(lambda job: job[0](job[1]), jobs)
            report += [row for rows in done if rows for row in rows]
    finally:
        for folder in refused:
            discard(spark, folder)
    return spark.createDataFrame(report, REPORT)

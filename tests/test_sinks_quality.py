import os
from datetime import datetime

from pyspark.sql import functions as F

from shopvitals import schemas
from shopvitals.operators import quality, sinks
from shopvitals.session import materialize, shared_dir
from shopvitals.sources.tables import scan_backup, scan_parquet

RUN = datetime(2024, 2, 1, 6, 30)


def orders(rows, n=3):
    return rows(
        [(f"o{i}", "c", None, "2024-01-01 00:00:00", "1.50", 'a "quoted", value', None) for i in range(n)],
        "order_id string, customer_id string, city string, order_ts timestamp, "
        "order_amount decimal(18,2), order_status string, created_at timestamp",
    )


class Broken:
    """A table whose scan fails."""

    def __new__(cls, spark):
        return spark.range(1).select(F.raise_error(F.lit("disk gone")).alias("x"))


def test_backup_skips_empty_tables_and_survives_a_broken_one(rows, spark, tmp_path):
    tables = {"raw_orders": orders(rows), "empty": orders(rows, 0), "broken": Broken(spark), "last": orders(rows, 2)}
    summary = {r["table_name"]: r for r in sinks.backup_parquet(tables, str(tmp_path), RUN).collect()}
    assert summary["raw_orders"]["rows"] == 3 and summary["raw_orders"]["size_kb"] > 0
    assert summary["empty"]["status"] == "skipped" and not os.path.exists(tmp_path / "empty")
    assert summary["broken"]["status"].startswith("failed")
    assert summary["last"]["rows"] == 2
    assert os.path.isdir(tmp_path / "raw_orders/year=2024/month=02/day=01")


def test_repeated_backup_run_does_not_duplicate(rows, spark, tmp_path):
    for _ in range(2):
        sinks.backup_parquet({"raw_orders": orders(rows)}, str(tmp_path), RUN)
    sinks.backup_parquet({"raw_orders": orders(rows)}, str(tmp_path), datetime(2024, 2, 2))
    assert scan_backup(spark, str(tmp_path), "raw_orders").count() == 6
    day = scan_backup(spark, str(tmp_path), "raw_orders", "2024-02-01")
    assert day.count() == 3
    assert "PartitionFilters: [isnotnull(year" in day._jdf.queryExecution().toString()


def test_refresh_replaces_but_never_empties(rows, spark, tmp_path):
    root = str(tmp_path)
    sinks.warehouse_refresh({"raw_orders": orders(rows)}, root)
    sinks.warehouse_refresh({"raw_orders": orders(rows, 2)}, root)
    (row,) = sinks.warehouse_refresh({"raw_orders": orders(rows, 0)}, root).collect()
    assert row["status"] == "skipped"
    (row,) = sinks.warehouse_refresh({"raw_orders": orders(rows).crossJoin(Broken(spark))}, root).collect()
    assert row["status"].startswith("failed")
    stored = sinks.read_refreshed(spark, f"{root}/RAW_ORDERS")
    assert stored.count() == 2 and stored.columns[0] == "ORDER_ID"
    assert stored.first()["ORDER_TS"] == "2024-01-01 00:00:00.000000"


def test_refresh_keeps_the_current_and_the_previous_version(rows, spark, tmp_path):
    for n in (1, 2, 3):
        sinks.warehouse_refresh({"t": orders(rows, n)}, str(tmp_path))
    assert sorted(os.listdir(tmp_path / "T/versions")) == ["2", "3"]
    assert sinks.read_refreshed(spark, f"{tmp_path}/T").count() == 3


def test_values_lost_to_a_new_type_are_counted(rows):
    old = rows([("1", "x"), ("a", None), (None, "2")], "diagnosis_id string, severity string")
    assert {tuple(r) for r in sinks.unreadable(old, schemas.DIAGNOSES).collect()} == {("diagnosis_id", 1), ("severity", 1)}
    assert sinks.unreadable(rows([], "status string"), schemas.DIAGNOSES).count() == 0


def test_totals_of_a_load(rows, spark, tmp_path):
    summary = sinks.warehouse_refresh({"a": orders(rows), "b": orders(rows, 0), "c": Broken(spark)}, str(tmp_path))
    total = sinks.summary_totals(summary).first()
    assert (total["succeeded"], total["skipped"], total["failed"], total["rows"]) == (1, 1, 1, 3)


def test_clean_for_load(rows):
    raw = rows(
        [(None, None, None), (None, "x", 5)],
        "tags array<string>, name string, timestamp_note int",
    )
    (row,) = sinks.clean_for_load(raw).collect()
    assert row.asDict() == {"TAGS": None, "NAME": "x", "TIMESTAMP_NOTE": "5"}


def test_csv_round_trip(rows, spark, tmp_path):
    table = orders(rows).withColumn("tags", F.array(F.lit("a"), F.lit("b")))
    (row,) = sinks.export_csv({"raw_orders": table}, str(tmp_path)).collect()
    assert row["rows"] == 3
    back = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/raw_orders")
    first = back.orderBy("order_id").first()
    assert first["order_status"] == 'a "quoted", value' and first["tags"] == '["a","b"]'


def test_schema_evolution_is_repeatable(rows):
    old = rows(
        [(1, "degraded", "text", "0.5"), (2, "degraded", "text", "high")],
        "diagnosis_id bigint, status string, issue_summary string, severity string",
    ).withColumn("legacy", F.lit("kept"))
    once = sinks.evolve_schema(old, schemas.DIAGNOSES)
    twice = sinks.evolve_schema(once, schemas.DIAGNOSES)
    assert once.schema == twice.schema
    assert [f.name for f in schemas.DIAGNOSES] == once.columns[:-1]
    assert [r["severity"] for r in twice.orderBy("diagnosis_id").collect()] == [0.5, None]
    assert once.first()["legacy"] == "kept"


def test_verify_counts(rows):
    got = {r["table_name"]: r["ok"] for r in sinks.verify_counts({"a": orders(rows), "b": orders(rows, 0)}).collect()}
    assert got == {"a": True, "b": False}


def test_appends(rows, spark, tmp_path):
    audit = spark.createDataFrame([], schemas.DIAGNOSES)
    for _ in range(2):
        sinks.append_diagnoses(audit.union(spark.sql(
            "SELECT 1L, TIMESTAMP '2024-01-01 10:00:00', 's', 0D, 0D, '', '', '', '', '', array(''), "
            "'', '', '', '', '', 1, '', NULL, NULL")), f"{tmp_path}/audit")
        sinks.append_logs(spark.createDataFrame([], schemas.PIPELINE_LOGS), f"{tmp_path}/logs")
    assert spark.read.parquet(f"{tmp_path}/audit").where("run_date = '2024-01-01'").count() == 2
    assert spark.read.parquet(f"{tmp_path}/logs").count() == 0


def test_zoneless_times_are_read_as_instants(spark, tmp_path):
    spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 10:00:00' AS ts").write.parquet(f"{tmp_path}/t")
    read = scan_parquet(spark, f"{tmp_path}/t")
    assert read.dtypes == [("ts", "timestamp")]
    assert read.select(F.unix_seconds("ts")).first()[0] == 1704103200


def test_materialized_tables_lie_in_the_shared_folder(spark):
    frame = materialize(spark.range(5), "numbers")
    root = spark.conf.get("spark.checkpoint.dir")
    assert frame.count() == 5 and root in frame.inputFiles()[0]
    assert shared_dir(spark, "x") != shared_dir(spark, "x")


def test_unique_ignores_nulls_and_counts_values(rows):
    table = rows([("a",), ("a",), ("a",), ("b",), ("c",), ("c",), (None,), (None,)], "k string")
    assert quality.dq_unique(table, "k").first()["failures"] == 2
    assert quality.dq_not_null(table, ["k"]).first()["failures"] == 2
    assert quality.dq_accepted_values(table, {"k": ("a", "b")}).first()["failures"] == 2


def test_there_are_69_tests():
    counts = {}
    for t in quality.TESTS:
        layer = counts.setdefault(t.layer, [0, 0, 0])
        layer[0] += len(t.unique)
        layer[1] += len(t.not_null)
        layer[2] += len(t.accepted)
    assert counts == {"raw": [6, 15, 0], "staging": [6, 24, 0], "marts": [2, 13, 3]}
    assert sum(map(sum, counts.values())) == 69


def test_a_failing_test_stops_the_switch(rows, spark, tmp_path):
    schema = "order_id string, customer_id string, order_ts timestamp, order_amount decimal(10,2), city string"
    at = "2024-01-01 10:00:00"
    good = rows([("o1", "c1", at, "1.00", "x"), ("o2", "c1", at, "2.00", "x")], schema)
    runs = [
        (good, True, 2), (rows([("o1", None, at, "1.00", "x")], schema), False, 2),
        (rows([("o1", "c", at, "1.00", "x"), ("o1", "c", at, "1.00", "x")], schema), False, 2),
        (rows([("o3", "c", at, "1.00", "x")], schema), True, 1), (rows([], schema), True, 0),
    ]
    path = f"{tmp_path}/stg_orders"
    for table, published, seen in runs:
        report = quality.publish_tested({"stg_orders": table}, str(tmp_path))
        assert report.select("published").distinct().collect() == [(published,)]
        assert report.drop("published").exceptAll(quality.dq_report({"stg_orders": table})).isEmpty() and report.count() == 6
        assert sinks.read_refreshed(spark, path).count() == seen
    assert sorted(p.name for p in (tmp_path / "stg_orders/versions").iterdir() if p.is_dir()) == ["2", "3"]


def test_sums_for_comparison_form_no_texts_and_find_what_changed(rows, spark):
    schema = "k string, n int, at timestamp, tags array<string>"
    one = [("a", 1, "2024-01-01 10:00:00", ["x"]), ("b", None, None, None), ("b", None, None, None)]
    frame = rows(one, schema)

    def sums(values):
        return rows(values, schema).agg(*sinks.content_sums(frame)).first()

    plan = frame.agg(*sinks.content_sums(frame))._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan and "conv(" not in plan and "decimal" not in plan
    assert sums(one) == sums(one[::-1]) and sums(one)["n_1"] == 3
    traded = [("b", 1, "2024-01-01 10:00:00", ["x"]), ("a", None, None, None), ("b", None, None, None)]
    assert sums(traded)["a_1"] == sums(one)["a_1"] and sums(traded)["a_0"] != sums(one)["a_0"]
    assert sums(one[:2])["a_0"] != sums(one)["a_0"]
    got = sinks.verify_content({"t": frame}, {"t": sinks.clean_for_load(rows(traded, schema))}).collect()
    assert {row["column_name"]: row["ok"] for row in got} == {"*": False, "k": True, "n": True, "at": True, "tags": True}


def test_digests_are_those_of_any_engine(rows, spark):
    from hashlib import md5

    def digest(*texts):
        return str(sum(int(md5(text.encode()).hexdigest()[:15], 16) for text in texts))

    table = rows([("ä", 1), ("ä", None), (None, None)], "V string, K int")
    content = sinks.content(table)
    got = {row["column_name"]: (row["n_values"], row["digest"]) for row in content.collect()}
    assert got == {
        "*": (3, digest("1\x1fä", "\\N\x1fä", "\\N\x1f\\N")), "V": (2, digest("v=ä", "v=ä")), "K": (1, digest("k=1")),
    }
    assert "md5" not in content._jdf.queryExecution().optimizedPlan().toString()
    empty = {tuple(row) for row in sinks.content(table.limit(0)).collect()}
    assert empty == {("*", 0, None), ("V", 0, None), ("K", 0, None)}


def test_derived_tables_read_what_was_written(rows, spark, tmp_path):
    from shopvitals.plans.warehouse import MARTS

    schema = (
        "order_id string, customer_id string, order_ts timestamp, order_date date, order_amount decimal(10,2), city string,"
        " is_cancelled boolean"
    )
    at = "2024-01-01 10:00:00"
    good = rows([("o1", "c1", at, at[:10], "1.00", "x", False), ("o2", "c1", at, at[:10], "2.00", "x", True)], schema)
    twice = good.unionByName(good)
    build, inputs = MARTS["mart_order_summary"]
    read = []

    def recorded(stg_orders):
        read.append(stg_orders.inputFiles())
        return build(stg_orders)

    for version, (table, published, total) in enumerate([(good, True, 2), (twice, False, 4)], 1):
        report = quality.publish_tested({"stg_orders": table}, str(tmp_path), {"mart_order_summary": (recorded, inputs)})
        assert read[-1] and all(f"{tmp_path}/stg_orders/versions/{version}/" in name for name in read[-1])
        wanted = quality.dq_report({"stg_orders": table, "mart_order_summary": build(table)})
        assert report.drop("published").exceptAll(wanted).isEmpty() and report.count() == wanted.count() == 10
        seen = {(row["table_name"], row["published"]) for row in report.collect()}
        assert seen == {("stg_orders", published), ("mart_order_summary", True)}
        # The mart is that of the new rows, even where readers keep the old ones.
        assert sinks.read_refreshed(spark, f"{tmp_path}/mart_order_summary").first()["total_orders"] == total
        assert sinks.read_refreshed(spark, f"{tmp_path}/stg_orders").count() == 2
    assert [p.name for p in (tmp_path / "stg_orders/versions").iterdir() if p.is_dir()] == ["1"]


def test_repeated_values_are_counted_by_hashes_first(rows, monkeypatch):
    asked = []
    unique = quality.dq_unique
    monkeypatch.setattr(quality, "dq_unique", lambda table, column: asked.append(column) or unique(table, column))
    schema = "k string, n bigint"
    assert quality.count_repeated(rows([("a", 1), ("b", 2), (None, None), (None, None), ("", 0)], schema), "k") == 0
    assert asked == ["_hash"]
    some = rows([("a", 1), ("a", 1), ("a", 2), ("", 3), ("", 3), ("b", 4), (None, None), (None, None)], schema)
    assert quality.count_repeated(some, "k") == 2 and asked == ["_hash", "_hash", "k"]
    assert quality.count_repeated(some, "n") == 2 and asked[3:] == ["n"]

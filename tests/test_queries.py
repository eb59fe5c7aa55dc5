"""Every registered query against its SQL, and the shape of the plans."""

import decimal

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from registry.inputs import Inputs
from registry.oracles import ORACLES
from registry.queries import QUERIES
from shopvitals.operators import features, ingest
from shopvitals.plans import monitor
from tests.conftest import TESTDATA

duckdb = pytest.importorskip("duckdb")

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, (int, decimal.Decimal)) and not isinstance(value, bool):
        return float(value)
    return value


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(type(v)), 0 if v is None else v) for v in r])


def test_every_query_has_its_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_all_columns_of_the_raw_tables_are_tested_for_null(spark):
    inputs = Inputs(spark, TESTDATA)
    tested = [queries()[name](spark, TESTDATA) for name in queries() if name.startswith("dq_not_null")]
    got = sorted((r.table_name, r.column_name) for frame in tested for r in frame.collect())
    assert got == sorted((name, column) for name, table in inputs.raw("a").items() for column in table.columns)


def test_entry(spark):
    assert entry(spark).count() > 0


UNWANTED = ("CartesianProduct", "NestedLoopJoin", "EvalPython", "PythonUDF", "InPandas")


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(name, spark, sql):
    """Same rows as the SQL, with a plan that joins on keys and stays in the JVM."""
    got = QUERIES[name](spark, TESTDATA)
    assert not [word for word in UNWANTED if word in plan_of(got)]
    columns = sorted(got.columns)
    cursor = sql.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    expected = ordered(tuple(plain(row[i]) for i in places) for row in cursor.fetchall())
    assert ordered(tuple(plain(row[c]) for c in columns) for row in got.collect()) == expected


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_time_filter_and_columns_reach_the_scan(spark):
    inputs = Inputs(spark, TESTDATA)
    plan = plan_of(features.feat_orders(inputs.view("b_raw_orders"), as_of="2024-01-15 12:00:00"))
    assert "GreaterThanOrEqual(ts,2024-01-15 11:30:00.0)" in plan
    assert "ReadSchema: struct<ts:timestamp>" in plan


def test_daily_health_has_one_exchange_above_the_marts(spark, rows):
    from shopvitals.operators import marts

    order = rows([], "order_date date, city string, total_orders bigint, total_revenue decimal(20,2), "
                     "avg_order_value decimal(20,2), cancellation_rate double")
    pay = rows([], "payment_date date, total_payments bigint, failed_payments bigint, failure_rate double, success_rate double")
    dels = rows([], "delivery_date date, total_deliveries bigint, delay_rate double, on_time_rate double, avg_delay_minutes double")
    comp = rows([], "complaint_date date, total_complaints bigint, severe_rate double")
    frame = marts.mart_business_health_daily(order, pay, dels, comp)
    plan = frame._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan


def test_cells_shuffle_each_row_set_once(spark):
    raw = Inputs(spark, TESTDATA).raw("b", *monitor.MONITORED)
    plan = plan_of(features.cells(features.activity(*[raw[n] for n in monitor.MONITORED])))
    assert plan.count("Exchange") == 1


def test_a_batch_is_what_meets_the_stored_keys(spark):
    inputs = Inputs(spark, TESTDATA)
    stored = inputs.view("b_raw_orders")
    plan = ingest.ingest_orders(inputs.messages, existing=stored)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "LeftAnti" in plan

import math
import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from registry.inputs import Inputs
from shopvitals.config import MonitorConfig
from shopvitals.operators import anomalies, diagnosis, features
from shopvitals.plans import monitor
from tests.conftest import TESTDATA

RAW_PAYMENTS = (
    "payment_id string, order_id string, payment_ts timestamp, payment_method string, "
    "payment_status string, amount decimal(18,2), failure_reason string, created_at timestamp"
)
RAW_ORDERS = (
    "order_id string, customer_id string, city string, order_ts timestamp, "
    "order_amount decimal(18,2), order_status string, created_at timestamp"
)
RAW_DELIVERIES = (
    "delivery_id string, order_id string, city string, delivery_partner string, "
    "promised_minutes int, actual_minutes int, delivery_status string, created_at timestamp"
)
RAW_COMPLAINTS = (
    "complaint_id string, order_id string, complaint_ts timestamp, ai_category string, ai_severity string"
)
START = datetime(2024, 3, 1)


@pytest.fixture
def raw(rows):
    """Uneven activity over two and a half days, with quiet stretches and odd values."""
    rng = random.Random(7)
    moments = sorted(
        START + timedelta(minutes=rng.uniform(0, 60 * 60) if rng.random() < 0.7 else rng.uniform(0, 300))
        for _ in range(600)
    )
    text = [str(m) for m in moments]
    cities = ["Pune", "Delhi", "Mumbai", "Chennai", "Kolkata", "Hyderabad", "Rourkela", None]
    orders = [
        (f"o{i}", "c", rng.choice(cities), t, str(rng.randint(1, 999)), rng.choice(["created", "cancelled", "failed", None]), t)
        for i, t in enumerate(text)
    ]
    pays = [
        (f"p{i}", "o", t, "UPI", s, "1", rng.choice(["a", "b", None]) if s == "failed" else None, t)
        for i, t in enumerate(text)
        for s in [rng.choice(["failed", "success", "success", "pending"])]
    ]
    dels = [
        (f"d{i}", "o", rng.choice(cities), "x", rng.choice([30, None]), rng.choice([20, 31, 50, None]), "s", t)
        for i, t in enumerate(text)
    ]
    comps = [
        (f"k{i}", "o", t, rng.choice(["late", "app", None]), rng.choice(["high", "critical", "low", None]))
        for i, t in enumerate(text[::3])
    ]
    return {
        "raw_orders": rows(orders, RAW_ORDERS),
        "raw_payments": rows(pays, RAW_PAYMENTS),
        "raw_deliveries": rows(dels, RAW_DELIVERIES),
        "raw_complaints": rows(comps, RAW_COMPLAINTS),
    }


def as_rows(frame, ts):
    return [r.asDict() for r in frame.withColumn("at", F.col(ts).cast("timestamp_ntz")).collect()]


def test_replay_against_brute_force(raw):
    pays, dels = as_rows(raw["raw_payments"], "payment_ts"), as_rows(raw["raw_deliveries"], "created_at")
    orders, comps = as_rows(raw["raw_orders"], "order_ts"), as_rows(raw["raw_complaints"], "complaint_ts")
    dels = [d for d in dels if d["promised_minutes"] is not None and d["actual_minutes"] is not None]
    reports = monitor.reports_replay(monitor.history_cells(raw)).withColumn(
        "at", F.col("run_timestamp").cast("timestamp_ntz")
    )
    got = {r["at"]: r for r in reports.collect()}
    first, last = min(o["at"] for o in orders), max(o["at"] for o in orders)
    quarter = lambda t: t.replace(minute=t.minute // 15 * 15, second=0, microsecond=0)
    runs, run = [], quarter(first) + timedelta(minutes=15)
    while run <= quarter(last) + timedelta(minutes=15):
        runs.append(run)
        run += timedelta(minutes=15)
    assert sorted(got) == runs

    def rate(rows, hit):
        return sum(map(hit, rows)) / len(rows) if rows else 0.0

    metrics = {
        "payment_failure_rate": (pays, lambda p: p["payment_status"] == "failed"),
        "delivery_delay_rate": (dels, lambda d: d["actual_minutes"] > d["promised_minutes"]),
        "complaint_severe_rate": (comps, lambda k: k["ai_severity"] in ("high", "critical")),
        "order_volume": (orders, None),
    }
    for run in runs:
        near = lambda rs: [r for r in rs if run - timedelta(minutes=30) <= r["at"] < run]
        f = got[run]["features"]
        assert f["volume"]["orders"] == len(near(orders))
        assert f["volume"]["revenue"] == sum(
            float(o["order_amount"]) for o in near(orders) if o["order_status"] == "created"
        )
        counts = {}
        for o in near(orders):
            if o["city"]:
                counts[o["city"]] = counts.get(o["city"], 0) + 1
        top = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
        assert [(e["city"], e["cnt"]) for e in f["volume"]["top_order_cities"]] == top
        assert f["payments"]["failure_rate"] == pytest.approx(rate(near(pays), metrics["payment_failure_rate"][1]), abs=5.01e-5)
        assert f["complaints"]["severe_rate"] == pytest.approx(rate(near(comps), metrics["complaint_severe_rate"][1]), abs=5.01e-5)
        delays = [d["actual_minutes"] - d["promised_minutes"] for d in near(dels)]
        assert f["deliveries"]["avg_delay_minutes"] == pytest.approx(statistics.mean(delays) if delays else 0, abs=0.0501)

        expected = {}
        for metric, (events, hit) in metrics.items():
            buckets = {}
            for e in events:
                if run - timedelta(hours=24) <= e["at"] < run:
                    half = e["at"].replace(minute=e["at"].minute // 30 * 30, second=0, microsecond=0)
                    buckets.setdefault(half, []).append(e)
            values = [float(len(b)) if hit is None else rate(b, hit) for b in buckets.values()]
            if len(values) < 2 or statistics.stdev(values) == 0:
                continue
            now = {
                "payment_failure_rate": f["payments"]["failure_rate"],
                "delivery_delay_rate": f["deliveries"]["delay_rate"],
                "complaint_severe_rate": f["complaints"]["severe_rate"],
                "order_volume": f["volume"]["orders"],
            }[metric]
            z = (now - statistics.mean(values)) / statistics.stdev(values)
            if abs(z) >= 2.5:
                expected[metric] = z
        found = {a["metric"]: a["z_score"] for a in got[run]["report"]["anomalies"]}
        assert set(found) == set(expected)
        for metric, z in expected.items():
            assert found[metric] == pytest.approx(z, abs=0.0051)
        assert got[run]["report"]["anomaly_count"] == len(expected)


def test_live_run_equals_replay(raw):
    run = "2024-03-02 06:15:00"
    rows = features.activity(*[raw[n] for n in monitor.MONITORED])
    (live,) = monitor.reports_as_of(rows, as_of=run).collect()
    replayed = monitor.reports_replay(monitor.history_cells(raw)).where(
        F.col("run_timestamp") == F.lit(run).cast("timestamp")
    )
    assert live == replayed.collect()[0]
    (orders,) = features.feat_orders(raw["raw_orders"], as_of=run).collect()
    assert orders["orders"] == live["features"]["volume"]["orders"]
    (pay,) = features.feat_payments(raw["raw_payments"], as_of=run).collect()
    assert pay["failure_rate"] == live["features"]["payments"]["failure_rate"]
    (dels,) = features.feat_deliveries(raw["raw_deliveries"], as_of=run).collect()
    assert dels["avg_delay_minutes"] == live["features"]["deliveries"]["avg_delay_minutes"]
    (comp,) = features.feat_complaints(raw["raw_complaints"], as_of=run).collect()
    assert comp["severe"] == live["features"]["complaints"]["severe"]
    tops = features.feat_top_cities(raw["raw_orders"], as_of=run).collect()
    assert [tuple(t) for t in tops] == [tuple(e) for e in live["features"]["volume"]["top_order_cities"]]


def test_empty_window(raw, spark):
    rows = features.activity(*[raw[n] for n in monitor.MONITORED])
    (report,) = monitor.reports_as_of(rows, as_of="2030-01-01 00:00:00").collect()
    f = report["features"]
    assert f["volume"]["orders"] == 0 and f["volume"]["revenue"] == 0.0
    assert f["payments"]["failure_rate"] == 0.0 and f["payments"]["top_failure_reasons"] == []
    assert report["report"]["anomaly_count"] == 0 and report["report"]["max_severity"] == 0.0
    (now,) = features.features_as_of(rows).collect()
    assert now["features"]["window_minutes"] == 30 and now["features"]["volume"]["orders"] == 0


def test_minutes_missing_from_deliveries_are_left_out(rows):
    raw = rows([("d", "o", "X", "p", None, 40, "s", "2024-03-01 00:00:00")], RAW_DELIVERIES)
    (got,) = features.feat_deliveries(raw, as_of="2024-03-01 00:10:00").collect()
    assert got["total"] == 0 and got["delay_rate"] == 0.0


def test_windows_off_the_grid_are_refused():
    with pytest.raises(ValueError):
        MonitorConfig(window_minutes=20).window_cells


FEATURES = (
    "run_timestamp timestamp, features struct<window_minutes:int,"
    "volume:struct<orders:bigint,revenue:double>,payments:struct<failure_rate:double>,"
    "deliveries:struct<delay_rate:double>,complaints:struct<severe_rate:double>>"
)


def snapshot_of(spark, orders=5, pay=0.0, delay=0.0, severe=0.0):
    return spark.sql(
        f"""SELECT TIMESTAMP '2024-03-01 00:00:00' AS run_timestamp, named_struct(
              'window_minutes', 30, 'volume', named_struct('orders', {orders}L, 'revenue', 0D),
              'payments', named_struct('failure_rate', {pay}D),
              'deliveries', named_struct('delay_rate', {delay}D),
              'complaints', named_struct('severe_rate', {severe}D)) AS features"""
    )


def baseline(spark, metric, mean, std):
    stats = {m: "CAST(NULL AS struct<mean:double,std:double>)" for m, _, _ in anomalies.METRICS}
    stats[metric] = f"named_struct('mean', {mean}D, 'std', {std}D)"
    columns = ", ".join(f"{sql} AS {name}" for name, sql in stats.items())
    return spark.sql(f"SELECT TIMESTAMP '2024-03-01 00:00:00' AS run_timestamp, {columns}")


def test_exactly_two_and_a_half_deviations_is_an_anomaly(spark):
    reports = anomalies.anomaly_report(
        snapshot_of(spark, orders=10), baseline(spark, "order_volume", 5, 2)
    )
    (row,) = anomalies.anomalies(reports).collect()
    assert (row["z_score"], row["severity"], row["direction"]) == (2.5, 0.5, "spike")


def test_no_spread_no_anomaly(spark):
    reports = anomalies.anomaly_report(
        snapshot_of(spark, orders=10), baseline(spark, "order_volume", 5, 0)
    )
    assert anomalies.anomalies(reports).isEmpty()


def test_one_bucket_has_no_spread(rows):
    buckets = rows(
        [("2024-03-01 00:30:00", "orders", "2024-03-01 00:00:00", 4.0)],
        "run_timestamp timestamp, domain string, bucket timestamp, value double",
    )
    (row,) = anomalies.baseline_stats(buckets).collect()
    assert (row["metric"], row["mean"], row["std"]) == ("order_volume", 4.0, 0.0)


@pytest.mark.parametrize(
    "values, status, severity, tags",
    [
        (dict(pay=0.2, delay=0.25, severe=0.3), "healthy", 0.0, ["rule_based"]),
        (dict(pay=0.2001), "critical", 0.7, ["rule_based", "payment"]),
        (dict(delay=0.26, severe=0.31), "degraded", 0.6, ["rule_based", "delivery", "complaints"]),
        (dict(orders=0), "degraded", 0.5, ["rule_based", "volume"]),
    ],
)
def test_rules(spark, values, status, severity, tags):
    reports = anomalies.anomaly_report(
        snapshot_of(spark, **values), baseline(spark, "order_volume", 5, 0)
    )
    (row,) = diagnosis.rule_diagnosis(reports).collect()
    rule = row["rule"]
    assert (rule["status"], rule["severity"], rule["tags"]) == (status, severity, tags)
    gated = diagnosis.llm_gate(diagnosis.rule_diagnosis(reports)).collect()[0]
    assert gated["escalate"] is (severity >= 0.7)
    off = diagnosis.llm_gate(diagnosis.rule_diagnosis(reports), MonitorConfig(model_configured=False))
    assert off.collect()[0]["escalate"] is False


def test_summary_text(spark):
    reports = anomalies.anomaly_report(
        snapshot_of(spark, pay=0.2238, orders=0), baseline(spark, "order_volume", 10, 2)
    )
    (row,) = diagnosis.rule_diagnosis(reports).collect()
    assert row["rule"]["issue_summary"] == (
        "payment failure rate 22.4%; 1 statistical anomalies; no orders in current window"
    )
    assert row["rule"]["severity"] == 1.0


def test_fallback_rows(rows):
    broken = rows(
        [("2024-03-01 00:00:00", 3, 0.25, False), ("2024-03-01 00:15:00", None, None, True)],
        "run_timestamp timestamp, orders_count bigint, failure_rate double, lost_audit boolean",
    )
    full, emergency = diagnosis.dag_fallback_rows(broken).orderBy("run_timestamp").collect()
    assert full["issue_summary"] == "AI unavailable. orders=3, failure_rate=0.25"
    assert (full["severity"], full["confidence"], full["tags"]) == (0.5, 0.3, ["dag_fallback"])
    assert emergency["issue_summary"] == "Total fallback. orders=None, failure_rate=None"
    assert emergency["severity"] is None and emergency["source"] == "dag_emergency_fallback"


def test_success_and_failure_stay_within_total(spark):
    snapshots = features.features_replay(Inputs(spark, TESTDATA).cells())
    wrong = snapshots.where("features.payments.failed + features.payments.success > features.payments.total")
    assert wrong.isEmpty()
    assert math.isclose(snapshots.agg(F.max("features.payments.failure_rate")).first()[0], 1.0)


def test_scheduled_runs_append_and_never_pass_silently(raw, spark, tmp_path):
    audit = str(tmp_path / "audit")
    rows = features.activity(*[raw[n] for n in monitor.MONITORED])
    # A run that alerts, and the same finding ten minutes later.
    decided = monitor.replay(raw).where("alerted_at is not null").orderBy("run_timestamp").first()
    at = spark.createDataFrame([(decided["run_timestamp"],)], "t timestamp").select(F.col("t").cast("string")).first()[0]
    for _ in range(2):  # the first run has no history, the second is a retry that replaces its row
        monitor.run_once(raw, audit, as_of=at)
        (row,) = spark.read.parquet(audit).collect()
        assert row["alerted_at"] is not None and row["source"] == decided["source"]
    later = str(datetime.fromisoformat(at) + timedelta(minutes=10))
    monitor.run_once(raw, audit, as_of=later)
    (row,) = spark.read.parquet(audit).where(f"run_timestamp = '{later}'").collect()
    assert row["alerted_at"] is None
    plan = monitor.recent_alerts(spark, audit, at)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan

    broken = {**raw, "raw_complaints": raw["raw_complaints"].withColumn(
        "ai_severity", F.raise_error(F.lit("gone")).cast("string"))}
    monitor.run_once(broken, audit, as_of="2024-03-01 02:00:00")
    last = spark.read.parquet(audit).where("source like 'dag%'").collect()
    assert len(last) == 1 and last[0]["status"] in ("degraded", "warning")
    probes = monitor.probes_as_of(rows, MonitorConfig(), "2024-03-01 02:00:00").first()
    assert probes["orders_count"] > 0 and 0 <= probes["failure_rate"] <= 1


def test_a_single_run_joins_on_equality(raw):
    rows = features.activity(*[raw[n] for n in monitor.MONITORED])
    for as_of in ("2024-03-01 02:00:00", None):
        plan = monitor.reports_as_of(rows, as_of=as_of)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_quiet_days_are_left_out_and_bounds_hold(rows):
    from shopvitals.operators.features import ticks

    day = 96
    cells = [5, 7, 3 * day + 10, 280_000_000]  # the last is far in the future
    frame = rows([(x,) for x in cells], "cell bigint")
    got = sorted(r["n"] for r in ticks(frame).select((F.unix_seconds("run_timestamp") / 900).cast("bigint").alias("n")).collect())
    busy = {d for x in cells for d in range(x // day, x // day + 3)}
    assert got == [n for n in range(6, 6 * day) if n // day in busy] + [
        n for n in range(280_000_000 // day * day, 280_000_002) if n // day in busy]
    some = ticks(frame, first=20, last=40).select((F.unix_seconds("run_timestamp") / 900).cast("bigint").alias("n")).collect()
    assert sorted(r["n"] for r in some) == list(range(20, 41))
    assert ticks(rows([], "cell bigint")).count() == 0


def test_one_event_far_ahead_does_not_stretch_a_replay(spark):
    inputs = Inputs(spark, TESTDATA)
    cells = inputs.cells()
    plain = features.features_replay(cells)
    far = cells.limit(1).withColumn("cell", F.lit(280_000_000).cast("bigint"))
    stretched = features.features_replay(cells.unionByName(far))
    assert stretched.count() <= plain.count() + 4 * 96
    last = plain.agg(F.max("run_timestamp").alias("t")).first()["t"]
    assert stretched.where(F.col("run_timestamp") <= F.lit(last)).exceptAll(plain).isEmpty()

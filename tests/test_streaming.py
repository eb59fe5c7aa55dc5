import json
import os
import time
from pathlib import Path

from pyspark.sql import functions as F

from registry.inputs import Inputs
from shopvitals import schemas
from shopvitals.operators import decisions
from shopvitals.plans import monitor
from shopvitals.streaming import ingest, windows
from shopvitals.streaming import monitor as stream_monitor
from shopvitals.streaming.sinks import create_table, day_of, read_days, read_table, write_days
from tests.conftest import TESTDATA
from tests.test_decisions import START, candidates, greedy
from tests.test_ingest import AT, MESSAGES, order


def in_time_parts(frame, column, folder, parts):
    """Files of consecutive stretches of time, in the order a stream picks them up."""
    bounds = frame.approxQuantile("_t", [i / parts for i in range(1, parts)], 0.0)
    edges = [None, *bounds, None]
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        part = frame
        if low is not None:
            part = part.where(F.col("_t") >= low)
        if high is not None:
            part = part.where(F.col("_t") < high)
        part.drop("_t").coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)  # the file source orders by modification time


def stream_of(spark, schema, folder):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_ingest_across_batches_and_retries(rows, spark, tmp_path):
    source, root, checkpoint = f"{tmp_path}/in", f"{tmp_path}/tables", f"{tmp_path}/checkpoint"

    def arrive(start, *values):
        rows([("orders_topic", v, start + i, AT) for i, v in enumerate(values)], MESSAGES).coalesce(1).write.mode(
            "append"
        ).parquet(source)

    def run():
        stream = spark.readStream.schema(MESSAGES).parquet(source)
        ingest.stream_ingest(stream, root, checkpoint).awaitTermination()
        table = read_table(spark, f"{root}/raw_orders", schemas.RAW_ORDERS)
        logs = read_table(spark, f"{root}/pipeline_logs", schemas.PIPELINE_LOGS)
        return {r["order_id"]: r["city"] for r in table.collect()}, table.count(), logs.count()

    arrive(0, order(city="first"), order(city="second"), "{", order(order_id=None))
    assert run() == ({"o1": "first"}, 1, 2)
    arrive(10, order(city="third"), order(order_id="o2", city="x"), json.dumps({"order_id": "o3"}))
    assert run() == ({"o1": "first", "o2": "x"}, 2, 3)
    assert run() == ({"o1": "first", "o2": "x"}, 2, 3)
    # The last batch runs again when its commit is lost.
    for name in ("1", ".1.crc"):
        path = Path(checkpoint) / "commits" / name
        if path.exists():
            os.remove(path)
    assert run() == ({"o1": "first", "o2": "x"}, 2, 3)


def test_streamed_doctor_equals_replay(spark, tmp_path):
    """Several batches, each diagnosing the ticks it closes, against one replay."""
    inputs = Inputs(spark, TESTDATA)
    timed = inputs.events.withColumn("_t", F.unix_seconds("ts").cast("double"))
    in_time_parts(timed, "ts", f"{tmp_path}/events", 4)
    stream = stream_of(spark, inputs.events.schema, f"{tmp_path}/events")
    stream_monitor.stream_doctor(
        inputs.activity(stream), f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    ).awaitTermination()
    path = f"{tmp_path}/out/ai_pipeline_diagnosis"
    batches = spark.read.parquet(path).where("batch_id >= 0").select("batch_id").distinct().count()
    assert batches >= 3
    columns = ["run_timestamp", "status", "severity", "tags", "source", "alert_fingerprint",
               "alerted_at", "features_json", "anomalies_json"]
    streamed = read_table(spark, path, schemas.DIAGNOSES).select(*columns)
    last = streamed.agg(F.max("run_timestamp").alias("t")).first()["t"]
    replayed = monitor.replay(inputs.raw("b")).where(F.col("run_timestamp") <= F.lit(last)).select(*columns)
    assert streamed.count() == replayed.count() > 1000
    assert streamed.exceptAll(replayed).isEmpty()


def test_alert_stream_remembers_across_batches(rows, spark, tmp_path):
    from datetime import timedelta

    entries = [("a", START + timedelta(minutes=7 * i)) for i in range(60)]
    entries += [("b", START + timedelta(minutes=50 * i)) for i in range(8)]
    frame = candidates(rows, entries).select(
        "alert_fingerprint", "run_timestamp", F.unix_seconds("run_timestamp").cast("double").alias("_t")
    )
    in_time_parts(frame, "run_timestamp", f"{tmp_path}/in", 3)
    stream = stream_of(spark, frame.drop("_t").schema, f"{tmp_path}/in")
    stream_monitor.stream_alert_dedup(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    out = read_table(spark, f"{tmp_path}/out", stream_monitor.ALERTS)
    assert out.count() == len(entries)
    sent = out.where("should_alert").select("alert_fingerprint", F.col("run_timestamp").cast("timestamp_ntz"))
    assert {tuple(r) for r in sent.collect()} == greedy(entries)
    assert decisions.alert_suppress(candidates(rows, entries)).where("should_alert").count() == sent.count()


def test_a_batch_reads_the_days_it_needs_however_many_are_stored(rows, spark, tmp_path):
    from datetime import timedelta

    path = f"{tmp_path}/alerts"
    create_table(spark, path, stream_monitor.ALERTS, by_day=True)
    listed = set()
    for stored in (3, 25, 50):
        frame = candidates(rows, [("a", START + timedelta(days=i)) for i in range(stored)]).select(
            "alert_fingerprint", "run_timestamp", F.lit(True).alias("should_alert"),
            F.lit(None).cast("string").alias("suppression_reason"),
        )
        write_days(frame, path, 0, day_of(F.col("run_timestamp")))
        last = frame.select(day_of(F.max("run_timestamp"))).first()[0]
        recent = read_days(spark, path, stream_monitor.ALERTS, last - 1, last, 1)
        assert recent.count() == 2
        listed.add(len(recent.inputFiles()))
        assert read_days(spark, path, stream_monitor.ALERTS, last - 1000, last, 1).count() == stored
        assert read_days(spark, path, stream_monitor.ALERTS, last - 1, last, 0).count() == 0
    assert len(listed) == 1


def test_late_rows_are_counted_and_left_out(rows, spark, tmp_path):
    source = f"{tmp_path}/in"
    schema = "event_ts timestamp, domain string, hit boolean"

    def arrive(*times):
        rows([(f"2024-01-01 {t}", "orders", False) for t in times], schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        windows.late_policy(stream, f"{tmp_path}/log", f"{tmp_path}/c1").awaitTermination()
        stream = spark.readStream.schema(schema).parquet(source)
        windows.append_parquet(
            windows.stream_window_metrics(stream), f"{tmp_path}/out", f"{tmp_path}/c2"
        ).awaitTermination()

    arrive("10:00:00", "10:20:00", "11:00:00")
    run()
    arrive("10:10:00", "10:45:00", "11:10:00", "12:00:00")
    run()
    log = spark.read.parquet(f"{tmp_path}/log").where("batch_id >= 0").orderBy("batch_id").collect()
    # The mark stands at 10:50 after the first batch: the window to 10:30 is closed, the next is not.
    assert [(r["rows"], r["late_rows"]) for r in log] == [(3, 0), (4, 1)]
    totals = {
        r["window_start"].strftime("%H:%M"): r["total"]
        for r in spark.read.parquet(f"{tmp_path}/out")
        .withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).collect()
    }
    assert totals == {"10:00": 2, "10:30": 1, "11:00": 2}


def test_dedup_state_drops_repeats(rows, spark, tmp_path):
    rows([("orders_topic", order(), i, AT) for i in range(5)], MESSAGES).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(MESSAGES).parquet(f"{tmp_path}/in")
    windows.append_parquet(
        ingest.stream_dedup(stream), f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    ).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1


def test_a_new_checkpoint_keeps_what_is_stored(rows, spark, tmp_path):
    root = f"{tmp_path}/tables"
    for i, values in enumerate([(order(), order(order_id="o2")), (order(order_id="o3"), order(city="again"))]):
        source = f"{tmp_path}/in{i}"
        rows([("orders_topic", v, j, AT) for j, v in enumerate(values)], MESSAGES).write.parquet(source)
        stream = spark.readStream.schema(MESSAGES).parquet(source)
        ingest.stream_ingest(stream, root, f"{tmp_path}/checkpoint{i}").awaitTermination()
    keys = [r["order_id"] for r in read_table(spark, f"{root}/raw_orders", schemas.RAW_ORDERS).collect()]
    assert sorted(keys) == ["o1", "o2", "o3"]


def test_dedup_keeps_every_message_without_a_key(rows, spark, tmp_path):
    rows([("orders_topic", "{", i, AT) for i in range(50)] + [("orders_topic", order(), 60, AT)] * 2, MESSAGES).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(MESSAGES).parquet(f"{tmp_path}/in")
    windows.append_parquet(ingest.stream_dedup(stream), f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 51


def test_a_batch_reads_no_stored_rows(rows, spark, tmp_path):
    """Keys are known from state: stored files that cannot be read any more do no harm."""
    source, root, checkpoint = f"{tmp_path}/in", f"{tmp_path}/tables", f"{tmp_path}/checkpoint"

    def run(i, *values):
        rows([("orders_topic", v, 10 * i + j, AT) for j, v in enumerate(values)], MESSAGES).coalesce(1).write.mode(
            "append").parquet(source)
        stream = spark.readStream.schema(MESSAGES).parquet(source)
        ingest.stream_ingest(stream, root, checkpoint).awaitTermination()

    run(0, order(), "{")
    for path in Path(root).glob("raw_orders/batch_id=0/part-*.parquet"):
        path.write_bytes(b"damaged")
    run(1, order(city="again"), order(order_id="o2"), order(order_id="o2", city="later"))
    run(2, order(order_id="o2"))
    stored = spark.read.schema(schemas.RAW_ORDERS).parquet(f"{root}/raw_orders/batch_id=1")
    assert [(r["order_id"], r["city"]) for r in stored.collect()] == [("o2", None)]
    assert not Path(f"{root}/raw_orders/batch_id=2").exists()  # nothing new, nothing written


def test_a_broken_message_does_not_hold_its_key(rows, spark, tmp_path):
    rows([("orders_topic", order(order_amount="n/a"), 0, AT), ("orders_topic", order(city="good"), 1, AT),
          ("unknown_topic", order(), 2, AT), ("payments_topic", None, 3, AT)], MESSAGES).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(MESSAGES).parquet(f"{tmp_path}/in")
    ingest.stream_ingest(stream, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    (kept,) = read_table(spark, f"{tmp_path}/t/raw_orders", schemas.RAW_ORDERS).collect()
    assert kept["city"] == "good"
    assert read_table(spark, f"{tmp_path}/t/pipeline_logs", schemas.PIPELINE_LOGS).count() == 2


def test_state_holds_keys_and_no_messages(rows, spark, tmp_path):
    """What a key costs does not follow the length of its message; a hot key is a few rows."""
    sizes = {}
    for length in (10, 20_000):
        source, checkpoint = f"{tmp_path}/in{length}", f"{tmp_path}/c{length}"
        values = [order(order_id=f"o{i % 40}", city="x" * length) for i in range(60)] + [order(order_id="hot")] * 200
        values += ["{" + "y" * length] * 3
        rows([("orders_topic", v, i, AT) for i, v in enumerate(values)], MESSAGES).write.parquet(source)
        stream = spark.readStream.schema(MESSAGES).parquet(source)
        ingest.stream_ingest(stream, f"{tmp_path}/t{length}", checkpoint).awaitTermination()
        assert read_table(spark, f"{tmp_path}/t{length}/raw_orders", schemas.RAW_ORDERS).count() == 41
        assert read_table(spark, f"{tmp_path}/t{length}/pipeline_logs", schemas.PIPELINE_LOGS).count() == 3
        state = spark.read.format("statestore").load(checkpoint)
        assert set(state.selectExpr("key.*").columns) == {"topic", "event_key", "broken"}
        sizes[length] = state.agg(F.count("*"), F.sum(F.length(F.to_json(F.struct("key", "value"))))).first()
    assert sizes[10] == sizes[20_000] and sizes[10][0] == 44


def test_the_earliest_of_a_batch_wins_wherever_it_is_read(rows, spark, tmp_path):
    late = "2024-02-01 11:00:00"
    values = [("orders_topic", order(city="late"), 1, late), ("orders_topic", order(city="higher"), 9, AT),
              ("orders_topic", order(city="first"), 3, AT), ("orders_topic", order(order_id="o2", city="none"), 5, None),
              ("orders_topic", order(order_id="o2", city="timed"), 1, AT)]
    for i, value in enumerate(values):  # a file each
        rows([value], MESSAGES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(MESSAGES).parquet(f"{tmp_path}/in")
    ingest.stream_ingest(stream, f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    got = {r["order_id"]: r["city"] for r in read_table(spark, f"{tmp_path}/t/raw_orders", schemas.RAW_ORDERS).collect()}
    assert got == {"o1": "first", "o2": "none"}


def test_partitions_keep_the_earliest_over_many_batches():
    import random

    import pandas as pd

    draw = random.Random(4)
    values = [("t", f"k{draw.randrange(50)}", -1, draw.random() < 0.01, draw.randrange(1000), i, "v") for i in range(3000)]
    frame = pd.DataFrame(values, columns=["topic", "event_key", "broken", "held", "at_us", "place", "value"])
    (got,) = ingest._earliest_of_partition(iter([frame[i : i + 70] for i in range(0, 3000, 70)]))
    want = {}
    for _, key, _, held, at, place, _ in values:
        want[key] = min(want.get(key, (True, 0, 0)[:0] or (2,)), (not held, at, place))
    assert {r.event_key: (not r.held, r.at_us, r.place) for r in got.itertuples()} == want
    assert list(ingest._earliest_of_partition(iter([]))) == []


def test_an_event_far_ahead_closes_nothing(rows, spark, tmp_path):
    """The clock guard keeps it from the watermark, and the quarantine keeps the row."""
    schema = "event_ts timestamp, domain string, label string, hit boolean, ok boolean, revenue decimal(32,10), delay int"
    source = f"{tmp_path}/in"

    def arrive(*times):
        rows([(t, "orders", "x", False, False, None, None) for t in times], schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = lambda: spark.readStream.schema(rows([], schema).schema).parquet(source)
        stream_monitor.stream_doctor(stream(), f"{tmp_path}/out", f"{tmp_path}/c1").awaitTermination()
        stream_monitor.stream_ahead(stream(), f"{tmp_path}/ahead", f"{tmp_path}/c2").awaitTermination()
        audit = read_table(spark, f"{tmp_path}/out/ai_pipeline_diagnosis", schemas.DIAGNOSES)
        return audit.count(), spark.read.parquet(f"{tmp_path}/ahead").count()

    arrive("2024-01-01 10:00:00", "2024-01-01 12:00:00", "9954-01-01 00:00:00")
    assert run() == (1, 1)
    arrive("2024-01-01 13:00:00", "2024-01-01 15:00:00")
    first = run()
    assert first == (13, 1)
    arrive("2024-03-01 10:00:00", "2024-03-01 12:00:00")  # two quiet months: their ticks are left out
    total, _ = run()
    assert total <= 13 + 4 * 96

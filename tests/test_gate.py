"""Suppression in operator state against the batch operator."""

import random
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from shopvitals.operators import decisions
from shopvitals.streaming import gate, windows
from tests.test_decisions import START, candidates, greedy


def run(spark, tmp_path, delay, schema):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = windows.append_parquet(gate.stream_alert_gate(stream, delay), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    return spark.read.parquet(f"{tmp_path}/out")


def arrive(rows, tmp_path, entries):
    frame = candidates(rows, entries).select("alert_fingerprint", "run_timestamp")
    frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    time.sleep(1.1)  # the file source orders by modification time
    return frame.schema


def test_shuffled_batches_equal_the_batch_operator_and_leave_no_state(rows, spark, tmp_path):
    rng = random.Random(6)
    entries = [("hot", START + timedelta(minutes=7 * i)) for i in range(150)]
    entries += [(fp, START + timedelta(minutes=rng.randint(0, 1000))) for fp in "bcd" for _ in range(20)]
    entries += entries[:5]  # repeated candidates
    shuffled = list(entries)
    rng.shuffle(shuffled)
    for part in range(3):
        schema = arrive(rows, tmp_path, shuffled[part::3])
    first = run(spark, tmp_path, "2 days", schema)
    assert first.count() == 0  # all may still be overtaken
    arrive(rows, tmp_path, [("end", START + timedelta(days=4))])
    out = run(spark, tmp_path, "2 days", schema)
    got = sorted(map(tuple, out.select("alert_fingerprint", F.col("run_timestamp").cast("timestamp_ntz"), "should_alert", "suppression_reason").collect()), key=str)
    batch = decisions.alert_suppress(candidates(rows, entries)).select(
        "alert_fingerprint", F.col("run_timestamp").cast("timestamp_ntz"), "should_alert", "suppression_reason")
    assert got == sorted(map(tuple, batch.collect()), key=str) and len(got) == len(entries)
    assert {(f, t) for f, t, s, _ in got if s} == greedy(entries)
    state = spark.read.format("statestore").load(f"{tmp_path}/checkpoint").selectExpr("key.*").collect()
    assert [tuple(r) for r in state] == [("end",)]  # the one candidate that is not decided yet


def test_an_alert_is_remembered_for_its_window_only(rows, spark, tmp_path):
    for minutes in (0, 20, 45, 50, 200):
        schema = arrive(rows, tmp_path, [("a", START + timedelta(minutes=minutes))])
    out = run(spark, tmp_path, "0 seconds", schema)
    got = sorted((t - START, s) for _, t, s in out.select("alert_fingerprint", F.col("run_timestamp").cast("timestamp_ntz"), "should_alert").collect())
    assert got == [(timedelta(minutes=m), s) for m, s in ((0, True), (20, False), (45, True), (50, False), (200, True))]


@pytest.mark.parametrize("seed", range(5))
def test_any_cuts_in_time_give_the_same_decisions(seed):
    rng = random.Random(seed)
    times = sorted(rng.choices(range(500), k=120))
    whole = gate.decide_due(None, times, 10**9, 30)
    last, waiting, got = None, [], []
    for mark in sorted(rng.choices(range(500), k=15)) + [10**9]:
        fresh = [t for t in times if t <= mark + 20 and t not in waiting and not any(t == d for d, _ in got)]
        rng.shuffle(fresh)
        last, waiting, decided = gate.decide_due(last, waiting + fresh, mark, 30)
        got += decided
    assert got == whole[2] and last == whole[0] and waiting == []

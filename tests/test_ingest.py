import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopvitals.operators import features, ingest, staging
from shopvitals.sources.topics import from_kafka, kafka_options

MESSAGES = "topic string, value string, offset bigint, received_at timestamp"
ORDER = {
    "order_id": "o1", "customer_id": "c1", "city": None, "order_ts": "2024-01-01T05:30:00+05:30",
    "order_amount": 12.5, "order_status": "created",
}
AT = "2024-01-01 00:00:00"


def order(**changes):
    return json.dumps({**ORDER, **changes})


def messages(rows, *values, topic="orders_topic"):
    return rows([(topic, v, i, AT) for i, v in enumerate(values)], MESSAGES)


def problems(frame):
    kind = ingest.EVENT_KINDS["orders"]
    return [r["problem"] for r in ingest.decode(frame, kind).orderBy("offset").collect()]


def test_offsets_in_event_times(rows):
    got = messages(rows, order(), order(order_ts="2024-01-01T00:00:00Z"), order(order_ts=""), order(order_ts=None))
    times = [r["order_ts"] for r in ingest.decode(got, ingest.EVENT_KINDS["orders"]).withColumn(
        "order_ts", F.col("order_ts").cast("timestamp_ntz")).orderBy("offset").collect()]
    assert times == [datetime(2024, 1, 1), datetime(2024, 1, 1), None, None]
    assert problems(got) == [None] * 4


def test_what_is_quarantined(rows):
    without_city = json.dumps({k: v for k, v in ORDER.items() if k != "city"})
    got = messages(
        rows, order(), '{"order_id":', "[1]", without_city, order(order_id=None),
        order(order_amount="n/a"), order(order_ts="yesterday"), None,
    )
    assert problems(got) == [
        None, "malformed JSON", "malformed JSON", "missing city", "order_id is null",
        "value of the wrong type", "value of the wrong type", "malformed JSON",
    ]
    assert ingest.ingest_orders(got).count() == 1
    logs = ingest.quarantine(got).collect()
    assert len(logs) == 7 and {r["status"] for r in logs} == {"error"}
    assert len({r["log_id"] for r in logs}) == 7


def test_amounts_and_minutes_keep_what_the_event_says(rows):
    long = "12345678901234567890.5"
    got = messages(rows, order(order_amount=12.345), order(order_id="o2", order_amount=long))
    assert problems(got) == [None, None]
    stored = ingest.ingest_orders(got)
    assert {r["order_id"]: r["order_amount"] for r in stored.collect()} == {"o1": Decimal("12.345"), "o2": Decimal(long)}
    (staged,) = staging.stg_orders(stored.where("order_id = 'o1'")).collect()
    assert staged["order_amount"] == Decimal("12.35")
    (total,) = features.feat_revenue(stored, as_of="2024-01-01 00:10:00").collect()
    assert total["revenue"] == float(Decimal(long) + Decimal("12.345"))
    delivery = {"delivery_id": "d", "order_id": "o", "city": "x", "delivery_partner": "y", "promised_minutes": "45.5",
                "actual_minutes": 44.4, "delivery_status": "z"}
    (row,) = ingest.ingest_deliveries(messages(rows, json.dumps(delivery), topic="deliveries_topic")).collect()
    assert (row["promised_minutes"], row["actual_minutes"]) == (46, 44)


def test_failure_reason_is_optional(rows):
    event = {"payment_id": "p", "order_id": "o", "payment_ts": "", "payment_method": "UPI",
             "payment_status": "success", "amount": "3"}
    (row,) = ingest.ingest_payments(messages(rows, json.dumps(event), topic="payments_topic")).collect()
    assert row["failure_reason"] is None and row["payment_ts"] is None


def test_unknown_topics_are_not_routed(rows):
    routed = ingest.ingest_route(messages(rows, order(), topic="other_topic"))
    assert all(good.isEmpty() and bad.isEmpty() for good, bad in routed.values())


def test_first_write_wins_for_a_hot_key(rows, spark):
    many = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise(F.lit("hot")).alias("k"),
        F.lit(AT).cast("timestamp").alias("created_at"),
        (F.lit(5000) - F.col("id")).alias("offset"),
        F.col("id").alias("payload"),
    )
    first = ingest.first_per_key(many, "k", ["created_at", "offset"])
    assert first.count() == 1667 + 1
    assert first.where("k = 'hot'").collect()[0]["payload"] == 4999


def test_running_ingest_twice_adds_nothing(rows):
    got = messages(rows, order(), order(order_id="o2"), order(city="late"))
    stored = ingest.ingest_orders(got)
    assert {r["order_id"]: r["city"] for r in stored.collect()} == {"o1": None, "o2": None}
    assert ingest.ingest_orders(got, existing=stored).isEmpty()
    more = messages(rows, order(city="later"), order(order_id="o3"))
    assert [r["order_id"] for r in ingest.ingest_orders(more, existing=stored).collect()] == ["o3"]


def test_complaints_are_labelled_on_the_way_in(rows):
    event = {"complaint_id": "c", "order_id": "o", "complaint_ts": AT, "complaint_text": "Refund payment"}
    silent = {**event, "complaint_id": "d", "complaint_text": None}
    got = messages(rows, json.dumps(event), json.dumps(silent), topic="complaints_topic")
    labels = {r["complaint_id"]: r["ai_category"] for r in ingest.ingest_complaints(got).collect()}
    assert labels == {"c": "payment_issue", "d": None}


def test_kafka_rows_keep_a_total_order(rows):
    records = rows(
        [("orders_topic", "x", 0, 7, AT), ("orders_topic", "y", 1, 7, AT)],
        "topic string, value string, partition int, offset bigint, timestamp timestamp",
    )
    offsets = [r["offset"] for r in from_kafka(records.withColumn("value", F.encode("value", "utf-8"))).collect()]
    assert len(set(offsets)) == 2
    assert kafka_options("host:9092")["startingOffsets"] == "earliest"
    assert kafka_options("host:9092", per_batch=500)["maxOffsetsPerTrigger"] == "500"
    assert kafka_options("host:9092")["subscribe"].count("_topic") == 5


@pytest.mark.parametrize("name", list(ingest.EVENT_KINDS))
def test_every_kind_has_its_key_among_the_required(name):
    kind = ingest.EVENT_KINDS[name]
    assert kind.key in kind.required


@pytest.mark.parametrize("tail", [" trailing", '{"order_id": "o2"}', ', {"order_id": "o2"}', "]", "}"])
def test_a_message_is_one_json_value(rows, tail):
    text = json.dumps({"order_id": "o1", "customer_id": "c", "city": "x", "order_ts": "2024-01-01", "order_amount": 1, "order_status": "s"})
    frame = rows([("orders_topic", text, 1, "2024-01-01"), ("orders_topic", text + tail, 2, "2024-01-01")],
                 "topic string, value string, offset bigint, received_at timestamp")
    got = {r["offset"]: r["problem"] for r in ingest.decode(frame, ingest.EVENT_KINDS["orders"]).collect()}
    assert got == {1: None, 2: "malformed JSON"}


def test_fractions_of_minutes_are_rounded(rows):
    def delivery(promised):
        return json.dumps({"delivery_id": str(promised), "order_id": "o", "city": "x", "delivery_partner": "p",
                           "promised_minutes": promised, "actual_minutes": 30, "delivery_status": "s"})
    frame = rows([("deliveries_topic", delivery(m), i, "2024-01-01") for i, m in enumerate([45.5, 45.4, 30, "x", None])],
                 "topic string, value string, offset bigint, received_at timestamp")
    got = [(r["promised_minutes"], r["problem"]) for r in ingest.decode(frame, ingest.EVENT_KINDS["deliveries"]).orderBy("offset").collect()]
    assert got == [(46, None), (45, None), (30, None), (None, "value of the wrong type"), (None, None)]


def test_model_labels_are_stored(rows):
    def complaint(i, text):
        return json.dumps({"complaint_id": i, "order_id": "o", "complaint_ts": "2024-01-01T00:00:00Z", "complaint_text": text})

    got = messages(rows, *[complaint(f"c{i}", "refund please") for i in range(4)], topic="complaints_topic")
    answers = rows(
        [("c0", 1, '{"category":"other"}'), ("c0", 2, '{"category":"app_issue"}'), ("c1", 1, "[]"),
         ("c1", 2, '{"category":null,"severity":"low"}'), ("c2", 1, '{"category":'), ("gone", 1, "{}")],
        "complaint_id string, attempt int, response string",
    )
    stored = {r["complaint_id"]: (r["ai_category"], r["ai_severity"]) for r in ingest.ingest_complaints(got, answers=answers).collect()}
    assert stored == {"c0": ("other", "medium"), "c1": (None, "low"), "c2": ("refund_delay", "high"), "c3": ("refund_delay", "high")}


def test_messages_are_parsed_once_for_all_that_reads_them(rows):
    def parses(frame):
        return "from_json" in frame._jdf.queryExecution().optimizedPlan().toString()

    got = messages(rows, order(), order(order_id="o2"), "{", order(city="late"))
    stored = ingest.ingest_orders(messages(rows, order(order_id="o2")))
    fresh = ingest.ingest_orders(got, existing=stored.localCheckpoint())
    assert [r["order_id"] for r in fresh.collect()] == ["o1"] and not parses(fresh)
    good, bad = ingest.ingest_route(got)["raw_orders"]
    assert not parses(good) and not parses(bad)
    assert good.count() == 3 and [r["value"] for r in bad.collect()] == ["{"]

"""Topic messages: Kafka for production, files of the same shape, and the test fixture."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopvitals.operators.ingest import EVENT_KINDS
from shopvitals.sources.fixture_sql import VIEWS

c = F.col


def kafka_options(servers: str, starting: str = "earliest", per_batch: int = 1_000_000) -> dict[str, str]:
    """Options of the topic source; a backlog comes in batches of ``per_batch`` messages at most."""
    return {
        "maxOffsetsPerTrigger": str(per_batch),
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(kind.topic for kind in EVENT_KINDS.values()),
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }


def from_kafka(records: DataFrame) -> DataFrame:
    """Kafka's columns as (topic, value, offset, received_at).

    Offsets count per partition; the partition goes into the low bits so that no two messages
    of a topic tie.
    """
    return records.select(
        "topic",
        c("value").cast("string").alias("value"),
        (c("offset") * 65536 + c("partition")).alias("offset"),
        c("timestamp").alias("received_at"),
    )


def read_topics(spark: SparkSession, servers: str, per_batch: int = 1_000_000) -> DataFrame:
    """Stream of all topics from the earliest offset; needs the Kafka connector jar."""
    options = kafka_options(servers, per_batch=per_batch)
    return from_kafka(spark.readStream.format("kafka").options(**options).load())


# Table behind each topic in the fixture, the field a repeated message changes, and the one it may lack.
_FIXTURE = {
    "orders": ("b_raw_orders", "customer_id", "city"),
    "payments": ("b_raw_payments", "order_id", "payment_status"),
    "deliveries": ("b_raw_deliveries", "order_id", "delivery_partner"),
    "refunds": ("b_raw_refunds", "order_id", "refund_reason"),
    "complaints": ("b_complaint_events", "order_id", "complaint_text"),
}


def fixture_messages(events: DataFrame) -> DataFrame:
    """Wire messages of the event-grain fixture, batch or streaming.

    Besides one message per row each topic has repeats of every tenth event that arrive a minute
    later with another id in them, and messages that cannot load: cut off in the middle, without
    a required field, with text after the value, and with two values.
    """
    spark = events.sparkSession
    parts = []
    for name, (view, changed, lacking) in _FIXTURE.items():
        kind = EVENT_KINDS[name]
        rows = spark.sql(VIEWS[view], events=events)
        number = F.regexp_extract(kind.key, "([0-9]+)$", 1).cast("bigint")
        payload = {
            field: F.date_format(field, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
            if field == kind.timestamp
            else c(field)
            for field in kind.fields
        }

        def text(values):
            return F.to_json(
                F.struct(*[value.alias(field) for field, value in values.items()]),
                {"ignoreNullFields": "false"},
            )

        late = F.make_dt_interval(mins=F.lit(1))
        variants = [
            F.struct(F.lit(0).alias("shift"), text(payload).alias("value")),
            F.when(
                number % 10 == 0,
                F.struct(F.lit(1), text({**payload, changed: F.lit("REPEAT")})),
            ),
        ]
        fresh = {**payload, kind.key: F.concat(F.lit("BAD-"), kind.key)}
        whole, partial = text(fresh), text({k: v for k, v in fresh.items() if k != lacking})
        variants += [
            F.when(number % 97 == 0, F.struct(F.lit(2), F.left(whole, F.lit(40)))),
            F.when(number % 89 == 0, F.struct(F.lit(3), partial)),
            F.when(number % 83 == 0, F.struct(F.lit(4), F.concat(whole, F.lit(" as sent")))),
            F.when(number % 79 == 0, F.struct(F.lit(5), F.concat(whole, whole))),
        ]
        variants = [v.cast("struct<shift:int,value:string>") for v in variants]
        parts.append(
            rows.select(
                F.lit(kind.topic).alias("topic"),
                number.alias("_number"),
                "created_at",
                F.inline(F.array_compact(F.array(*variants))),
            ).select(
                "topic",
                "value",
                (c("_number") * 8 + c("shift")).alias("offset"),
                F.when(c("shift") == 0, c("created_at"))
                .otherwise(c("created_at") + late)
                .alias("received_at"),
            )
        )
    return reduce(DataFrame.unionByName, parts)

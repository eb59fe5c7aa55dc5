"""Messages into raw tables as a stream."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from shopvitals import schemas
from shopvitals.operators.ingest import EVENT_KINDS, EventKind, decode, loadable, quarantine, with_row_key
from shopvitals.session import pin_streaming, side_by_side
from shopvitals.streaming.sinks import create_table, first_number, read_table, write_batch

c = F.col


def stream_ingest(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    answers: DataFrame | None = None,
) -> StreamingQuery:
    """Route, decode, quarantine and append every topic, first write per key winning forever.

    Complaints are stored with the model's labels where ``answers`` has them at the time of the batch.

    Every key that came is state, without its message, so a batch costs what its own messages cost
    and reads no stored table; state grows by one key, however long messages are. With a new
    checkpoint the keys stored so far are put into the state once, with the first batch. A message
    that cannot load is told by its offset. Delivery is at least once: a batch is appended under its
    own folder, so writing it again replaces it.
    """
    spark = pin_streaming(messages.sparkSession)
    for kind in EVENT_KINDS.values():
        create_table(spark, f"{root}/{kind.table}", schemas.RAW_TABLES[kind.table])
    create_table(spark, f"{root}/pipeline_logs", schemas.PIPELINE_LOGS)
    tables = [*(kind.table for kind in EVENT_KINDS.values()), "pipeline_logs"]
    seed = f"{checkpoint.rstrip('/')}/stored_keys"
    first = first_number(
        spark, checkpoint, *(f"{root}/{name}" for name in tables),
        prepare=lambda: stored_keys(messages, root).write.mode("overwrite").parquet(seed),
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        number = first + batch_id
        new = batch.where(~c("held")).drop("held").persist()

        def load_topic(kind: EventKind) -> None:
            rows = loadable(decode(new.where(c("event_key").isNotNull()), kind), kind, answers)
            path, names = f"{root}/{kind.table}", schemas.RAW_TABLES[kind.table].names
            write_batch(rows.select(*names), path, number)

        try:
            # One job fills the cache before the topics are written side by side.
            counted = new.groupBy("topic", c("event_key").isNotNull().alias("loads")).count().collect()
            loading = {row["topic"] for row in counted if row["loads"]}
            side_by_side(load_topic, [kind for kind in EVENT_KINDS.values() if kind.topic in loading])
            if not all(row["loads"] for row in counted):
                bad = quarantine(new.where(c("event_key").isNull()))
                write_batch(bad, f"{root}/pipeline_logs", number)
        finally:
            new.unpersist()

    known = spark.readStream.schema(stored_keys(messages, root).schema).parquet(seed)
    return (
        first_messages(messages, known).writeStream.foreachBatch(load)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stored_keys(messages: DataFrame, root: str) -> DataFrame:
    """(topic, event_key) of all rows that the raw tables hold."""
    spark = messages.sparkSession
    return reduce(
        DataFrame.unionByName,
        [
            read_table(spark, f"{root}/{kind.table}", schemas.RAW_TABLES[kind.table]).select(
                F.lit(kind.topic).alias("topic"), c(kind.key).alias("event_key")
            )
            for kind in EVENT_KINDS.values()
        ],
    )


_LAST = 2**63 - 1
#: What travels to the stage that keeps the earliest message; instants and offsets as whole numbers.
_CARRIED = "topic string, event_key string, broken bigint, held boolean, at_us bigint, place bigint, value string"
_KEY = ["topic", "event_key", "broken"]


def _earliest(parts: list[pd.DataFrame]) -> pd.DataFrame:
    rows = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
    rows = rows.sort_values(["held", "at_us", "place"], ascending=[False, True, True], kind="stable")
    return rows.drop_duplicates(_KEY)


def _earliest_of_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each Arrow batch without the messages that one before them in it repeats."""
    for rows in batches:
        if len(rows):
            yield _earliest([rows])


def _earliest_of_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The earliest message of each key of a whole partition; memory follows its distinct keys."""
    held: list[pd.DataFrame] = []
    waiting = kept = 0
    for rows in batches:
        held.append(rows)
        waiting += len(rows)
        if waiting > max(50_000, kept):
            held = [_earliest(held)]
            waiting, kept = 0, len(held[0])
    if any(len(rows) for rows in held):
        yield _earliest(held)


def first_messages(messages: DataFrame, known: DataFrame) -> DataFrame:
    """Per batch the first message of each key that neither ``known`` nor an earlier batch has, and
    every message that cannot load.

    Within a batch the earliest message (arrival, offset) of a key is kept, first where the messages
    are read, so that a key that repeats a lot is a few rows, then by key. What the state
    remembers is the key alone, of a message that cannot load its offset. Rows of ``known`` come
    back as ``held``: they only fill the state.
    """
    none = F.lit(-_LAST)
    place = F.coalesce("offset", none)
    arrived = with_row_key(messages).withColumns(
        {
            "broken": F.when(c("event_key").isNull(), place).otherwise(none),
            "held": F.lit(False),
            "at_us": F.coalesce(F.unix_micros("received_at"), none),
            "place": place,
        }
    )
    stored = known.where(c("event_key").isNotNull()).withColumns(
        {"broken": none, "held": F.lit(True), "at_us": none, "place": none, "value": F.lit(None).cast("string")}
    )
    carried = [*_KEY, "held", "at_us", "place", "value"]
    candidates = arrived.select(*carried).mapInPandas(_earliest_of_batches, _CARRIED).unionByName(stored.select(*carried))
    earliest = candidates.repartition(*_KEY).mapInPandas(_earliest_of_partition, _CARRIED)
    return earliest.dropDuplicates(_KEY).select(
        "topic", "event_key", "held", F.timestamp_micros(F.nullif("at_us", none)).alias("received_at"),
        F.nullif("place", none).alias("offset"), "value",
    )


def stream_dedup(messages: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Messages without those repeated within ``delay``, with state bounded by the delay.

    A repeat that comes later passes; the sink's own check still drops it. A message whose key
    cannot be read is told by its offset: it has no repeats, and quarantine gets all of them.
    """
    keyed = messages.withColumn("event_key", message_key()).withColumn(
        "_unkeyed_offset", F.when(c("event_key").isNull(), c("offset"))
    )
    return (
        keyed.withWatermark("received_at", delay)
        .dropDuplicatesWithinWatermark(["topic", "event_key", "_unkeyed_offset"])
        .drop("_unkeyed_offset")
    )


def message_key() -> Column:
    """Key field of a message, by its topic."""
    key = F.lit(None).cast("string")
    for kind in EVENT_KINDS.values():
        key = F.when(
            c("topic") == kind.topic, F.get_json_object("value", f"$.{kind.key}")
        ).otherwise(key)
    return key

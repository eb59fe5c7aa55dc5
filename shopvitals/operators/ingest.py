"""From topic messages to raw tables: route, decode, quarantine, first write wins.

Messages are rows of (topic, value, offset, received_at), batch or streaming.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shopvitals import schemas
from shopvitals.functions.json import once, parse_whole_json
from shopvitals.functions.time import parse_event_ts
from shopvitals.operators.complaints import classify_complaint_rules, label_complaints
from shopvitals.session import materialize, side_by_side

c = F.col


@dataclass(frozen=True)
class EventKind:
    """How one topic's events become rows of one raw table."""

    topic: str
    table: str
    key: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    timestamp: str | None = None
    numbers: tuple[tuple[str, str], ...] = ()

    @property
    def fields(self) -> tuple[str, ...]:
        return self.required + self.optional


_MONEY = schemas.MONEY.simpleString()

# Topics, and the fields an event must or may carry.
EVENT_KINDS = {
    "orders": EventKind(
        "orders_topic", "raw_orders", "order_id",
        ("order_id", "customer_id", "city", "order_ts", "order_amount", "order_status"),
        timestamp="order_ts", numbers=(("order_amount", _MONEY),),
    ),
    "payments": EventKind(
        "payments_topic", "raw_payments", "payment_id",
        ("payment_id", "order_id", "payment_ts", "payment_method", "payment_status", "amount"),
        optional=("failure_reason",),
        timestamp="payment_ts", numbers=(("amount", _MONEY),),
    ),
    "deliveries": EventKind(
        "deliveries_topic", "raw_deliveries", "delivery_id",
        ("delivery_id", "order_id", "city", "delivery_partner", "promised_minutes",
         "actual_minutes", "delivery_status"),
        numbers=(("promised_minutes", "int"), ("actual_minutes", "int")),
    ),
    "refunds": EventKind(
        "refunds_topic", "raw_refunds", "refund_id",
        ("refund_id", "order_id", "refund_ts", "refund_amount", "refund_reason"),
        timestamp="refund_ts", numbers=(("refund_amount", _MONEY),),
    ),
    "complaints": EventKind(
        "complaints_topic", "raw_complaints", "complaint_id",
        ("complaint_id", "order_id", "complaint_ts", "complaint_text"),
        timestamp="complaint_ts",
    ),
}


def parse(messages: DataFrame, *kinds: EventKind) -> DataFrame:
    """Messages of the kinds given, or any, with the fields of their JSON as text; each is parsed once."""
    names = sorted({name for kind in kinds or EVENT_KINDS.values() for name in kind.fields})
    as_text = ", ".join(f"{name} string" for name in names)
    event = F.from_json(
        c("_text"),
        f"{as_text}, _broken string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"},
    )
    return messages.withColumn("_text", c("value").cast("string")).select(
        "*", once(_event=event, _keys=F.json_object_keys("_text"), _whole=parse_whole_json(c("_text")).isNotNull())
    )


def typed_fields(kind: EventKind) -> tuple[dict[str, Column], Column]:
    """Of a parsed message: the columns of the table, and what is wrong with it (NULL if nothing)."""
    typed: dict[str, Column] = {name: c(f"_event.{name}") for name in kind.fields}
    bad_type = F.lit(False)
    for name, sql_type in kind.numbers:
        given = c(f"_event.{name}")
        if sql_type == "int":  # a fraction is rounded half up, as a column of whole numbers does
            given = F.round(given.try_cast("decimal(38,10)"), 0)
        typed[name] = given.try_cast(sql_type)
        bad_type = bad_type | (c(f"_event.{name}").isNotNull() & typed[name].isNull())
    if kind.timestamp:
        given = F.nullif(c(f"_event.{kind.timestamp}"), F.lit(""))
        typed[kind.timestamp] = parse_event_ts(c(f"_event.{kind.timestamp}"))
        bad_type = bad_type | (given.isNotNull() & typed[kind.timestamp].isNull())
    absent = F.array_except(F.array(*[F.lit(n) for n in kind.required]), c("_keys"))
    problem = (
        F.when(c("_keys").isNull() | ~c("_whole") | c("_event._broken").isNotNull(), "malformed JSON")
        .when(F.size(absent) > 0, F.concat(F.lit("missing "), F.array_join(absent, ", ")))
        .when(c(f"_event.{kind.key}").isNull(), F.lit(f"{kind.key} is null"))
        .when(bad_type, "value of the wrong type")
    )
    return typed, problem


def decode(messages: DataFrame, kind: EventKind) -> DataFrame:
    """Messages of one topic as table columns, plus ``problem`` for rows that cannot load.

    ``problem`` names the first thing wrong: text that is not exactly one JSON object (nothing may
    follow it), an absent required field, a missing key, or a value of the wrong type. Good rows carry NULL.
    """
    typed, problem = typed_fields(kind)
    return parse(messages.where(c("topic") == kind.topic), kind).select(
        *[typed[name].alias(name) for name in kind.fields],
        c("received_at").alias("created_at"),
        "topic",
        "offset",
        c("_text").alias("value"),
        problem.alias("problem"),
    )


def with_row_key(messages: DataFrame) -> DataFrame:
    """Messages of all topics with ``event_key``, the key of the row they become; NULL if they cannot load."""
    key = F.lit(None).cast("string")
    for kind in EVENT_KINDS.values():
        loads = typed_fields(kind)[1].isNull()
        key = F.when(c("topic") == kind.topic, F.when(loads, c(f"_event.{kind.key}"))).otherwise(key)
    known = messages.where(c("topic").isin(*[kind.topic for kind in EVENT_KINDS.values()]))
    return parse(known).select("topic", "offset", "received_at", c("_text").alias("value"), key.alias("event_key"))


def loadable(decoded: DataFrame, kind: EventKind, answers: DataFrame | None = None) -> DataFrame:
    """Decoded messages that are rows of the table, with ``offset`` to order them by.

    Complaints get their labels from the rules, or from the model's ``answers`` where there are any.
    """
    rows = decoded.where(c("problem").isNull()).drop("problem", "topic", "value")
    if kind.table == "raw_complaints":
        rows = classify_complaint_rules(rows) if answers is None else label_complaints(rows, answers)
    return rows


def broken(decoded: DataFrame) -> DataFrame:
    """Decoded messages that cannot load."""
    return decoded.where(c("problem").isNotNull()).select(
        "topic", "offset", "value", "problem", "created_at"
    )


def log_rows(bad: DataFrame) -> DataFrame:
    """Messages that cannot load as rows of ``pipeline_logs``."""
    return bad.select(
        F.xxhash64("topic", "offset").alias("log_id"),
        F.lit("ingest").alias("component"),
        F.lit("error").alias("status"),
        F.concat_ws(": ", "topic", "problem", "value").alias("message"),
        "created_at",
    )


def first_per_key(rows: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order_by``.

    A minimum over (order, row) combines before the shuffle: however often a key repeats,
    each input partition sends one row for it.
    """
    rest = [name for name in rows.columns if name not in (key, *order_by)]
    first = rows.groupBy(key).agg(F.min(F.struct(*order_by, *rest)).alias("_first"))
    return first.select(key, "_first.*").select(*rows.columns)


def dedup_first_write(
    rows: DataFrame,
    key: str,
    order_by: Sequence[str] = ("created_at", "offset"),
    existing: DataFrame | None = None,
) -> DataFrame:
    """Rows to append: the first per key, and only keys the target does not hold yet.

    The target's keys are first cut to those in the batch (a semi join the small batch can be
    broadcast into), so the whole target never has to be shuffled against itself. The batch is stored
    for that, as both joins read it: its messages are parsed once.
    """
    fresh = first_per_key(rows, key, order_by)
    if existing is None:
        return fresh
    fresh = materialize(fresh, "fresh")
    held = existing.select(key).join(fresh.select(key), key, "left_semi")
    return fresh.join(held, key, "left_anti")


def ingest_route(messages: DataFrame) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Per raw table its loadable rows (with ``offset``) and its quarantined messages.

    Both are read from what a batch has been decoded into, so that its messages are parsed once; that is
    stored without the texts of messages that load. The frames of a stream decode it when they run.
    """

    def route(kind: EventKind) -> tuple[DataFrame, DataFrame]:
        decoded = decode(messages, kind)
        if not messages.isStreaming:
            kept = F.when(c("problem").isNotNull(), c("value"))
            decoded = materialize(decoded.withColumn("value", kept), "decoded")
        return loadable(decoded, kind), broken(decoded)

    kinds = EVENT_KINDS.values()
    return {kind.table: pair for kind, pair in zip(kinds, side_by_side(route, kinds))}


def _ingest(
    messages: DataFrame, name: str, existing: DataFrame | None, answers: DataFrame | None = None
) -> DataFrame:
    kind = EVENT_KINDS[name]
    rows = loadable(decode(messages, kind), kind, answers)
    rows = dedup_first_write(rows, kind.key, existing=existing)
    return rows.select(*[f.name for f in schemas.RAW_TABLES[kind.table]])


def ingest_orders(messages: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _ingest(messages, "orders", existing)


def ingest_payments(messages: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _ingest(messages, "payments", existing)


def ingest_deliveries(messages: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _ingest(messages, "deliveries", existing)


def ingest_refunds(messages: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _ingest(messages, "refunds", existing)


def ingest_complaints(
    messages: DataFrame, existing: DataFrame | None = None, answers: DataFrame | None = None
) -> DataFrame:
    return _ingest(messages, "complaints", existing, answers)


def quarantine(messages: DataFrame) -> DataFrame:
    """Messages that cannot load, as rows for ``pipeline_logs``. Good rows are unaffected."""
    return reduce(
        DataFrame.unionByName,
        [log_rows(broken(decode(messages, kind))) for kind in EVENT_KINDS.values()],
    )


def parse_event_times(messages: DataFrame) -> DataFrame:
    """Event time of each message that carries one, beside the text it was read from."""
    parts = None
    for kind in EVENT_KINDS.values():
        if kind.timestamp is None:
            continue
        given = F.get_json_object(c("value").cast("string"), f"$.{kind.timestamp}")
        rows = messages.where(c("topic") == kind.topic).select(
            "topic", "offset", given.alias("event_ts_text"), parse_event_ts(given).alias("event_ts")
        )
        parts = rows if parts is None else parts.unionByName(rows)
    return parts

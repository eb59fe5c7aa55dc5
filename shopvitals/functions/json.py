"""JSON text as VARIANT, accepting only what is one whole JSON value."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_whole_json(text: Column) -> Column:
    """The value of ``text``, or NULL when it is not exactly one JSON value.

    The built-in parser stops after the first value. Parsing the text once inside an array
    and once inside an object makes anything that follows the value an error.
    """
    in_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.when(
        in_array.isNotNull() & F.try_variant_get(in_array, "$[1]", "variant").isNull(),
        F.try_variant_get(in_object, "$.v", "variant"),
    )


def json_kind(value: Column) -> Column:
    """Type name of a VARIANT: OBJECT<…>, ARRAY<…>, BIGINT, DECIMAL(…), DOUBLE, STRING, …"""
    return F.schema_of_variant(value)


def once(**columns: Column) -> Column:
    """Columns computed a single time, whatever is later made of them.

    A filter on a derived column is otherwise pushed below the projection together with its
    expression, and costly parsing is done again for every mention.
    """
    return F.inline(F.array(F.struct(*[value.alias(name) for name, value in columns.items()])))

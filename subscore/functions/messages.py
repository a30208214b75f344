"""Message payloads: base64 text, JSON objects."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def decode_base64(column: Column) -> Column:
    """Base64 text to UTF-8 text, row by row.

    Quotes, blanks and line breaks are ignored. A payload that holds any other character
    outside the alphabet, or does not decode, gives NULL and leaves its neighbours alone.
    """
    payload = F.translate(column, "\"' \t\r\n", "")
    return F.try_to_binary(payload, F.lit("base64")).cast("string")


def parse_json(column: Column, schema: T.StructType) -> Column:
    """JSON object text to a struct; unreadable text gives only NULL fields."""
    return F.from_json(column.cast("string"), schema)


def parse_json_rows(column: Column, schema: T.StructType) -> Column:
    """JSON text to structs: one for an object, one per element for an array of objects.

    Unreadable text gives NULL.
    """
    return F.from_json(column.cast("string"), T.ArrayType(schema))

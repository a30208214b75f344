"""Column expressions. Everything here runs inside the JVM."""

from subscore.functions.casts import change_type, is_missing, quoted, to_double, to_int
from subscore.functions.lookups import map_values, substitute_values
from subscore.functions.messages import decode_base64, parse_json, parse_json_rows
from subscore.functions.scores import sigmoid, vector_item

__all__ = [
    "change_type",
    "decode_base64",
    "is_missing",
    "map_values",
    "parse_json",
    "parse_json_rows",
    "quoted",
    "sigmoid",
    "substitute_values",
    "to_double",
    "to_int",
    "vector_item",
]

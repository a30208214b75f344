"""Casts that give NULL for unreadable text whatever the session's ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Characters the non-ANSI integer cast trims: blanks and ASCII control characters.
_TRIMMED = r"[\x00-\x20\x7F]*"
_WHOLE_PART = rf"^{_TRIMMED}([+-]?\d*)(\.\d*)?{_TRIMMED}$"
_FRACTION_ONLY = rf"^{_TRIMMED}[+-]?\.\d*{_TRIMMED}$"


def quoted(name: str) -> str:
    """Column name safe for ``F.col``, also with dots or backticks in it."""
    return "`" + name.replace("`", "``") + "`"


def to_int(column: Column) -> Column:
    """Text to int with the fraction cut off: '12.7' -> 12, '.5' -> 0, '1e2' -> NULL."""
    whole = F.regexp_extract(column, _WHOLE_PART, 1).try_cast("int")
    # Plain numbers, nearly all, never reach the patterns.
    return F.coalesce(
        column.try_cast("int"), F.when(column.rlike(_FRACTION_ONLY), F.lit(0)), whole
    )


def to_double(column: Column) -> Column:
    return column.try_cast("double")


def change_type(column: Column, old: T.DataType, new: str) -> Column:
    """Cast to the type named ``new``; values that do not fit become NULL."""
    if isinstance(old, T.StringType) and new in ("int", "integer"):
        return to_int(column)
    return column.try_cast(new)


def is_missing(column: Column, data_type: T.DataType) -> Column:
    """True for NULL and, in floating-point columns, for NaN."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()

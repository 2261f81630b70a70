"""Scalar column expressions (string, date, cast helpers).

Each helper returns a ``Column`` made only of built-in expressions, so it
stays inside whole-stage codegen and never crosses into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def cast_column(c: Column | str, dtype: T.DataType | str, on_bad_cast: str = "fail") -> Column:
    """Cast ``c``; ``on_bad_cast='null'`` turns unparsable values into null."""
    col = F.col(c) if isinstance(c, str) else c
    if on_bad_cast == "fail":
        return col.cast(dtype)
    if on_bad_cast == "null":
        return col.try_cast(dtype)
    raise ValueError(f"unknown on_bad_cast policy: {on_bad_cast!r}")


def whole_number(c: Column | str, on_bad_cast: str = "fail") -> Column:
    """Text of a number ("2", "2.0", "1.3E12") as a bigint, truncated toward zero."""
    return cast_column(cast_column(c, "decimal(38,6)", on_bad_cast), "bigint", on_bad_cast)


def last_segment(c: Column | str, sep: str = ".") -> Column:
    """Part after the last ``sep``; the whole text when there is none; null stays null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.substring_index(col, sep, -1)


def parent_path(c: Column | str, sep: str = ".") -> Column:
    """Every segment but the last, joined again by ``sep`` ('' for one segment)."""
    col = F.col(c) if isinstance(c, str) else c
    parts = F.split(col, "\\" + sep if sep in ".^$|?*+()[]{}\\" else sep)
    return F.array_join(F.slice(parts, 1, F.size(parts) - 1), sep)


def digits_only(c: Column | str) -> Column:
    """Trim, then delete every character that is not an ASCII digit."""
    col = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.trim(col), "[^0-9]", "")


def epoch_ms_to_timestamp(c: Column | str) -> Column:
    """Epoch milliseconds to a zone-free timestamp, truncated to whole seconds.

    Seconds are ``ms div 1000`` (toward zero, exact integer arithmetic) and are
    added to the NTZ epoch, so the session time zone never enters the result.
    """
    col = (F.col(c) if isinstance(c, str) else c).cast("bigint")
    seconds = ((col - col % F.lit(1000)) / F.lit(1000)).cast("bigint")
    return F.timestamp_add("SECOND", seconds, F.expr(_EPOCH_NTZ))


def contains_ci(c: Column | str, needle: str) -> Column:
    """Case-insensitive literal substring test (no wildcard characters)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.lower(col).contains(needle.lower())


def contains_literal(c: Column | str, needle: str) -> Column:
    """Case-sensitive literal substring test."""
    col = F.col(c) if isinstance(c, str) else c
    return col.contains(needle)


def prefix_int(c: Column | str, n: int, dtype: str = "smallint") -> Column:
    """First ``n`` characters of the integer's text, as an integer."""
    col = F.col(c) if isinstance(c, str) else c
    return F.substring(col.cast("string"), 1, n).cast(dtype)

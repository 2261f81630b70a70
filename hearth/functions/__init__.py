"""Column expressions shared by the operators (all built-in Spark functions)."""

from hearth.functions.columns import (
    cast_column,
    contains_ci,
    contains_literal,
    digits_only,
    epoch_ms_to_timestamp,
    last_segment,
    parent_path,
    prefix_int,
)

__all__ = [
    "cast_column",
    "contains_ci",
    "contains_literal",
    "digits_only",
    "epoch_ms_to_timestamp",
    "last_segment",
    "parent_path",
    "prefix_int",
]

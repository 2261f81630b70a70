"""Operators of a training-data pipeline (deduplication, filtering, tokens, mixing).

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames, names its columns by parameters, and states in its
docstring what it does with nulls, empty and very long texts, ties, repeated
rows, empty tables and extra columns.
"""

"""Column functions built from Spark built-ins (no Python UDFs)."""

from tidemark.functions.encode import (
    checkpoint_text, long_to_rowversion, parse_rowversion_hex, rowversion_hex, to_float,
)
from tidemark.functions.cleaning import (
    apply_casing, cast_columns, clean_strings, round_fractional,
)

__all__ = ["checkpoint_text", "long_to_rowversion", "parse_rowversion_hex", "rowversion_hex",
           "to_float", "apply_casing", "cast_columns", "clean_strings", "round_fractional"]

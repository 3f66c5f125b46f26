"""Checkpoint encodings (C1, C2) and text-to-number parsing (C4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.operators._util import as_col

# The empty rowversion checkpoint and the checkpoint timestamp layout.
ZERO_ROWVERSION = "0x0000000000000000"
DEFAULT_TIMESTAMP_CHECKPOINT = "1900-01-01 00:00:00"
CHECKPOINT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def rowversion_hex(col) -> Column:
    """binary -> ``0x`` + lower-case hex; null -> ``0x0000000000000000``."""
    return F.coalesce(F.concat(F.lit("0x"), F.lower(F.hex(as_col(col)))), F.lit(ZERO_ROWVERSION))


def long_to_rowversion(col) -> Column:
    """An 8-byte big-endian binary from a long (two's complement for negatives)."""
    return F.unhex(F.lpad(F.hex(as_col(col).cast("long")), 16, "0"))


def parse_rowversion_hex(text: str | None) -> bytes:
    """``0x...`` checkpoint text -> bytes; missing -> eight zero bytes."""
    t = (text or ZERO_ROWVERSION).strip()
    if t.lower().startswith("0x"):
        t = t[2:]
    if len(t) % 2:
        t = "0" + t
    return bytes.fromhex(t)


def checkpoint_text(col) -> Column:
    """timestamp -> checkpoint text with six fractional digits."""
    return F.date_format(as_col(col), CHECKPOINT_TS_FORMAT)


def to_float(col) -> Column:
    """Text -> double; empty or malformed text -> null instead of an error (C4)."""
    return F.nullif(F.trim(as_col(col)), F.lit("")).try_cast("double")

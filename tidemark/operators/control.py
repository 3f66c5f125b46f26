"""Control values (checkpoints, watermarks, page ends, tile bounds) as lossless text.

Control values leave Spark as text made inside Spark and come back as literals cast
inside Spark, so neither the Python process's time zone nor a Python type touches them:

* binary        ``0x`` and lower-case hex (byte order is text order)
* timestamp     microseconds since the epoch
* everything else  Spark's own cast to string, which casts back to the same value
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BinaryType):
        return F.concat(F.lit("0x"), F.lower(F.hex(c)))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("string")
    return c.cast("string")


def from_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.BinaryType):
        return F.unhex(F.substring(c, 3, 1 << 30))
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(c.cast("long"))
    return c.cast(dtype)


def literal(value, dtype: T.DataType) -> Column:
    """A literal of ``dtype`` from control text or a Python value.

    For timestamps, text that is a whole number is microseconds; other text and naive
    datetimes are wall time in the session's zone; datetimes with a zone are instants.
    """
    if isinstance(value, Column):
        return value
    if isinstance(dtype, T.BinaryType):
        data = bytes.fromhex(value[2:]) if isinstance(value, str) else bytes(value)
        return F.lit(bytearray(data)).cast(dtype)
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None and isinstance(dtype, T.TimestampType):
            since = value - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
            return F.timestamp_micros(F.lit(since // dt.timedelta(microseconds=1)))
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(dtype)
    if isinstance(value, dt.date):
        return F.lit(value.isoformat()).cast(dtype)
    if isinstance(value, str) and isinstance(dtype, T.TimestampType) and re.fullmatch(r"-?\d+", value):
        return F.timestamp_micros(F.lit(int(value)))
    return F.lit(value).cast(dtype)


def max_text(df: DataFrame, col: str) -> str | None:
    """The greatest value of a column, as control text."""
    return df.select(to_text(F.max(col), df.schema[col].dataType)).first()[0]


class Bounds:
    """Sorted bounds as one literal array; a row finds its place by binary search.

    The plan holds one constant and a search of log2(n) steps, whatever the number of
    bounds, so plans with thousands of page ends stay small.
    """

    def __init__(self, values: list, dtype: T.DataType):
        self.n, self.dtype = len(values), dtype
        if isinstance(dtype, T.TimestampType) and all(isinstance(v, str) and re.fullmatch(r"-?\d+", v) for v in values):
            self.array = F.array(*[F.lit(int(v)) for v in values])
            self.key = F.unix_micros
        elif isinstance(dtype, T.StringType) or not all(isinstance(v, str) for v in values) \
                or isinstance(dtype, (T.BinaryType, T.TimestampType)):
            self.array, self.key = F.array(*[literal(v, dtype) for v in values]), lambda c: c
        else:  # one literal text, split and cast while the plan is made
            self.array = F.split(F.lit(",".join(values)), ",").cast(T.ArrayType(dtype))
            self.key = lambda c: c

    def count_below(self, c: Column, strict: bool = True) -> Column:
        """Number of bounds ``b < c`` (``b <= c`` if not strict); null for null."""
        if not self.n:
            return F.when(c.isNotNull(), F.lit(0))
        key = self.key(c)
        steps = [1 << i for i in range(self.n.bit_length() - 1, -1, -1)]

        def advance(i, step):
            at = F.element_at(self.array, F.least(i + step, F.lit(self.n)))
            return F.when((i + step <= self.n) & ((at < key) if strict else (at <= key)), i + step).otherwise(i)

        return F.when(c.isNotNull(), F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance))

"""Key-range buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.operators._util import as_col


def floor_div(col, width: int) -> Column:
    """Exact floor division of an integral column by a positive width.

    ``div`` truncates toward zero (-5 div 10 = 0) and ``floor(x / w)`` goes through
    a double, losing exactness above 2**53. ``(x - pmod(x, w)) div w`` stays in long
    arithmetic and floors negatives (-5 -> -1).
    """
    if width <= 0:
        raise ValueError("bucket width must be positive")
    c = as_col(col).cast("long")
    w = F.lit(int(width)).cast("long")
    return F.call_function("div", c - F.pmod(c, w), w)


def bucket_id(col, width: int, null_bucket: int | None = 0) -> Column:
    """Bucket number ``floor(key / width)``; a null key goes to ``null_bucket``."""
    b = floor_div(col, width)
    return b if null_bucket is None else F.coalesce(b, F.lit(int(null_bucket)).cast("long"))

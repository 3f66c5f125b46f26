from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (list, tuple)):
        return list(x)
    return [x]


def as_col(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def as_value_col(x) -> Column:
    """A literal, or a Column (for example a lazy scalar subquery), as a Column."""
    return x if isinstance(x, Column) else F.lit(x)


def typed_lit(value, dtype) -> Column:
    """A literal of ``dtype`` (a type or its name), see ``control.literal``."""
    from pyspark.sql import types as T

    from tidemark.operators.control import literal
    return literal(value, T.DataType.fromDDL(dtype) if isinstance(dtype, str) else dtype)

"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", *,
               max_rows: int = 1_000_000, max_bytes: int = 256 << 20, known: tuple[int, int] | None = None) -> DataFrame:
    """Join, broadcasting ``small`` only if it has at most ``max_rows`` rows and ``max_bytes``.

    ``known``: rows and bytes of ``small``, or of something that holds it, if they were counted before.

    The check counts ``small`` and adds up its text and binary columns (a cheap, column-pruned
    action on a small side); above a bound the join is left to Spark (sort-merge, or a runtime
    broadcast when adaptive execution measures the side as small).
    """
    width = F.lit(8 * len(small.columns))
    for f in small.schema.fields:
        if f.dataType.typeName() in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
    n, size = known or small.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    side = F.broadcast(small) if n <= max_rows and size <= max_bytes else small
    return big.join(side, on, how)

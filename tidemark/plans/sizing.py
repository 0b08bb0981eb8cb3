"""Broadcast only behind a checked size bound.

``bounded_broadcast`` counts at most ``max_rows + 1`` rows of a *probe* whose
row count bounds the side to broadcast (by default the side itself). When the
bound holds the side is hinted for broadcast; otherwise it is returned as is
and Spark plans a shuffle join (AQE may still convert it at run time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dimension rows are narrow (< 200 bytes): 100k rows stay below ~20 MB.
MAX_BROADCAST_ROWS = 100_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    probe: DataFrame | None = None,
    factor: int = 1,
    known_bound: int | None = None,
) -> DataFrame:
    """Broadcast ``df`` if ``probe`` (default ``df``) has at most max_rows / factor rows.

    ``known_bound`` is an upper bound on the rows of ``df`` that holds by
    construction (e.g. a literal list, or one row per day of a fixed window);
    when it is within the limit no counting job is needed.
    """
    if known_bound is not None and known_bound <= max_rows:
        return F.broadcast(df)
    target = probe if probe is not None else df
    if row_count_at_most(target, max(max_rows // max(factor, 1), 0)):
        return F.broadcast(df)
    return df

"""Broadcast hints given only after the side was counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows up to which a narrow side (a few scalar columns) is broadcast; beyond it the join shuffles.
MAX_BROADCAST_ROWS = 200_000


def small_side(df: DataFrame, *, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else unchanged.

    The count reads at most ``max_rows + 1`` rows, so checking a large side stays cheap.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df

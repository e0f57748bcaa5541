"""Broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension row is a few hundred bytes at most, so a broadcast stays in the
# tens of megabytes even when sent to a thousand executors. Real dimensions are
# far smaller (51 states, ~130 diseases, 53 weeks a year).
MAX_BROADCAST_ROWS = 100_000


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      known_rows: int | None = None) -> DataFrame:
    """Mark `df` for broadcast when its row count is proven <= max_rows.

    `known_rows` is a bound known by construction (e.g. a literal lookup);
    otherwise the rows are counted, stopping at max_rows + 1. Beyond the
    bound the frame is returned unmarked and the join falls back to a
    shuffle join (which AQE may still convert from measured sizes).
    """
    if known_rows is not None and known_rows <= max_rows:
        return F.broadcast(df)
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df

"""When a small side may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A row here is a key and a few numbers, so this many rows are a few megabytes.
MAX_BROADCAST_ROWS = 10_000


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast of a frame known to have at most `max_rows` rows, if those are few.

    Beyond that the join is left to Catalyst, and a hot key to the adaptive skew join.
    """
    return F.broadcast(df) if max_rows <= MAX_BROADCAST_ROWS else df

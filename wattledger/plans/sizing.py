"""Measured broadcast decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# more than a century of hourly rows; at the width of the weather lookup well under 100 MB on an executor
MAX_BROADCAST_ROWS = 1_000_000


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; counting is one distributed job over ``df``."""
    return df.count() <= max_rows


def broadcast_within(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` hinted for broadcast if it has at most ``max_rows`` rows, else ``df`` as it is.

    The count is worth its job where the other side is a fact table that would have to be shuffled. Select narrow,
    fixed-width columns first, so that the row bound is a size bound.

    Without the hint Spark sort-merges both sides, and adaptive execution splits skewed partitions. It can only do so if
    ``df`` comes from a scan: the output of an aggregation should be written first (``storage.written``), which also
    saves deriving it again for the count.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df

"""Join strategy helpers.

A side is broadcast only after its size has been checked; beyond the bound
the join stays a plain equi-join, which Spark plans as a shuffle join (and AQE
may still convert at runtime from real statistics).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default row bound for a broadcast dimension. A zone lookup has a few hundred
# rows; 200k narrow rows stay a few MB in every executor.
BROADCAST_MAX_ROWS = 200_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    ``take`` scans partitions incrementally and stops as soon as
    ``max_rows + 1`` rows are seen, and only a constant column is fetched, so
    the check stays cheap and bounded even when the side turns out large
    (unlike ``limit(n).count()``, which funnels every task's rows to one reducer).
    """
    return len(df.select(F.lit(1).alias("one")).take(max_rows + 1)) <= max_rows


def fits_count(df: DataFrame, max_rows: int) -> bool:
    """The same for a plain table of files: its footers hold the count, and nothing but the count is fetched."""
    return df.count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint when the side is proven small, else the frame unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df

"""Date filters that reach both the Parquet scan and the partition directories.

``to_date(ts) BETWEEN a AND b`` alone is rewritten by Catalyst into a
timestamp range pushed to Parquet, but it does not touch the directory
partitions (``PartitionFilters: []``). When the table carries a derived day
column, the same predicate is added on it, which prunes whole directories.
A compacted table is partitioned by the first day of each folder instead; the
folder names tell which of them a range of days can touch.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_range(ts_col: str, start: str, end: str, day_col: str | None = None) -> Column:
    """Inclusive ``DATE(ts) BETWEEN start AND end`` (+ the partition-column twin)."""
    lo, hi = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    cond = F.to_date(F.col(ts_col)).between(lo, hi)
    if day_col:
        cond = cond & F.col(day_col).between(lo, hi)
    return cond


def bin_column(ts_col: str) -> str:
    """Partition column of a compacted table: the first day that a folder holds."""
    return f"{ts_col}_bin"


def bins_of(df: DataFrame, bin_col: str, start: str, end: str) -> Column:
    """Condition on the bins that can hold days of the range: from the last bin that begins by ``start`` to ``end``."""
    starts = {m for f in df.inputFiles() for m in re.findall(rf"/{re.escape(bin_col)}=(\d{{4}}-\d\d-\d\d)/", f)}
    first = max((s for s in starts if s <= start), default=start)
    return F.col(bin_col).between(F.to_date(F.lit(first)), F.to_date(F.lit(end)))


def trips_between(df: DataFrame, ts_col: str, start: str, end: str, day_col: str | None = None) -> DataFrame:
    if day_col is None and bin_column(ts_col) in df.columns:
        return df.where(day_range(ts_col, start, end) & bins_of(df, bin_column(ts_col), start, end))
    if day_col is None:
        cand = f"{ts_col}_day"
        day_col = cand if cand in df.columns else None
    return df.where(day_range(ts_col, start, end, day_col))

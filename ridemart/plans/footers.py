"""Counts and extents answered from Parquet footers and folder names: no row is read.

A warehouse answers such queries from its metadata. Spark can do the same
through the v2 Parquet source with aggregate push-down: a task reads a file's
footer, and partial results per file are summed. Both settings belong to a
session, so they are kept in a child session (same Spark context, own SQL
settings) that only reads these tables.

Limits of the source: counts, and minima and maxima of numbers and dates;
grouping by partition columns. Timestamps are not among them, so an extent in
time takes the first and the last day from the folder names and reads the
time column of these two days alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.operators.tables import partition_stats
from ridemart.operators.warehouse import row_count

_sessions: dict[str, SparkSession] = {}


def footer_session(spark: SparkSession) -> SparkSession:
    """A child session that reads Parquet through the v2 source and pushes aggregates into it."""
    app = spark.sparkContext.applicationId
    if app not in _sessions:
        child = spark.newSession()
        for k, v in spark.conf.getAll.items():
            if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
                child.conf.set(k, v)
        v1 = [s for s in child.conf.get("spark.sql.sources.useV1SourceList").split(",") if s and s != "parquet"]
        child.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
        child.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        _sessions[app] = child
    return _sessions[app]


def footers(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, read so that aggregates are answered from its footers."""
    return footer_session(spark).read.parquet(path)


def partition_counts(spark: SparkSession, path: str, partition_col: str, table_name: str) -> DataFrame:
    """:func:`partition_stats` of a partitioned table without reading its rows."""
    return partition_stats(footers(spark, path), partition_col, table_name)


def table_rows(spark: SparkSession, path: str, alias: str = "row_count") -> DataFrame:
    """``count(1)`` of a table without reading its rows."""
    return row_count(footers(spark, path), alias)


def extent(spark: SparkSession, path: str, ts_col: str, day_col: str, amount_col: str = "total_amount") -> DataFrame:
    """Latest and earliest time and largest amount of a table partitioned by the day of ``ts_col``.

    The amount and the outer days come from footers and folder names, the times
    from two day folders. Rows without a time lie in a day folder of their own
    and count for the amount only.
    """
    df = footers(spark, path)
    days = df.groupBy(day_col).agg(F.max(amount_col).alias("most"))
    ends = days.agg(F.min(day_col).alias("lo"), F.max(day_col).alias("hi"), F.max("most").alias("most")).first()
    outer = df.where(F.col(day_col).isin([d for d in (ends.lo, ends.hi) if d is not None]))
    return outer.agg(F.max(ts_col).alias("max_pickup"), F.min(ts_col).alias("min_pickup")).select(
        "max_pickup", "min_pickup", F.lit(ends.most).cast(df.schema[amount_col].dataType).alias(f"max_{amount_col}"))

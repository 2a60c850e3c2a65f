"""Warehouse queries over raw or laid-out trip tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.plans.pruning import trips_between


def distinct_vendors(df: DataFrame, ts_col: str, start: str, end: str) -> DataFrame:
    """``SELECT DISTINCT VendorID`` over a date range (A8). Partial distinct runs map-side."""
    return trips_between(df, ts_col, start, end).select("VendorID").distinct()


def count_trips(df: DataFrame, ts_col: str, start: str, end: str, vendor: int | None = None) -> DataFrame:
    """``count(*) AS trips`` over a date range and optionally one vendor."""
    x = trips_between(df, ts_col, start, end)
    if vendor is not None:
        x = x.where(F.col("VendorID") == vendor)
    return x.agg(F.count(F.lit(1)).alias("trips"))


def trip_extent(df: DataFrame, ts_col: str, amount_col: str = "total_amount") -> DataFrame:
    """Latest and earliest pickup, largest amount."""
    return df.agg(F.max(ts_col).alias("max_pickup"), F.min(ts_col).alias("min_pickup"),
                  F.max(amount_col).alias("max_total_amount"))


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """``count(1)``."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def sql(spark: SparkSession, query: str) -> DataFrame:
    """Ad-hoc SQL read to a frame."""
    return spark.sql(query)

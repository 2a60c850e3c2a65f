"""Staging: not-null filter, dedup, rename + cast to the conformed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemart.functions import num, payment_type_description, safe_int_of, surrogate_key
from ridemart.specs import STAGING_COLUMNS, Config, ServiceSpec


def dedup_trips(df: DataFrame, keys: list[str], tie_breakers: list[str] | None = None) -> DataFrame:
    """Keep one row per ``keys`` (W1 + P9).

    The row kept is the first in ascending order of ``tie_breakers`` (default:
    every other column, NULLs first), so the choice is repeatable; rows still
    tied are identical. ``row_number() = 1`` plans as a partial
    ``WindowGroupLimit`` before the shuffle, so each map task forwards at most
    one row per key: a hot key cannot pile up in one reducer.
    """
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in keys]
    order = [F.col(c).asc_nulls_first() for c in tie_breakers]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def stage_trips(raw: DataFrame, spec: ServiceSpec, config: Config = Config()) -> DataFrame:
    """Raw trips of one service -> conformed staging trips (21 columns)."""
    df = raw.where(F.col("VendorID").isNotNull())
    df = dedup_trips(df, ["VendorID", spec.pickup])
    cols = set(df.columns)

    def amount(name: str):
        return num(F.col(name)) if name in cols else num(F.lit(0))

    trip_type = safe_int_of(df, "trip_type") if "trip_type" in cols else F.lit(1).cast(T.LongType())
    out = df.select(
        surrogate_key("VendorID", spec.pickup).alias("tripid"),
        safe_int_of(df, "VendorID").alias("vendorid"),
        safe_int_of(df, "RatecodeID").alias("ratecodeid"),
        safe_int_of(df, "PULocationID").alias("pickup_locationid"),
        safe_int_of(df, "DOLocationID").alias("dropoff_locationid"),
        F.col(spec.pickup).cast(T.TimestampType()).alias("pickup_datetime"),
        F.col(spec.dropoff).cast(T.TimestampType()).alias("dropoff_datetime"),
        F.col("store_and_fwd_flag").cast(T.StringType()).alias("store_and_fwd_flag"),
        safe_int_of(df, "passenger_count").alias("passenger_count"),
        num("trip_distance").alias("trip_distance"),
        trip_type.alias("trip_type"),
        num("fare_amount").alias("fare_amount"),
        num("extra").alias("extra"),
        num("mta_tax").alias("mta_tax"),
        num("tip_amount").alias("tip_amount"),
        num("tolls_amount").alias("tolls_amount"),
        amount("ehail_fee").alias("ehail_fee"),
        num("improvement_surcharge").alias("improvement_surcharge"),
        num("total_amount").alias("total_amount"),
        F.coalesce(safe_int_of(df, "payment_type"), F.lit(0).cast(T.LongType())).alias("payment_type"),
        payment_type_description(df["payment_type"], df.schema["payment_type"].dataType)
        .alias("payment_type_description"),
    )
    assert out.columns == STAGING_COLUMNS
    if config.is_test_run:
        out = preview(out, config.dev_limit)
    return out


def preview(df: DataFrame, n: int = 100) -> DataFrame:
    """First ``n`` rows (S5, L2). Which rows is unspecified unless ``df`` is ordered."""
    return df.limit(n)

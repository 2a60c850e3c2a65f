"""Core models: zone dimension, unioned trips, trip fact, monthly revenue mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridemart.functions import month_start
from ridemart.plans.joins import maybe_broadcast
from ridemart.specs import FACT_COLUMNS, REVENUE_SUMS, STAGING_COLUMNS, UNKNOWN_BOROUGH


def dim_zones(seed: DataFrame) -> DataFrame:
    """Zone lookup -> dimension; 'Boro' in the service zone reads 'Green' (F9)."""
    return seed.select(
        "locationid", "borough", "zone",
        F.replace(F.col("service_zone"), F.lit("Boro"), F.lit("Green")).alias("service_zone"),
    )


def union_services(staged: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of conformed staging frames, each tagged with its service type.

    Frames are aligned by name, so a column order slip cannot shift values.
    """
    parts = [df.select(*STAGING_COLUMNS).withColumn("service_type", F.lit(label).cast(T.StringType()))
             for label, df in staged.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def enrich_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Inner-join trips to the known zones twice, pickup and dropoff.

    Trips whose pickup or dropoff zone is NULL, missing or of borough
    'Unknown' are dropped. The zone side is a lookup table; it is broadcast
    after a row-count check, so both joins run map-side without shuffling trips.
    """
    known = zones.where(F.col("borough") != UNKNOWN_BOROUGH).select("locationid", "borough", "zone")
    known = maybe_broadcast(known)
    pz = known.select(F.col("locationid").alias("_pu_id"), F.col("borough").alias("pickup_borough"),
                      F.col("zone").alias("pickup_zone"))
    dz = known.select(F.col("locationid").alias("_do_id"), F.col("borough").alias("dropoff_borough"),
                      F.col("zone").alias("dropoff_zone"))
    out = (trips.join(pz, trips["pickup_locationid"] == pz["_pu_id"], "inner")
                .join(dz, F.col("dropoff_locationid") == dz["_do_id"], "inner"))
    return out.select(*FACT_COLUMNS)


def fact_trips(staged: dict[str, DataFrame], zones: DataFrame) -> DataFrame:
    """Fact table: union of services, enriched with both zones (26 columns)."""
    return enrich_zones(union_services(staged), zones)


def monthly_zone_revenue(fact: DataFrame) -> DataFrame:
    """Revenue per pickup zone name, month and service (A1-A4).

    Sums stay DECIMAL(38,9) and skip NULLs (an all-NULL group sums to NULL);
    averages are returned as DOUBLE. Partial aggregation runs before the
    shuffle, so a hot zone costs one row per map task.
    """
    aggs = [F.sum(src).alias(dst) for src, dst in REVENUE_SUMS]
    aggs += [
        F.count("tripid").alias("total_monthly_trips"),
        F.avg("passenger_count").cast(T.DoubleType()).alias("avg_monthly_passenger_count"),
        F.avg("trip_distance").cast(T.DoubleType()).alias("avg_monthly_trip_distance"),
    ]
    return (fact.groupBy(F.col("pickup_zone").alias("revenue_zone"),
                         month_start("pickup_datetime").alias("revenue_month"),
                         F.col("service_type"))
                .agg(*aggs))
